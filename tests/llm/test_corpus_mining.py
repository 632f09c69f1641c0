"""Source divergence, language identification and phrase collocations."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catchment.llm import collocations, language_id, source_divergence
from catchment.llm.queries import QUERIES
from tests.conftest import rows, srt
from tests.llm import brute
from tests.llm.conftest import EXTRA

WORDS = {
    "en": "the river rose slowly after rain and fell over the weir station level".split(),
    "de": "der fluß stieg nach dem regen langsam über das wehr höhe pegel und".split(),
    "мир": "река вода дождь и под мостом над берегом".split(),
}


def mixed(seed=5, n=240):
    """Rows (id, text, lang, source): three languages, six sources of which one
    holds a third, null and empty cells, copies, odd characters."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        source = "big" if i % 3 == 0 else rnd.choice("abcde")
        ws = [rnd.choice(WORDS[lang][: 8 if source == "a" else None]) for _ in range(rnd.choice([3, 20, 60]))]
        ws = [w + rnd.choice(["", "", "", ".", ",", "\n", "42", "\t", "\x0b"]) for w in ws]
        out.append((i, " ".join(ws).capitalize(), lang, source))
    out += [(900, None, "en", "none"), (901, "", "en", "none"), (902, "12 34 !!", "xx", "y"), (903, "12", "xx", "z"), (904, "the river", None, None), (904, "the river", None, None)]
    out += [(905, "The River\x00rose", None, "s"), (906, "a 😀 b · c", "en", "a"), (None, "the the the the the", "en", "a"), (907, "x" * 1_200_000, "en", "a"), (908, "of the river " * 90_000, "en", "big")]
    return out


@pytest.fixture(scope="module")
def frame(spark):
    data = [(*r, *EXTRA, "l", "p") for r in mixed()]
    cols = ", ".join(f"{c} string" for c in [*EXTRA, "left", "phrase"])
    return spark.createDataFrame(data, f"doc_id bigint, text string, lang string, source string, {cols}").repartition(5)


@pytest.fixture(scope="module")
def plain():
    return mixed()


# --- source divergence -------------------------------------------------------
def test_divergence_equals_brute_force(frame, plain):
    want = brute.divergence([(lang, s, t) for _, t, lang, s in plain])
    assert rows(source_divergence.source_divergence(frame)) == srt(want)
    assert {w[2] for w in want} == {"pair", "term"} and ("xx", "y", "pair", "z", 0, 1) in want


def test_divergence_in_small_shards_and_limits(frame, plain, monkeypatch):
    monkeypatch.setattr(source_divergence, "SHARD_ROWS", 7)
    monkeypatch.setattr(source_divergence, "CELLS", 20)
    want = brute.divergence([(lang, s, t) for _, t, lang, s in plain], 2, 3)
    assert rows(source_divergence.source_divergence(frame, min_docs=2, top=3)) == srt(want)


def test_divergence_of_tasks_that_return_early(plain, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD_ROWS", 3)
    small = [r for r in plain if len(r[1] or "") < 10_000]
    table = pa.table({"lang": [x[2] or "" for x in small], "source": [x[3] or "" for x in small], "text": [x[1] for x in small]})
    parts = [b for b in source_divergence._task_counts(iter(table.to_batches(max_chunksize=4)))]
    assert len(parts) > 5
    total = source_divergence._merge([pa.Table.from_batches(parts)]).to_pylist()
    whole = source_divergence._count(table.to_batches()[0]).to_pylist()
    key = lambda r: (r["lang"], r["source"], r["term"] or "", r["n"], r["docs"])
    assert sorted(map(key, total)) == sorted(map(key, whole))


def test_shares_are_exact():
    rnd = random.Random(1)
    for _ in range(300):
        size, terms = rnd.randrange(9 * 10**15 - 10**7), rnd.randrange(1, 10**7)
        count = rnd.randrange(size + 1)
        got = source_divergence.shares(np.array([count]), np.array([size]), terms)
        assert int(got[0]) == 1 + 10**9 * (count + 1) // (size + terms)
    assert int(source_divergence.shares(np.array([5]), np.array([5]), 1)[0]) == 10**9 + 1


# --- language identification -----------------------------------------------------
def test_language_of_held_out_documents(frame, plain):
    got = {}
    for r in language_id.identify_language(frame).collect():
        got.setdefault(r.doc_id, []).append(r)
    seen = right = 0
    for i, t, lang, _ in plain:
        r = got[i][0]
        assert len(got[i]) == sum(x[0] == i for x in plain)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in {"en", "de", "мир", "xx"} and 0 < r.score <= 1
            if r.held_out and i < 900:
                seen += 1
                right += r.lang_pred == lang
    assert seen > 20 and right >= 0.95 * seen


def test_language_without_labels_and_with_one(spark, frame):
    none = frame.filter("false")
    assert language_id.identify_language(none).count() == 0
    some = spark.createDataFrame([(1, "words", None), (2, None, None)], "doc_id int, text string, lang string")
    assert rows(language_id.identify_language(some), "lang_pred", "score") == [("und", 0.0), ("und", 0.0)]
    one = spark.createDataFrame([(i, "some words here", "en") for i in range(40)], "doc_id int, text string, lang string")
    assert set(rows(language_id.identify_language(one), "lang_pred", "score")) == {("en", 1.0)}


def test_mean_embedding_equals_a_plain_loop():
    model = language_id.Model(["x"], np.random.default_rng(3).normal(size=(1 << language_id.BITS, language_id.DIM)), np.zeros((language_id.DIM, 1)), np.zeros(1))
    texts = ["Ab abab ü", "", None, "1 2", "ab"]
    got = model.means(pa.array(texts, pa.string()))
    for t, vector in zip(texts, got, strict=True):
        found = []
        for w in [x for x in brute.re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.fold(t or ""))]:
            raw = [0, *[b + 0 for b in w.encode()], 0]
            for n in language_id.SIZES:
                for i in range(len(raw) - n + 1):
                    h = n
                    for b in raw[i : i + n]:
                        h = (h * 0x9E3779B97F4A7C15 + b + 1) % 2**64
                    found.append(int(language_id.mix(np.array([h], np.uint64))[0]) >> (64 - language_id.BITS))
        want = model.vectors[found].mean(axis=0) if found else np.zeros(language_id.DIM)
        assert np.allclose(vector, want)


def test_calibrated_scores_and_rejection():
    rnd = np.random.default_rng(1)
    rows_ = []
    for i in range(400):  # two languages, one document in ten with the other's label
        lang = i % 2
        at = rnd.choice(50, 12, replace=False) + 50 * (lang if rnd.random() > 0.1 else 1 - lang)
        rows_.append(("ab"[lang], at, np.full(12, 1 / 12)))
    m = language_id.fit(["a", "b"], rows_)
    p = np.array([m.scores((share @ m.vectors[at])[None])[0].max() for _, at, share in rows_])
    assert 0.65 < p.mean() < 0.97  # nine tenths are right
    assert m.least > np.quantile(p, 0.5)  # 99 of 100 can be reached for few or none


# --- collocations ----------------------------------------------------------------
def test_collocations_equal_brute_force(frame, plain):
    data = [(lang, t) for _, t, lang, _ in plain]
    assert rows(collocations.mine_collocations(frame)) == srt(brute.collocations(data))
    small = [r for r in plain if len(r[1] or "") < 10_000]
    few = frame.filter("text IS NULL OR length(text) < 10000")
    want = brute.collocations([(lang, t) for _, t, lang, _ in small], 5, 3, 50, 90)
    assert rows(collocations.mine_collocations(few, least=3, top=50, closed=90)) == srt(want)
    assert max(w[1] for w in want) == 50 and any(w[2].count(" ") > 1 for w in want)
    want = brute.collocations([(lang, t) for _, t, lang, _ in small], 3, 2, None)
    assert rows(collocations.mine_collocations(few, max_words=3, least=2, top=None)) == srt(want)


def test_collocations_in_many_small_blocks(frame, plain, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKET_KEYS", 50)
    monkeypatch.setattr(collocations, "ORDER_ROWS", 3)
    small = [r for r in plain if len(r[1] or "") < 10_000]
    few = frame.filter("text IS NULL OR length(text) < 10000").repartition(9)
    assert rows(collocations.mine_collocations(few, least=2)) == srt(brute.collocations([(lang, t) for _, t, lang, _ in small], 5, 2))


def test_tally_of_dense_and_sparse_tiles(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TILE_BITS", 3)
    monkeypatch.setattr(collocations, "DENSE", 40)
    rnd = np.random.default_rng(2)
    left, right = (np.minimum(rnd.zipf(1.3, 3000), 2**31) - 1 for _ in range(2))
    keys, counts, which = collocations.tally(left, right)
    assert (np.diff(keys) > 0).all() and (counts == np.bincount(which, minlength=len(keys))).all()
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long")
    a, b = collocations.halves(F.col("key"))
    back = np.array(frame.select(a, b).collect())
    assert (back[which] == np.stack([left, right], 1)).all()


@pytest.mark.parametrize("numbers", [np.zeros(0, np.int64), np.array([3, -1, 2**31 - 1], np.int32), np.array([0, 2**62, -5])])
def test_packed_numbers(numbers):
    assert collocations.unpack(collocations.pack(numbers)).tolist() == numbers.tolist()


def test_scores_past_64_bits(spark):
    cases = [(10**12, 2 * 10**13, 10**12, 10**12 + 7), (10**12, 3 * 10**13, 2 * 10**12, 10**13), (100, 10**4, 100, 100)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", collocations._score(df.a, df.n, df.l, df.r)).collect()
    for a, n, left, right, s in map(tuple, got):
        assert s == 1000 * a * n // (left * right)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_collocations"])
def test_queries_on_edge_tables_equal_brute_force(spark, tables, docs, name):
    got = rows(QUERIES[name](spark, tables["edge"]))
    want = brute.divergence([("en", "s", t) for _, t in docs]) if "op11" in name else brute.collocations([("en", t) for _, t in docs])
    assert got == srt(want)
