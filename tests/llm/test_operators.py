"""The operators' own interfaces: general forms, limits and edge cases."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catchment.llm import byte_bpe, decontaminate, line_dedup, ngram_jaccard, quality_rules, sharding, substring_dedup, toxicity, url_filter
from catchment.llm.common import chunks, flat, window_hashes, words
from tests.conftest import rows
from tests.llm import brute
from tests.llm.conftest import corpus, prose

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aB c\n\t\x0bé😀 |#", max_size=40)), max_size=12)


# --- shared kernels ----------------------------------------------------------
@SETTINGS
@given(TEXT)
def test_words_of_a_batch(texts):
    arr = pa.array(texts, pa.string())
    raw, offsets = flat(arr)
    w = words(raw, offsets)
    distinct = w.distinct.to_pylist()
    got = [[distinct[c].decode() for c in w.code[a:b]] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert got == [brute.WORD.findall(t or "") for t in texts]
    at, _ = window_hashes(w.hashes(), w.doc, 3)
    assert len(at) == sum(max(len(x) - 2, 0) for x in got)


@SETTINGS
@given(TEXT, st.integers(1, 50))
def test_chunks_cover_a_batch_in_order(texts, limit):
    arr = pa.array(texts, pa.string()).slice(0)
    assert [t for c in chunks(arr, limit) for t in c.to_pylist()] == texts


# --- quality -----------------------------------------------------------------
@SETTINGS
@given(TEXT)
def test_quality_counts(texts):
    got = quality_rules.count_features(pa.array(texts, pa.string())).to_pylist()
    assert got == [brute.quality_counts(t) for t in texts]


def test_label_model_recovers_planted_accuracies():
    rnd = np.random.default_rng(1)
    truth = rnd.random(4000) < 0.8
    accuracy, cover = np.array([0.95, 0.8, 0.7, 0.6]), np.array([0.9, 0.8, 0.9, 0.5])
    right = rnd.random((4000, 4)) < accuracy
    votes = np.where(rnd.random((4000, 4)) < cover, np.where(right == truth[:, None], 1, -1), 0)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = quality_rules.fit_label_model(patterns, counts.astype(float))[inverse.ravel()]
    majority = votes.sum(axis=1) > 0
    assert ((p >= 0.5) == truth).mean() >= max(0.9, (majority == truth).mean())


def test_kept_documents_have_all_their_columns(awkward, docs):
    kept = quality_rules.keep_quality(awkward)
    assert kept.columns == awkward.columns
    judged = quality_rules.judge_quality(awkward).filter("kept")
    assert rows(kept.select("doc_id")) == rows(judged.select("doc_id"))


# --- near copies ---------------------------------------------------------------
@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_components_with_large_groups_in_tiles(spark, monkeypatch, n, num, den):
    rnd = random.Random(n)
    seed = [f"w{rnd.randint(0, 400)}" for _ in range(90)]
    texts = []
    for _ in range(40):  # a family of near copies around the threshold
        own = list(seed)
        for _ in range(rnd.randint(0, 5)):
            own[rnd.randrange(len(own))] = f"x{rnd.randint(0, 9)}"
        texts.append(" ".join(own))
    texts += [prose(rnd, 50) for _ in range(10)] + texts[:5]
    rnd.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    want = brute.jaccard_components(docs, n, num, den)
    for limits in ({}, {"PAIR_GROUP": 2, "BLOCK": 8, "BEST": 1, "SHARE": 0.2}):
        for k, v in limits.items():
            monkeypatch.setattr(ngram_jaccard, k, v)
        got = ngram_jaccard.jaccard_components(df, n, num, den)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


@pytest.mark.parametrize("own", [1, 2])
def test_template_pages_that_do_not_link_make_no_square_of_candidates(spark, monkeypatch, own):
    """Pages of one template with a few own words each, below the similarity:
    four times the pages may bring four times the candidates, not sixteen."""
    made, real = {}, ngram_jaccard.stage
    candidates = ("near-pairs", "tile-pairs")

    def counting(df, name):
        out = real(df, name)
        if name in candidates:
            made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(ngram_jaccard, "stage", counting)
    monkeypatch.setattr(ngram_jaccard, "PAIR_GROUP", 16)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 64)
    words_of = 99 if own == 2 else 45
    found = {}
    for pages in (200, 800):
        texts = []
        for i in range(pages):
            page = [f"t{j}" for j in range(words_of)]
            for k in range(own):
                page[20 * (k + 1)] = f"own{i}x{k}"
            texts.append((i, " ".join(page)))
        made.clear()
        df = spark.createDataFrame(texts, "doc_id bigint, text string")
        got = ngram_jaccard.jaccard_components(df, 3, 90, 100)
        assert got.filter("component_id != doc_id").isEmpty()
        found[pages] = sum(made.values())
    assert found[800] <= 4 * max(found[200], 200)


def test_reach_is_the_largest_size_that_leaves_room(spark):
    for num, den in ((90, 100), (80, 100), (50, 100), (100, 100)):
        sizes = [(n, p) for n in range(1, 60) for p in range(n - -(-num * n // den) + 1)]
        got = spark.createDataFrame(sizes, "n long, p int").select("n", "p", ngram_jaccard.reach(F.col("n"), F.col("p"), num, den)).collect()
        for n, p, most in got:
            assert most == max(b for b in range(3 * n + 2) if (num + den) * (n - p) >= num * (n + b))


def test_one_per_component_keeps_rows_without_id(awkward, docs):
    kept = ngram_jaccard.one_per_component(awkward, 5, 80, 100)
    assert kept.columns == awkward.columns
    stay = [i for i, (_, c) in brute.jaccard_components(docs, 5, 80, 100).items() if i == c]
    assert rows(kept.select("doc_id")) == rows(awkward.sparkSession.createDataFrame([(i,) for i in [*stay, None, None, None]], "doc_id bigint"))


def test_components_of_a_path_graph(spark):
    from catchment.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, 120), (110, 120), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 110: 100, 120: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- decontamination -------------------------------------------------------------
def test_contamination_with_and_without_broadcast(spark, monkeypatch, docs):
    rnd = random.Random(4)
    items = [(i, prose(rnd, rnd.choice([3, 9, 10, 11, 40]))) for i in range(6)]
    mixed = [(i, (t or "") + " " + " ".join(items[i % 6][1].split()[: rnd.randint(2, 40)])) for i, t in docs]
    df, bench = spark.createDataFrame(mixed, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted((i, *brute.contamination(t, items)) for i, t in mixed)
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        got = decontaminate.find_contamination(df, bench, [F.col("doc_id")]).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == want


def test_clean_documents_stay_whole(spark, awkward, docs):
    bench = spark.createDataFrame([(1, docs[0][1])], "item_id bigint, text string")
    kept = decontaminate.drop_contaminated(awkward, bench)
    assert kept.columns == awkward.columns
    bad = {t for _, t in docs if brute.contamination(t, [(1, docs[0][1])])[1]}
    assert rows(kept, "doc_id", "text") == rows(awkward.filter(F.col("text").isNull() | ~F.col("text").isin(*bad)), "doc_id", "text")


# --- lines and substrings ----------------------------------------------------------
@pytest.mark.parametrize("run", [1, 2, 4])
def test_line_runs_of_other_lengths(spark, run):
    rnd = random.Random(run)
    docs = [(i, "\n".join(rnd.choice(["a", "b", " b ", "", "c d", "e"]) for _ in range(rnd.randint(0, 14)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc.doc_id: (r.n_lines, r.n_removed, r.clean) for r in line_dedup.dedup_lines(df, run).collect()}
    assert got == brute.dedup_lines(docs, run)


def test_lines_of_awkward_rows(awkward, docs):
    out = line_dedup.dedup_lines(awkward).collect()
    assert len(out) == awkward.count()
    first = [r for r in out if r.doc.doc_id == 1]
    assert [r.n_removed for r in first] == [0, 0]  # rows that repeat id and text are one document
    lone = [r for r in out if r.doc.doc_id is None and r.doc.text]
    assert all(r.n_removed == r.n_lines for r in lone)  # null ids come last
    assert [r.clean for r in out if r.doc.text is None] == [None] * sum(r.doc.text is None for r in out)
    kept = line_dedup.drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns and kept.filter("doc_id is null and text is not null").isEmpty()


@pytest.mark.parametrize("run, long_words", [(3, 50), (3, 6), (4, 5), (1, 2)])
def test_passages_of_few_lines(spark, run, long_words):
    rnd = random.Random(run * long_words)
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    docs = [(1, f"head\n{one}\ntail"), (2, f"other\n {one} \nend"), (3, f"p {two}\nq"), (4, f"z\np {two}\nq"), (5, "q"), (6, "lone line"), (7, "lone line"), (8, "a b\nc d"), (9, "\na b\n\n c d")]
    lines = ["a", "b c", " b c ", "", "d e f g", "h i j k l", "q"]
    docs += [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 6)))) for i in range(10, 60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc.doc_id: (r.n_lines, r.n_removed, r.clean) for r in line_dedup.dedup_lines(df, run, long_words=long_words).collect()}
    want = brute.dedup_passages(docs, run, long_words)
    assert got == want
    assert [want[i][1] for i in (2, 4, 5, 7, 9)] == ([1, 2, 1, 1, 2] if run > 1 else [want[i][1] for i in (2, 4, 5, 7, 9)])


@pytest.mark.parametrize("window, k", [(13, 5), (6, 2), (4, 4)])
def test_substring_windows(spark, window, k):
    rnd = random.Random(window)
    docs = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc.doc_id: (r.n_words, r.n_removed, r.clean) for r in substring_dedup.dedup_substrings(df, window, k).collect()}
    assert got == brute.dedup_substrings(docs, window)


def test_factors_name_their_source(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    other = " ".join(f"q{i}" for i in range(20))
    docs = [(1, "start " + passage), (2, other), (5, f"x {passage} {other} y"), (7, passage)]
    found = {r.doc: [tuple(f) for f in r.factors] for r in substring_dedup.factors(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {5: [(1, 30, 1), (31, 20, 2)], 7: [(0, 30, 1)]}


def test_substrings_of_awkward_rows(awkward, docs):
    out = substring_dedup.dedup_substrings(awkward).collect()
    assert len(out) == awkward.count()
    assert all(r.n_removed == 0 for r in out if r.doc.doc_id is None)
    assert [r.n_removed for r in out if r.doc.doc_id == 1] == [0, 0]
    assert set(out[0].doc.asDict()) == set(awkward.columns)


# --- sharding ------------------------------------------------------------------------
@SETTINGS
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20), st.integers(1, 40))
def test_jump_hash_is_the_published_one(keys, shards):
    got = sharding.jump_hash(np.array(keys, np.int64), shards)
    assert got.tolist() == [brute.jump(k % 2**64, shards) for k in keys]
    grown = sharding.jump_hash(np.array(keys, np.int64), shards + 1)
    assert all(a == b or b == shards for a, b in zip(got, grown, strict=True))


def test_slots_over_many_cells_and_repeated_rows(spark, monkeypatch, awkward):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 2)
    df = awkward.select("doc_id", "text").union(spark.range(300).select("id", F.lit("x")))
    out = sharding.assign_shards(df, 4).collect()
    assert len(out) == df.count()
    for s in range(4):
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own))) and len(own) > 40
    assert len({r.shard for r in out if r.doc_id is None}) == 1


def test_rows_that_repeat_id_and_text_fill_several_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 40)
    dealt, deal = [], sharding.deal_cells
    monkeypatch.setattr(sharding, "deal_cells", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    df = spark.range(300).select((F.col("id") % 3 * F.col("id")).alias("doc_id"), F.lit("x").alias("text")).repartition(4)
    out = sharding.assign_shards(df, 2).collect()
    assert len(out) == 300
    for s in range(2):
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own)))
    copies = sorted(r.slot for r in out if r.doc_id == 0)
    assert len(copies) == 100 and copies == list(range(copies[0], copies[0] + 100))
    sizes = [r["count"] for r in dealt[0].filter(F.col("cell.part") + F.col("cell.size") > 0).groupBy("shard", "cell").count().collect()]
    assert sum(sizes) == 100 and len(sizes) == 3 and max(sizes) < 60


# --- byte pairs --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def vocab():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return byte_bpe.Vocabulary(f.read())


@SETTINGS
@given(st.lists(st.binary(max_size=70), max_size=8))
def test_both_segment_trees_merge_like_a_plain_scan(vocab, pieces):
    def scan(piece):
        ids = [int(vocab.byte_id[b]) for b in piece]
        while True:
            found = [(vocab.pairs[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in vocab.pairs]
            if not found:
                return ids
            rank, i = min(found)
            ids[i : i + 2] = [rank]

    want = [scan(p) for p in pieces]
    assert [np.frombuffer(b, "<u4").tolist() for b in vocab.encode_pieces(pieces)] == want
    assert [vocab.encode_one(p) for p in pieces] == want


def test_long_pieces(vocab):
    piece = b"ab" * 3000 + b"\xff" * 500
    assert np.frombuffer(vocab.encode_pieces([piece])[0], "<u4").tolist() == vocab.encode_one(piece)


def test_unknown_ids_raise(spark):
    ranks = byte_bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    df = spark.createDataFrame([([99_999_999],)], "ids array<int>")
    with pytest.raises(Exception, match="IndexError"):
        df.select(byte_bpe.decode(F.col("ids"), ranks)).collect()


# --- toxicity ------------------------------------------------------------------------------
@SETTINGS
@given(st.lists(st.integers(0, 7), min_size=1, max_size=4), st.randoms(use_true_random=False))
def test_marginals_equal_an_enumeration(lengths, rnd):
    bounds = np.cumsum([0, *lengths])
    e = np.array([rnd.uniform(-3, 3) for _ in range(bounds[-1])])
    chain = np.array([rnd.uniform(-2, 2) for _ in range(4)])
    got = toxicity.forward_backward(e, bounds, chain)[2]
    start, ot, to, tt = chain
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if a == b:
            continue
        total, toxic = 0.0, np.zeros(b - a)
        for tags in itertools.product((0, 1), repeat=int(b - a)):
            score = start * tags[0] + sum(x * y for x, y in zip(tags, e[a:b], strict=True))
            score += sum((ot, tt)[p] * q + to * p * (1 - q) for p, q in zip(tags, tags[1:], strict=False))
            total += np.exp(score)
            toxic += np.exp(score) * np.array(tags)
        assert np.allclose(got[a:b], toxic / total)


def test_scores_and_spans_of_planted_words(spark):
    rnd = random.Random(2)
    rows_, labels = [], []
    for i in range(600):
        ws = prose(rnd, rnd.randint(10, 60)).split()
        bad = i % 3 == 0
        for _ in range(rnd.randint(2, 4) * bad):
            ws.insert(rnd.randrange(len(ws)), rnd.choice(["Vile!", "nasty", "grimfoo", "grimbar,"]))
        rows_.append((i, "é " + " ".join(ws)))
        labels.append((i, int(bad)))
    rows_ += [(1000, None), (1001, ""), (None, "nasty vile nasty")]
    docs = spark.createDataFrame(rows_, "doc_id bigint, text string")
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r.doc_id: r for r in out.collect()}
    truth, texts = dict(labels), dict(rows_)
    held = [i for i in truth if got[i].held_out]
    assert len(held) > 60 and np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    for i in held[:30]:
        for s in got[i].spans:
            assert any(w in texts[i][s.begin : s.end].lower() for w in ("vile", "nasty", "grim"))
    assert got[None].predicted == 1 and not got[None].held_out
    assert got[1000].score == got[1001].score < 0.5 and got[1000].spans == []


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, None)], [(1, 1), (2, 1)]])
def test_scores_without_labels_of_both_kinds(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    known = [y for _, y in labels if y is not None]
    want = np.clip(np.mean(known) if known else 0.5, 1e-6, 1 - 1e-6)
    assert np.allclose([r.score for r in out], want)


# --- urls ------------------------------------------------------------------------------------
@SETTINGS
@given(st.text(alphabet="abcd", max_size=9))
def test_viterbi_finds_the_cheapest_split(piece):
    counts, total = {"ab": 40, "abc": 5, "d": 30, "cd": 20, "a": 3, "bcd": 1}, 100

    def cost(parts):
        return sum(-math.log(counts[p] / total) if p in counts else math.log(total) + math.log(10) * len(p) for p in parts)

    def splits(s):
        return [[]] if not s else [[s[:k], *rest] for k in range(1, len(s) + 1) for rest in splits(s[k:])]

    got = url_filter.viterbi(piece, counts, total)
    assert "".join(got) == piece
    assert cost(got) == pytest.approx(min(map(cost, splits(piece))))


def own_pages(hide=""):
    """Pages of good hosts, of hosts with a block word, and of hosts that only
    share a word with these; ``hide`` is cut out of the urls that hold it."""
    text = "<p>free river station music casino bets pills news city park win cheap lake</p>"
    good = [f"https://www.{a}{b}.net/en/{i}" for i, (a, b) in enumerate([("river", "station"), ("city", "park"), ("news", "lake"), ("music", "city")] * 12)]
    bad = [f"http://{h}.net/en/{i}.html" for i, h in enumerate(["freecasino", "free-bets", "m.cheappills", "casino-win", "cheapfree-pills"] * 2)]
    urls = [u.replace(hide, "") if hide else u for u in good + bad] + [None, "", "no host", "http:///x", "http://freewin.net/en/7.html", "http://x.net/" + "ab" * 3000]
    return [(i, u, text if i % 2 else None) for i, u in enumerate(urls)], range(len(good), len(good) + len(bad)), len(good) + len(bad) + 4


def test_url_verdicts_equal_plain_bayes(spark):
    pages, bad, alike = own_pages()
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages + pages[:3]], "page_id long, url string, html string, host string, odds int")
    got = url_filter.filter_urls(frame, rules=[]).collect()
    assert len(got) == len(frame.collect())
    first, second = brute.url_odds(pages + pages[:3], url_filter.BLOCK_WORDS)
    want = sorted((p[0], a, b) for p, a, b in zip(pages + pages[:3], first, second, strict=True))
    for r, (i, a, b) in zip(sorted(got, key=lambda r: r.page_id), want, strict=True):
        assert r.page_id == i
        assert np.allclose([r.p_unseeded, r.p_block], [1 / (1 + math.exp(-a)), 1 / (1 + math.exp(-b))], atol=1e-5)
        assert r.verdict == ("block" if b >= 0 else "allow")
    blocked = {r.page_id for r in got if r.verdict == "block"}
    assert blocked == {*bad, alike}  # a host without a block word is blocked by the words beside them


@pytest.mark.parametrize("hidden", ["casino", "bets", "pills"])
def test_url_model_finds_hosts_whose_block_word_is_hidden(spark, hidden):
    pages, bad, _ = own_pages(hide=hidden)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.filter_urls(frame, rules=[]).collect()}
    assert all(got[i].verdict == "block" for i in bad if "free" in pages[i][1] or "cheap" in pages[i][1])
    assert all(got[i].verdict == "allow" for i in range(bad[0]))


def test_corpus_is_what_the_tests_assume():
    texts = [t for _, t in corpus()]
    assert None in texts and "" in texts and max(len(t or "") for t in texts) >= 9000


def test_toxicity_of_documents_with_clashing_columns(spark, awkward, docs):
    labels = spark.createDataFrame([(i, int(bool(t) and "BUY" in t), "a", 1) for i, t in docs], "doc_id bigint, toxic int, _id string, y int")
    wide = awkward.withColumns({c: F.lit(c) for c in ("y", "_label", "_labelled", "_text", "toxic", "label")})
    got = toxicity.score_toxicity(wide, labels)
    plain = toxicity.score_toxicity(awkward.select("doc_id", "text"), labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "spans"]
    assert rows(got, "doc_id", "score") == rows(plain, "doc_id", "score") and got.count() == awkward.count()
