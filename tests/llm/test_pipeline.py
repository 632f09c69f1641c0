"""corpus_pipeline against a brute-force version, stage by stage."""

import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute


def test_stages_equal_brute_force(spark, tables, docs):
    rows = spark.read.parquet(tables["edge"] + "/documents.parquet")
    columns = rows.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(tables["edge"] + "/benchmark.parquet").collect()]
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    want = dict(docs)
    judged = brute.judge_quality(docs)
    steps = {}
    want = steps["quality_rules"] = {i: t for i, t in want.items() if judged[i][2]}
    cut = brute.dedup_lines(list(want.items()))
    want = steps["line_dedup"] = {i: cut[i][2] for i in want if cut[i][1] == 0 or cut[i][1] < cut[i][0]}
    comp = brute.jaccard_components(list(want.items()), 5, 80, 100)
    want = steps["ngram_jaccard"] = {i: t for i, t in want.items() if comp[i][1] == i}
    want = steps["decontamination"] = {i: t for i, t in want.items() if not brute.contamination(t, items)[1]}
    assert len(docs) > len(steps["quality_rules"]) > len(steps["ngram_jaccard"]) > len(want) > 5

    assert [name for name, _ in corpus_pipeline.STAGES] == [*steps, "byte_bpe"]
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        path = f"{tables['edge']}/stage-{k}"
        step(spark, rows, tables["edge"]).write.parquet(path)
        rows = spark.read.parquet(path)
        if name in steps:
            assert rows.columns == columns
            assert {r.doc_id: r.text for r in rows.collect()} == steps[name], name
            assert all(r.n_chars == len(r.text) for r in rows.collect())
    assert {r.doc_id: (r.ids, r.n_tokens) for r in rows.collect()} == {i: (enc.encode_ordinary(t), len(enc.encode_ordinary(t))) for i, t in want.items()}


def test_run_gives_the_last_stage(spark, tables):
    out = corpus_pipeline.run(spark, tables["edge"])
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens"] and out.count() > 5
    assert corpus_pipeline.run(spark, tables["empty"]).count() == 0


def test_passages_of_one_and_two_lines_go(spark, tables):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(1, f"head\n{one}\ntail"), (2, f"other\n{one}\nend"), (3, f"p {two}\nq"), (4, f"z\np {two}\nq"), (5, one)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], spark.read.parquet(tables["edge"] + "/documents.parquet").schema)
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, df, tables["edge"]).collect()}
    assert got == {1: rows[0][1], 2: "other\nend", 3: rows[2][1], 4: "z"}


def test_ids_that_do_not_decode_to_the_text_fail(spark, tables, monkeypatch):
    df = spark.createDataFrame([(1, "two words", "en", "s", 9), (None, None, "en", "s", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [r.n_tokens for r in corpus_pipeline.byte_bpe(spark, df, "").orderBy("doc_id").collect()] == [0, 2]
    encode = corpus_pipeline.encode
    monkeypatch.setattr(corpus_pipeline, "encode", lambda *a: F.slice(encode(*a), 1, 1))
    with pytest.raises(Exception, match="do not decode to the text of document 1"):
        corpus_pipeline.byte_bpe(spark, df, "").collect()


def test_only_the_result_stays_in_the_shared_folder(spark, tables):
    from pathlib import Path

    from catchment.llm.common import shared_root

    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.glob("stage-*"))
    out = corpus_pipeline.run(spark, tables["edge"])
    assert [Path(out.staged_path)] == sorted(set(root.glob("stage-*")) - before)
    assert out.count() > 0
