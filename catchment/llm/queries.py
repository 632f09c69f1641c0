"""The registered queries of the package: one thin ``opN_<name>`` each, and
the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import decode, encode, load_ranks, pack
from .collocations import mine_collocations
from .common import table
from .decontaminate import find_contamination
from .language_id import identify_language
from .line_dedup import dedup_lines
from .ngram_jaccard import jaccard_components
from .quality_rules import judge_quality
from .sharding import assign_shards
from .source_divergence import source_divergence
from .substring_dedup import dedup_substrings
from .token_counts import count_tokens
from .toxicity import score_toxicity
from .url_filter import filter_urls


# Line dedup: words from which a later run of one or two lines is deleted too.
LONG_WORDS = 50


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_quality"
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return find_contamination(docs, bench, [F.col("doc_id")]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), shards=8)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, limit=1024)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = table(spark, sf_dir, "documents").select("doc_id", encode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("ids"))
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pack(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("clean", 256).alias("kept_sha256")
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), long_words=LONG_WORDS).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("clean", F.lit("")), 256).alias("kept_sha256")
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_language_id": op12_language_id,
    "op13_collocations": op13_collocations,
}

_OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM d JOIN reach r ON r.a = d.doc_id LEFT JOIN n USING (doc_id) GROUP BY 1, 2
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL) AS ids FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (g) WHERE first < doc_id),
ps AS (SELECT doc_id, list(DISTINCT p) AS ps FROM gone GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS clean
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d) t
  ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(clean, '')) AS kept_sha256
FROM d LEFT JOIN ps USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP10 = r"""
WITH lines AS (
  SELECT doc_id, no, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
        FROM documents)),
worded AS (
  SELECT doc_id, list(t ORDER BY no) AS ts, list(no ORDER BY no) AS nos,
    list(len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) ORDER BY no) AS words
  FROM lines WHERE t <> '' GROUP BY 1),
win AS (
  SELECT doc_id, s, i, array_to_string(ts[i:i + s - 1], chr(10)) AS g, nos[i:i + s - 1] AS nos,
    list_sum(words[i:i + s - 1]) AS words, len(ts) = s AS whole
  FROM (SELECT *, unnest(range(1, len(ts) - s + 2)) AS i FROM worded, range(1, 4) t(s) WHERE len(ts) >= s)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s, g ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(nos) AS no FROM ranked WHERE r > 1 AND (s = 3 OR words >= 50 OR whole)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.no) AS clean
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no WHERE g.no IS NULL GROUP BY 1),
n AS (SELECT doc_id, len(ts) AS n FROM worded),
m AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(m.n, 0) AS n_removed, sha256(coalesce(kept.clean, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM occ GROUP BY 1, 2, 3),
cell AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(n.n, 0) AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
size AS (SELECT lang, source, sum(n) AS size, count(*) AS v, sum(total) AS lang_size FROM cell GROUP BY 1, 2),
p AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 1)) // (size + v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (total + 1)) // (lang_size + v)::HUGEINT AS q
  FROM cell JOIN size USING (lang, source)),
pair AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item,
    coalesce(f.value, 0) AS value
  FROM grp g JOIN grp o ON o.lang = g.lang AND o.source <> g.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3) f
  ON f.lang = g.lang AND f.source = g.source AND f.other = o.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pair UNION ALL SELECT * FROM term),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_OP13 = r"""
WITH piece AS (
  SELECT lang, d, unnest(ps) AS p, generate_subscripts(ps, 1) AS i
  FROM (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
        FROM documents)),
ws AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, range(1, 6) t(k) WHERE len(w) >= k)
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM ws GROUP BY 1),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, n.n,
    (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c JOIN n USING (lang)
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cut),
inner_part AS (
  SELECT lang, phrase AS longer, a AS f, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_part x ON x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.f >= 100 * c.a),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst ANTI JOIN gone USING (lang, phrase) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM best WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": _OP2,
    "op5_decontamination": _OP5,
    "op9_substring_dedup": _OP9,
    "op10_line_dedup": _OP10,
    "op11_source_divergence": _OP11,
    "op13_collocations": _OP13,
}
