"""Quality rules by weak supervision.

Each rule reads a few counts of a text and votes good (+1), bad (-1) or
abstains (0). The rules' accuracies are not set by hand: expectation
maximisation over the vote patterns of the whole corpus estimates, for good
and for bad documents, how often each rule casts each vote, and the posterior
probability of "good" replaces all-must-pass filtering.

Only the counts of the distinct vote patterns (3 ** rules at most, whatever
the corpus) reach the driver; texts are read in place and never shuffled.

Defined cases: a null or empty text has no words and fails the base rule;
rows are judged one by one, so ties, repeated rows, null ids and extra columns
change nothing; an empty table gives the starting model and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, flat, give_back, per_text, stage, unstage, words, worker_state

_COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_marks", "n_shouts", "n_digits",
]
FEATURES = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS])


def _bytes_in(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _bytes_in(b"#*$%&|<>")
_UPPER = _bytes_in(bytes(range(65, 91)))
_LETTER = _bytes_in(bytes([*range(65, 91), *range(97, 123)]))
_MARK = _bytes_in(b".!?")
_SHOUT = _bytes_in(b"!")
_DIGIT = _bytes_in(b"0123456789")
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80  # not a UTF-8 continuation byte


def _repeat_words(code: np.ndarray, doc: np.ndarray, n_codes: int, n_docs: int) -> np.ndarray:
    """Words of each text inside a 3-word window that the text holds twice."""
    if len(code) < 3:
        return np.zeros(n_docs, np.int64)
    at = np.flatnonzero(doc[:-2] == doc[2:])
    if n_codes < 1 << 21:  # three codes fit one integer
        key = (code[at] * n_codes + code[at + 1]) * n_codes + code[at + 2]
    else:
        _, pair = np.unique(code[at] * n_codes + code[at + 1], return_inverse=True)
        key = pair * n_codes + code[at + 2]
    order = np.lexsort((key, doc[at]))
    same = (key[order][1:] == key[order][:-1]) & (doc[at][order][1:] == doc[at][order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(code), dtype=bool)
    for j in range(3):
        covered[at[twice] + j] = True
    return np.bincount(doc[covered], minlength=n_docs)


def _lines(texts: pa.Array) -> tuple[list[int], list[int]]:
    """Lines with a word, and those of them equal to an earlier one."""
    n, dup = [], []
    for text in texts.to_pylist():
        own = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        n.append(len(own))
        dup.append(len(own) - len(set(own)))
    return n, dup


def count_features(texts: pa.Array) -> pa.Array:
    """The counts of ``FEATURES`` for a batch of texts."""
    parts: list[list[np.ndarray]] = []
    for part in chunks(texts):
        raw, offsets = flat(part)
        w = words(raw, offsets)
        n_lines, n_dup = _lines(part)
        n_bytes = np.concatenate([[0], np.cumsum(_CODE_POINT[raw], dtype=np.int64)])
        chars = np.concatenate([[0], np.cumsum(n_bytes[w.end] - n_bytes[w.begin])])
        count = lambda kind, raw=raw, offsets=offsets: per_text(kind[raw], offsets)
        parts.append(
            [
                np.diff(w.bounds),
                chars[w.bounds[1:]] - chars[w.bounds[:-1]],
                count(_SYMBOL),
                np.array(n_dup),
                _repeat_words(w.code, w.doc, len(w.distinct), len(part)),
                np.array(n_lines),
                *(count(k) for k in (_UPPER, _LETTER, _MARK, _SHOUT, _DIGIT)),
            ]
        )
    cols = [np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for i in range(len(_COUNTS))]
    return pa.StructArray.from_arrays([pa.array(c) for c in cols], names=_COUNTS)


def quality_counts(text: Column, once: bool = False) -> Column:
    """The counts of a text. With ``once`` the planner may not copy the call,
    so that all that is derived from the counts shares one evaluation."""

    @F.arrow_udf(FEATURES)
    def counts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("quality_rules")
        for t in parts:
            yield count_features(t)
        give_back()

    return counts.asNondeterministic()(text) if once else counts(text)


def rule_votes(f: Column) -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains. A rule that looks for one
    defect abstains where it finds none: its absence is no praise."""
    n = f["n_words"]
    never = F.lit(False)

    def vote(bad: Column, good: Column = never) -> Column:
        return F.when(n == 0, F.lit(0)).when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))

    marred = (10 * f["n_symbols"] > n) | (3 * f["n_upper"] > f["n_letters"]) | (10 * f["n_shouts"] > n) | (5 * f["n_digits"] > f["word_chars"])
    plain = (50 * f["n_symbols"] <= n) & (6 * f["n_upper"] <= f["n_letters"]) & (50 * f["n_shouts"] <= n) & (10 * f["n_digits"] <= f["word_chars"])
    return {
        "symbols": vote(5 * f["n_symbols"] > n),
        "capitals": vote(2 * f["n_upper"] > f["n_letters"]),
        "shouts": vote(5 * f["n_shouts"] > n),
        "lines": vote(10 * f["n_dup_lines"] > 3 * f["n_lines"]),
        "repeats": vote(10 * f["n_repeat_words"] > 3 * n),
        "plain": vote(marred, plain),
        "word_length": vote((f["word_chars"] < 2 * n) | (f["word_chars"] > 12 * n)),
        "sentences": vote(n > 100 * f["n_marks"], (n >= 3 * f["n_marks"]) & (n <= 60 * f["n_marks"])),
    }


def pattern_of(f: Column) -> Column:
    """All votes of a document as one base-3 number."""
    out = F.lit(0)
    for v in rule_votes(f).values():
        out = out * 3 + v + 1
    return out.cast("int")


def base_failed(f: Column) -> Column:
    return (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> np.ndarray:
    """Posterior of "good" for every vote pattern (votes in {-1, 0, 1}).

    Two latent classes; per class each rule has its own chance of each vote.
    The start is the majority vote, which also fixes which class is "good".
    """
    if not len(patterns):
        return np.zeros(0)
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    total = counts.sum()
    cast = np.maximum(np.abs(patterns).sum(axis=1), 1)
    good = np.clip(0.5 + 0.45 * patterns.sum(axis=1) / cast, 0.05, 0.95)
    for _ in range(rounds):
        log = np.zeros((2, len(patterns)))
        for k, share in enumerate((1 - good, good)):
            weight = share * counts
            table = np.einsum("p,prv->rv", weight, onehot) + 1.0
            table /= table.sum(axis=1, keepdims=True)
            log[k] = np.log((weight.sum() + 1) / (total + 2)) + np.einsum("prv,rv->p", onehot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        if np.abs(new - good).max() < tol:
            return new
        good = new
    return good


def label_model(patterns: DataFrame) -> DataFrame:
    """(pattern, p_quality) from the counts of vote patterns."""
    rules = len(rule_votes(F.struct(*(F.lit(0).alias(c) for c in _COUNTS))))
    rows = sorted(patterns.select("pattern", "count").collect())  # 3 ** rules rows at most
    number = np.array([r[0] for r in rows], dtype=np.int64)
    votes = np.stack([number // 3 ** (rules - 1 - k) % 3 - 1 for k in range(rules)], axis=1)
    p = fit_label_model(votes, np.array([r[1] for r in rows], dtype=float))
    return patterns.sparkSession.createDataFrame([(int(a), float(b)) for a, b in zip(number, p, strict=True)], "pattern int, p_quality double")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: id, counts, posterior and the verdict."""
    f = docs.select(F.col(id_col), quality_counts(F.col(text_col)).alias("f"))
    staged = stage(f.select(id_col, "f", pattern_of(F.col("f")).alias("pattern")), "quality")
    model = label_model(staged.groupBy("pattern").count())
    return staged.join(F.broadcast(model), "pattern").select(
        id_col,
        *(F.col("f")[c].alias(c) for c in _COUNTS),
        "p_quality",
        base_failed(F.col("f")).alias("base_failed"),
        (~base_failed(F.col("f")) & (F.col("p_quality") >= threshold)).alias("kept"),
    )


def keep_quality(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that the rules keep, with all their columns; the second
    pass counts again in place, so no text is shuffled or stored."""
    counted = docs.select(F.struct("*").alias("doc"), quality_counts(F.col(text_col), once=True).alias("f"))
    votes = counted.select("doc", "f", pattern_of(F.col("f")).alias("pattern"))
    patterns = stage(votes.select("pattern"), "patterns")
    model = label_model(patterns.groupBy("pattern").count())
    unstage(patterns)
    judged = votes.join(F.broadcast(model), "pattern").filter(~base_failed(F.col("f")) & (F.col("p_quality") >= threshold))
    return judged.select("doc.*")
