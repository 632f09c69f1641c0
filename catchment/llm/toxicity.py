"""Toxicity by a linear-chain conditional random field over words.

Two tags, toxic and other. Emissions come from a word's features (the word
without case and outer marks, its first 3 to 6 and 8 letters), hashed into a
fixed weight vector; transitions let toxic words attract their neighbours.
Forward-backward gives every word's marginal; a document's score is a logistic
function of its marginals, and runs of words above one half are its offending
spans, with offsets.

Only documents are labelled, so the words' labels are derived: a feature that
stands in many toxic training documents and in almost no other marks its words
in toxic documents. All training uses a bounded sample, TOXIC_ROWS toxic and
CLEAN_ROWS other labelled documents at most, less near copies of each other;
scoring runs over all documents, in place, without a shuffle.

Defined cases: a null or empty text has no words and gets the score of a
document without toxic marginals; several labels of one id count as toxic if
one is; labels without a value are skipped; without labels of both kinds every
score is the share of toxic labels (0.5 without any), less 1e-6 from 0 and 1;
rows are scored one by one, so repeated rows and null ids get their own;
extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, flat, mix, ship, window_hashes, words, worker_state

TOXIC_ROWS = 1000
CLEAN_ROWS = 2000
FEATURE_BITS = 18
ROUNDS = 25
CACHE_ENTRIES = 500_000
SCORE_BYTES = 8 << 20  # every chunk takes as many steps as its longest text has words
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>*#$%&|-_/\\~^`+=@"


def word_features(word: bytes) -> list[int]:
    """Hashed features of a word."""
    w = word.decode("utf-8", "replace").lower().strip(_EDGE)
    keys = ["w" + w] + [f"{k}{w[:k]}" for k in (3, 4, 5, 6, 8) if len(w) >= k]
    return [xxhash.xxh3_64_intdigest(k) & ((1 << FEATURE_BITS) - 1) for k in keys]


def features_of(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of some words one after the other, and where each word's begin;
    no object stays for a word."""
    flat_features, sizes = array("q"), array("q", [0])
    for a in range(0, len(distinct), 10_000):
        for x in distinct.slice(a, 10_000).to_pylist():
            own = word_features(x)
            flat_features.extend(own)
            sizes.append(len(own))
    return np.array(flat_features, np.int64), np.cumsum(np.array(sizes, np.int64))


@dataclass
class Crf:
    """Weights: features, start, other-toxic, toxic-other and toxic-toxic;
    ``doc`` maps a document's marginals to its score."""

    feature: np.ndarray
    chain: np.ndarray
    doc: np.ndarray
    ident: int = 0

    def emissions(self, w: Words) -> np.ndarray:
        kept = worker_state("toxicity")
        if kept.get("crf") != self.ident:
            kept.update(crf=self.ident, cache={})
        cache = kept["cache"]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        out = np.empty(len(w.distinct))
        for i, x in enumerate(w.distinct.to_pylist()):
            e = cache.get(x)
            if e is None:
                e = cache[x] = float(self.feature[word_features(x)].sum())
            out[i] = e
        return out[w.code] if len(out) else out


def forward_backward(e: np.ndarray, bounds: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of toxic from the left (own emission in), from the right (own
    emission out), and the marginals, for all sequences at once: step t moves
    every sequence longer than t."""
    e = np.exp(np.clip(e, -30, 30))
    start, ot, to, tt = np.exp(np.clip(chain, -30, 30))
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    first, last = bounds[:-1][order], bounds[1:][order] - 1
    longer = np.searchsorted(-length[order], -np.arange(1, length.max(initial=0) + 1), side="right")  # sequences of t words or more
    left, right = np.empty(len(e)), np.ones(len(e))
    for t, k in enumerate(longer.tolist()):
        at = first[:k] + t
        if t == 0:
            left[at] = start * e[at]
        else:
            r = left[at - 1]
            left[at] = np.clip(e[at] * (ot + tt * r) / (1 + to * r), 1e-30, 1e30)
            at = last[:k] - t
            r = e[at + 1] * right[at + 1]
            right[at] = np.clip((to + tt * r) / (1 + ot * r), 1e-30, 1e30)
    odds = left * right
    return left, right, odds / (1 + odds)


def document_features(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document: 1, the log of its summed marginals, its largest one."""
    total = np.concatenate([[0.0], np.cumsum(p)])
    expected = np.maximum(total[bounds[1:]] - total[bounds[:-1]], 0)
    most = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        most[full] = np.maximum.reduceat(p, bounds[:-1][full])
    return np.stack([np.ones(len(most)), np.log(expected + 0.01), most], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _apart(w: Words, h: np.ndarray) -> np.ndarray:
    """Texts that share no least 5-word window with an earlier one."""
    at, gram = window_hashes(h, w.doc, 5)
    seen: set = set()
    keep = []
    for d, (a, b) in enumerate(zip(*(np.searchsorted(at, x) for x in (w.bounds[:-1], w.bounds[1:])), strict=True)):
        own = {int(gram[a:b].min()), int(mix(gram[a:b]).min())} if b > a else {h[w.bounds[d] : w.bounds[d + 1]].tobytes()}
        if not own & seen:
            keep.append(d)
        seen |= own
    return np.array(keep, np.int64)


def _surprise(a: np.ndarray, b: np.ndarray, n_a: float, n_b: float) -> np.ndarray:
    """Log-likelihood ratio (G squared) of a feature's share between classes."""
    share = n_a / (n_a + n_b)
    n = np.maximum(a + b, 1)
    term = lambda x, e: x * np.log(np.maximum(x, 1e-9) / e)
    return 2 * (term(a, n * share) + term(b, n * (1 - share)))


def fit(texts: list[str], toxic: list[int]) -> Crf:
    """A model from labelled documents."""
    crf = Crf(np.zeros(1 << FEATURE_BITS, np.float32), np.array([-4.0, -4.0, 0.0, 0.0]), np.zeros(3), int(mix(np.array([len(texts) + 1], np.uint64))[0]))
    y = np.array(toxic, float)
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
    if not 0 < y.sum() < len(y):
        crf.doc[0] = np.log(share / (1 - share))
        return crf
    arr = pa.array(texts, pa.string())
    w = words(*flat(arr))
    keep = _apart(w, w.hashes())
    y, w = y[keep], words(*flat(arr.take(pa.array(keep))))
    del arr
    n_words = len(w.distinct)
    feat, first = features_of(w.distinct)  # of word i: feat[first[i] : first[i + 1]]
    owner = np.repeat(np.arange(n_words), np.diff(first))

    # words' labels: features of many toxic and almost no other documents
    pair = np.unique(w.doc * n_words + w.code)
    df = np.zeros((2, 1 << FEATURE_BITS))
    doc_of, word_of = pair // n_words, pair % n_words
    del pair
    for d in range(len(y)):
        own = word_of[np.searchsorted(doc_of, d) : np.searchsorted(doc_of, d, side="right")]
        if len(own):
            size = first[own + 1] - first[own]
            at = np.arange(size.sum()) + np.repeat(first[own] - np.cumsum(size) + size, size)
            df[int(y[d]), np.unique(feat[at])] += 1
    n_toxic, n_other = y.sum(), len(y) - y.sum()
    strong = (df[1] / n_toxic >= 8 * (df[0] + 0.5) / n_other) & (_surprise(df[1], df[0], n_toxic, n_other) >= 2 * np.log(20 * (df.sum(axis=0) > 0).sum()))
    marks = np.zeros(n_words, bool)
    np.logical_or.at(marks, owner, strong[feat])
    tag = marks[w.code] & (y[w.doc] == 1)

    # gradient ascent (Adam) on the conditional likelihood of the tags
    weight = np.zeros(1 << FEATURE_BITS)
    weight[strong] = 2.0
    weight[~strong] = -1.0
    theta = np.concatenate([weight, crf.chain])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.flatnonzero(w.doc[:-1] == w.doc[1:]) if len(w.doc) > 1 else np.zeros(0, np.int64)
    starts = w.bounds[:-1][np.diff(w.bounds) > 0]
    for t in range(1, ROUNDS + 1):
        weight, chain = theta[:-4], theta[-4:]
        em = np.bincount(owner, weight[feat], minlength=n_words)[w.code]
        left, right, p = forward_backward(em, w.bounds, chain)
        per_word = np.bincount(w.code, tag - p, minlength=n_words)
        grad = np.zeros_like(theta)
        grad[:-4] = np.bincount(feat, per_word[owner], minlength=1 << FEATURE_BITS)
        _, ot, to, tt = np.exp(np.clip(chain, -30, 30))
        after = np.exp(np.clip(em[inner + 1], -30, 30)) * right[inner + 1]
        mass = np.stack([np.ones(len(inner)), ot * after, left[inner] * to, left[inner] * tt * after])
        mass /= mass.sum(axis=0)
        a, b = tag[inner], tag[inner + 1]
        seen = np.array([(~a & b).sum(), (a & ~b).sum(), (a & b).sum()], float)
        grad[-4] = (tag[starts] - p[starts]).sum()
        grad[-3:] = seen - mass[1:].sum(axis=1)
        grad -= 0.01 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    crf.feature, crf.chain = theta[:-4].astype(np.float32), theta[-4:]
    em = np.bincount(owner, crf.feature[feat], minlength=n_words)[w.code]
    crf.doc = _fit_logistic(document_features(forward_backward(em, w.bounds, crf.chain)[2], w.bounds), y)
    return crf


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str) -> tuple[list[str], list[int]]:
    """Texts and labels of at most TOXIC_ROWS + CLEAN_ROWS labelled documents
    for which ``train`` holds."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train).groupBy(F.col(id_col).alias("_labelled")).agg(F.max(label_col).alias("_label"))
    some = [known.filter(F.col("_label") == k).orderBy(F.xxhash64("_labelled"), "_labelled").limit(n) for k, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = some[0].union(some[1])
    texts = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), F.col("_own") == F.col("_labelled"))
    rows = rows.groupBy("_labelled").agg(F.min("_text").alias("text"), F.max("_label").alias("label")).orderBy("_labelled").collect()
    return [r["text"] or "" for r in rows], [int(r["label"]) for r in rows]


SCORED = "score double, spans array<struct<begin:int,end:int,weight:double>>"
_SPAN = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())])


def _spans(w: Words, p: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of words with a marginal of one half or more: code point offsets
    and the largest marginal."""
    hot = np.flatnonzero(p >= 0.5)
    new = np.ones(len(hot), bool)
    new[1:] = (hot[1:] != hot[:-1] + 1) | (w.doc[hot[1:]] != w.doc[hot[:-1]])
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(hot)) - 1 if len(first) else first
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    doc = w.doc[hot[first]]
    base = chars[offsets[:-1][doc]]
    values = pa.StructArray.from_arrays(
        [
            pa.array((chars[w.begin[hot[first]]] - base).astype(np.int32)),
            pa.array((chars[w.end[hot[final]]] - base).astype(np.int32)),
            pa.array(np.maximum.reduceat(p[hot], first) if len(first) else np.zeros(0)),
        ],
        fields=list(_SPAN),
    )
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offsets) - 1))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def toxicity(docs: DataFrame, crf: Crf, text_col: str = "text") -> Column:
    """Struct of score and offending spans of a text column."""
    model = docs.sparkSession.sparkContext.broadcast(crf)

    @F.arrow_udf(SCORED)
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for part in parts:
            out = [pa.StructArray.from_arrays([pa.array([], pa.float64()), pa.array([], pa.list_(_SPAN))], names=["score", "spans"])]
            for texts in chunks(part, SCORE_BYTES):
                raw, offsets = flat(texts)
                w = words(raw, offsets)
                p = forward_backward(m.emissions(w), w.bounds, m.chain)[2]
                z = document_features(p, w.bounds) @ m.doc
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                out.append(pa.StructArray.from_arrays([pa.array(score), _spans(w, p, raw, offsets)], names=["score", "spans"]))
            yield pa.concat_arrays(out)

    return of(F.col(text_col))


def held_out(id_col: Column) -> Column:
    """One fifth of all ids, never trained on."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id, held_out, score, predicted and offending spans of each document."""
    ship(docs.sparkSession)
    crf = fit(*training_rows(docs, labels, ~held_out(F.col(id_col)), id_col, text_col, label_col))
    scored = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), toxicity(docs, crf, text_col).alias("t"))
    return scored.select(id_col, "held_out", F.col("t.score").alias("score"), (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.col("t.spans").alias("spans"))
