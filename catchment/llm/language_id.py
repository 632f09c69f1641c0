"""Language of a text by averaged hashed subword embeddings.

A text's words are its runs of ASCII letters (A-Z folded) and characters
beyond ASCII. Every word gives the hashes of its 2 to 4 byte pieces, with a
mark before and after the word; a text is the mean of the embeddings of all
pieces of all its words, and a linear softmax over that mean gives the
languages. Embeddings and softmax are trained together by stochastic gradient
descent in numpy, one document a step. A part of the training documents is
kept from the descent: it sets the temperature of the softmax, so that a score
is the chance of being right, and the least score at which TARGET of the
accepted documents are right; below it a prediction is returned, but rejected.

Training uses about ROWS labelled documents in all, dealt evenly to the
languages (PER_LANG at most, MIN_LANG at least for each), chosen by a hash of
their text so that copies count once. Tasks turn them into sparse vectors of
at most 2^BITS entries; texts do not leave the tasks. Predictions run over all
documents, in place, without a shuffle, on a model of fixed size.

Defined cases: a null text or one without a letter (Unicode category L) is
``und`` with score 0, rejected; without any labelled training document every
text is; with one language only, that language has score 1. Rows with a null
id or language are predicted, but never learned from; repeated rows are
predicted one by one; extra columns are not read. More than MAX_LANGS labels
raise ValueError. Long texts are handled whole, a task holds one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, give_back, mix, ship
from .runs import FOLD, LETTERS, Runs, cut

ROWS, PER_LANG, MIN_LANG = 4000, 600, 20
MAX_LANGS = 10_000
BITS = 15
DIM = 16
SIZES = (2, 3, 4)  # bytes of a piece
EPOCHS, RATE = 8, 0.5
CALIBRATION = 4  # one training document in so many is kept from the descent
TARGET = 0.99
UND = "und"


def pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word and bucket of every piece of some distinct words."""
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size + 2)
    raw = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    body = np.ones(len(raw), bool)
    body[ends - 1] = body[ends - size - 2] = False
    raw[body] = flat(words)[0]
    raw += np.uint64(1)
    word = np.repeat(np.arange(len(size)), size + 2)
    owner, bucket = [], []
    for n in SIZES:
        k = len(raw) - n + 1
        if k <= 0:
            break
        h = np.full(k, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + raw[j : j + k]
        inside = word[:k] == word[n - 1 :]
        owner.append(word[:k][inside])
        bucket.append((mix(h[inside]) >> np.uint64(64 - BITS)).astype(np.int64))
    return (np.concatenate(owner), np.concatenate(bucket)) if owner else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _letters(texts: pa.Array) -> Runs:
    raw, offsets = flat(texts)
    return cut(FOLD[raw], offsets, LETTERS)


@dataclass
class Model:
    langs: list[str]
    vectors: np.ndarray  # bucket x dimension
    weights: np.ndarray  # dimension x language
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # score from which a prediction is accepted

    def means(self, texts: pa.Array) -> np.ndarray:
        """Mean embedding of each text's pieces (zero without any)."""
        w = _letters(texts)
        owner, bucket = pieces(w.distinct)
        n_words, n_texts = len(w.distinct), len(texts)
        count = np.bincount(w.doc, np.bincount(owner, minlength=n_words)[w.code], minlength=n_texts)
        out = np.empty((n_texts, self.vectors.shape[1]))
        for j in range(out.shape[1]):
            of_word = np.bincount(owner, self.vectors[bucket, j], minlength=n_words)
            out[:, j] = np.bincount(w.doc, of_word[w.code], minlength=n_texts)
        return out / np.maximum(count, 1)[:, None]

    def scores(self, mean: np.ndarray) -> np.ndarray:
        return softmax((mean @ self.weights + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(langs: list[str], vectors: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """A model from (language, buckets, shares) of documents; ``shares`` add up
    to one, and the order of the documents decides which are kept for
    calibration."""
    rnd = np.random.default_rng(seed)
    model = Model(langs, rnd.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)), np.zeros((DIM, len(langs))), np.zeros(len(langs)))
    if not langs:
        return model
    at = {x: i for i, x in enumerate(langs)}
    held = [v for i, v in enumerate(vectors) if i % CALIBRATION == CALIBRATION - 1]
    used = [v for i, v in enumerate(vectors) if i % CALIBRATION != CALIBRATION - 1]
    steps, done = EPOCHS * len(used), 0
    for _ in range(EPOCHS):
        for i in rnd.permutation(len(used)):
            lang, bucket, share = used[i]
            mean = share @ model.vectors[bucket]
            miss = softmax(mean @ model.weights + model.bias)
            miss[at[lang]] -= 1
            rate = RATE * (1 - done / steps)
            back = model.weights @ miss
            model.weights -= rate * np.outer(mean, miss)
            model.bias -= rate * 0.1 * miss
            # a piece's own share is small: its step is that of the mean, times its pieces
            model.vectors[bucket] -= rate * np.minimum(share * len(bucket), 10.0)[:, None] * back
            done += 1
    if held:
        z = np.array([share @ model.vectors[bucket] for _, bucket, share in held]) @ model.weights + model.bias
        y = np.array([at[lang] for lang, _, _ in held])
        # smoothed targets: without a mistake in the sample no temperature would be low enough
        want = np.full(z.shape, 1 / (len(y) + 2) / max(len(langs) - 1, 1))
        want[np.arange(len(y)), y] = (len(y) + 1) / (len(y) + 2)
        loss = lambda t: -(want * np.log(softmax(z / t) + 1e-12)).sum(axis=1).mean()
        model.temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
        p = softmax(z / model.temperature)
        best, right = p.max(axis=1), p.argmax(axis=1) == y
        order = np.argsort(-best)
        good = np.flatnonzero(np.cumsum(right[order]) >= TARGET * np.arange(1, len(y) + 1))
        model.least = float(best[order][good[-1]]) if len(good) else float(best.max())
    return model


def held_out(id_col: Column) -> Column:
    """One fifth of all ids, never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of training documents, each text once in a task."""
    seen: set[int] = set()
    for batch in batches:
        rows = [i for i, k in enumerate(batch["key"].to_pylist()) if not (k in seen or seen.add(k))]
        kept = batch.take(pa.array(rows, pa.int64()))
        for i in range(len(kept)):
            w = _letters(kept["text"].slice(i, 1))
            owner, bucket = pieces(w.distinct)
            total = np.bincount(bucket, np.bincount(w.code, minlength=len(w.distinct))[owner], minlength=1 << BITS)
            at = np.flatnonzero(total)
            if len(at):
                share = (total[at] / total.sum()).astype("<f4")
                yield pa.record_batch([kept["key"].slice(i, 1), kept["lang"].slice(i, 1), pa.array([at.astype("<i4").tobytes()]), pa.array([share.tobytes()])], names=["key", "lang", "at", "share"])
    give_back()


def training_vectors(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], list[tuple[str, np.ndarray, np.ndarray]]]:
    """The languages of all training documents and a bounded sample's vectors."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of {lang_col}")
    if not counts:
        return [], []
    each = max(MIN_LANG, min(PER_LANG, ROWS // len(counts)))
    scale = 1 << 30
    limits = docs.sparkSession.createDataFrame([(x, min(scale, -(-scale * each // n))) for x, n in counts.items()], "lang string, least long")
    key = F.xxhash64("text", F.lit("language"))
    some = known.join(F.broadcast(limits), "lang").filter(F.pmod(key, F.lit(scale)) < F.col("least")).select(key.alias("key"), "lang", "text")
    found = some.mapInArrow(_sparse, "key long, lang string, at binary, share binary").dropDuplicates(["key", "lang"]).orderBy("key", "lang")
    vectors = [(r["lang"], np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["share"], "<f4").astype(float)) for r in found.toLocalIterator()]
    return sorted(counts), vectors


PREDICTED = "lang_pred string, score double, accepted boolean"


def language(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Struct of language, score and acceptance of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTED)
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        names = pa.array([*m.langs, UND], pa.string())
        for part in parts:
            out = [pa.StructArray.from_arrays([pa.array([], t) for t in (pa.string(), pa.float64(), pa.bool_())], names=["lang_pred", "score", "accepted"])]
            for texts in chunks(part):
                lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                best, score = np.full(len(texts), len(m.langs)), np.zeros(len(texts))
                if m.langs:
                    p = m.scores(m.means(texts))
                    best = np.where(lettered, p.argmax(axis=1), best)
                    score = np.where(lettered, p.max(axis=1), score)
                good = lettered & bool(m.langs) & (score >= m.least)
                out.append(pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(score), pa.array(good)], names=["lang_pred", "score", "accepted"]))
            yield pa.concat_arrays(out)
        give_back()

    return of(F.col(text_col))


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score and accepted of each document."""
    ship(docs.sparkSession)
    model = fit(*training_vectors(docs, id_col, text_col, lang_col))
    told = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), language(docs, model, text_col).alias("t"))
    return told.select(id_col, "held_out", "t.lang_pred", "t.score", "t.accepted")
