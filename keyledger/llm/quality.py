"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer numpy network whose probabilities are calibrated by a temperature.

Random indexing gives every item a fixed sparse ternary vector drawn from its
hash; nothing has to be stored or agreed on between workers.  A word's vector is
the sum, over all its occurrences in all documents, of the index vectors of its
left and right neighbours (under other seeds, so order counts), scaled to length
one: words used alike point alike.  Words are told apart by ``BUCKET_BITS`` bits of
their hash, so the table of vectors is bounded whatever the corpus; it is summed by
a shuffle of its entries.  A document's vector is the mean of its words' vectors;
beside it stand the mean index vectors of what its words are made of (the word,
its first and last three bytes, its shape) and a few whole-text rates.

The network is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``,
those with the smallest hash of the id), none of them held out; the scores
cover every document and its whole text.  Labels, lang, source and doc_id are
never inputs of a score.

Defined cases: a null text counts as empty and is scored like any other; a
label that is null is not learnt from; with no labels, or labels of one kind,
every score is the share of label 1 (0.5 without labels).  The score depends on
the text alone, so repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, keep_rows, seeded_uint, table, text_key, text_or_empty
from keyledger.llm.words import Words, blocks_of_texts, mix

SAMPLE_ROWS = 6000      # labelled rows the network is fitted on, at most
HELD_OUT = 2            # remainder of crc32(doc_id) mod FOLDS that is never learnt from
FOLDS = 4
THRESHOLD = 0.7
DIM_BITS = 8
DIM = 1 << DIM_BITS     # of the random-index vectors
NONZERO = 2             # entries of an index vector that are not zero
HIDDEN = 32
EPOCHS = 400
SEED = 20240131
KINDS = ("word", "prefix", "suffix", "shape")
SIDES = ("left", "right")
BUCKET_BITS = 14        # words share a vector if so many bits of their hashes agree
CONTEXT_BITS = 6
CONTEXT = 1 << CONTEXT_BITS  # entries of a word's vector
AT_ONCE = 1 << 16       # words whose vectors are added at a time
N_RATES = 11


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT


def _index_sum(keys: np.ndarray, rows: np.ndarray, out: np.ndarray, bits: int = DIM_BITS) -> None:
    """Add the sparse ternary vectors of ``keys`` to ``out`` (flat, 2^bits entries
    for each row); ``rows`` is where each key's row begins."""
    h = mix(keys)
    for _ in range(NONZERO):
        cell = rows + (h & np.uint64((1 << bits) - 1)).view(np.int64)
        sign = 1.0 - 2.0 * ((h >> np.uint64(bits)) & np.uint64(1)).astype(np.float64)
        out += np.bincount(cell, weights=sign, minlength=len(out))
        h = h >> np.uint64(bits + 1)


def _neighbours(doc: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """The keys of each word's left and right neighbours in its document (none: 0)."""
    left, right = np.zeros_like(word), np.zeros_like(word)
    inside = doc[1:] == doc[:-1]
    left[1:][inside] = word[:-1][inside]
    right[:-1][inside] = word[1:][inside]
    return [left, right]


def bucket_of(word: np.ndarray) -> np.ndarray:
    return (mix(word) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def context_sums(texts: list[bytes]) -> np.ndarray:
    """The index vectors of the neighbours of all words, summed by the word's bucket (flat)."""
    out = np.zeros(1 << BUCKET_BITS + CONTEXT_BITS)
    w = Words(texts)
    if len(w.doc):
        word = w.keys()
        rows = bucket_of(word) << CONTEXT_BITS
        for side, key in zip(SIDES, _neighbours(w.doc, word), strict=True):
            there = key != 0
            _index_sum(key[there] ^ np.uint64(seeded_uint(SEED, side)), rows[there], out, CONTEXT_BITS)
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The words' vectors, by bucket.  Tasks sum over their own rows and send the
    entries that are not zero; the table's size does not depend on the input's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS + CONTEXT_BITS)
        for texts, _ in blocks_of_texts(batches, []):
            total += context_sums(texts)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell].astype(np.int64))], names=["cell", "n"])

    sums = np.zeros(1 << BUCKET_BITS + CONTEXT_BITS)
    got = docs.select(text_or_empty().alias("text")).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return unit_rows(sums.reshape(-1, CONTEXT))


def unit_rows(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return (x / np.where(size > 0, size, 1)).astype(np.float32)


def pooled(doc: np.ndarray, word: np.ndarray, n: int, vectors: np.ndarray) -> np.ndarray:
    """The sum of the words' vectors in each of ``n`` documents."""
    out, bucket = np.zeros((n, CONTEXT)), bucket_of(word)
    for a in range(0, len(doc), AT_ONCE):
        part = doc[a:a + AT_ONCE]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        out[part[first]] += np.add.reduceat(vectors[bucket[a:a + AT_ONCE]], first, axis=0, dtype=np.float64)
    return out


def features(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One row per text: CONTEXT entries of its words' vectors, DIM of their index
    vectors, and N_RATES rates."""
    n = len(texts)
    w = Words(texts)
    doc, out, rates, context = w.doc, np.zeros(n * DIM), np.zeros((n, N_RATES)), np.zeros((n, CONTEXT))
    n_words = np.bincount(doc, minlength=n)
    count = np.maximum(n_words, 1)
    if len(doc):
        size = w.end - w.start
        word = w.keys()
        first = w.hash_of(w.start, np.minimum(w.start + 3, w.end))
        last = w.hash_of(np.maximum(w.end - 3, w.start), w.end)
        c = w.classes()
        shape = ((c > 0) @ (1 << np.arange(5)) + 64 * np.minimum(size, 12)).astype(np.uint64)
        for kind, key in zip(KINDS, (word, first, last, shape), strict=True):
            _index_sum(key ^ np.uint64(seeded_uint(SEED, kind)), doc * DIM, out)
        context = pooled(doc, word, n, vectors)
        per_doc = lambda x: np.bincount(doc, weights=x, minlength=n)
        classes = np.stack([per_doc(c[:, j]) for j in range(5)], axis=1)
        n_bytes = np.maximum(classes.sum(axis=1), 1)
        distinct = np.unique(mix(word + doc.astype(np.uint64)), return_index=True)[1]
        rates[:, :5] = classes / n_bytes[:, None]
        rates[:, 5] = n_bytes / count / 10
        rates[:, 6] = np.bincount(doc[distinct], minlength=n) / count
        rates[:, 7] = np.log1p(n_words) / 10
        rates[:, 8] = per_doc(size > 20) / count
        rates[:, 9] = np.array([t.count(b"\n") for t in texts]) / count
        rates[:, 10] = per_doc(_neighbours(doc, word)[0] == word) / count
    return np.hstack([context / count[:, None], out.reshape(n, DIM) / count[:, None], rates])


class Network:
    """Two layers (tanh, sigmoid) and a temperature, with the words' vectors
    that its inputs are pooled from."""

    vectors: np.ndarray | None = None

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature, constant=None):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature, self.constant = temperature, constant

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def of(self, texts: list[bytes]) -> np.ndarray:
        """The scores of texts."""
        return self.score(features(texts, self.vectors))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the log loss of four fifths of the rows, classes weighted alike
    half way; the rest picks the epoch and the temperature."""
    if len(y) == 0 or y.min() == y.max():
        return Network(0, 1, 0, 0, 0, 0, 1.0, constant=float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(y))
    check = part[:max(1, len(y) // 5)]
    train = part[len(check):] if len(part) > len(check) else part
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    xs, ys = (x[train] - mean) / scale, y[train]
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, best = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], (np.inf, [a.copy() for a in p])
    xc, yc = (x[check] - mean) / scale, y[check]
    for epoch in range(1, EPOCHS + 1):
        h = np.tanh(xs @ p[0] + p[1])
        d = (_sigmoid(h @ p[2] + p[3]) - ys) / len(ys)
        back = np.outer(d, p[2]) * (1 - h * h)
        grads = [xs.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
        for i, g in enumerate(grads):
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.001 * (g * g - v[i])
            p[i] -= 0.01 * (m[i] / (1 - 0.9 ** epoch)) / (np.sqrt(v[i] / (1 - 0.999 ** epoch)) + 1e-8)
        if epoch % 10 == 0 and (loss := _log_loss(np.tanh(xc @ p[0] + p[1]) @ p[2] + p[3], yc)) < best[0]:
            best = (loss, [a.copy() for a in p])
    w1, b1, w2, b2 = best[1]
    z = np.tanh(xc @ w1 + b1) @ w2 + b2
    temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: _log_loss(z / t, yc))
    return Network(mean, scale, w1, b1, w2, b2, float(temperature))


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.
    The words' vectors are those of all documents.  The sample's ids are at most
    ``sample_rows`` rows, so they are broadcast; features are computed by the
    tasks and only they reach the driver."""
    vectors = word_vectors(docs)
    sample = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .select("doc_id", F.col("quality").cast("int").alias("quality"),
                      F.xxhash64("doc_id").alias("_order"))
              .orderBy("_order", "doc_id", "quality").limit(sample_rows))
    chosen = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rows in blocks_of_texts(batches, ["doc_id", "quality"]):
            x = features(texts, vectors).astype(np.float32)
            crc = pa.array([zlib.crc32(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*rows, crc, pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["doc_id", "quality", "crc", "x"])

    got = chosen.mapInArrow(run, "doc_id bigint, quality int, crc bigint, x binary").orderBy(
        "doc_id", "quality", "crc").limit(sample_rows).collect()
    x = np.array([np.frombuffer(r["x"], dtype=np.float32) for r in got], dtype=np.float64).reshape(-1, CONTEXT + DIM + N_RATES)
    net = fit(x, np.array([float(r["quality"]) for r in got]))
    net.vectors = vectors
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, text_key, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rows in blocks_of_texts(batches, ["doc_id", "text_key"]):
            yield pa.RecordBatch.from_arrays([*rows, pa.array(net.of(texts))],
                                             names=["doc_id", "text_key", "score"])

    return docs.select("doc_id", text_key().alias("text_key"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, text_key bigint, score double")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    s = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return s.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored below the threshold go.  The score is
    added where the row lies, so no row moves."""
    net = train(docs, table(spark, sf_dir, "labels"))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, rows in blocks_of_texts(batches, columns):
            keep = pa.array(net.of(texts) >= THRESHOLD)
            yield pa.RecordBatch.from_arrays(rows, names=columns).filter(keep)

    return docs.mapInArrow(run, docs.schema)
