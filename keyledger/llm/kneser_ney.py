"""LM scoring: an interpolated modified Kneser-Ney n-gram model of order two
(each word given the one before), counted over all training documents.

Documents lie in blocks.  A block sends every shard of the vocabulary its words
there, each once with its training count; the shard answers with the word's
number and total.  Likewise the block's word pairs go to shards of pairs, whose
answers are the pairs' totals and, for the first words, how many kinds of pair
follow with count 1, 2 and more.  A shard is a sorted array of hashes with its
counts, written to the worker's own disk and memory-mapped while it answers; no
worker or driver ever holds the whole model, which grows with the corpus.  How
many different words a word follows is added up by one more pass of the pair
shards' word lists to the vocabulary shards.  The driver sees only sums: tokens,
distinct words, and counts of counts for the discounts.

Pairs are dealt by their first word; a first word with many occurrences is
split over as many shards as its count asks for, and its answers are added.

The probability of a word w after v is
  max(c(vw) - D(c), 0) / c(v) + (D1 N1(v) + D2 N2(v) + D3 N3+(v)) / c(v) * p(w)
  p(w) = max(l(w) - D'(l), 0) / T + (D1' M1 + D2' M2 + D3' M3+) / T / (V + 1)
with c training counts, l(w) the number of words that w follows, T the kinds of
pairs, and a word never seen in training one class of its own.  A document
begins after a start mark and closes with the end token.

Defined cases: a null text counts as empty and is the end token alone; a null id
is not held out; rows that repeat an id are scored each.  Without training rows
every probability is 1 / (V + 1).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty
from keyledger.llm.exchange import (BLOCK_BYTES, SortedArrays, answered, arrow_rows, packed, parts_of, served, shard_of, unpacked,
                                    write_blocks)
from keyledger.llm.words import BLOCK_BYTES as CHUNK_BYTES
from keyledger.llm.words import Words, mix
from keyledger.session import stage

FOLDS, HELD_OUT = 10, 0
END_KEY = np.uint64(0xE0D0F0D0C0FFEE01)  # hash of the end token
START = np.int64(-1)                     # number of the start mark
SHARD_ENTRIES = 2_000_000                # entries that a shard gathers, about
BASE_ADD = 0.1

BLOCK = "block bigint, n_docs bigint, n_train bigint, n_tokens bigint, n_words bigint, docs binary, tokens binary, words binary"
REQUEST = "shard bigint, block bigint, payload binary"
ANSWER = "kind string, dest bigint, src bigint, payload binary, sums array<bigint>"
SCORE = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
         "base_score double, score double")


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end) and how many
    tokens each text has."""
    keys, sizes, first, held = [], [], 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (held and held + len(texts[i]) > CHUNK_BYTES):
            part = texts[first:i]
            if part:
                w = Words(part)
                n = np.bincount(w.doc, minlength=len(part))
                k = np.full(len(w.doc) + len(part), END_KEY, dtype=np.uint64)
                k[np.arange(len(w.doc)) + w.doc] = w.keys()
                keys.append(k)
                sizes.append(n + 1)
            first, held = i, 0
        if i < len(texts):
            held += len(texts[i])
    return (np.concatenate(keys), np.concatenate(sizes)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents as numbers of the block's own sorted word list."""
    from pyspark import TaskContext

    def block(no: int, ids: list, held_out: list, texts: list[bytes]) -> pa.RecordBatch:
        keys, sizes = token_keys(texts)
        words, tokens = np.unique(keys, return_inverse=True)
        held = np.array(held_out, dtype=bool)
        doc = [np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is None for i in ids]), held, sizes]
        row = (TaskContext.get().partitionId() << 32 | no, len(ids), int((~held).sum()), len(tokens), len(words), packed(*doc),
               packed(tokens.astype(np.int32)), packed(words))
        return arrow_rows(BLOCK, [row]).to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size, no = [], [], [], 0, 0
        for batch in batches:
            for i, h, t in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text")), strict=True):
                text = t.as_py()
                if texts and size + len(text) > block_bytes:
                    yield block(no, ids, held, texts)
                    ids, held, texts, size, no = [], [], [], 0, no + 1
                ids.append(i.as_py())
                held.append(h.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield block(no, ids, held, texts)

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"),
                       text_or_empty().cast("binary").alias("text")).mapInArrow(run, BLOCK)


class Block:
    """A block's documents and tokens, and its distinct word pairs."""

    def __init__(self, row: dict):
        ids, null, self.held_out, self.sizes = unpacked(row["docs"])
        self.doc_ids = [None if n else int(i) for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.tokens = unpacked(row["tokens"])[0].astype(np.int64)
        self.n_words = row["n_words"]
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.train = ~self.held_out[self.doc]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=self.n_words)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, second, train count, place): distinct pairs as places in the
        word list (the start mark is n_words), and each token's pair."""
        before = np.r_[self.n_words, self.tokens[:-1]]
        before[np.cumsum(self.sizes)[:-1]] = self.n_words
        code, place = np.unique(before * (self.n_words + 1) + self.tokens, return_inverse=True)
        return (code // (self.n_words + 1), code % (self.n_words + 1),
                np.bincount(place[self.train], minlength=len(code)), place)


def _word_requests(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, count = unpacked(row["words"])[0], Block(row).word_counts()
                yield from arrow_rows(REQUEST, [(s, row["block"], packed(words[at], count[at].astype(np.int32)))
                                            for s, at in parts_of(shard_of(words, shards))]).to_batches()

    return blocks.mapInArrow(run, REQUEST)


def _number_words(shards: int):
    def run(shard: int, parts) -> pa.Table:
        keys, place = np.unique(np.concatenate([p[0] for _, p in parts]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([p[1] for _, p in parts])).astype(np.int64)
        rank = np.empty(len(keys), dtype=np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(keys))  # common words get small numbers
        rows = [("sums", -1, shard, None, [int((total > 0).sum()), int(total.sum())])]
        with SortedArrays(keys, rank * shards + shard, total) as model:
            for block, (words, _) in parts:
                at = model.find(words)
                rows.append(("word", block, shard, packed(model.values[0][at], model.values[1][at]), None))
        return arrow_rows(ANSWER, rows)

    return run


def _splits(count: np.ndarray, per_shard: int) -> np.ndarray:
    """Over how many shards the pairs of a first word are dealt."""
    return np.maximum(1, -(-count // per_shard))


def _dealt_pairs(block: Block, got: dict, n_train: int, shards: int):
    number = np.r_[np.concatenate([p[0] for p in got["word"]]), START]
    count = np.r_[np.concatenate([p[1] for p in got["word"]]), n_train]
    first, second, seen, place = block.pairs()
    split = _splits(count, SHARD_ENTRIES // 4)[first]
    salt = (mix(number[second].view(np.uint64)) >> np.uint64(20)) % split.astype(np.uint64)
    shard = shard_of(mix(number[first].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt), shards)
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return number, count, first[order], second[order], seen[order], back[place], shard[order]


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _pair_requests(blocks: DataFrame, words: DataFrame, n_train: int, shards: int) -> DataFrame:
    def run(row: dict, got: dict) -> pa.Table:
        number, _, first, second, seen, _, shard = _dealt_pairs(Block(row), got, n_train, shards)
        rows = []
        for s, at in parts_of(shard):
            start = _runs(first[at])
            rows.append((s, row["block"], packed(number[first[at][start]], np.diff(np.r_[start, at.stop - at.start]).astype(np.int32),
                                                 number[second[at]], seen[at].astype(np.int32))))
        return arrow_rows(REQUEST, rows)

    return answered(blocks, words, run, REQUEST)


def _count_pairs(word_shards: int):
    def run(shard: int, parts) -> pa.Table:
        first = [np.repeat(p[0], p[1]) for _, p in parts]
        pair = [mix(f.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + mix(p[2].view(np.uint64)))
                for f, (_, p) in zip(first, parts, strict=True)]
        keys, at, place = np.unique(np.concatenate(pair), return_index=True, return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([p[3] for _, p in parts])).astype(np.int64)
        known = total > 0
        lead, tail = np.concatenate(first)[at][known], np.concatenate([p[2] for _, p in parts])[at][known]
        class_of = np.minimum(total[known], 3)
        leads, lead_at = np.unique(lead, return_inverse=True)
        kinds = np.bincount(lead_at * 3 + class_of - 1, minlength=3 * len(leads)).reshape(-1, 3)
        rows = [("sums", -1, shard, None, [*(int((total == r).sum()) for r in range(1, 5)), int(known.sum())])]
        with SortedArrays(keys, total) as model:
            for (block, p), pairs in zip(parts, pair, strict=True):
                near = np.searchsorted(leads, p[0]).clip(0, max(len(leads) - 1, 0))
                hit = leads[near] == p[0] if len(leads) else np.zeros(len(p[0]), bool)
                n = np.where(hit[:, None], kinds[near], 0) if len(leads) else np.zeros((len(p[0]), 3), np.int64)
                rows.append(("pair", block, shard, packed(model.values[0][model.find(pairs)].astype(np.int32), p[1],
                                                          *(n[:, j].astype(np.int32) for j in range(3))), None))
        words, follows = np.unique(tail, return_counts=True)
        order = np.argsort(words % word_shards, kind="stable")
        words, follows = words[order], follows[order]
        rows += [("follow", s, shard, packed(words[at], follows[at].astype(np.int32)), None)
                 for s, at in parts_of(words % word_shards)]
        return arrow_rows(ANSWER, rows)

    return run


def _follow_counts(words: DataFrame, follows: DataFrame) -> DataFrame:
    """Add up, in each vocabulary shard, how many words each word follows, and
    tell the blocks that hold it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = [unpacked(r) for r in right.column("payload").to_pylist()]
        keys, place = np.unique(np.concatenate([p[0] for p in got] or [np.zeros(0, np.int64)]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([p[1] for p in got] or [np.zeros(0)]),
                            minlength=len(keys)).astype(np.int64)
        rows = [("sums", -1, 0, None, [*(int((total == r).sum()) for r in range(1, 5)), int((total >= 3).sum())])]
        with SortedArrays(keys, total) as model:
            for r in left.to_pylist():
                number = unpacked(r["payload"])[0]
                at = model.find(number).clip(0, max(len(keys) - 1, 0))
                n = np.where(model.keys[at] == number, model.values[0][at], 0) if len(keys) else np.zeros(len(number), np.int64)
                rows.append(("follow", r["dest"], r["shard"], packed(n.astype(np.int64)), None))
        return arrow_rows(ANSWER, rows)

    return (words.withColumnRenamed("src", "shard").groupBy("shard")
            .cogroup(follows.withColumnRenamed("dest", "shard").groupBy("shard")).applyInArrow(run, ANSWER))


def discounts(n: list[int]) -> np.ndarray:
    """D(0..3) from how many items have counts 1 to 4; where one of these is
    missing the discount falls back to half."""
    n1, n2, n3, n4 = n
    d = [0.0, 0.5, 0.5, 0.5]
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        for r, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
            if a and b:
                d[r] = float(np.clip(r - (r + 1) * y * b / a, 0, r))
    return np.array(d)


def score_block(row: dict, got: dict, m: dict) -> pa.Table:
    """The scores of a block's documents; ``m`` holds the corpus sums."""
    b = Block(row)
    _, count, first, second, _, place, _ = _dealt_pairs(b, got, m["n_train"], m["shards"])
    follow = np.concatenate([p[0] for p in got["follow"]])
    d1, d2 = discounts(m["n_follow"][:4]), discounts(m["n_pairs"][:4])
    kinds = max(m["n_pairs"][4], 1)
    f1, f2, f3 = m["n_follow"][0], m["n_follow"][1], m["n_follow"][4]
    rest = (d1[1] * f1 + d1[2] * f2 + d1[3] * f3) / kinds if m["n_pairs"][4] else 1.0
    word = np.maximum(follow - d1[np.minimum(follow, 3)], 0) / kinds + rest / (m["vocabulary"] + 1)
    seen = np.concatenate([p[0] for p in got["pair"]]).astype(np.int64)
    kinds_of = np.zeros((len(count), 3))
    at = 0
    for _, size, *n in got["pair"]:
        lead = first[at + np.cumsum(size) - size]
        for j in range(3):
            kinds_of[:, j] += np.bincount(lead, weights=n[j], minlength=len(count))
        at += int(size.sum())
    total = count[first]
    back = kinds_of @ d2[1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.maximum(seen - d2[np.minimum(seen, 3)], 0) / total + back[first] / total * word[second]
    p = np.where(total > 0, p, word[second])
    n_docs = len(b.sizes)
    known = count[:-1][b.tokens]
    base = np.log10((known + BASE_ADD) / (m["train_tokens"] + BASE_ADD * (m["vocabulary"] + 1)))
    add = lambda x: np.bincount(b.doc, weights=x, minlength=n_docs)
    columns = [b.doc_ids, b.held_out, b.sizes.astype(np.int64), add(known > 0).astype(np.int64),
               np.full(n_docs, m["train_tokens"], np.int64), add(base), add(np.log10(p)[place])]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow_rows(SCORE, []).schema, strict=True)],
                    names=arrow_rows(SCORE, []).column_names)


def _sums(answers: DataFrame, n: int) -> list[int]:
    r = answers.where("kind = 'sums'").agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(n)]).first()
    return [int(x) for x in r]


def score_documents(docs: DataFrame, shard_entries: int = SHARD_ENTRIES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` with the contract's columns and ``perplexity``,
    the inverse of the geometric mean of its tokens' probabilities."""
    blocks = write_blocks(to_blocks(docs, block_bytes), "lm")
    n_train, n_tokens, n_words = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
        "n_train", "n_tokens", "n_words")]).first()
    word_shards, pair_shards = max(1, -(-n_words // shard_entries)), max(1, -(-n_tokens // shard_entries))
    words = stage(served(_word_requests(blocks, word_shards), _number_words(word_shards), ANSWER), "lm-words")
    vocabulary, train_tokens = _sums(words, 2)
    word = words.where("kind = 'word'").drop("sums")
    pairs = stage(served(_pair_requests(blocks, word, n_train, pair_shards), _count_pairs(word_shards), ANSWER), "lm-pairs")
    follows = stage(_follow_counts(word, pairs.where("kind = 'follow'").drop("sums")), "lm-follows")
    model = {"n_train": n_train, "shards": pair_shards, "vocabulary": vocabulary, "train_tokens": train_tokens,
             "n_pairs": _sums(pairs, 5), "n_follow": _sums(follows, 5)}
    answers = word.unionByName(pairs.where("kind = 'pair'").drop("sums")).unionByName(
        follows.where("kind = 'follow'").drop("sums"))
    scored = answered(blocks, answers, lambda row, got: score_block(row, got, model), SCORE)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
