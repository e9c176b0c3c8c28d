"""Lexical retrieval packing.

Documents become token ids.  Long ones fill whole windows by themselves; what
is left over is packed by retrieval: within a shard, an inverted index with
BM25 weights returns the unused documents most like a seed, and they fill the
seed's window greedily, best first; the last is cut where the window ends and
its rest stays available.  All ids of the seed query the index, and every
document that shares one is scored; scores of many seeds at once are products of
dense blocks of the index, where that is cheaper than adding up its postings.
Only a shard's last sequence can be short, and it is cut into powers of two,
which need no padding.

A term is a token id, so the vocabulary is the tokenizer's: document
frequencies are counted over all documents and their table, one number per id,
is bounded by the vocabulary and broadcast.  A document's signature is two of its
ids, drawn by a hash weighted by how late the vocabulary has them (it lists common
strings first), so that documents which share rare ids tend to share it; shards are ranges of signatures, cut by ``sharding``'s splitters
and ended by a hash of the row, so a hot group of copies is cut into as many
shards as it needs.  Shards, and with them sequences, are the same however the
input is partitioned.

Defined cases: a null text counts as empty and is one token, the end; rows that
repeat an id are packed each on its own, and rows that agree in id and text are
interchangeable.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty
from keyledger.llm.sharding import split
from keyledger.llm.words import mix
from keyledger.session import stage

WINDOW = 2048
END = 1                       # id that closes every document
TOKENIZER = "byte_bpe_50k"    # a name for public_tokenizers.path
SHARD_TOKENS = 1_500_000      # tokens of a shard, about
SEEDS = 128                   # scored at a time, at most
DENSE = 4_000_000             # numbers of a dense block of the index
FIRST = 32                    # neighbours that are looked for first
LONG_RUN = 20_000             # characters of one kind in a row that the fast encoder is not given
K1, B = 1.2, 0.75

# How the vocabulary's file cuts texts into words, and its added token.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ADDED, ADDED_ID = "<|endoftext|>", 50256
_RUN = re.compile(rf"\s{{{LONG_RUN}}}|\w{{{LONG_RUN}}}|[^\w\s]{{{LONG_RUN}}}")


@lru_cache(maxsize=2)
def tokenizer(name: str):
    """The public vocabulary as its tokenizers file has it, added tokens
    included.  A worker reads the file once and encodes in the task's own thread."""
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


@lru_cache(maxsize=2)
def fast_encoder(name: str):
    """The same vocabulary in an encoder that gives the same ids several times as
    fast, for text without added tokens (the tests compare them)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def text_ids(text: str, name: str = TOKENIZER) -> list[int]:
    """The ids that the tokenizers file gives a whole text; the string of its
    added token is that token's id.  A text with a very long run of blanks, letters
    or signs goes to the tokenizers library itself."""
    if len(text) >= LONG_RUN and _RUN.search(text):
        return tokenizer(name).encode(text, add_special_tokens=False).ids
    encode = fast_encoder(name).encode_ordinary
    if ADDED not in text:
        return encode(text)
    out: list[int] = []
    for n, part in enumerate(text.split(ADDED)):
        out += [ADDED_ID] * (n > 0) + encode(part)
    return out


def encoded(texts: list[str], name: str = TOKENIZER) -> Iterator[bytes]:
    """Token ids of whole texts, each with the end, as little-endian uint16 bytes."""
    for text in texts:
        yield np.array([*text_ids(text, name), END], dtype="<u2").tobytes()


def token_ids(text: str, name: str = TOKENIZER) -> bytes:
    """Token ids of one whole text and the end."""
    return next(encoded([text], name))


@lru_cache(maxsize=1)
def _clocks() -> tuple[np.ndarray, np.ndarray]:
    """Per id its place in the order in which exponential clocks (from a hash, at
    the rate of the id's logarithm) ring, and per place a number for it: two
    documents share the first id to ring with the probability of their weighted
    overlap."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    draw = (mix(ids + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    place = np.empty(1 << 16, dtype=np.int32)
    place[np.argsort(-np.log(draw + 2.0 ** -54) / np.log(ids.astype(np.float64) + 2), kind="stable")] = np.arange(1 << 16)
    return place, (mix(ids) >> np.uint64(24)).astype(np.int64) << 16


def signature(ids: np.ndarray) -> int:
    """Two of the ids: the first to ring and the next."""
    place, number = _clocks()
    at = place[ids]
    first = int(at.min())
    at[at == first] = 1 << 16
    return int(number[first]) | int(at.min()) % (1 << 16)


def tokenized(docs: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """doc_id, ids (uint16 little-endian), n, and where the row is dealt:
    ``__hash`` (its signature) and ``__tie`` (a hash of the row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = list(encoded(batch.column("text").to_pylist(), name))
            sig = [signature(np.frombuffer(x, dtype="<u2")) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(sig, pa.int64())],
                names=["doc_id", "ids", "n", "__hash"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, ids binary, n bigint, __hash bigint").withColumn("__tie", F.xxhash64("doc_id", "ids"))


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """In how many documents each id occurs: one number per id of the
    vocabulary.  Tasks count their own rows; the counts are added by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, last = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_py(), dtype="<u2")
                at = np.arange(len(ids))
                last[ids] = at
                df[ids[last[ids] == at]] += 1  # each id once, at its last place
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(df[term])], names=["term", "df"])

    df = np.zeros(1 << 16, dtype=np.int64)
    for r in tokens.select("ids").mapInArrow(run, "term int, df bigint").groupBy("term").agg(
            F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


class Index:
    """BM25 over the units of one shard.  A unit's query is all its ids; ids that
    no other unit has find nothing and are left out."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n, self.whole = len(units), None
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        unit = np.repeat(np.arange(self.n), lengths)
        code, tf = np.unique(np.concatenate(units).astype(np.int64) << 32 | unit if self.n else np.zeros(0, np.int64), return_counts=True)
        term, unit = code >> 32, code & 0xFFFFFFFF
        shared = np.bincount(term, minlength=1 << 16)[term] > 1
        term, unit, tf = term[shared], unit[shared], tf[shared]
        norm = K1 * (1 - B + B * lengths[unit] / max(mean_length, 1))
        self.weight = (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        self.unit = unit
        _, first, self.term = np.unique(term, return_index=True, return_inverse=True)
        self.first = np.append(first, len(term))
        by_unit = np.argsort(unit, kind="stable")
        self.terms_of = self.term[by_unit]
        self.first_of = np.searchsorted(unit[by_unit], np.arange(self.n + 1))

    def _block(self, low: int, high: int) -> np.ndarray:
        """The weights of some terms in all units; kept if that is the whole index."""
        if self.whole is not None:
            return self.whole[low:high]
        a, b = self.first[low], self.first[high]
        block = np.zeros((high - low, self.n), dtype=np.float32)
        block[self.term[a:b] - low, self.unit[a:b]] = self.weight[a:b]
        if high - low == len(self.first) - 1:
            self.whole = block
        return block

    def scores(self, seeds: np.ndarray) -> np.ndarray:
        """The score of every unit for every seed (itself: zero)."""
        n_terms = len(self.first) - 1
        queries = [self.terms_of[self.first_of[s]:self.first_of[s + 1]] for s in seeds.tolist()]
        terms = np.concatenate(queries)
        postings = int((self.first[terms + 1] - self.first[terms]).sum())
        # Nanoseconds, about: a list and a posting; a number of a block made, and a product.
        if 3000 * len(terms) + 10 * postings <= n_terms * self.n * (2 + 0.05 * len(seeds)):
            out = np.zeros((len(seeds), self.n), dtype=np.float32)
            for k, q in enumerate(queries):
                at = np.concatenate([np.arange(a, b) for a, b in zip(self.first[q].tolist(), self.first[q + 1].tolist(), strict=True)] or [
                    np.zeros(0, np.int64)])
                out[k] = np.bincount(self.unit[at], weights=self.weight[at], minlength=self.n)
        else:
            out = np.zeros((len(seeds), self.n), dtype=np.float32)
            asked = np.repeat(np.arange(len(seeds)), [len(q) for q in queries])
            order = np.argsort(terms, kind="stable")
            asked, terms = asked[order], terms[order]
            step = max(1, DENSE // self.n)
            for low in range(0, n_terms, step):
                high = min(low + step, n_terms)
                x, y = np.searchsorted(terms, [low, high])
                query = np.zeros((len(seeds), high - low), dtype=np.float32)
                query[asked[x:y], terms[x:y] - low] = 1
                out += query @ self._block(low, high)
        out[np.arange(len(seeds)), seeds] = 0
        return out


def best_first(units: np.ndarray, score: np.ndarray) -> Iterator[int]:
    """``units`` by falling score, equal ones as they come; the first are found
    without sorting the rest."""
    if len(units) > 4 * FIRST:
        first = score[units] >= np.partition(score[units], -FIRST)[-FIRST]
        head, units = units[first], units[~first]
        yield from head[np.argsort(-score[head], kind="stable")].tolist()
    yield from units[np.argsort(-score[units], kind="stable")].tolist()


def pack_shard(tokens: list[np.ndarray], idf: np.ndarray, mean_length: float,
               window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one shard."""
    pieces, sequence = [], 0
    left, begin = [], []
    for d, ids in enumerate(tokens):
        whole = len(ids) // window
        for k in range(whole):
            pieces.append((d, k * window, window, sequence, 0))
            sequence += 1
        begin.append(whole * window)
        left.append(len(ids) - whole * window)
    begin, left = np.array(begin, dtype=np.int64), np.array(left, dtype=np.int64)
    owner = np.flatnonzero(left)
    units = [tokens[d][begin[d]:] for d in owner]
    index = Index(units, idf, mean_length)
    ahead = max(1, int(SEEDS * min(1.0, left.sum() / max(len(owner), 1) / window)))  # of so many units most become seeds
    unused = np.ones(len(owner), dtype=bool)
    scored: dict[int, np.ndarray] = {}
    filled, next_unit = 0, 0
    while True:
        while next_unit < len(owner) and not unused[next_unit]:
            next_unit += 1
        if next_unit == len(owner):
            break
        seed = next_unit
        if seed not in scored:
            batch = seed + np.flatnonzero(unused[seed:])[:ahead]
            scored = dict(zip(batch.tolist(), index.scores(batch), strict=True))
        score = scored[seed]
        near = np.flatnonzero((score > 0) & unused)
        for u in chain([seed], best_first(near, score)):
            d = owner[u]
            take = int(min(left[d], window - filled))
            pieces.append((int(d), int(begin[d]), take, sequence, filled))
            begin[d] += take
            left[d] -= take
            filled += take
            unused[u] = left[d] > 0
            if filled == window:
                sequence, filled = sequence + 1, 0
                break
    return _powers_of_two(pieces, sequence, filled)


def _powers_of_two(pieces: list[tuple[int, int, int, int, int]], last: int, filled: int):
    """Cut the last, short sequence into sequences whose lengths are powers of
    two, the longest first."""
    if not filled or filled & (filled - 1) == 0:
        return pieces
    done = [p for p in pieces if p[3] != last]
    sizes = [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
    sequence, room, offset = last, sizes.pop(0), 0
    for d, start, length, _, _ in [p for p in pieces if p[3] == last]:
        while length:
            take = min(length, room)
            done.append((d, start, take, sequence, offset))
            start, length, room, offset = start + take, length - take, room - take, offset + take
            if not room:
                sequence, room, offset = sequence + 1, sizes.pop(0) if sizes else 0, 0
    return done


PIECE = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
         "sequence_id bigint, offset bigint")


def dealt(tokens: DataFrame, n_tokens: int, shards: int) -> tuple[DataFrame, int]:
    """``tokens`` with ``__shard``, and how many there are: ranges of (``__hash``,
    ``__tie``) of about equal tokens.  One row repeated very often is dealt
    to several shards."""
    keys = stage(tokens.groupBy("__hash", "__tie", F.col("n").alias("__size")).agg(F.count(F.lit(1)).alias("copies")), "packing-keys")
    splitters, found = split(keys.withColumn("weight", (F.col("__size") * F.col("copies")).cast("double")), float(n_tokens), shards)
    table, first = [], 0
    for r in found:
        parts = max(1, min(r["rows"], round(r["weight"] * shards / n_tokens))) if r["keys"] == 1 else 1
        table.append((r["range"], first, parts))
        first += parts
    ranges = F.broadcast(tokens.sparkSession.createDataFrame(table, "range int, first int, parts int"))
    part = F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("parts")).cast("int")
    return tokens.select("*", splitters.column().alias("range")).join(ranges, "range").select(*tokens.columns, part.alias("__shard")), first


def pack(docs: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, name: str = TOKENIZER) -> DataFrame:
    """One row per piece, with its ``ids`` (little-endian unsigned 32-bit numbers)
    and their ``ids_crc32``; a sequence is the rows of one sequence_id."""
    spark = docs.sparkSession
    tokens = stage(tokenized(docs, name), "packing-tokens")
    n_docs, n_tokens = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return _with_crc(spark.createDataFrame([], PIECE))
    df = document_frequencies(tokens)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    shared = spark.sparkContext.broadcast(idf)
    mean_length = n_tokens / n_docs
    placed, shards = dealt(tokens, n_tokens, max(1, -(-n_tokens // shard_tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, names, shard = [], [], 0
        for batch in batches:
            ids += [np.frombuffer(x.as_py(), dtype="<u2") for x in batch.column("ids")]
            names.append(batch.column("doc_id"))
            shard = batch.column("__shard")[0].as_py() if batch.num_rows else shard
        if not ids:
            return
        doc, start, length, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(
            *pack_shard(ids, shared.value, mean_length, window), strict=True))
        piece = [ids[d][s:s + n].astype("<u4").tobytes() for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
        size = np.array([len(x) for x in ids], dtype=np.int64)
        doc_id = pa.chunked_array(names).take(pa.array(doc)).combine_chunks()
        columns = [doc_id, start, length, pa.array(piece, pa.binary()), size[doc], sequence + (shard << 36), offset]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                                         names=[c.split()[0] for c in PIECE.split(", ")])

    moved = placed.repartitionById(shards, F.col("__shard")).sortWithinPartitions("__hash", "__tie", "doc_id")
    return _with_crc(moved.select("doc_id", "ids", "__shard").mapInArrow(run, PIECE))


def _with_crc(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def stage_packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents, with their ids."""
    return pack(docs)
