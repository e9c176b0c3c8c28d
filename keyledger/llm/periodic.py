"""Periodic run detection with suffix trees.

A run is a stretch of words in which words ``period`` apart are identical, with
the smallest such period, that goes on so in neither direction.  For the words
of a document and for their reversal a suffix tree is built by Ukkonen's
algorithm.  Along the tree's Euler tour the depth of two leaves' lowest common
ancestor is the least depth between them, found in constant time, and says how
many words agree from two places on (in the reversal: before them).  Every run
has a root that is the longest Lyndon word at its place, for one of two opposite
orders of the words; so the longest Lyndon words of both orders, found from the
leaves in order, are the candidates, and each is extended in both directions.

Before that, stretches that can't belong to a run are cut out and a word that
occurs nowhere else stands for each: a run agrees with itself, one period on, in
at least ``gram_words`` words, so each of its words lies in a group of so many
words that occurs twice in the document, a period apart (``repeating``).  All
words of which that holds are in the trees, whatever a run's length or period.

Defined cases: a null or empty text has no words and no runs; a null id is like
any other; words are told apart by their bytes, whatever the script.  An empty
table gives an empty result.  Columns other than ``doc_id`` and ``text`` are not
read.  Memory: the trees of one document at a time, a few hundred bytes for each
of its words that repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty
from keyledger.llm.words import PrefixHash, Words, blocks_of_texts, mix, powers

MIN_WORDS = 24
MIN_EXPONENT = 3
BLOCK = 16  # depths of the tour that one entry of the sparse table stands for
_BASE = 0xD1342543DE82EF95
_UNDO = pow(_BASE, -1, 1 << 64)


class SuffixTree:
    """Ukkonen's suffix tree of ``words`` (numbers from 1) with an end, 0, that
    differs from all.  ``rank`` has each place's rank among the suffixes, a
    prefix before what it begins."""

    def __init__(self, words: list[int]):
        self._tour(*self._build([*words, 0]))

    @staticmethod
    def _build(text: list[int]):
        """Ways into nodes, (node above * sigma + the way's first word) -> node,
        and of each inner node how many words lead to it.  A leaf is ``~place``
        of its suffix; the words on a way are those of any suffix below it."""
        n, sigma = len(text), max(text) + 1
        suffix, depth, link = [0], [0], [0]            # of the inner nodes: a suffix below, words from the root
        child: dict[int, int] = {}
        find = child.get
        node, edge, length, place = 0, 0, 0, 0         # the active point, and the longest suffix still to be added
        base, above = 0, 0                             # node * sigma, depth[node]
        for i, word in enumerate(text):
            last = 0
            while place <= i:
                if not length:
                    edge = i
                key = base + text[edge]
                to = find(key)
                if to is None:
                    child[key] = ~place
                    if last:
                        link[last] = node
                        last = 0
                else:
                    if to < 0:
                        some = ~to
                    else:
                        some = suffix[to]
                        span = depth[to] - above
                        if length >= span:             # the active point lies below ``to``
                            edge += span
                            length -= span
                            node, base, above = to, to * sigma, above + span
                            continue
                    then = text[some + above + length]
                    if then == word:                   # there already, and so are all shorter suffixes
                        length += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(suffix)
                    suffix.append(some)
                    depth.append(above + length)
                    link.append(0)
                    child[key] = middle
                    child[middle * sigma + then] = to
                    child[middle * sigma + word] = ~place
                    if last:
                        link[last] = middle
                    last = middle
                place += 1
                if node:
                    node = link[node]
                    base, above = node * sigma, depth[node]
                elif length:
                    length -= 1
                    edge = place
        return n, sigma, child, depth

    def _tour(self, n: int, sigma: int, child: dict[int, int], depth: list[int]) -> None:
        """The Euler tour, leaf by leaf; of the depths between two leaves only
        the least is kept, that of their lowest common ancestor."""
        ways = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        order = np.argsort(ways)                           # by the node above, then by the way's first word
        above = ways[order] // sigma
        kids = np.fromiter(child.values(), dtype=np.int64, count=len(child))[order].tolist()
        child.clear()
        begin = np.searchsorted(above, np.arange(len(depth) + 1)).tolist()
        past = np.array(depth)[above]                      # a way past earlier ones leaves the depth above as the least
        past[np.r_[True, above[1:] != above[:-1]]] = -1
        past = past.tolist()
        leaves, least, stack, low = [], [], [], 0
        way, end = begin[0], begin[1]
        while True:
            while way < end:
                to = kids[way]
                if past[way] >= 0:
                    low = past[way]
                way += 1
                if to < 0:
                    leaves.append(~to)
                    least.append(low)
                else:
                    if way < end:
                        stack.append((way, end))
                    way, end = begin[to], begin[to + 1]
            if not stack:
                break
            way, end = stack.pop()
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[leaves] = np.arange(n)
        self._minima(np.array(least, dtype=np.int32))

    def _minima(self, depths: np.ndarray) -> None:
        whole = np.full(-(-len(depths) // BLOCK) * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        whole[:len(depths)] = depths
        rows = whole.reshape(-1, BLOCK)
        self._depths = whole
        self._from_start = np.minimum.accumulate(rows, axis=1).ravel()
        self._to_end = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self._sparse = [rows.min(axis=1)]
        while len(self._sparse[-1]) > 1 << len(self._sparse) - 1:
            step, below = 1 << len(self._sparse) - 1, self._sparse[-1]
            self._sparse.append(np.minimum(below[:-step], below[step:]))

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from the places ``i`` and ``j`` (different) on."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)
        low, high = a // BLOCK, b // BLOCK
        out = np.minimum(self._to_end[a], self._from_start[b])
        near = np.flatnonzero(low == high)
        x, y = a[near], b[near]
        least = self._depths[x]
        for k in range(1, BLOCK):
            least = np.minimum(least, self._depths[np.minimum(x + k, y)])
        out[near] = least
        far = np.flatnonzero(high - low > 1)
        level = np.frexp((high - low - 1)[far].astype(np.float64))[1] - 1
        for k in np.unique(level):
            rows = far[level == k]
            out[rows] = np.minimum(out[rows], np.minimum(self._sparse[k][low[rows] + 1], self._sparse[k][high[rows] - (1 << int(k))]))
        return out.astype(np.int64)


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank (the length, if none): the
    longest Lyndon word at a place ends there."""
    out = [len(rank)] * len(rank)
    open_, ranks = [], [min(rank) - 1]
    for i, r in enumerate(rank):
        while ranks[-1] > r:
            ranks.pop()
            out[open_.pop()] = i
        ranks.append(r)
        open_.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(words: list[int], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(start, length, period) of every run of at least ``min_words`` words
    (numbers from 1) and ``min_exponent`` (at least 2) periods, by start, then
    period."""
    n = len(words)
    if n < min_words:
        return np.empty((0, 3), dtype=np.int64)
    tree, back = SuffixTree(words), SuffixTree(words[::-1])
    found = []
    for rank in (tree.rank[:n], -tree.rank[:n]):
        j = next_smaller(rank.tolist())
        i = np.flatnonzero(j < n)
        j = j[i]
        start = i - back.agree(n - i, n - j)
        found.append(np.stack([start, j + tree.agree(i, j) - start, j - i], axis=1))
    out = np.concatenate(found)
    out = np.unique(out[out[:, 1] >= np.maximum(min_words, min_exponent * out[:, 2])], axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def gram_words(min_words: int, min_exponent: int) -> int:
    """In how many words a run agrees with itself, one period on, at least."""
    return min_words - min_words // min_exponent


def repeating(found: Words, gram: int, min_exponent: int) -> np.ndarray:
    """Per word of a block: can it lie in a run?  First, does it lie in ``gram``
    words that occur twice in its document; then, again and again, in ``gram``
    words that occur twice in the stretch of such words around it, no further
    apart than a run in that stretch could have its period.  Equal words have
    equal keys, so none is missed."""
    n = len(found.start)
    held = np.zeros(n, dtype=bool)
    if n < gram:
        return held
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(PrefixHash(found.data)(found.start, found.end) * powers(_BASE, n)[:n], out=sums[1:])
    at = np.flatnonzero(found.doc[:n - gram + 1] == found.doc[gram - 1:])
    grams = mix((sums[at + gram] - sums[at]) * powers(_UNDO, n)[at] + found.doc[at].astype(np.uint64) * np.uint64(_BASE))
    order = np.argsort(grams)
    equal = grams[order[1:]] == grams[order[:-1]]
    order = order[np.r_[False, equal] | np.r_[equal, False]]  # grams that occur twice, few of all
    order = order[np.lexsort((order, grams[order]))]
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    one, two = at[order[same]], at[order[same + 1]]           # an occurrence and the next
    while len(one):
        change = np.zeros(n + 1, dtype=np.int32)
        both = np.unique(np.concatenate([one, two]))
        np.add.at(change, both, 1)
        np.subtract.at(change, both + gram, 1)
        held = np.cumsum(change[:n]) > 0
        begins = held & (np.r_[True, ~held[:-1]] | np.r_[True, found.doc[1:] != found.doc[:-1]])
        stretch = np.cumsum(begins)
        size = np.bincount(stretch[held], minlength=stretch[-1] + 1)
        stay = (stretch[one] == stretch[two]) & ((two - one) * min_exponent <= size[stretch[one]])
        if stay.all():
            return held
        one, two = one[stay], two[stay]
    return np.zeros(n, dtype=bool)


def document_runs(words: list[bytes], held: np.ndarray, min_words: int, min_exponent: int) -> np.ndarray:
    """Runs of one document of which only the words ``held`` can be in one."""
    number: dict[bytes, int] = {}
    text, place = [], []
    edges = np.flatnonzero(np.diff(held, prepend=False, append=False)).tolist()
    for k, (a, b) in enumerate(zip(edges[::2], edges[1::2], strict=True)):
        text += [number.setdefault(w, len(number) + 1) for w in words[a:b]]
        place += range(a, b)
        number[b" %d" % k] = len(number) + 1  # stands for what is cut out; no word has a blank
        text.append(len(number))
        place.append(b)
    out = runs_of(text, min_words, min_exponent)
    out[:, 0] = np.array(place, dtype=np.int64)[out[:, 0]]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats: all of a run but its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.subtract.at(change, runs[:, 0] + runs[:, 1], 1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period in words, by
    start, then period) and ``collapsed`` (the text without the repetitions, one
    space between words) of every row."""
    gram = gram_words(min_words, min_exponent)
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.large_string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, (ids,) in blocks_of_texts(batches, ["doc_id"]):
            found = Words(texts)
            held = repeating(found, gram, min_exponent)
            edge = np.searchsorted(found.doc, np.arange(len(texts) + 1))
            any_held = np.concatenate([[0], np.cumsum(held)])
            rows, kept = [], []
            for d, text in enumerate(texts):
                words, (a, b) = text.split(), edge[d:d + 2]
                runs = np.empty((0, 3), dtype=np.int64)
                if any_held[b] > any_held[a]:
                    runs = document_runs(words, held[a:b], min_words, min_exponent)
                rows.append([{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()])
                kept.append(b" ".join(collapsed(words, runs) if len(runs) else words))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(edge)), pa.array(rows, kinds.field("runs").type),
                 pa.array(kept, pa.large_binary()).cast(pa.large_string())], schema=kinds)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        work, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; where ten divides h, the crc32 of the decimal id,
    the words from the a-th on are those of one period over and over.  A null id
    leaves its text as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for k, i in enumerate(ids):
                h = zlib.crc32(b"%d" % i) if i is not None else 1
                words = texts[k].encode().split() if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    tail = words[a:a + p]
                    texts[k] = b" ".join(words[:a] + (tail * (-(-(n - a) // p)))[:n - a]).decode()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        work, "doc_id bigint, text string")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The greatest of length / period is found by whole numbers: with lengths and
    periods below 2^31 their products fit a long."""
    found = periodic_runs(repeat_tails(documents(spark, sf_dir)))
    top = F.reduce("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), top.alias("top"), F.sha2(text, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.call_function("div", F.col("top.length") * 1000, F.col("top.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
