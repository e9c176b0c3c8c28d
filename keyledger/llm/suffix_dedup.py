"""Suffix-array dedup of repeated passages.

Every byte covered by a 100-byte string that also starts earlier (smaller
doc_id, or the same document further left) is removed.

To find the places where strings can repeat without sorting all suffixes of the
corpus in one place, every 100-byte window is named by its anchor, the place in
it whose 32-byte hash is smallest: equal windows have equal anchors.  The
windows of one anchor form a segment of about 130 bytes.  Anchors and segment
hashes are shuffled; a segment that occurs earlier as a whole is settled there.
Only the first copies of different segments that share an anchor are left, and
they go, by anchor, to tasks that build a suffix array of them: suffixes smaller
than their successors are sorted directly, all others are induced from these by
scanning the buckets, and adjacent common prefixes give the equal windows, the
earliest of which stays.

An anchor that very many different segments share (a common line shorter than a
window) would make one task's array grow with the corpus; from ``HOT_SEGMENTS``
segments its windows are dealt by their own hash instead, which gives the same
result.  Copies are told apart by 64-bit hashes of anchor and segment together.

Defined cases: a null text counts as empty; texts shorter than a window lose
nothing; a null id comes before all others, and rows that repeat an id come in
the order in which they were read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty
from keyledger.llm.exchange import answered, arrow_rows, packed, parts_of, served, shard_of, unpacked, write_blocks
from keyledger.llm.words import PrefixHash, mix
from keyledger.session import stage

BLOCK_BYTES = 2 << 20       # text of a block, about; a task needs some hundred bytes for each
MATCH = 100
ANCHOR = 32
HOT_SEGMENTS = 500
SHARD_ENTRIES = 2_000_000
SHARD_BYTES = 3 << 20       # bytes that a suffix array is built of, about
SEPARATOR = 255             # never a byte of UTF-8

BLOCK = "block bigint, n_bytes bigint, docs binary, texts binary, segments binary"
REQUEST = "shard bigint, block bigint, payload binary"
ANSWER = "kind string, dest bigint, src bigint, payload binary, sums array<bigint>"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<bigint>, kept binary"
ALONE, COPY, SHARED, HOT = 0, 1, 2, 3


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of whole texts, sorted by id, with the segments of their windows:
    worked out once, while the texts are at hand."""
    from pyspark import TaskContext

    def block(no: int, rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        ids = [r[0] for r in rows]
        sizes = np.array([len(t) for _, t in rows], dtype=np.int64)
        docs = packed(np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is None for i in ids]), sizes)
        text = np.frombuffer(b"".join(t for _, t in rows), dtype=np.uint8)
        return arrow_rows(BLOCK, [(TaskContext.get().partitionId() << 32 | no, len(text), docs, packed(text),
                                   packed(*segments(text, sizes)))]).to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, no = [], 0, 0
        for batch in batches:
            for i, t in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = t.as_py()
                if rows and size + len(text) > block_bytes:
                    yield block(no, rows)
                    rows, size, no = [], 0, no + 1
                rows.append((i.as_py(), text))
                size += len(text)
        if rows:
            yield block(no, rows)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       text_or_empty().cast("binary").alias("text")).mapInArrow(run, BLOCK)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size, m = 1, x
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The segments of the windows of ``text``, documents of ``sizes`` bytes: how
    far each begins behind the one before, its windows but one, the segments
    that differ (the earliest of each) ordered by anchor hash, which of these each
    segment equals, and the hashes of these segments' anchors and of themselves."""
    n = len(text)
    if n < MATCH:
        none, hashes = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        return none, none, none, none, hashes, hashes
    hash_of = PrefixHash(text)
    at = np.arange(n - ANCHOR + 1)
    gram = hash_of.raw(at, at + ANCHOR)
    low = np.uint64(0xFFFFFF)
    place = _least((mix(gram) & ~low) | (at.astype(np.uint64) & low), MATCH - ANCHOR + 1)
    start = np.arange(n - MATCH + 1)
    place = start + ((place & low).astype(np.int64) - start) % (1 << 24)
    doc_end = np.repeat(np.cumsum(sizes), sizes)[:len(start)]
    valid = start + MATCH <= doc_end
    new = np.r_[True, (place[1:] != place[:-1]) | (doc_end[1:] != doc_end[:-1])] & valid
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & ~np.r_[valid[1:] & ~new[1:], False])
    anchor = mix(gram[place[first]] + np.uint64(1))
    segment = mix(hash_of(first, last + MATCH) + (place[first] - first).astype(np.uint64))
    _, earliest, entry_of = np.unique(mix(anchor ^ mix(segment)), return_index=True, return_inverse=True)
    order = np.argsort(anchor[earliest], kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    entry, small = earliest[order], lambda x: x.astype(np.int32)
    return (small(np.diff(first, prepend=0)), small(last - first), small(entry), small(back[entry_of]), anchor[entry], segment[entry])


class Block:
    """A block's texts and the segments of their windows.

    ``first`` and ``last`` are a segment's first and last window, ``anchor`` and
    ``segment`` its hashes.  ``entry`` are the segments that differ within the
    block (the earliest of each), ordered by anchor hash; ``entry_of`` gives each
    segment's entry."""

    def __init__(self, row: dict):
        ids, null, self.sizes = unpacked(row["docs"])
        self.doc_ids = [None if n else int(i) for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.order_id = np.where(null, np.iinfo(np.int64).min, ids)
        self.ends = np.cumsum(self.sizes)
        self.text = unpacked(row["texts"])[0] if row.get("texts") is not None else None
        gap, more, entry, entry_of, self.anchor, self.segment = unpacked(row["segments"])
        self.first = np.cumsum(gap, dtype=np.int64)
        self.last = self.first + more
        self.entry, self.entry_of = entry.astype(np.int64), entry_of.astype(np.int64)
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def copies_here(self) -> np.ndarray:
        """Segments that are not the earliest of their entry in the block."""
        return self.entry[self.entry_of] != np.arange(len(self.entry_of))


def _anchor_requests(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                yield from arrow_rows(REQUEST, [
                    (s, row["block"], packed(b.anchor[at], b.segment[at], b.order_id[b.doc[b.entry[at]]]))
                    for s, at in parts_of(shard_of(b.anchor, shards))]).to_batches()

    return blocks.select("block", "docs", "segments").mapInArrow(run, REQUEST)


def settle(hot_segments: int = HOT_SEGMENTS):
    """Per entry: alone, a copy of an earlier one, or the first of several that
    share an anchor (hot from ``hot_segments`` of them)."""

    def run(shard: int, parts) -> pa.Table:
        sizes = np.array([len(p[0]) for _, p in parts])
        anchor, segment, doc = (np.concatenate([p[i] for _, p in parts]) for i in range(3))
        order = np.lexsort((np.repeat(np.arange(len(parts)), sizes), doc, segment, anchor))
        a, s = anchor[order], segment[order]
        new_anchor = np.r_[True, a[1:] != a[:-1]]
        new = new_anchor | np.r_[True, s[1:] != s[:-1]]
        group = np.cumsum(new_anchor) - 1
        different = np.bincount(group, weights=new)[group]
        state = np.where(~new, COPY, np.where(different == 1, ALONE, np.where(different < hot_segments, SHARED, HOT)))
        out = np.empty(len(order), dtype=np.uint8)
        out[order] = state
        ends = np.cumsum(sizes)
        rows = [("sums", -1, shard, None, [int((state == SHARED).sum()), int((state == HOT).sum())])]
        rows += [("state", block, shard, packed(out[e - n:e]), None) for (block, _), e, n in
                 zip(parts, ends.tolist(), sizes.tolist(), strict=True)]
        return arrow_rows(ANSWER, rows)

    return run


def _states(got: dict, b: Block) -> np.ndarray:
    return np.concatenate([p[0] for p in got["state"]]) if got.get("state") else np.zeros(len(b.entry), np.uint8)


def _flat(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... first[0] + sizes[0] - 1, first[1], ..."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _hot_windows(b: Block, got: dict) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the hot segments and their hashes, ordered by hash, equal ones
    by place."""
    seg = np.sort(b.entry[_states(got, b) == HOT])
    window = _flat(b.first[seg], b.last[seg] - b.first[seg] + 1)
    h = PrefixHash(b.text)(window, window + MATCH) if len(window) else np.zeros(0, np.uint64)
    order = np.argsort(h, kind="stable")
    return window[order], h[order]


def _further_requests(blocks: DataFrame, states: DataFrame, arrays: int, hot_shards: int) -> DataFrame:
    """What the anchors' states ask for, in one pass: the bytes of shared
    segments, to the array of their anchor ('segment'), and the hashes of hot
    windows, each to its shard ('window')."""

    def run(row: dict, got: dict) -> pa.Table:
        b = Block(row)
        entry = np.flatnonzero(_states(got, b) == SHARED)
        seg = b.entry[entry]
        sizes = b.last[seg] + MATCH - b.first[seg]
        rows = [("segment", s, row["block"], packed(entry[at], b.order_id[b.doc[seg[at]]], b.first[seg[at]], sizes[at],
                                                    b.text[_flat(b.first[seg[at]], sizes[at])]))
                for s, at in parts_of(shard_of(b.anchor[entry], arrays))]
        window, h = _hot_windows(b, got)
        doc = b.order_id[np.searchsorted(b.ends, window, side="right")]
        rows += [("window", s, row["block"], packed(h[at], np.zeros(at.stop - at.start, np.uint64), doc[at]))
                 for s, at in parts_of(shard_of(h, hot_shards))]
        return arrow_rows(f"kind string, {REQUEST}", rows)

    return answered(blocks, states, run, f"kind string, {REQUEST}")


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number (past the
    end: separators)."""
    t = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), dtype=np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | t[i:i + len(text)]
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it: the first byte that
    differs from its neighbour decides for the run before it.  The last suffix
    is greater than the empty one."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    after = np.searchsorted(differs, np.arange(n))
    out = np.zeros(n, dtype=bool)
    inside = after < len(differs)
    at = differs[after[inside]]
    out[inside] = text[at] < text[at + 1]
    return out


def sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes from each on: eight bytes at a
    time, and only what is still tied is sorted again."""
    order = places[np.argsort(words[places], kind="stable")]
    n, key = len(words), words[order]
    new = np.r_[True, key[1:] != key[:-1]] if len(order) else np.zeros(0, bool)
    for at in range(8, depth, 8):
        tied = np.flatnonzero(~new | np.r_[~new[1:], False])
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        sub = order[tied]
        key = np.where(sub + at < n, words[np.minimum(sub + at, n - 1)], np.uint64(0))
        again = np.lexsort((key, group))
        order[tied], key = sub[again], key[again]
        new[tied] = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
    return order


def suffix_array(text: np.ndarray, depth: int = MATCH) -> np.ndarray:
    """Suffixes of ``text`` in order of their first ``depth`` bytes at least, by
    two-stage sorting: the suffixes smaller than their successors are sorted
    directly; scanning the buckets from the smallest first byte on, each suffix
    found puts the one before it, if that is greater, behind those already in
    its bucket."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    direct = smaller_than_next(text)
    count = np.bincount(text, minlength=256)
    bucket = np.concatenate([[0], np.cumsum(count)])
    n_direct = np.bincount(text[direct], minlength=256)
    array = np.empty(n, dtype=np.int64)
    sorted_direct = sort_directly(np.flatnonzero(direct), eight_bytes(text), depth)
    from_direct = np.concatenate([[0], np.cumsum(n_direct)])
    filled = bucket[:-1].copy()  # next free place among the induced suffixes of each bucket
    array[filled[text[-1]]] = n - 1
    filled[text[-1]] += 1

    def put(found: np.ndarray) -> None:
        first = text[found]
        order = np.argsort(first, kind="stable")
        found, first = found[order], first[order]
        for c, at in parts_of(first):
            array[filled[c]:filled[c] + at.stop - at.start] = found[at]
            filled[c] += at.stop - at.start

    for c in np.flatnonzero(count).tolist():
        array[bucket[c + 1] - n_direct[c]:bucket[c + 1]] = sorted_direct[from_direct[c]:from_direct[c + 1]]
        scanned = bucket[c]
        while scanned < filled[c]:  # runs of one byte fill their own bucket, a step of the run at a time
            now = array[scanned:filled[c]]
            scanned = filled[c]
            before = now[now > 0] - 1
            put(before[~direct[before] & (text[before] == c)])
        whole = array[bucket[c]:bucket[c + 1]]
        before = whole[whole > 0] - 1
        put(before[~direct[before] & (text[before] > c)])
    return array


def common_prefixes(text: np.ndarray, array: np.ndarray, depth: int = MATCH) -> np.ndarray:
    """Bytes that each suffix of the array shares with the one before it, up to
    ``depth`` (the first: 0)."""
    words, n = eight_bytes(text), len(text)
    out = np.zeros(len(array), dtype=np.int64)
    alive = np.arange(1, len(array))
    for at in range(0, depth, 8):
        x, y = array[alive] + at, array[alive - 1] + at
        inside = np.maximum(x, y) < n
        alive, x, y = alive[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        for byte in range(8):
            out[alive] += (differ >> np.uint64(56 - 8 * byte)) == 0
        alive = alive[differ == 0]
    return np.minimum(out, depth)


def repeated_windows(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of the windows that also start earlier.  ``text`` holds
    segments (``starts``, ``sizes``) ended by separators; ``rank`` orders them,
    and within one further left is earlier."""
    array = suffix_array(text)
    shared = common_prefixes(text, array)
    segment = np.searchsorted(starts, array, side="right") - 1
    offset = array - starts[segment]
    whole = offset + MATCH <= sizes[segment]
    new = shared < MATCH
    group = np.cumsum(new)[whole]
    segment, offset = segment[whole], offset[whole]
    order = np.lexsort((offset, rank[segment], group))
    g = group[order]
    copy = order[np.flatnonzero(np.r_[False, g[1:] == g[:-1]])]
    return segment[copy], offset[copy]


def _sort_segments(shard: int, parts) -> pa.Table:
    entry, doc, first, sizes = (np.concatenate([p[i] for _, p in parts]) for i in range(4))
    part = np.repeat(np.arange(len(parts)), [len(p[0]) for _, p in parts])
    order = np.lexsort((first, part, doc))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.full(int(sizes.sum()) + len(sizes), SEPARATOR, dtype=np.uint8)
    text[_flat(starts, sizes)] = np.concatenate([p[4] for _, p in parts])
    segment, offset = repeated_windows(text, starts, sizes, rank)
    order = np.argsort(part[segment], kind="stable")
    segment, offset = segment[order], offset[order]
    rows = [("window", parts[i][0], shard, packed(entry[segment[at]].astype(np.int32), offset[at].astype(np.int32)), None)
            for i, at in parts_of(part[segment])]
    return arrow_rows(ANSWER, rows)


def remove(row: dict, got: dict) -> pa.Table:
    """What is left of a block's documents."""
    b = Block(row)
    state = _states(got, b)
    change = np.zeros(len(b.text) + 1, dtype=np.int64)
    copies = np.flatnonzero(b.copies_here() | (state[b.entry_of] == COPY)) if len(b.entry) else np.zeros(0, np.int64)
    np.add.at(change, b.first[copies], 1)
    np.add.at(change, b.last[copies] + MATCH, -1)
    windows = [b.first[b.entry[e]] + o for e, o in got.get("window", [])]
    if got.get("hot"):
        windows.append(_hot_windows(b, got)[0][np.concatenate([p[0] for p in got["hot"]]) == COPY])
    for w in windows:
        np.add.at(change, w, 1)
        np.add.at(change, w + MATCH, -1)
    gone = np.cumsum(change[:-1]) > 0
    out, start = [], 0
    for doc_id, size in zip(b.doc_ids, b.sizes.tolist(), strict=True):
        g = gone[start:start + size]
        spans = np.flatnonzero(np.diff(g, prepend=False, append=False))
        out.append((doc_id, size, int(g.sum()), spans.tolist(), b.text[start:start + size][~g].tobytes()))
        start += size
    return arrow_rows(RESULT, out)


def _count(answers: DataFrame) -> tuple[int, int]:
    r = answers.where("kind = 'sums'").agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(2)]).first()
    return int(r[0]), int(r[1])


def deduplicated(docs: DataFrame, hot_segments: int = HOT_SEGMENTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans``
    (start and end, in bytes, of every removed run, one after the other) and
    ``kept``, the bytes that stay (a run may end inside a character)."""
    blocks = write_blocks(to_blocks(docs, block_bytes), "suffix")
    n_bytes = int(blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    shards = max(1, -(-2 * n_bytes // ((MATCH - ANCHOR + 2) * SHARD_ENTRIES)))
    settled = stage(served(_anchor_requests(blocks, shards), settle(hot_segments), ANSWER), "suffix-states")
    n_shared, n_hot = _count(settled)
    states = settled.where("kind = 'state'").drop("sums")
    arrays = max(1, -(-n_shared * (MATCH + 40) // SHARD_BYTES))
    hot_shards = max(1, -(-n_hot * (MATCH - ANCHOR + 1) // SHARD_ENTRIES))
    answers = states
    if n_shared + n_hot:
        asked = stage(_further_requests(blocks, states, arrays, hot_shards), "suffix-requests")
        windows = served(asked.where("kind = 'segment'").drop("kind"), _sort_segments, ANSWER)
        hot = served(asked.where("kind = 'window'").drop("kind"), settle(hot_segments), ANSWER).where("kind = 'state'")
        answers = answers.unionByName(windows.drop("sums")).unionByName(hot.drop("sums").withColumn("kind", F.lit("hot")))
    return answered(blocks, answers, remove, RESULT)


def suffix_dedup(docs: DataFrame, hot_segments: int = HOT_SEGMENTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` with the contract's columns."""
    return deduplicated(docs, hot_segments, block_bytes).select(
        "doc_id", "n_bytes", "n_removed", F.expr("cast(size(spans) div 2 as bigint)").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


#: DuckDB: every window of every text by its digest (texts as hexadecimal, two
#: digits a byte), the runs that copies cover, and what lies between them.
ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, {2 * MATCH})) AS s
      FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - {MATCH - 1})) AS p FROM d WHERE len(h) >= {2 * MATCH})),
copies AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
steps AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {MATCH} THEN 0 ELSE 1 END AS fresh FROM copies),
runs AS (SELECT doc_id, min(p) AS start, max(p) + {MATCH} AS stop
         FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps) GROUP BY doc_id, run),
between AS (SELECT doc_id, start, stop, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM runs),
per AS (SELECT doc_id, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans, max(stop) AS last,
               string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' ORDER BY start) AS head
        FROM between JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""
