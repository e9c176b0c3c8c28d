"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected on random lines.  Two vectors at the least cosine
fall within a window of half width ``t`` on a line with a known probability, so
over many lines a pair is a candidate if it collides on at least ``need`` of
them, ``need`` being the largest count that such a pair still reaches with
probability ``RECALL``.  Lines are sorted and each vector's window, centred on
the vector, is read off the sorted order; candidates are verified by their
cosine in double precision.

One line alone keeps a constant share of all vectors in a window, so the lists
are cut before they are sorted: a vector is dealt into ``tables`` cells, each a
tuple of quantised lines within its label.  The number of lines in a tuple grows
with the logarithm of the largest label's rows, so cells keep their size as the
table grows, and the number of tables follows from the recall that the least
cosine must keep.  A cell of more than ``CHUNK`` rows (a group of near copies)
is cut into chunks, and every pair of chunks is a block of its own, so no task
holds more than two chunks of it and no pair is lost.  A pair that shares
several cells counts in its first table only.

Identical vectors of a label are one vector with a weight before any of that:
they link with each other whatever their number, and a link to one of them counts
for all.

Defined cases: a null, zero, empty or non-finite vector, one with a null
component, and one with a null label or id link with nothing; vectors of
different lengths never link; rows that repeat id, label and vector are one
vector, and the result has a row for each.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger.llm.common import connected_components, seeded_uint, table
from keyledger.session import stage

MIN_COSINE = 0.98
RECALL = 0.997      # of the cells and of the counting, each, for a pair at the least cosine
LINES = 24          # lines on which collisions are counted
CELL = 10.0         # width of a cell on a line, in distances at the least cosine
WINDOW = 2.0        # half width of a window, likewise
FAR_PER_ROW = 8     # unrelated vectors of its label that a row meets in a cell, about
CHUNK = 96
PAIRS_AT_ONCE = 1 << 19
SEED = 10


def _normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def same_cell(width: float, distance: float) -> float:
    """Probability that two points at a distance share a cell on a random line."""
    s = width / distance
    return 1 - 2 * _normal_cdf(-s) - 2 / (math.sqrt(2 * math.pi) * s) * (1 - math.exp(-s * s / 2))


def calibrate(n_rows: int, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> tuple[float, int, int, float, int]:
    """(cell width, lines per cell, tables, window half width, collisions
    needed) for ``n_rows`` vectors of one label."""
    near, far = math.sqrt(2 - 2 * min_cosine), math.sqrt(2)
    width = CELL * near
    per_cell = max(1, math.ceil(math.log(max(n_rows / FAR_PER_ROW, 1.0)) / -math.log(same_cell(width, far))))
    hit = same_cell(width, near) ** per_cell
    tables = math.ceil(math.log(1 - recall) / math.log(1 - hit))
    p = 2 * _normal_cdf(WINDOW) - 1
    tail, need = 0.0, LINES + 1
    while tail < recall:
        need -= 1
        tail += math.comb(LINES, need) * p ** need * (1 - p) ** (LINES - need)
    return width, per_cell, tables, WINDOW * near, need


def lines(name: str, n: int, dim: int) -> np.ndarray:
    return np.random.default_rng(seeded_uint(SEED, f"{name}:{dim}")).normal(size=(n, dim))


def vectors_of(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column in double precision, None where unusable."""
    out = []
    for x in column:
        v = x.values
        if not x.is_valid or v is None or len(v) == 0 or v.null_count:
            out.append(None)
            continue
        a = v.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(a if np.isfinite(a).all() and a.any() else None)
    return out


def unit(a: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest entry so that squares
    neither overflow nor vanish."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    return a / np.sqrt(np.einsum("ij,ij->i", a, a))[:, None]


DEALT = "tab int, label bigint, cell bigint, vec_id bigint, copies bigint, vec binary, cells binary"


def dealt(rows: DataFrame, width: float, per_cell: int, tables: int) -> DataFrame:
    """One row per vector and table, with the cell it falls in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = vectors_of(batch.column("embedding"))
            for dim in sorted({len(v) for v in vectors if v is not None}):
                at = np.array([i for i, v in enumerate(vectors) if v is not None and len(v) == dim])
                u = unit(np.array([vectors[i] for i in at]))
                shift = np.random.default_rng(seeded_uint(SEED, "shift")).random(tables * per_cell)
                place = np.floor(u @ lines("cell", tables * per_cell, dim).T / width + shift).astype(np.int64)
                weight = np.random.default_rng(seeded_uint(SEED, "key")).integers(1, 1 << 62, per_cell) | 1
                cells = (place.reshape(len(at), tables, per_cell) * weight).sum(axis=2) ^ dim
                packed = [r.tobytes() for r in u]
                every = np.tile(np.arange(len(at)), tables)
                pick = pa.array(at[every])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(tables, dtype=np.int32), len(at))),
                     batch.column("label").take(pick), pa.array(cells.T.ravel()), batch.column("vec_id").take(pick),
                     batch.column("copies").take(pick), pa.array([packed[i] for i in every], pa.binary()),
                     pa.array([cells[i].tobytes() for i in every], pa.binary())],
                    names=["tab", "label", "cell", "vec_id", "copies", "vec", "cells"])

    return rows.mapInArrow(run, DEALT)


def blocks(cells: DataFrame) -> DataFrame:
    """Cut large cells: column ``block`` names the block a row is compared in,
    ``side`` its chunk there (both sides of a block that compares a chunk with
    itself are 0)."""
    key = ["tab", "label", "cell"]
    large = (cells.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CHUNK)
             .select(*key, F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    rows = (cells.join(large, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
            .withColumn("chunk", F.pmod(F.xxhash64("vec_id", "vec"), F.col("chunks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.select("*", other.alias("other"))
    a, b = F.least("chunk", "other"), F.greatest("chunk", "other")
    return rows.select("tab", "label", "vec_id", "copies", "vec", "cells", (F.col("chunk") > F.col("other")).cast("int").alias("side"),
                       (F.col("chunk") != F.col("other")).alias("crossed"), F.xxhash64(*key, a, b).alias("block"))


def candidate_pairs(u: np.ndarray, block: np.ndarray, half: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one block that collide on at least ``need`` lines."""
    n = len(u)
    codes = []
    for h in lines("count", LINES, u.shape[1]) @ u.T:
        value = h + block * 1e3                 # blocks far apart on the line
        order = np.argsort(value, kind="stable")
        s = value[order]
        reach = np.searchsorted(s, s + half, side="right") - np.arange(n) - 1
        first = np.repeat(np.arange(n), reach)
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(reach) - reach, reach)
        a, b = order[first], order[second]
        codes.append(np.minimum(a, b) * n + np.maximum(a, b))
    code, hits = np.unique(np.concatenate(codes), return_counts=True)
    code = code[hits >= need]
    return code // n, code % n


def compare(rows: dict[str, np.ndarray], half: float, need: int, min_cosine: float):
    """Verified pairs of a few blocks, as links counted per row (a partner as
    often as it has copies) and as each row's smallest id reachable within them."""
    ids, n = rows["vec_id"], len(rows["vec_id"])
    count, low = np.zeros(n, dtype=np.int64), ids.copy()
    for dim in np.unique(rows["dim"]):
        at = np.flatnonzero(rows["dim"] == dim)
        u = np.frombuffer(b"".join(rows["vec"][at].tolist()), dtype=np.float64).reshape(len(at), dim)
        block = np.unique(rows["block"][at], return_inverse=True)[1]
        a, b = candidate_pairs(u, block, half, need)
        cells = np.frombuffer(b"".join(rows["cells"][at].tolist()), dtype=np.int64).reshape(len(at), -1)
        tab = rows["tab"][at]
        same = (rows["label"][at][a] == rows["label"][at][b]) & (tab[a] == tab[b])
        same &= (rows["side"][at][a] != rows["side"][at][b]) | ~rows["crossed"][at][a]
        a, b = a[same], b[same]
        link = np.einsum("ij,ij->i", u[a], u[b]) >= min_cosine
        a, b = a[link], b[link]
        shared = (cells[a] == cells[b]) & (np.arange(cells.shape[1]) < tab[a][:, None])
        a, b = at[a[~shared.any(axis=1)]], at[b[~shared.any(axis=1)]]
        np.add.at(count, a, rows["copies"][b])
        np.add.at(count, b, rows["copies"][a])
        while True:
            m = np.minimum(low[a], low[b])
            if (m == low[a]).all() and (m == low[b]).all():
                break
            np.minimum.at(low, a, m)
            np.minimum.at(low, b, m)
    return count, low


def links(rows: DataFrame, half: float, need: int, min_cosine: float) -> DataFrame:
    """vec_id, n (links counted in a block), low (smallest id its links reach
    there) for every row that has links in a block."""

    def batches_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Whole blocks, several at a time while they are small."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            t = pa.Table.from_batches(held)
            block = t.column("block").to_numpy()
            start = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            size = np.diff(np.r_[start, len(block)])
            done, pairs, first = 0, 0, 0
            for s, k in zip(start[:-1].tolist(), size[:-1].tolist(), strict=True):
                if pairs and pairs + k * k > PAIRS_AT_ONCE:
                    yield _arrays(t.slice(first, s - first))
                    first, pairs = s, 0
                pairs += k * k
                done = s + k
            if done > first:
                yield _arrays(t.slice(first, done - first))
            held = t.slice(done).to_batches()
        if held:
            yield _arrays(pa.Table.from_batches(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches_of_blocks(batches):
            count, low = compare(r, half, need, min_cosine)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(r["vec_id"][at]), pa.array(count[at]), pa.array(low[at])],
                                             names=["vec_id", "n", "low"])

    return (rows.repartition("block").sortWithinPartitions("block")
            .mapInArrow(run, "vec_id bigint, n bigint, low bigint"))


def _arrays(t: pa.Table) -> dict[str, np.ndarray]:
    out = {c: t.column(c).to_numpy() for c in ("tab", "label", "vec_id", "copies", "side", "crossed", "block")}
    out["vec"] = np.array(t.column("vec").to_pylist() + [None], dtype=object)[:-1]
    out["cells"] = np.array(t.column("cells").to_pylist() + [None], dtype=object)[:-1]
    out["dim"] = np.array([len(v) // 8 for v in out["vec"]], dtype=np.int64)
    return out


def collapsed(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable vectors: (``vec_id``, ``h1``, ``h2``) of each, the hashes of its
    label and vector, and one row per different vector: ``vec_id`` (the smallest),
    ``copies``, ``label``, ``embedding``, ``h1``, ``h2``.  Copies are combined where
    they are read, before anything moves."""
    e = F.col("embedding")
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & F.exists(e, lambda x: x != 0)
              & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label = F.col("label").cast("bigint")
    rows = vectors.where(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), "embedding",
                                        F.xxhash64(label, e).alias("h1"), F.xxhash64(e, F.lit(1), label).alias("h2"))
    members = stage(rows.select("vec_id", "h1", "h2").distinct(), "embedding-members")
    groups = members.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    one = rows.groupBy("h1", "h2").agg(F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"))
    return members, stage(groups.join(one, ["h1", "h2"]), "embedding-vectors")


def near_dedup(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    element = vectors.schema["embedding"].dataType
    if not isinstance(element, T.ArrayType):
        raise TypeError("embedding must be an array")
    members, rows = collapsed(vectors)
    most = rows.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width, per_cell, tables, half, need = calibrate(most, min_cosine)
    cells = stage(dealt(rows.select("vec_id", "copies", "label", "embedding"), width, per_cell, tables), "embedding-cells")
    found = stage(links(blocks(cells), half, need, min_cosine), "embedding-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")), "embedding-components")
    zero = F.lit(0).cast("bigint")
    one = (rows.select("h1", "h2", "vec_id", "copies").join(counts, "vec_id", "left").join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
           .select("h1", "h2", (F.coalesce("n", zero) + F.col("copies") - 1).alias("n"), F.coalesce("component", "vec_id").alias("c")))
    of = members.join(one, ["h1", "h2"]).groupBy("vec_id").agg(F.sum("n").alias("n_links"), F.min("c").alias("component_id"))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id")).join(of, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", zero).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "embeddings"))


#: DuckDB: all pairs of a label by their cosine, and what links reach.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT DISTINCT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {MIN_COSINE}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
first AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN first ON first.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
