"""SimHash near-dedup by meet-in-the-middle ball hashing.

A 64-bit fingerprint per document; every distinct fingerprint emits all its
variants within half the radius, the variants are shuffled, and fingerprints
that meet at a variant are paired, deduplicated and verified.  Two
fingerprints within the (even) radius always meet half way, so no link is
lost, and at most 65 distinct fingerprints lie within one bit of a variant, so
no group grows with the data however many documents share a fingerprint.
Fingerprints that meet are linked in a chain, not all to all: they are all
within the radius of each other, so the chain gives the same components.

Defined cases: null and empty texts, and texts of white space only, have
fingerprint zero, linked like any other; a text of fewer words than a shingle
is one shingle; equal fingerprints are linked; a null id is never the smallest
of a component unless all are null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger.llm.common import connected_components, documents, keep_rows, text_key, text_or_empty
from keyledger.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
COUNT_BLOCK = 1 << 16  # hashes whose bits are counted at a time


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint: a bit is set if set in over half the shingles'
    hashes.  Words are split at ASCII white space and A-Z is lower-cased."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in
                       zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), COUNT_BLOCK):
        part = hashes[i:i + COUNT_BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key, fp (the fingerprint as a signed bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fp.view(np.int64))],
                names=["doc_id", "text_key", "fp"])

    return docs.select("doc_id", text_key().alias("text_key"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, text_key bigint, fp bigint")


def ball_masks(radius: int) -> list[int]:
    """Signed 64-bit masks of at most ``radius`` set bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Chains of links ``(a, b)`` between distinct fingerprints (column ``fp``)
    that give the components of all pairs within ``max_bits`` bits."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: half of it is the ball around each fingerprint")
    mask = F.explode(F.array(*[F.lit(m) for m in ball_masks(max_bits // 2)]))
    variants = fps.select("fp", mask.alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    previous = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    met = variants.withColumn("a", previous).where(F.col("a").isNotNull()).select("a", F.col("fp").alias("b"))
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_key, fp, component_id, lead (the component's first
    ``(doc_id, text_key)``) of every row."""
    rows = stage(fingerprints(docs, shingle_words), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    fps = stage(rows.groupBy("fp").agg(first.alias("lead")), "simhash-fps")
    roots = connected_components(links(fps.select("fp"), max_bits), "simhash-components")
    rooted = fps.join(roots.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "lead", F.coalesce("component", "fp").alias("root"))
    leads = rooted.groupBy("root").agg(F.min("lead").alias("lead"))
    of_fp = stage(rooted.drop("lead").join(leads, "root").select("fp", "lead"), "simhash-leads")
    return rows.join(of_fp, "fp").select("doc_id", "text_key", "fp", F.col("lead.doc_id").alias("component_id"), "lead")


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    c = components(documents(spark, sf_dir))
    return c.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage_simhash(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document with the smallest id of each group stays."""
    c = components(docs)
    lead = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("text_key") == F.col("lead.text_key"))
    return keep_rows(docs, c.where(lead).select("doc_id", "text_key").distinct())
