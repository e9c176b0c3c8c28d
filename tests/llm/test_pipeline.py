import hashlib
import math
from collections import Counter

import duckdb

import __spark_entry__ as E
import corpus_pipeline
from keyledger.llm import mixing, packing, quality, queries
from keyledger.llm.common import table
from tests.llm import fixtures as fx
from tests.llm.test_dedup import brute_fingerprint


def brute_copies(docs, sf):
    """How often each document is in the mixture: every stage by hand, but for
    the classifier's scores."""
    spark = docs.sparkSession
    net = quality.train(docs, table(spark, sf, "labels"))
    scores = {(r.doc_id, r.text_key): r.score for r in quality.score(docs, net).collect()}
    rows = [(r.doc_id, r.text or "", r.source) for r in quality.score(docs, net).join(
        docs.withColumn("text_key", __import__("keyledger.llm.common", fromlist=["x"]).text_key()), ["doc_id", "text_key"])
        .where("score >= 0.7").select("doc_id", "text", "source").collect()]
    assert scores
    keep = {}
    for i, t, s in rows:
        if t not in keep or i > keep[t][0]:
            keep[t] = (i, t, s)
    rows = sorted(keep.values(), key=lambda r: r[0])
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    groups = fx.Groups(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                groups.join(a, b)
    rows = [r for n, r in enumerate(rows) if groups.find(n) == n]
    size = Counter()
    pool = lambda s: s if s in mixing.RECIPE else ""
    for _, t, s in rows:
        size[pool(s)] += len(t)
    whole, target, copies = sum(size.values()), {**mixing.RECIPE, "": mixing.OTHER}, Counter()
    for i, t, s in rows:
        rate = target[pool(s)] * whole / size[pool(s)] if size[pool(s)] else 0
        pieces = max(1, math.ceil(rate / mixing.PIECE))
        for k in range(pieces):
            u = int(hashlib.md5(f"{mixing.SEED}|{i}|{k}".encode()).hexdigest()[:13], 16) / 16 ** 13
            copies[i, t] += sum(c <= u for c in mixing.cumulative(rate / pieces))
    return +copies


def test_pipeline_against_stages_by_hand(spark, tmp_path):
    docs = fx.documents(spark).where("doc_id is not null")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{fx.SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    copies = brute_copies(given, str(tmp_path))
    want = Counter()
    for (i, t), n in copies.items():
        want[i] += n * len(packing.token_ids(t)) // 2
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want


def test_stages_take_odd_rows_and_empty_tables(spark):
    docs = fx.with_extra(fx.documents(spark))
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, fx.SF)
        assert name == "packing" or out.columns == docs.columns
        assert apply(spark, docs.where("false"), fx.SF).count() == 0
        docs = out
    assert docs.count() > 0


def test_queries_are_registered_and_match_duckdb(spark):
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    con = duckdb.connect()
    sf = "/root/testdata/sf0.01"
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in queries.ORACLE_SQL.items():
        df = names[name](spark, sf)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want)), name
