import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from keyledger.llm import common, embeddings, exact_dedup, simhash, suffix_dedup
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


@pytest.mark.parametrize("support", [0.001, 0.02])
def test_exact_dedup_against_brute_force(spark, docs, support):
    rows = fx.pairs(docs)
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    got = exact_dedup.decide(fx.with_extra(docs), support).collect()
    assert len(got) == len(rows)
    kept: dict[str, int] = {}
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [i for i in groups[text] if i is not None]
        assert r["keep_id"] == (max(ids) if ids else None) and r["group_size"] == len(groups[text])
        kept[text] = kept.get(text, 0) + r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_exact_dedup_stage_keeps_one_row_of_each_text(spark, docs):
    extra = fx.with_extra(docs)
    out = exact_dedup.stage_exact_dedup(spark, extra, fx.SF)
    assert out.columns == extra.columns
    texts = [t for _, t in fx.pairs(out)]
    assert sorted(texts) == sorted({t for _, t in fx.pairs(docs)})
    assert out.where("kept <> -1").count() == 0


def brute_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark, docs):
    rows = fx.pairs(docs)
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = fx.Groups(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                groups.join(a, b)
    least: dict[int, int | None] = {}
    for n, (i, _) in enumerate(rows):
        g = groups.find(n)
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = sorted(((i is None, i or 0, f"{fp:016x}", least[groups.find(n)]) for n, ((i, _), fp) in enumerate(zip(rows, fps))), key=str)
    got = simhash.components(fx.with_extra(docs)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f"), "component_id").collect()
    assert sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in got), key=str) == want


def test_simhash_links_every_pair_within_two_bits(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in fps for _ in range(3)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    got = {(r.node, r.component) for r in common.connected_components(simhash.links(
        spark.createDataFrame([(f,) for f in fps], "fp bigint"))).collect()}
    groups = fx.Groups(len(fps))
    for a in range(len(fps)):
        for b in range(a):
            if ((fps[a] ^ fps[b]) & ((1 << 64) - 1)).bit_count() <= 2:
                groups.join(a, b)
    want = {(f, fps[groups.find(n)]) for n, f in enumerate(fps)}
    assert got == {w for w in want if sum(w[1] == x[1] for x in want) > 1}
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), 3)


def test_simhash_stage_keeps_one_of_each_group(spark, docs):
    out = simhash.stage_simhash(spark, fx.with_extra(docs), fx.SF)
    left = fx.pairs(out)
    assert len(left) == simhash.components(docs).select("lead").distinct().count()
    fps = [brute_fingerprint(t) for _, t in left]
    assert all((a ^ b).bit_count() > 2 for n, a in enumerate(fps) for b in fps[:n])


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(500)] + [(10_000, 10_000 + i) for i in range(1, 300)] + [(7, 7)]
    got = dict(common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(got[i] == 0 for i in range(501)) and all(got[10_000 + i] == 10_000 for i in range(300))


def brute_removed(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = t.encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = True
            seen.add(w)
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot_segments,block_bytes", [(500, 20_000), (2, 50_000)])
def test_suffix_dedup_against_brute_force(spark, docs, hot_segments, block_bytes):
    rows = fx.documents(spark).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(fx.with_extra(rows), hot_segments, block_bytes).collect()]
    assert sorted(got) == sorted(brute_removed(fx.pairs(rows)))


def test_suffix_dedup_keeps_texts_and_spans(spark, docs):
    rows = fx.documents(spark).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    texts = {i: t.encode() for i, t in fx.pairs(rows)}
    removed = 0
    for r in suffix_dedup.deduplicated(rows, block_bytes=30_000).collect():
        edges = list(zip(r.spans[::2], r.spans[1::2]))
        assert all(a < b for a, b in edges) and all(b < c for (_, b), (c, _) in zip(edges, edges[1:]))
        kept, at = b"", 0
        for a, b in [*edges, (len(texts[r.doc_id]), None)]:
            kept, at = kept + texts[r.doc_id][at:a], b
        assert bytes(r.kept) == kept and r.n_removed == sum(b - a for a, b in edges) == r.n_bytes - len(kept)
        removed += r.n_removed
    assert removed > 5000


def test_suffix_dedup_of_a_very_long_text(spark):
    rng = np.random.default_rng(3)
    once = rng.integers(97, 123, 8_000_000, dtype=np.uint8).tobytes().decode()
    rows = [(1, once + once[1_000_000:1_500_000]), (2, once[3_000_000:3_200_000] + "!" * 50), (3, "z" * 2_000_000)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert got[1] == (8_500_000, 500_000, 1) and got[2] == (200_050, 200_000, 1)
    assert got[3] == (2_000_000, 1_999_999, 1)


def test_suffix_array_sorts_and_counts_prefixes():
    rng = random.Random(1)
    for _ in range(30):
        text = bytes(rng.choice(b"ab\xff" if rng.random() < .5 else b"a") for _ in range(rng.randint(1, 400)))
        a = np.frombuffer(text, dtype=np.uint8)
        array = suffix_dedup.suffix_array(a, depth=len(a))
        assert sorted(array.tolist()) == list(range(len(a)))
        assert [text[i:] for i in array] == sorted(text[i:] for i in range(len(a))) or 255 in text
        shared = suffix_dedup.common_prefixes(a, array, depth=16)
        for n in range(1, len(a)):
            x, y = text[array[n]:][:16], text[array[n - 1]:][:16]
            same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert shared[n] >= same


def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + rng.normal(size=16) * (0.02 if i % 3 else 0.3)).tolist(), i % 4 if i % 20 else 0)
            for i in range(400)]
    hub = rng.normal(size=16)
    rows += [(1000 + i, (hub + rng.normal(size=16) * 0.03).tolist(), 2) for i in range(350)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, [None] + [1.0] * 15, 1),
             (2004, rows[0][1], None), (2005, [1e200] * 16, 3), (2006, [1e-200] * 16, 3), (2007, [1.0, 2.0], 3),
             (2008, [2.0, 4.0], 3), (2009, [], 3), (None, rows[0][1], 0), (5, rows[5][1], rows[5][2])]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def test_embedding_near_dedup_against_brute_force(spark):
    rows, df = vectors(spark)
    use = [r for r in rows[:-1] if r[0] is not None and r[2] is not None and r[1] and None not in r[1]
           and np.isfinite(r[1]).all() and np.any(r[1])]
    at = {r[0]: n for n, r in enumerate(use)}
    unit = [np.array(r[1]) / np.abs(r[1]).max() for r in use]
    unit = [u / np.linalg.norm(u) for u in unit]
    links, groups = {i: 0 for i in at}, fx.Groups(len(use))
    by_id = sorted(at)
    pos = {i: n for n, i in enumerate(by_id)}
    for a in range(len(use)):
        for b in range(a):
            if use[a][2] == use[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                links[use[a][0]] += 1
                links[use[b][0]] += 1
                groups.join(pos[use[a][0]], pos[use[b][0]])
    got = embeddings.near_dedup(df.select("*", F.lit(1).alias("kept"), F.lit(1).alias("cell"))).collect()
    assert len(got) == len(rows)
    found = sum({r.vec_id: r.n_links for r in got}.values())
    assert all(r.n_links <= links.get(r.vec_id, 0) for r in got)
    assert found >= 0.97 * sum(links.values()) and sum(links.values()) > 60_000
    for r in got:
        if r.vec_id in at:
            assert r.component_id == by_id[groups.find(pos[r.vec_id])]
        else:
            assert r.component_id == r.vec_id and r.n_links == 0
        assert r.kept == (r.vec_id is not None and r.component_id == r.vec_id)


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert exact_dedup.decide(none).count() == 0 and exact_dedup.stage_exact_dedup(spark, none, fx.SF).count() == 0
    assert simhash.components(none).count() == 0 and simhash.stage_simhash(spark, none, fx.SF).count() == 0
    assert suffix_dedup.suffix_dedup(none).count() == 0
    assert embeddings.near_dedup(vectors(spark)[1].where("false")).count() == 0


def test_thousands_of_identical_vectors(spark):
    rng = np.random.default_rng(8)
    same, near, far = rng.normal(size=16), None, rng.normal(size=(40, 16))
    near = same + rng.normal(size=16) * 0.001
    rows = [(i, same.tolist(), 1) for i in range(5000, 10_000)] + [(i, near.tolist(), 1) for i in range(30)] + [
        (100 + i, far[i].tolist(), 1) for i in range(40)] + [(200 + i, same.tolist(), 2) for i in range(3)] + [
        (300, [0.0] * 16, 1), (301, [0.0] * 16, 1), (302, None, 1), (303, None, 1), (5001, same.tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    got = {r.vec_id: tuple(r)[1:] for r in embeddings.near_dedup(df).collect()}
    assert all(got[i] == (5029, 0, False) for i in range(5000, 10_000))
    assert all(got[i] == (5029, 0, i == 0) for i in range(30)) and all(got[200 + i] == (2, 200, i == 0) for i in range(3))
    assert all(got[i] == (0, i, True) for i in (100, 300, 301, 302, 303))
    members, one = embeddings.collapsed(df)
    assert one.count() == 43 and members.count() == 5073
