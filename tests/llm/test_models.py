import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyledger.llm import kneser_ney, mixing, packing, quality
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


def brute_kneser_ney(rows):
    texts = [(i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, t.encode().lower().split() + [None]) for i, t in rows]
    before = lambda w: ["<start>", *w[:-1]]
    uni, pair = Counter(), Counter()
    for _, held, w in texts:
        if not held:
            uni.update(w)
            pair.update(zip(before(w), w, strict=True))
    follows, kinds, total = Counter(c for _, c in pair), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, _), n in pair.items():
        kinds[a][min(n, 3) - 1] += 1
        total[a] += n

    def discount(values):
        n = [sum(v == r for v in values) for r in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(r - (r + 1) * y * n[r] / n[r - 1] for r in (1, 2, 3))]

    d2, d1 = discount(pair.values()), discount(follows.values())
    m = [sum(v == 1 for v in follows.values()), sum(v == 2 for v in follows.values()), sum(v >= 3 for v in follows.values())]
    n, v = sum(uni.values()), len(uni)
    rest = sum(d1[r + 1] * m[r] for r in range(3)) / len(pair)
    one = lambda c: max(follows[c] - d1[min(follows[c], 3)], 0) / len(pair) + rest / (v + 1)

    def two(a, c):
        if not total[a]:
            return one(c)
        return (max(pair[a, c] - d2[min(pair[a, c], 3)], 0) + sum(d2[r + 1] * kinds[a][r] for r in range(3)) * one(c)) / total[a]

    out = [(i, held, len(w), sum(uni[c] > 0 for c in w), n, sum(math.log10((uni[c] + .1) / (n + .1 * (v + 1))) for c in w),
            sum(math.log10(two(a, c)) for a, c in zip(before(w), w, strict=True))) for i, held, w in texts]
    a = max((w for w in total if w != "<start>"), key=total.get)
    mass = sum(two(a, c) for c in uni) + sum(d2[r + 1] * kinds[a][r] for r in range(3)) / total[a] * rest / (v + 1)
    return out, mass


@pytest.mark.parametrize("shard_entries,block_bytes", [(2_000_000, 1 << 23), (900, 40_000)])
def test_lm_scoring_against_brute_force(spark, docs, shard_entries, block_bytes):
    want, mass = brute_kneser_ney(fx.pairs(docs))
    assert abs(mass - 1) < 1e-9
    got = kneser_ney.score_documents(fx.with_extra(docs), shard_entries, block_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
        assert g[7] == pytest.approx(10 ** (-w[6] / w[2]), rel=1e-9)
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_lm_scoring_splits_a_frequent_first_word(spark, docs, monkeypatch):
    monkeypatch.setattr(kneser_ney, "_splits", lambda count, _: np.maximum(1, count // 50))
    want, _ = brute_kneser_ney(fx.pairs(docs))
    got = kneser_ney.score_documents(docs, 3000, 60_000).agg(F.sum("score")).first()[0]
    assert got == pytest.approx(sum(r[6] for r in want), rel=1e-9)


def test_lm_scoring_without_rows_and_without_training_rows(spark, docs):
    assert kneser_ney.score_documents(docs.where("false")).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    got = kneser_ney.score_documents(docs.where(F.col("doc_id").isin(held))).collect()
    assert got and all(r.score == 0 and r.base_score == 0 and r.train_tokens == 0 for r in got)


def test_quality_scores_held_out_rows_well(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in quality.op6_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(r.predicted, labels[i]) for i, r in got.items() if r.held_out and i in labels]
    assert np.mean([p == q for p, q in held]) > 0.97
    assert np.mean([p for p, q in held if q]) > 0.98


def brute_quality(texts):
    """Words' vectors and documents' features word by word."""
    key = lambda w: int(quality.Words([w]).keys()[0])
    one = lambda k, kind, bits: _index_vector(k, kind, bits)
    sums, words = defaultdict(lambda: np.zeros(quality.CONTEXT)), [t.lower().split() for t in texts]
    bucket = lambda w: int(quality.bucket_of(np.array([key(w)], dtype=np.uint64))[0])
    for ws in words:
        for i, w in enumerate(ws):
            for side, j in (("left", i - 1), ("right", i + 1)):
                if 0 <= j < len(ws):
                    sums[bucket(w)] += one(key(ws[j]), side, quality.CONTEXT_BITS)
    unit = {b: v / np.linalg.norm(v) if v.any() else v for b, v in sums.items()}
    rows = []
    for ws in words:
        context, own = np.zeros(quality.CONTEXT), np.zeros(quality.DIM)
        for w in ws:
            context += unit.get(bucket(w), 0)
            kinds = [any(65 <= c <= 90 for c in w), any(97 <= c <= 122 for c in w), any(48 <= c <= 57 for c in w),
                     any(c < 128 and not bytes([c]).isalnum() for c in w), any(c >= 128 for c in w)]
            shape = sum(k << n for n, k in enumerate(kinds)) + 64 * min(len(w), 12)
            for kind, k in zip(quality.KINDS, (key(w), key(w[:3]), key(w[-3:]), shape), strict=True):
                own += one(k, kind, quality.DIM_BITS)
        rows.append(np.concatenate([context, own]) / max(len(ws), 1))
    return unit, np.array(rows)


def _index_vector(k, kind, bits):
    h = int(quality.mix(np.array([k ^ quality.seeded_uint(quality.SEED, kind)], dtype=np.uint64))[0])
    out = np.zeros(1 << bits)
    for _ in range(quality.NONZERO):
        out[h & (1 << bits) - 1] += 1 - 2 * (h >> bits & 1)
        h >>= bits + 1
    return out


def test_quality_vectors_and_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "AT_ONCE", 7)
    texts = ["the cat sat on the mat", "the dog sat on the mat", "a", "", "x1 über-9 the the the\nthe " * 5, "  one\ttwo  "] + [
        f"number {i} sat on the {w}" for i in range(12) for w in ("mat", "rug")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    vectors = quality.word_vectors(docs.unionByName(spark.createDataFrame([(99, None)], docs.schema)))
    unit, rows = brute_quality([t.encode() for t in texts])
    assert {b for b in range(len(vectors)) if vectors[b].any()} == {b for b, v in unit.items() if v.any()}
    assert all(np.allclose(vectors[b], v, atol=1e-6) for b, v in unit.items())
    got = quality.features([t.encode() for t in texts], vectors)
    assert np.allclose(got[:, :-quality.N_RATES], rows, atol=1e-6)
    like = lambda a, b: float(vectors[quality.bucket_of(quality.Words([a]).keys())[0]] @ vectors[quality.bucket_of(quality.Words([b]).keys())[0]])
    assert like(b"mat", b"rug") > 0.8 > like(b"mat", b"sat")  # words used alike point alike
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id bigint, quality int")
    net = quality.train(docs, labels)
    x = (got - net.mean) / net.scale
    z = [sum(np.tanh(sum(x[r, i] * net.w1[i, j] for i in range(x.shape[1])) + net.b1[j]) * net.w2[j] for j in range(quality.HIDDEN)) + net.b2[0]
         for r in range(3)]
    assert np.allclose(net.of([t.encode() for t in texts[:3]]), 1 / (1 + np.exp(-np.array(z) / net.temperature)), atol=1e-6)


def test_quality_odd_rows(spark, docs):
    labels = spark.read.parquet(f"{fx.SF}/labels.parquet")
    extra = fx.with_extra(docs)
    net = quality.train(extra, labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 0)], labels.schema)))
    scored = quality.score(extra, net).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    by_key = defaultdict(set)
    for r in scored:
        by_key[r.text_key].add(r.score)
    assert max(len(s) for s in by_key.values()) <= 2  # equal texts: one score but for sums in another order
    out = quality.stage_quality(spark, extra, fx.SF)
    assert out.columns == extra.columns and 0 < out.count() < docs.count()
    assert quality.train(docs, labels.where("quality = 1")).score(np.zeros((2, 1))).tolist() == [1.0, 1.0]
    assert quality.train(docs, labels.where("false")).score(np.zeros((1, 1))).tolist() == [0.5]
    assert quality.stage_quality(spark, docs.where("false"), fx.SF).count() == 0


def test_mixing_meets_targets_and_repeats_itself(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    size = lambda df: {r[0]: r[1] for r in df.groupBy(mixing.pool_of(mixing.RECIPE).alias("pool")).agg(F.sum(F.length("text"))).collect()}
    mixture = size(mixing.replicate(docs))
    whole = sum(mixture.values())
    # 500 documents a source, lengths with a long tail: a share varies by about 8 % of itself
    for pool, share in {**mixing.RECIPE, "": mixing.OTHER}.items():
        assert mixture[pool] / whole == pytest.approx(share, rel=0.3)
    a = mixing.shuffled(mixing.replicate(docs)).select("doc_id", mixing.COPY, mixing.ORDER).collect()
    b = mixing.replicate(docs.repartition(7)).select("doc_id", mixing.COPY, mixing.ORDER).collect()
    assert sorted(a) == sorted(b) and [r[2] for r in a] == sorted(r[2] for r in a)


def test_mixing_shares_out_the_targets_of_absent_sources(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("src"), F.col("id") % 4).alias("source"), F.lit("x" * 50).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(9000, "src9", None), (9001, "src9", "")], "doc_id bigint, source string, text string"))
    got = dict(mixing.rates(docs, {"src0": 0.3, "src1": 0.1, "src8": 0.2, "src9": 0.2}, 0.2))
    # present: src0, src1 and the rest (two sources), 0.6 of the targets; src9 has no characters
    assert got == pytest.approx({"": 0.2 / 0.6 * 2, "src0": 0.3 / 0.6 * 4, "src1": 0.1 / 0.6 * 4, "src9": 0.0})
    assert abs(mixing.replicate(docs, {"src0": 0.3, "gone": 0.3}, 0.4).count() - 4000) < 300
    assert dict(mixing.rates(docs, {"gone": 1.0}, 0.0)) == {"": 0.0}
    assert dict(mixing.rates(docs.limit(0), mixing.RECIPE, mixing.OTHER)) == {}


def test_mixing_draws_are_poisson_at_small_and_large_means(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"),
                                    F.when(F.col("id") < 40, "few").otherwise("many").alias("source"))
    n = [r[0] for r in mixing.replicate(docs, {"few": 0.9}, 0.1).where("source = 'few'").groupBy("doc_id").count().select("count").collect()]
    assert len(n) == 40 and np.mean(n) == pytest.approx(67.5, rel=0.06) and np.var(n) < 200
    n = [r[0] for r in mixing.replicate(docs, {"few": 0.01}, 0.99).where("source = 'many'").groupBy("doc_id").count().select("count").collect()]
    n += [0] * (2960 - len(n))
    assert np.mean(n) == pytest.approx(1.0, abs=0.06) and np.var(n) == pytest.approx(1.0, abs=0.12)
    assert mixing.cumulative(2.0)[:2] == pytest.approx([math.exp(-2), 3 * math.exp(-2)])


def test_mixing_odd_rows(spark, docs):
    extra = fx.with_extra(docs)
    out = mixing.stage_mixing(spark, extra, fx.SF)
    assert out.columns == extra.columns and out.count() > 0 and out.where("mix_rate <> -1 or n_copies <> -1").count() == 0
    assert mixing.stage_mixing(spark, docs.where("false"), fx.SF).count() == 0
    no_text = docs.where("doc_id in (100001, 100002)")
    assert mixing.stage_mixing(spark, no_text, fx.SF).count() == 0  # a mixture of no characters


def test_token_ids_are_those_of_the_tokenizers_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t, *_ in fx.rows()] + ["a  b", " a", "a ", "a \n b", "é è  ö", "don't  stop's", "x  y", "a 　b",
                                                  "　 a", "a　 　b", "\n a", "  ", " ", "1 2  3", "a\x1c b", "tab\t x"]
    for t in texts * 2:
        assert np.frombuffer(packing.token_ids(t), dtype="<u2").tolist() == whole.encode(t, add_special_tokens=False).ids + [1], repr(t[:50])


def test_token_ids_of_added_tokens_and_long_blanks(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda t: np.frombuffer(packing.token_ids(t), dtype="<u2").tolist()
    assert ids("a <|endoftext|> b") == [64, 220, 50256, 275, 1]
    texts = ["<|endoftext|>", "a<|endoftext|><|endoftext|>b <|endoftext", "a" + " " * 1_000_000 + "b", "\n" * 1_100_000, "", "a b"]
    want = [whole.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert [ids(t) for t in texts] == want
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in packing.encoded(texts)] == want
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    covered = Counter()
    for r in rows:
        covered[r.doc_id] += r.length
        piece = np.array(want[r.doc_id][r.start:r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(want[r.doc_id])
    assert covered == {i: len(x) for i, x in enumerate(want)}


@pytest.mark.parametrize("window,shard_tokens", [(2048, 1_500_000), (256, 20_000)])
def test_packing_holds_every_token_once(spark, docs, window, shard_tokens):
    rows = packing.pack(fx.with_extra(docs), window, shard_tokens).collect()
    want = Counter((i, packing.token_ids(t)) for i, t in fx.pairs(docs))
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    short = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        size = sum(p.length for p in pieces)
        assert 0 < size <= window and (size == window or size & (size - 1) == 0)
        short += size < window
    crc = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    covered = Counter()
    for r in rows:
        covered[r.doc_id] += r.length
    size_of = Counter()
    for (i, ids), n in want.items():
        size_of[i] += n * len(ids) // 2
    assert covered == size_of
    single = {i: ids for (i, ids), n in want.items() if n == 1 and sum(j == i for j, _ in want) == 1}
    for (i, start, length, c), n in crc.items():
        if i in single:
            ids = np.frombuffer(single[i], dtype="<u2")[start:start + length]
            assert n == 1 and zlib.crc32(ids.astype("<u4").tobytes()) == c
    assert short < 12 * (1 + sum(size_of.values()) // shard_tokens + 1)


def test_packing_puts_like_documents_together():
    rng = np.random.default_rng(0)
    topics = [rng.integers(1000 * k, 1000 * k + 40, size=(12, 60)).astype("<u2") for k in range(1, 9)]
    shard = [t[i] for i in range(12) for t in topics]
    df = np.bincount(np.concatenate([np.unique(x) for x in shard]), minlength=1 << 16)
    pieces = packing.pack_shard(shard, np.log1p((len(shard) - df + .5) / (df + .5)), 60.0, window=600)
    by_sequence = defaultdict(Counter)
    for d, _, length, s, _ in pieces:
        by_sequence[s][d % 8] += length
    assert np.mean([c.most_common(1)[0][1] / sum(c.values()) for c in by_sequence.values()]) > 0.85


def test_fast_ids_are_the_files_ids_for_any_text():
    import random
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    points = [c for c in range(0x3400) if not 0xD800 <= c < 0xE000] + list(range(0x3400, 0x30000, 37)) + list(range(0xE0000, 0x110000, 997))
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)} \n{chr(c)}'s" for c in points if not 0xD800 <= c < 0xE000]
    rng = random.Random(6)
    usual = [chr(c) for c in (32, 9, 10, 13, 39, 46, 48, 49, 0xA0, 0x2003, 0x3000, 0x1F600, 0xE9, 0x4E2D)] + ["'s", "'ll", "<|endoftext|>", "<|", "|>", "the"]
    texts += ["".join(rng.choice(usual) if rng.random() < .7 else chr(rng.randrange(32, 0xD800)) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts += [c * n for c in ("a", "!", "é", "1", "\n", " ") for n in (packing.LONG_RUN - 1, packing.LONG_RUN, packing.LONG_RUN + 5)]
    for text, e in zip(texts, whole.encode_batch_fast(texts, add_special_tokens=False)):
        assert packing.text_ids(text) == e.ids, repr(text[:60])


def plain_bm25(units, idf, mean):
    counts = [Counter(u.tolist()) for u in units]
    norm = [packing.K1 * (1 - packing.B + packing.B * len(u) / mean) for u in units]
    return np.array([[0.0 if a == b else sum(idf[t] * counts[b][t] * (packing.K1 + 1) / (counts[b][t] + norm[b]) for t in counts[a] if t in counts[b])
                      for b in range(len(units))] for a in range(len(units))])


@pytest.mark.parametrize("dense", [4_000_000, 200])
def test_retrieval_is_plain_bm25_over_all_ids(spark, dense, monkeypatch):
    monkeypatch.setattr(packing, "DENSE", dense)
    units = [np.frombuffer(packing.token_ids(t), dtype="<u2")[:300] for _, t in fx.pairs(fx.documents(spark))][:120]
    df = np.bincount(np.concatenate([np.unique(u) for u in units]), minlength=1 << 16)
    idf = np.log1p((len(units) - df + .5) / (df + .5))
    mean = sum(map(len, units)) / len(units)
    index, want = packing.Index(units, idf, mean), plain_bm25(units, idf, mean)
    for seeds in (np.arange(len(units)), np.array([5])):
        got = index.scores(seeds)
        assert np.allclose(got, want[seeds], rtol=1e-4, atol=1e-3)
        assert (got.argmax(axis=1) == want[seeds].argmax(axis=1)).mean() > 0.98
    # The first window takes the first unit and its neighbours, best first.
    pieces = packing.pack_shard(units, idf, mean, window=2048)
    first = [d for d, *_, s, _ in sorted(pieces, key=lambda p: p[4]) if s == 0]
    order = np.lexsort((np.arange(len(units)), -want[0]))
    assert first == [0, *[int(u) for u in order if want[0][u] > 0]][:len(first)] and len(first) > 4


def test_sequences_do_not_depend_on_the_partitioning(spark, docs):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    get = lambda d: sorted(map(tuple, packing.pack(d, 512, 40_000).collect()))
    assert get(rows.coalesce(1)) == get(rows.repartition(7))


def test_a_row_repeated_very_often_is_dealt_to_several_shards(spark):
    same = spark.range(3000).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("one text that is the same in every row").alias("text"))
    rows = same.unionByName(spark.range(500).select((F.col("id") + 10).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text")))
    out = packing.pack(rows, 256, 5000).collect()
    assert sum(r.length for r in out) == 3000 * len(packing.token_ids("one text that is the same in every row")) // 2 + sum(
        len(packing.token_ids(f"text number {i}")) // 2 for i in range(500))
    shards = Counter()
    for r in out:
        shards[r.sequence_id >> 36] += r.length
    assert len(shards) > 4 and max(shards.values()) < 15_000


def test_packing_without_rows(spark, docs):
    assert packing.pack(docs.where("false")).count() == 0
