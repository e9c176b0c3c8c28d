import random
import re
import zlib
from collections import Counter

import pytest

from keyledger.llm import spelling as S
from tests.llm import fixtures as fx


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute(words, ratio=10):
    by = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w in words:
        f = min(by[w], key=lambda x: (-words[x], x), default=None)
        form[w] = f if f is not None and words[f] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (words[w], len(by[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def found(spark, words, **k):
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    rows = S.variants(df, **k).collect()
    assert len(rows) == len(words)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def edited(rng, w, letters):
    k, c, o = rng.randrange(len(w) + 1), rng.choice(letters), rng.randrange(3)
    return w[:k] + c + w[k:] if o == 0 or k == len(w) else w[:k] + c + w[k + 1:] if o == 1 or len(w) < 8 else w[:k] + w[k + 1:]


def test_words_of_few_letters_against_brute_force(spark):
    rng = random.Random(5)
    words = Counter()
    base = ["".join(rng.choice("abÀéÿ") for _ in range(rng.randint(7, 10))) for _ in range(50)] + [
        "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "baaaaaaa", "aaaaaaab", "ababababa", "abababab", "babababab"]
    for b in base:
        words[b] += rng.choice([2, 30, 400, 5000, 60_000])
        for _ in range(6):
            words[edited(rng, b, "abÀéÿ")] += rng.choice([2, 3, 30, 400])
    want = brute(words)
    assert found(spark, words) == want
    chains = [w for w, v in want.items() if v[2] and want[v[2]][2]]
    assert chains and all(want[w][4] != want[w][2] for w in chains)  # roots lie beyond the first form


def test_long_words_and_those_at_the_limit(spark):
    words = Counter({"x" * k: 5 + 100 * (k % 3) for k in range(60, 70)})
    words.update({("xy" * 40)[:k]: k for k in (63, 64, 65, 66, 79)})
    words.update({"z" * 3000: 7, "z" * 2999: 70, "z" * 1500 + "q" + "z" * 1499: 700, "z" * 1500 + "é" + "z" * 1499: 7000, "shorter": 9, "shortest": 99})
    assert found(spark, words) == brute(words)


def test_ties_and_the_ratio(spark):
    words = {"abcdefg": 2, "abcdefh": 20, "abcdeff": 20, "abcdefgg": 19, "zzzzzzz": 3, "zzzzzzy": 29}
    got = found(spark, words)
    assert got["abcdefg"] == (2, 3, "abcdeff", 20, "abcdeff") and got["zzzzzzz"] == (3, 1, None, None, "zzzzzzz")
    assert found(spark, words, ratio=9) == brute(words, 9)


def brute_words(pairs, misspell):
    out = Counter()
    for i, t in pairs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i if i is not None else 'null'}:{w}".encode())
            if misspell and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 2}


@pytest.mark.parametrize("misspell", [False, True])
def test_counted_words(spark, misspell, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 50)
    docs = fx.documents(spark)
    more = spark.createDataFrame([(1, "ÀÉÎÕÜ×÷ÿ ÀÉÎÕÜ×÷ÿ àéîõüßœabcdefgh 日本語abcdefgh ABCDEFGh"), (2, "abcdefgh" * 40_000 + " é\x85abcdefgh\xa0x")], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(more)
    got = {r.word: r.n for r in S.count_words(docs, misspell=misspell).collect()}
    assert got == brute_words(fx.pairs(docs), misspell) and "àéîõüß" not in got


def test_the_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{fx.SF}/documents.parquet")
    want = brute(brute_words(fx.pairs(docs), True))
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.op13_spelling_variants(spark, fx.SF).collect()}
    assert got == want and sum(v[2] is not None for v in want.values()) > 5


def test_empty_tables_and_texts_without_words(spark):
    docs = fx.documents(spark)
    assert S.variants(S.count_words(docs.limit(0))).collect() == []
    none = spark.createDataFrame([(1, None), (2, ""), (None, "1 2 ab cd"), (3, "onlyonce")], "doc_id bigint, text string")
    assert S.variants(S.count_words(fx.with_extra(none))).collect() == []
    assert found(spark, {"lonelyword": 5}) == {"lonelyword": (5, 0, None, None, "lonelyword")}
