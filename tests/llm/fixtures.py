"""Documents with every odd case the operators define, over the given sf0.001
documents, and the brute-force versions they are held against."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
PASSAGE = ("this passage of well over fifty words repeats across documents and is long enough that every window of one hundred "
           "bytes in its middle lies wholly inside it whatever stands before it or after it in the text that quotes it ") * 2
EXTRA = ["kept", "text_key", "ids", "score", "block", "shard", "n_copies", "mix_rate", "component_id"]


def rows() -> list[tuple]:
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(300)
    near = base.split(" ")
    near[150] = "changed"
    out = [
        (100001, None), (100002, ""), (100003, ""), (100004, " \t\n "), (100005, base), (100006, base), (100007, base.upper()),
        (100008, " ".join(near)), (100009, "Ünïcödé “text” 日本語 " + prose(40)), (100010, prose(30_000)), (100011, "a"),
        (100012, "one two"), (100013, PASSAGE + prose(60)), (100014, prose(50) + " " + PASSAGE), (100015, PASSAGE),
        (100016, "x" * 5000), (100017, "x" * 120), (100018, "  double  blanks\t\n  and   more \n\n end "),
        (100019, "password=short"), (100020, 'é Token : "abcdef123" AKIA' + "A1" * 10 + " " + "0af" * 12),
        (100021, "user=alice token=secret=abcdef https://db.example.com/x"), (100022, "https://db.example.com/x alone"),
        (100023, "token=token: longvalue AKIAKIA12 opaque Zm9vYmFyQmF6UXV4MTIz and AKIA" + "B" * 16),
        (100024, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."),
        (None, base), (None, "no id at all"), (100005, base),
    ]
    return [(i, t, "en" if n % 3 else None, f"src{n % 4}" if n % 5 else None, len(t) if t is not None else None)
            for n, (i, t) in enumerate(out)]


def documents(spark, with_given: bool = True):
    odd = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = odd.unionByName(spark.read.parquet(f"{SF}/documents.parquet")) if with_given else odd
    return docs.repartition(5)


def with_extra(docs):
    """Columns more, named as the operators name their own."""
    return docs.select("*", *[F.lit(-1).alias(c) for c in EXTRA])


def pairs(docs) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


class Groups:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
