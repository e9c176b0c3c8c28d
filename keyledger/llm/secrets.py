"""Secret scans by multipart credential linking.

Parts are found by patterns over whole texts: strong ones (assignments, access
key ids, hex keys) stand alone; weak ones (logins, opaque tokens, endpoints)
mean little by themselves.  Weak parts are joined by interval with the parts of
the other classes in the same scope, ``SCOPE`` code points to either side, and
are reported only when what completes them is there: a login needs a secret, an
opaque token an identifier or an endpoint, an endpoint an identifier and a
secret.

The interval join is an equi-join on (document, cell): cells are ``SCOPE`` code
points, a part lies in every cell from its start to its end, the scope's parts
are first reduced to one row per document, cell and class (first start, last
end), and a weak part looks into the cells its scope touches.  So a document
with very many parts gives rows in proportion to its length, never pairs of them.  The text is scanned once; only lengths of
matches and of what lies between are kept, and positions are their running
sums.  DataFrame functions only.

Defined cases: null text counts as empty; a document without parts has zero
counts and empty spans; rows that repeat an id and text have equal results.  An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger.llm.common import documents, text_key, text_or_empty
from keyledger.session import stage

SCOPE = 200

# The patterns of the base kinds, then those of the weak kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run is taken whole, so runs that are too short can be left out here
LOGIN = r"""(?i)\b(?:user(?:_?name|_?id)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""(?i)\b(?:https?|s?ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]{3,}"""
MIXED = ["[A-Z]", "[a-z]", "[0-9]"]  # an opaque token holds one of each

#: name, pattern, group whose length is tested (0: the match), least length, class
KINDS = [
    ("assign", ASSIGN, 2, 6, "secret"),
    ("access", ACCESS, 0, 20, "id"),
    ("hex", HEX, 0, 24, "secret"),
    ("login", LOGIN, 0, 1, "id"),
    ("opaque", OPAQUE, 0, 20, "secret"),
    ("endpoint", ENDPOINT, 0, 1, "place"),
]
BASE = 3  # the first kinds are reported wherever they are
KEY = ["doc_id", "text_key"]


def _matches(no: int):
    """Array of (kind, no, gap, size, ok) of one kind: the code points between
    the match before and this one, those of the match, whether it counts."""
    _, pattern, group, least, _ = KINDS[no]
    found, tested = F.col(f"m{no}"), F.col(f"g{no}") if group else F.col(f"m{no}")
    gaps = F.split("text", pattern, -1)
    mixed = lambda m: [m.rlike(c) for c in (MIXED if pattern == OPAQUE else [])]
    row = F.transform(F.arrays_zip(found.alias("m"), tested.alias("t"), F.transform(F.slice(gaps, 1, F.size(found)), F.length).alias("gap")),
                      lambda x: F.struct(F.lit(no).alias("kind"), x["gap"].alias("gap"), F.length(x["m"]).alias("size"),
                                         reduce(and_, mixed(x["m"]), F.length(x["t"]) >= least).alias("ok")))
    numbered = F.transform(row, lambda x, i: F.struct(x["kind"].alias("kind"), i.alias("no"), x["gap"].alias("gap"),
                                                      x["size"].alias("size"), x["ok"].alias("ok")))
    return F.when(F.size(found) > 0, numbered).otherwise(
        F.array().cast("array<struct<kind:int,no:int,gap:int,size:int,ok:boolean>>"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and ``parts`` of every row: the one pass over texts."""
    texts = docs.select("doc_id", text_key().alias("text_key"), text_or_empty().alias("text"))
    found = texts.select("*", *[F.regexp_extract_all("text", F.lit(p), 0).alias(f"m{i}")
                                for i, (_, p, _, _, _) in enumerate(KINDS)])
    found = found.select("*", *[F.when(F.size(f"m{i}") > 0, F.regexp_extract_all("text", F.lit(p), g)).otherwise(
        F.col(f"m{i}")).alias(f"g{i}") for i, (_, p, g, _, _) in enumerate(KINDS) if g])
    return found.select(*KEY, F.concat(*[_matches(i) for i in range(len(KINDS))]).alias("parts"))


def located(scanned: DataFrame) -> DataFrame:
    """One row per part that counts: doc_id, text_key, kind, start, end."""
    rows = (scanned.where(F.size("parts") > 0).dropDuplicates(KEY)
            .select(*KEY, F.explode("parts").alias("p")).select(*KEY, "p.*"))
    before = Window.partitionBy(*KEY, "kind").orderBy("no")
    ends = F.sum(F.col("gap").cast("bigint") + F.col("size")).over(before)
    parts = rows.select(*KEY, "kind", (ends - F.col("size")).alias("start"), ends.alias("end"), "ok").where("ok")
    # A weak part that lies in a base span is that span's own value.
    earlier = Window.partitionBy(*KEY).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    covered = F.max(F.when(F.col("kind") < BASE, F.col("end"))).over(earlier)
    return (parts.withColumn("covered", F.coalesce(covered, F.lit(0)))
            .where((F.col("kind") < BASE) | (F.col("covered") <= F.col("start"))).drop("covered", "ok"))


def completed(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complement lies within ``scope`` of them."""
    kind_class = F.element_at(F.array(*[F.lit(c) for *_, c in KINDS]), F.col("kind") + 1)
    cell = lambda c: F.floor(c / scope).cast("bigint")
    cells = (parts.select(*KEY, kind_class.alias("class"), "start", "end",
                          F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))).alias("cell"))
             .groupBy(*KEY, "cell", "class").agg(F.min("start").alias("first"), F.max("end").alias("last")))
    weak = parts.where(F.col("kind") >= BASE).select(
        *[F.col(k).alias(f"w_{k}") for k in KEY], "kind", "start", "end",
        F.explode(F.sequence(cell(F.col("start") - scope), cell(F.col("end") + scope))).alias("w_cell"))
    near = weak.join(cells, weak["w_doc_id"].eqNullSafe(cells["doc_id"]) & (weak["w_text_key"] == cells["text_key"])
                     & (weak["w_cell"] == cells["cell"])
                     & (cells["first"] <= weak["end"] + scope) & (cells["last"] >= weak["start"] - scope))
    has = {c: F.max(cells["class"] == c) for c in ("id", "secret", "place")}
    name = F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), F.col("kind") + 1)
    met = near.groupBy("w_doc_id", "w_text_key", "kind", weak["start"], weak["end"]).agg(
        *[v.alias(f"has_{c}") for c, v in has.items()])
    whole = (F.when(name == "login", F.col("has_secret"))
             .when(name == "opaque", F.col("has_id") | F.col("has_place"))
             .otherwise(F.col("has_id") & F.col("has_secret")))
    return met.where(whole).select(F.col("w_doc_id").alias("doc_id"), F.col("w_text_key").alias("text_key"),
                                   "kind", "start", "end")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, n_linked (weak
    parts reported), base_sha256 and spans."""
    scanned = stage(scan(docs), "secret-parts")
    parts = stage(located(scanned), "secret-spans")
    spans = parts.where(F.col("kind") < BASE).unionByName(completed(parts, scope))
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), s["kind"] + 1)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    per_doc = spans.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{KINDS[i][0]}") for i in range(BASE)])
    found = per_doc.select(
        F.col("doc_id").alias("f_doc_id"), F.col("text_key").alias("f_key"), *[f"n_{KINDS[i][0]}" for i in range(BASE)],
        F.size(F.filter("all", lambda s: s["kind"] >= BASE)).cast("bigint").alias("n_linked"),
        F.sha2(text(F.filter("all", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"), text(F.col("all")).alias("spans"))
    rows = scanned.select(*KEY)
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["f_doc_id"]) & (rows["text_key"] == found["f_key"]), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select("doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), zero("n_linked"),
                      F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def _oracle() -> str:
    """DuckDB: the same scan; the interval join written as a plain one."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    found = "\nUNION ALL ".join(
        f"SELECT doc_id, {i} AS kind, regexp_extract_all(t, {quote(p)}, 0) AS m, regexp_extract_all(t, {quote(p)}, {g}) AS g, "
        f"regexp_split_to_array(t, {quote(p)}) AS gaps, {least} AS least FROM d"
        for i, (_, p, g, least, _) in enumerate(KINDS))
    opaque = next(i for i, k in enumerate(KINDS) if k[1] == OPAQUE)
    mixed = " AND ".join(f"regexp_matches(m, '{c}')" for c in MIXED)
    names, classes = ("[" + ", ".join(f"'{k[j]}'" for k in KINDS) + "][kind + 1]" for j in (0, 4))
    near = lambda c: f"max(o.class = '{c}')"
    show = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    counts = ", ".join(f"count(*) FILTER (kind = {i})::BIGINT AS n_{KINDS[i][0]}" for i in range(BASE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
rows AS (SELECT doc_id, kind, least, unnest(range(1, len(m) + 1)) AS no, unnest(m) AS m, unnest(g) AS g, unnest(gaps[1:len(m)]) AS gap
         FROM found WHERE len(m) > 0),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY no)::BIGINT AS stop FROM rows),
spans AS (SELECT doc_id, kind, stop - length(m) AS start, stop, {names} AS name, {classes} AS class
          FROM placed WHERE length(g) >= least AND (kind <> {opaque} OR ({mixed}))),
open AS (SELECT * FROM (SELECT *, max(CASE WHEN kind < {BASE} THEN stop END) OVER (PARTITION BY doc_id ORDER BY start, kind) AS covered
                        FROM spans) WHERE kind < {BASE} OR coalesce(covered, 0) <= start),
met AS (SELECT w.doc_id, w.kind, w.start, w.stop, w.name, {near('id')} AS has_id, {near('secret')} AS has_secret, {near('place')} AS has_place
        FROM open w JOIN open o ON o.doc_id = w.doc_id AND o.start <= w.stop + {SCOPE} AND o.stop >= w.start - {SCOPE}
        WHERE w.kind >= {BASE} GROUP BY ALL),
shown AS (SELECT doc_id, kind, start, stop, name FROM open WHERE kind < {BASE}
          UNION ALL SELECT doc_id, kind, start, stop, name FROM met
          WHERE CASE name WHEN 'login' THEN has_secret WHEN 'opaque' THEN has_id OR has_place ELSE has_id AND has_secret END),
per AS (SELECT doc_id, {counts}, count(*) FILTER (kind >= {BASE})::BIGINT AS n_linked,
               coalesce({show} FILTER (kind < {BASE}), '') AS base, {show} AS spans FROM shown GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_linked, 0) AS n_linked, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""


ORACLE = _oracle()
