"""Spelling variants by a relational trie frontier.

The words of a corpus and their reversals form two tries, kept as one edge table
(node, symbol, child).  A frontier of states (word, position, node, edits) is
joined with the edges of one depth after another: a state without an edit
follows its own word, and at each node may also put another symbol in the place
of its next one, take a further symbol, or leave one out; a state with an edit
follows exactly.  A state whose word ends at the end of another word, one edit
made, is a pair of neighbours.

An edit in a word's second half is found in the trie from the word's first half
on, an edit in the first half in the trie of reversals, so no state branches
near the roots, where every symbol has a child.  An edge carries 256 bits, one set
for each hash of a rest of a word below it; a state that needs a rest whose bit is
not set is dropped at once, which loses nothing.  Edits within equal symbols are
made at the last of them, so every pair is found once.  Nodes are 64-bit hashes
of prefixes; each pair is verified by its edit distance.

A word longer than ``LONG`` code points would need a join for each: those words,
and theirs alone, are compared by hashes of the word without its i-th symbol,
which finds the same pairs.

Defined cases: null, empty and letterless texts have no words; a null id is the
text ``null`` to the query; an empty table gives an empty result; ties between
forms go to the smaller word in code-point order; a word's neighbours are at most
its length times the alphabet, so no group of them grows with the data.  Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty
from keyledger.llm.words import PrefixHash, mix
from keyledger.session import drop_path, scratch_path, stage

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10      # a form is so many times as frequent as its variant
LONG = 64       # code points of the longest words in the tries
FLUSH = 200_000  # different words counted in memory at a time
# Letters: A-Z, a-z and U+00C0 to U+00FF, a byte each in Latin-1; A-Z is lowered.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


# ------------------------------------------------------------------ words

def drop_letter(doc_id: int | None, run: bytes, start: int = 0) -> bytes:
    """The run (Latin-1) without one of its letters where 31 divides the crc32 of
    ``<doc_id>:<run>``; ``start``: the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % 31 == 0 else run


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, misspell: bool = False) -> DataFrame:
    """``word``, ``n``: the runs of letters of all texts, lowered, and how often
    each occurs, of at least ``min_letters`` and ``min_count``.  ``misspell``:
    leave a letter out where ``drop_letter`` says."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                # Letters are one byte each in Latin-1; all else becomes a blank.
                runs = text.as_py().encode("latin-1", "replace").translate(_LETTERS).split()
                words = Counter([w for w in runs if len(w) >= min_letters])
                if misspell:
                    start = zlib.crc32(b"%d:" % i if i is not None else b"null:")
                    for w, n in words.items():
                        spelt = drop_letter(i, w, start)
                        if len(spelt) >= min_letters:
                            held[spelt] += n
                else:
                    held.update(words)
                if len(held) > FLUSH:
                    yield flush()
        yield flush()

    parts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        work, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ tries

def node(prefix):
    """The node of a prefix in the trie of words or (``back``) of reversals."""
    return F.xxhash64("back", prefix)


def rest_bit(pos):
    """0 to 255: a hash of what follows the first ``pos`` symbols."""
    return F.xxhash64(F.expr(f"substring(s, {pos} + 1)")).bitwiseAND(F.lit(255)).cast("int")


def both_ways(words: DataFrame) -> DataFrame:
    """``s`` and ``back`` for every word: itself, and reversed."""
    return words.select(F.col("word").alias("s"), F.lit(False).alias("back")).unionByName(
        words.select(F.reverse("word").alias("s"), F.lit(True).alias("back")))


# From where on a word's own edges may be met, and where its search starts: the
# first half (reversed: the rest) is the same in both words of a pair.
EDGES_FROM = "if(back, length(s) div 2, (length(s) - 1) div 2)"
STARTS_AT = "if(back, length(s) - length(s) div 2, length(s) div 2)"


def edge_table(words: DataFrame) -> DataFrame:
    """``depth``, ``parent``, ``symbol``, ``child`` and ``below0`` to ``below3``, the
    bits of the rests of words below the child, of both tries."""
    k = both_ways(words).select("*", F.explode(F.expr(f"sequence({EDGES_FROM}, length(s) - 1)")).alias("depth"))
    return k.select(
        "depth", node(F.expr("substring(s, 1, depth)")).alias("parent"), F.expr("substring(s, depth + 1, 1)").alias("symbol"),
        node(F.expr("substring(s, 1, depth + 1)")).alias("child"),
        rest_bit("depth + 1").alias("bit"),
    ).groupBy("depth", "parent", "symbol", "child").agg(
        *[F.bit_or(F.expr(f"if(shiftright(bit, 6) = {k}, shiftleft(1L, bit), 0L)")).alias(f"below{k}") for k in range(4)])


STATE = ["s", "back", "pos", "node", "edited"]


def starts(words: DataFrame, depth: int) -> DataFrame:
    """The states that enter at ``depth``: at half the word, and past the next
    symbol, left out."""
    s = both_ways(words).where(F.expr(f"{STARTS_AT} = {depth}")).select(
        "*", F.lit(depth).alias("pos"), node(F.expr(f"substring(s, 1, {depth})")).alias("node"))
    left_out = F.expr("substring(s, pos + 1, 1) != substring(s, pos + 2, 1)")
    moves = F.array(F.struct("pos", F.lit(False).alias("edited")),
                    F.when(left_out, F.struct((F.col("pos") + 1).alias("pos"), F.lit(True).alias("edited"))))
    return s.select("s", "back", "node", F.inline(F.array_compact(moves))).select(*STATE)


def advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: every state over every edge of its node that it can take."""
    rests = sum((rest_bit(f"pos + {k}") * (1 << 8 * k) for k in range(1, 3)), rest_bit("pos"))
    j = states.withColumn("rests", rests).join(edges.drop("depth"), F.col("node") == F.col("parent")).withColumn(
        "next", F.expr("substring(s, pos + 1, 1)"))

    def has(k: int):
        bit = f"(shiftright(rests, {8 * k}) & 255)"
        word = " ".join(f"when {i} then below{i}" for i in range(4))
        return F.expr(f"(shiftright(case shiftright({bit}, 6) {word} end, {bit}) & 1) = 1")

    follows, edited = F.col("symbol") == F.col("next"), F.col("edited")
    move = lambda skip, edit: F.struct(
        (F.col("pos") + skip).cast("int").alias("pos"), F.lit(edit).alias("edited"))
    replaces = ~edited & ~follows & (F.col("next") != "") & has(1)
    takes = ~edited & ~follows & has(0)
    leaves_out = ~edited & follows & F.expr("pos + 1 < length(s) and substring(s, pos + 2, 1) != substring(s, pos + 3, 1)") & has(2)
    keeps = follows & (~edited | has(1))
    moves = F.array(F.when(keeps, F.struct((F.col("pos") + 1).cast("int").alias("pos"), F.col("edited"))),
                    F.when(replaces, move(1, True)), F.when(takes, move(0, True)), F.when(leaves_out, move(2, True)))
    return (j.where(keeps | replaces | takes | leaves_out)
            .select("s", "back", F.col("child").alias("node"), F.inline(F.array_compact(moves))).select(*STATE))


def trie_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of ``words`` (``word``, ``n``, no
    longer than LONG) one edit apart, each in both directions."""
    spark = words.sparkSession
    edges = stage(edge_table(words).sortWithinPartitions("depth"), "spelling-edges")
    shortest, longest = words.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    found, going, consumed = scratch_path(spark, "spelling-found"), None, None
    ended = F.col("edited") & (F.col("pos") == F.length("s"))
    for depth in range((shortest or 1) // 2, (longest or 0) + 1):
        states = starts(words, depth)
        if going is not None:
            states = states.unionByName(going.where(~ended))
        path = scratch_path(spark, "spelling-level")
        advance(states, edges.where(F.col("depth") == depth)).write.parquet(path)
        going = spark.read.schema(states.schema).parquet(path)
        going.where(ended).select("s", "back", "node").write.mode("append").parquet(found)
        if consumed:
            drop_path(spark, consumed)
        consumed = path
    if consumed is None:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where(F.lit(False))
    ends = spark.read.schema("s string, back boolean, node bigint").parquet(found)
    named = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back")).select(
        F.xxhash64("back", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))).alias("node"),
        F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = ends.join(named, "node").select(F.when(F.col("back"), F.reverse("s")).otherwise(F.col("s")).alias("word"),
                                            "near", "near_n", "back")
    # A pair that agrees in the first half of the word was found by the words' own trie.
    again = F.expr("back and substring(word, 1, length(word) div 2) = substring(near, 1, length(word) div 2)")
    return pairs.where(~again & (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "near_n")


# ------------------------------------------------------------------ long words

def without_one(words: DataFrame) -> DataFrame:
    """``id`` and ``size`` of every word with, for each place, ``at`` and the hash
    of the word ``without`` the symbol there; ``last``: the next symbol differs.
    ``at`` -1: the whole word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, word in zip(batch.column("id"), batch.column("word"), strict=True):
                data = np.frombuffer(word.as_py().encode("latin-1"), dtype=np.uint8)
                n, h = len(data), PrefixHash(data)
                without = h.sums[:n] + (h.sums[n] - h.sums[1:]) * h.undo[1]
                without = mix(np.append(without, h.sums[n]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n + 1, i.as_py(), dtype=np.int64)), pa.array(np.full(n + 1, n, dtype=np.int32)),
                     pa.array(np.append(np.arange(n, dtype=np.int32), np.int32(-1))), pa.array(without.view(np.int64)),
                     pa.array(np.append(data != np.append(data[1:], 0), False))],
                    names=["id", "size", "at", "without", "last"])

    return words.select(F.xxhash64("word").alias("id"), "word").mapInArrow(
        work, "id bigint, size int, at int, without bigint, last boolean")


def long_pairs(words: DataFrame) -> DataFrame:
    """As ``trie_pairs``, of words of which one at least is longer than LONG."""
    v = stage(without_one(words), "spelling-long")
    less = v.where("at >= 0 and last").alias("a").join(v.where("at < 0").alias("b"), F.expr("a.without = b.without and a.size = b.size + 1"))
    less = less.select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    same = v.where("at >= 0").alias("a").join(v.where("at >= 0").alias("b"), F.expr(
        "a.without = b.without and a.size = b.size and a.at = b.at")).where(F.expr("a.id != b.id"))
    ids = less.unionByName(less.select(F.col("y").alias("x"), F.col("x").alias("y"))).unionByName(
        same.select(F.col("a.id").alias("x"), F.col("b.id").alias("y")))
    known = words.select(F.xxhash64("word").alias("id"), "word", "n")
    pairs = (ids.join(known.select(F.col("id").alias("x"), "word"), "x")
             .join(known.select(F.col("id").alias("y"), F.col("word").alias("near"), F.col("n").alias("near_n")), "y"))
    return pairs.where((F.greatest(F.length("word"), F.length("near")) > LONG) & (F.levenshtein("word", "near", 1) == 1)).select(
        "word", "near", "near_n")


# ------------------------------------------------------------------ forms

def roots(links: DataFrame) -> DataFrame:
    """``word``, ``root`` of links ``word``, ``form``: the last form reached.  A form
    is RATIO times as frequent as its word, so chains are short; each round doubles
    the steps."""
    at = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.alias("a").join(at.alias("b"), F.col("a.root") == F.col("b.word"), "left")
        moved = stage(further.select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")),
                      "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        at = moved.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every row
    of ``words`` (``word``, ``n``)."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = trie_pairs(words.where(F.length("word") <= LONG))
    if not words.where(F.length("word") > LONG).isEmpty():
        pairs = pairs.unionByName(long_pairs(words.where(F.length("word") >= LONG)))
    near = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("top"))
    top_n = -F.col("top.less")
    is_form = top_n >= ratio * F.col("n")
    formed = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(is_form, F.col("top.form")).alias("form"),
        F.when(is_form, top_n).alias("form_n")), "spelling-forms")
    linked = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(linked, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    found = variants(count_words(documents(spark, sf_dir), misspell=True))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
