"""Benchmark passages found in documents by a broadcast set of normalised word n-grams, and cut out.

A benchmark text's windows of ten words are kept under a 64-bit key. Every position of every document
makes the key of the window that begins there and looks it up in a broadcast join, inside the stage
that reads the texts; of its words only those of a document with hits leave it. A hit is verified
word by word before it counts.

Only DataFrame functions are used. The windows are broadcast while they stay under a stated size;
a larger benchmark is taken in as many passes as keep each of them under it.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Words of a window.
WINDOW = 10
#: A word: letters, digits and all that is not ASCII.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Bytes of windows that are broadcast at once.
BROADCAST_BYTES = 64 << 20
#: Bytes that a window takes beside its text and its items' names.
WINDOW_BYTES = 64


def lowered(text: Column) -> Column:
    """A-Z in lower case and no other letter."""
    # lower() alone would do for texts of one byte a character, and it is far faster.
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), lowered)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _key(hashes: Column, at: Column, n: int) -> Column:
    """The key of the window of n words that begins at a position, null where the words end before."""
    key = F.xxhash64(*[F.get(hashes, at + F.lit(k)) for k in range(n)])
    return F.when(at + F.lit(n) <= F.size(hashes), key)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``length, key, grams`` of ``benchmark(item_id, text, ...)``: one row per length and key, with an array of
    ``(gram, items)``.

    A text of fewer words than a window is one window; one without words has none. A null item id
    counts as the empty string.
    """
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    rows = rows.select("item", "words", word_hashes(F.col("words")).alias("hashes"), "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("at"))
    # The key of an array is that of its elements in a row.
    key = F.xxhash64(F.slice("hashes", F.col("at") + 1, F.col("length")))
    gram = F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ")
    grams = rows.select("length", key.alias("key"), gram.alias("gram"), "item").distinct()
    grams = grams.groupBy("length", "key", "gram").agg(F.collect_list("item").alias("items"))
    return grams.groupBy("length", "key").agg(F.collect_list(F.struct("gram", "items")).alias("grams"))


def _verified(words: Column, at: Column, n: int, grams: Column) -> Column:
    """``(from, to, items)`` of the gram that is the window of n words itself, null if none is."""
    own = F.array_join(F.slice(words, at + 1, n), " ")
    items = F.flatten(F.transform(F.filter(grams, lambda g: g["gram"] == own), lambda g: g["items"]))
    return F.when(F.size(items) > 0, F.struct(at.alias("from"), (at + n).alias("to"), items.alias("items")))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value bound, so that lambdas inside do not compute it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(places: Column) -> Column:
    """Maximal runs ``(from, to)`` of sorted distinct places."""
    opens = F.filter(places, lambda p, i: (i == 0) | (F.get(places, i - 1) != p - 1))
    ends = F.filter(places, lambda p, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != p + 1))
    return F.arrays_zip(opens.alias("from"), F.transform(ends, lambda p: p + 1).alias("to"))


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``doc_id, n_words, spans, items`` for each row of ``docs(doc_id, text, ...)``.

    ``spans`` are the merged runs ``(from, to)`` of words that some occurrence of a window covers, ``items``
    the sorted names of the benchmark items whose windows occur. Texts without words, empty and
    null ones have neither; an empty benchmark hits nothing. Rows that repeat stay as they are, and
    other columns of either table are not looked at.
    """
    windows = stage(benchmark_windows(benchmark, window), "windows")
    size = F.sum(F.aggregate("grams", F.lit(WINDOW_BYTES), lambda n, g: n + F.octet_length(g["gram"]) + F.octet_length(F.array_join(g["items"], " ")) + 32))
    found = windows.groupBy("length").agg(size.alias("bytes")).collect()  # a row for each length, of which there are ten
    lengths = sorted(r["length"] for r in found)
    passes = max(1, -(-sum(r["bytes"] for r in found) // broadcast_bytes))

    rows = docs.select(
        F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), words_of(F.col("text")).alias("words"),
        # Rows that repeat are told apart by where they were read, so none of them gather in one task.
        F.spark_partition_id().alias("part"),
    )
    if passes > 1:
        rows = stage(rows, "words")
    rows = rows.withColumn("hashes", word_hashes(F.col("words")))
    each = rows.select("id", "digest", "part", "words", "hashes", F.posexplode_outer("hashes").alias("at", "hash")).drop("hash")

    def look_up(k: int) -> DataFrame:
        out, hits = each, []
        for n in lengths:
            held = windows.filter((F.col("length") == n) & (F.pmod("key", F.lit(passes)) == k))
            held = held.select(F.col("key").alias(f"key{n}"), F.col("grams").alias(f"grams{n}"))
            out = out.withColumn(f"own{n}", _key(F.col("hashes"), F.col("at"), n))
            out = out.join(F.broadcast(held), F.col(f"own{n}") == F.col(f"key{n}"), "left")
            hits.append(_verified(F.col("words"), F.col("at"), n, F.col(f"grams{n}")))
        first = (F.coalesce("at", F.lit(0)) == 0) if k == 0 else F.lit(False)
        any_key = F.lit(False)
        for n in lengths:
            any_key = any_key | F.col(f"grams{n}").isNotNull()
        out = out.filter(first | any_key)
        held = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<struct<from:int,to:int,items:array<string>>>")
        return out.select("id", "digest", "part", F.size("words").alias("n"), F.when(first, 1).otherwise(0).alias("base"), held.alias("hits"))

    seen = look_up(0)
    for k in range(1, passes):
        seen = seen.unionAll(look_up(k))
    told = seen.groupBy("id", "digest", "part").agg(
        F.max("n").cast("long").alias("n_words"),
        F.sum("base").alias("copies"),
        F.flatten(F.collect_set(F.transform("hits", lambda h: F.struct(h["from"], h["to"])))).alias("covers"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.flatten(F.transform("hits", lambda h: h["items"])))))).alias("items"),
    )
    inside = F.array_sort(F.array_distinct(F.flatten(F.transform("covers", lambda s: F.sequence(s["from"], s["to"] - 1)))))
    told = told.withColumn("spans", _once(inside, _runs))
    told = told.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return told.select(F.col("id").alias("doc_id"), "n_words", "spans", "items", "digest")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``."""
    hits = benchmark_hits(docs, benchmark, window, broadcast_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_hits(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with all its columns, less what the benchmark covers.

    ``remove="spans"`` cuts the covered words out of ``text``, each with the separators before it;
    ``"documents"`` leaves out documents with any. Texts without hits, null ones too, stay as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    hits = benchmark_hits(docs, benchmark, window, broadcast_bytes).filter(F.size("spans") > 0)
    hits = hits.dropDuplicates(["doc_id", "digest"]).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans"))
    own = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("__row"), F.col("doc_id").alias("__own"), F.col("text").alias("__text"))
    same = F.col("__own").eqNullSafe(F.col("__id")) & (F.md5(F.coalesce("__text", F.lit("")).cast("binary")) == F.col("__digest"))
    back = [F.col(f"__row.c{i}") for i in range(len(docs.columns))]
    if remove == "documents":
        return own.join(hits, same, "left_anti").select(*[b.alias(c) for b, c in zip(back, docs.columns, strict=True)])
    # A piece is a word with what stands before it; what follows the last word stays.
    upper = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
    other = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]"
    pieces = F.regexp_extract_all("__text", F.lit(f"{other}*{upper}+"), F.lit(0))
    tail = F.regexp_extract("__text", f"({other}*)$", 1)

    def between(own: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["to"]))
        starts = F.concat(F.transform("__spans", lambda s: s["from"]), F.array(F.size(own)))
        gaps = F.arrays_zip(ends.alias("from"), starts.alias("to"))
        return F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice(own, g["from"] + 1, g["to"] - g["from"]))), "")

    kept = F.concat(_once(pieces, between), tail)
    cut = own.join(hits, same, "left").withColumn("__kept", F.when(F.col("__spans").isNull(), F.col("__text")).otherwise(kept))
    return cut.select(*[(F.col("__kept") if c == "text" else b).alias(c) for b, c in zip(back, docs.columns, strict=True)])
