"""A mix of sources to target weights whose shares change over the training, by integrated schedules.

A source's schedule says how much it is drawn at each moment of the training, which runs from 0 to 1.
Its integral, scaled to the source's target, is the number of words that the source has given by each
moment. Every copy of a document begins at some number of words into its source; the moment at which
the source has given that many is the copy's training position. Sorting all copies by position gives
the order of training.

Only DataFrame functions are used. A source is never held in one task: documents fall into buckets by
hash, sums are taken per bucket first, and the running total is the bucket's start plus the one inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK

#: Share weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
REPEATS = 3
#: For each weight, the source's schedule: (moment, height) points joined by lines.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.75, 1.0), (1.0, 2.0)),
)
Schedule = Sequence[tuple[float, float]]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{BLANK}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, weight_class, target`` from one row per source ``(source, source_size)``.

    Sources weigh ``weights`` in turn, by code point order, null last. Together they get the words of
    all sources; none gets more than ``repeats`` times its own, and what it cannot take goes to the
    others by weight. The level at which that ends is found at once: sources fill up in order of
    size to weight, so running sums in that order give the level after each.
    """
    everywhere = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everywhere.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("weight_class", F.pmod(place, F.lit(len(weights))).cast("int"))
    rows = rows.withColumn("w", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), F.col("weight_class") + 1))
    rows = rows.withColumn("cap", F.col("source_size") * repeats).withColumn("fill", F.col("cap").cast("double") / F.col("w").cast("double"))
    before = everywhere.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "words": F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(before), F.lit(0)),
        }
    )
    # The first source that its share does not fill sets the level for itself and all after it.
    # Weights are left until the last source; only without sources there are none.
    share = F.try_divide(F.col("words").cast("double"), F.col("weights").cast("double"))
    level = F.min(F.when(share <= F.col("fill"), F.struct("fill", share.alias("level")))).over(everywhere)["level"]
    target = F.least(F.col("cap").cast("double"), level * F.col("w").cast("double"))
    return rows.select("source", "source_size", "weight_class", target.alias("target"))


def moment(part: Column, schedule: Schedule) -> Column:
    """The moment by which ``part`` (0 to 1) of a schedule's integral is reached."""
    steps, total = [], 0.0
    for (t0, y0), (t1, y1) in zip(schedule[:-1], schedule[1:], strict=True):
        steps.append((t0, t1, y0, y1, total))
        total += (t1 - t0) * (y0 + y1) / 2.0
    want = part * F.lit(total)
    out = F.lit(float(schedule[-1][0]))
    for t0, t1, y0, y1, done in reversed(steps):
        slope = (y1 - y0) / (t1 - t0)
        more = want - F.lit(done)
        # Height times time plus half the slope times its square is what is still wanted.
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(y0 * y0) + F.lit(2.0 * slope) * more))
        step = F.lit(2.0) * more / (F.lit(y0) + root) if slope else more / F.lit(y0)
        end = done + (t1 - t0) * (y0 + y1) / 2.0
        out = F.when(want < F.lit(end), F.lit(t0) + step).otherwise(out)
    return out


def curriculum(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    schedules: Sequence[Schedule] = SCHEDULES,
    digits: int = 3,
    keep_text: bool = False,
) -> DataFrame:
    """All columns of ``docs(doc_id, text, source, ...)``, the text only if kept, and ``__size, __source_size, __target,
    __taken, __copies``: an array of ``(words, position)``, one for each time the document is taken.

    A source gives its documents in the order of a hash of the id, over and over, until its target
    (in whole words) is reached; the last copy may give only its first words. A null text and one of
    blanks have no words and no copies, and a source of such texts has the target 0. Rows that repeat an id follow one another by text. ``digits``
    hexadecimal digits of the hash make the buckets of the running sum.
    """
    names = [c for c in docs.columns if keep_text or c != "text"]
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), word_count(F.col("text")).alias("__size"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("__text"), F.struct(*own).alias("__row"))
    rows = rows.withColumn("__hash", F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("__bucket", F.substring("__hash", 1, digits))

    sums = rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__sum"))
    targets = source_targets(sums.groupBy("__source").agg(F.sum("__sum").alias("source_size")).withColumnRenamed("__source", "source"), weights, repeats)
    ahead = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__source", "__bucket", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__start"))
    starts = starts.join(targets, F.col("__source").eqNullSafe(F.col("source"))).select(
        F.col("__source").alias("s"), F.col("__bucket").alias("b"), "__start", F.col("source_size").alias("__source_size"), F.col("weight_class").alias("__class"), F.col("target").alias("__target")
    )
    inside = Window.partitionBy("__source", "__bucket").orderBy(F.col("__hash"), F.col("__id").asc_nulls_last(), F.col("__text")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    rows = rows.join(starts, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("b"))).drop("s", "b")
    rows = rows.withColumn("__before", F.col("__before") + F.col("__start"))
    whole = F.round("__target").cast("long")

    def copy(n: Column) -> Column:
        begin = F.col("__source_size") * n + F.col("__before")
        words = F.greatest(F.lit(0), F.least(F.col("__size"), whole - begin))
        # A source without words has the target 0 and no copies.
        part = F.try_divide(begin.cast("double"), F.col("__target"))
        position = F.lit(None).cast("double")
        for i, s in enumerate(schedules):
            position = F.when(F.col("__class") % len(schedules) == i, moment(part, s)).otherwise(position)
        return F.struct(words.cast("long").alias("words"), position.alias("position"))

    copies = F.filter(F.array(*[copy(F.lit(n).cast("long")) for n in range(repeats)]), lambda c: c["words"] > 0)
    rows = rows.withColumn("__copies", copies)
    taken = F.aggregate("__copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return rows.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(names)], "__size", "__source_size", "__target", taken.alias("__taken"), "__copies")


def training_order(mix: DataFrame, copies: str = "__copies") -> DataFrame:
    """One row per copy, ``__words`` and ``__position`` added, range-sorted by position."""
    rows = mix.select("*", F.explode(copies).alias("__copy")).select("*", F.col("__copy.words").alias("__words"), F.col("__copy.position").alias("__position"))
    return rows.drop("__copy", copies).repartitionByRange("__position").sortWithinPartitions("__position")
