"""Fixity of an archive and its replica by Merkle trees over records and offset ranges.

Records are written as WARC text. The primary archive's order and lengths give each record an offset.
Digests of the records that begin in one range of offsets are hashed in order to the range's digest;
sixteen ranges make the range above, up to one root. The replica's records take the places that the
primary's index gives them. Two trees are then compared from the root: equal nodes clear all below
them, and only nodes that differ are opened, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranges import running_total
from .common import stage

#: The lowest range spans 2**16 bytes; each level above joins 2**4.
RANGE_BITS, FANOUT_BITS = 16, 4
ABSENT = "absent"


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    body = F.coalesce(body, F.lit(""))
    head = [F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit(""))]
    length = F.octet_length(body).cast("string")
    return F.concat(*head, F.lit("\r\nContent-Length: "), length, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def record_digests(records: DataFrame) -> DataFrame:
    """``id, length, digest`` per id of ``records(id, record)``. Records that share an id (a null one
    too) are one entry: its digest covers their number, extremes and the sum of their digests."""
    one = records.select("id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    number = F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(38,0)")
    per = one.groupBy("id").agg(F.sum("length").alias("length"), F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.sum(number).alias("sum"))
    many = F.sha2(F.concat_ws(" ", F.col("n").cast("string"), "low", "high", F.col("sum").cast("string")), 256)
    return per.select("id", "length", F.when(F.col("n") == 1, F.col("low")).otherwise(many).alias("digest"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """``id, offset, length, digest, status, cleared_level`` for every record of either archive.

    Both are ``(id, record)`` with whole-number ids. ``status`` is ``ok``, ``changed``, ``missing``
    (not in the replica) or ``extra`` (not in the primary, without an offset). ``cleared_level`` is
    the level of the highest equal node over the record: 0 for the record itself, null where it differs.
    """
    own = record_digests(primary)
    total = running_total(own.withColumn("__no_id", F.col("id").isNull().cast("int")).withColumn("__id", F.coalesce("id", F.lit(0))), "length", "__no_id", ["__id"], out="end", total="size")
    theirs = record_digests(replica).select(F.col("id").alias("r_id"), F.col("digest").alias("theirs"))
    placed = total.select("id", (F.col("end") - F.col("length")).alias("offset"), "length", "digest")
    leaves = placed.join(theirs, F.col("id").eqNullSafe(F.col("r_id")), "left")
    leaves = stage(leaves.select("id", "offset", "length", "digest", F.coalesce("theirs", F.lit(ABSENT)).alias("theirs")), "leaves")

    last = leaves.agg(F.max("offset").alias("m")).first()["m"] or 0
    shifts = [RANGE_BITS]
    while last >> shifts[-1]:
        shifts.append(shifts[-1] + FANOUT_BITS)

    def above(children: DataFrame, at: Column) -> DataFrame:
        """Range digests from the digests of what begins in them, in order of offset."""
        side = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda x: x[c]), ""), 256)
        return children.groupBy(at.alias("node")).agg(side("digest").alias("digest"), side("theirs").alias("theirs"))

    levels = [stage(above(leaves.withColumn("at", F.col("offset")), F.shiftright("offset", RANGE_BITS)), "level")]
    for _ in shifts[1:]:
        levels.append(stage(above(levels[-1].withColumn("at", F.col("node")), F.shiftright("node", FANOUT_BITS)), "level"))

    rows = leaves.withColumn("cleared_level", F.lit(None).cast("int"))
    opened = levels[-1]
    for level in range(len(levels), 0, -1):
        cleared = opened.filter(F.col("digest") == F.col("theirs")).select(F.col("node").alias("__node"), F.lit(level).alias("__level"))
        at = F.shiftright("offset", shifts[level - 1])
        rows = rows.join(cleared, at == F.col("__node"), "left").withColumn("cleared_level", F.coalesce("cleared_level", "__level")).drop("__node", "__level")
        if level > 1:
            differ = opened.filter(F.col("digest") != F.col("theirs")).select(F.col("node").alias("__parent"))
            below = levels[level - 2]
            opened = below.join(differ, F.shiftright(below["node"], FANOUT_BITS) == F.col("__parent"), "left_semi")
    same = F.col("cleared_level").isNotNull() | (F.col("digest") == F.col("theirs"))
    status = F.when(same, "ok").when(F.col("theirs") == ABSENT, "missing").otherwise("changed")
    rows = rows.select("id", "offset", "length", "digest", status.alias("status"), F.coalesce("cleared_level", F.when(same, F.lit(0))).alias("cleared_level"))
    extra = record_digests(replica).join(own.select(F.col("id").alias("o_id")), F.col("id").eqNullSafe(F.col("o_id")), "left_anti")
    none = F.lit(None)
    return rows.union(extra.select("id", none.cast("long"), "length", "digest", F.lit("extra"), none.cast("int")))
