"""Releases whose files arrive one by one, over several runs of a stream.

The stream carries file names only. A state per release holds the names of its members until all that
its contract asks for are there; only then do the files' rows go to the ledger, in one load. A file
that comes later replaces its member and gives the release again, as a revision.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.gates import Gate
from ..operators.ledger import Ledger

#: What the reader of files gives; contents that are not selected are not read.
FILE = "path string, modificationTime timestamp, length long, content binary"
STATE = "survey string, year int, members string"
COMPLETE = "survey string, year int, member string, path string"


def file_stream(spark: SparkSession, path: str, survey: Column, year: Column, member: Column, glob: str = "*") -> DataFrame:
    """Names of new files below a folder as ``survey, year, member, path, modified``; contents are not read.

    ``survey``, ``year`` and ``member`` are expressions over the column ``path``. A file whose name gives none
    of them is left out.
    """
    files = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    named = files.select(
        survey.cast("string").alias("survey"), year.try_cast("int").alias("year"), member.cast("string").alias("member"), "path", F.col("modificationTime").alias("modified")
    )
    return named.filter("survey <> '' AND year IS NOT NULL AND member <> ''")


def whole_releases(files: DataFrame, required: Sequence[str]) -> DataFrame:
    """``survey, year, member, path`` of releases that became complete, or changed after they were.

    ``required`` names the members of a release; files of other members belong to none. Of several files for
    one member the newest counts, then the one with the last name. A state holds one path per member.
    """
    wanted = sorted(set(required))

    def hold(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        survey, year = key
        held = json.loads(state.get[2]) if state.exists else {}
        before = json.dumps(held, sort_keys=True)
        for frame in frames:
            for member, path, modified in zip(frame["member"], frame["path"], frame["modified"], strict=True):
                if member in wanted:
                    held[member] = max(held.get(member, ["", ""]), [modified.isoformat(), path])
        state.update((survey, year, json.dumps(held, sort_keys=True)))
        if len(held) == len(wanted) and json.dumps(held, sort_keys=True) != before:
            yield pd.DataFrame({"survey": survey, "year": year, "member": wanted, "path": [held[m][1] for m in wanted]})

    return files.groupBy("survey", "year").applyInPandasWithState(hold, COMPLETE, STATE, "update", GroupStateTimeout.NoTimeout)


def ingest_pieces(
    files: DataFrame,
    ledger: Ledger,
    gates: Sequence[Gate],
    checkpoint: str,
    required: Sequence[str],
    read: Callable[[SparkSession, list[str]], DataFrame],
    name: str = "pieces",
    further: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> StreamingQuery:
    """Work off all files that are there now, promote releases that are whole, then stop.

    ``read`` gives the rows of a list of files; ``survey`` and ``year`` are added from the files' names. All
    releases that became whole in a run make one load, whose id follows from the checkpoint and the
    run, so a run that is repeated after a failure gives the same ledger. The driver sees names of
    files, not their rows.
    """
    stream_id = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            paths = sorted(r["path"] for r in batch.select("path").collect())
            if paths:
                rows = read(batch.sparkSession, paths).withColumn("__path", F.input_file_name())
                known = batch.select(F.col("survey").alias("__survey"), F.col("year").alias("__year"), plain_path(F.col("path")).alias("__file"))
                rows = rows.join(F.broadcast(known), plain_path(F.col("__path")) == F.col("__file"))
                rows = rows.withColumns({"survey": F.col("__survey"), "year": F.col("__year")}).drop("__survey", "__year", "__file", "__path")
                ledger.promote(rows, gates, load=f"{name}-{stream_id}-{batch_id:08d}", further=further)
        finally:
            batch.unpersist()

    whole = whole_releases(files, required)
    return whole.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def plain_path(path: Column) -> Column:
    """A file's path without scheme and encoding, which readers write in different ways."""
    return F.regexp_replace(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/*", "/")


def waiting_releases(spark: SparkSession, checkpoint: str, required: Sequence[str]) -> DataFrame:
    """``survey, year, present, missing`` of releases that are not whole yet, from a stream's stored state."""
    states = spark.read.format("statestore").load(checkpoint).select(F.col("value.groupState.members").alias("members"), "key.*")
    wanted = F.array(*[F.lit(m) for m in sorted(set(required))])
    present = F.array_sort(F.map_keys(F.from_json("members", "map<string,array<string>>")))
    return states.select("survey", "year", present.alias("present"), F.array_except(wanted, present).alias("missing")).filter(F.size("missing") > 0)
