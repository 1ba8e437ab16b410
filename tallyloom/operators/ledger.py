"""Content-addressed release ledger: digests, promotion, integrity, backfill planning.

Layout under one root, every directory written by one load:

    data/load=<id>/survey=<s>/year=<y>/part-*      release rows
    ledger/artifacts/load=<id>/                    one row per stored artifact
    ledger/files/load=<id>/                        one row per stored file, with bytes and SHA-256
    ledger/lanes/load=<id>/                        one row per stored file, with row count and row sums
    ledger/checks/load=<id>/                       one row per gate
    ledger/schemas/load=<id>/                      the columns of the stored rows
    ledger/places/<n>                              the n-th place in the order of loads is taken
    ledger/releases/load=<id>/                     one row per release, written last

Readers find data only through ``ledger/releases``. Data lands first and the ledger row last, so
a load that dies in between leaves nothing that a reader can see, and running it again under
the same id overwrites its own directories. A release whose content is the current one's already is
recorded, and its second copy goes: equal content is stored once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import file_errors, list_files, with_digests
from .gates import FAIL, GATE_COLUMNS, Gate, gates_passed, merge_gates, run_gates
from .joins import missing_years

SCHEMA_VERSION = 2
PROMOTED, UNCHANGED, QUARANTINED = "promoted", "already-current", "quarantined"

RELEASES_SCHEMA = (
    "survey string, year int, digest string, release_id string, status string, change string, "
    "n_rows bigint, load string, seq bigint"
)


# --- digests -----------------------------------------------------------------------------------


def artifact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and SHA-256 of each file, of any size; files are read in pieces."""
    files = with_digests(list_files(spark, path))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "bytes", "sha256")


#: A row's SHA-256 in four numbers of 64 bits.
LANES = tuple(f"lane{i}" for i in range(4))


def row_hash(columns: Sequence[str]) -> Column:
    """The SHA-256 of a row's fields in name order.

    Names and values carry their lengths, so no content of one row reads as fields of another. Null fields are left out, so a column added by a later load does not change earlier rows.
    """
    value = {c: F.col(c).cast("string") for c in columns}
    fields = [F.concat(F.lit(f"{len(c)}:{c}="), F.length(value[c]).cast("string"), F.lit(":"), value[c]) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *fields), 256)


def row_code(columns: Sequence[str]) -> Column:
    """The first 48 bits of a row's hash as a number, of which fingerprints are sums."""
    return _code(row_hash(columns))


def _code(row: Column) -> Column:
    return F.conv(F.substring(row, 1, 12), 16, 10).cast("bigint")


def _modulo(total: Column) -> Column:
    return F.pmod(total, F.lit(Decimal(1 << 64))).cast("decimal(20,0)")


def row_lanes(df: DataFrame, by: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """``n_rows``, sum of 48-bit codes and four 64-bit lanes per group: row hashes cut in four and each
    quarter added up modulo 2**64.

    The lanes hash the rows as a multiset of any order. Lanes of parts add up to the lanes of the
    whole, so a release is checked from its files' lanes and a part from the whole less the rest.
    """
    hashed = df.select(*by, row_hash(columns).alias("__h"))
    names = hashed.columns[:-1]
    quarter = lambda i: F.conv(F.substring("__h", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")
    return hashed.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(_code(F.col("__h")).cast("decimal(20,0)")).alias("codes"),
        *[_modulo(F.sum(quarter(i))).alias(c) for i, c in enumerate(LANES)],
    )


def joined_lanes(lanes: DataFrame, by: Sequence[str]) -> DataFrame:
    """``row_lanes`` of unions of the groups that ``lanes`` has."""
    return lanes.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.sum("codes").alias("codes"), *[_modulo(F.sum(c)).alias(c) for c in LANES])


def lane_errors(recorded: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """``error`` and ``by`` of groups whose rows are not the recorded ones, from the lanes of both."""
    sums = lambda df, name: df.select(*by, F.col("n_rows").alias(f"__{name}_rows"), F.struct(*LANES).alias(f"__{name}"))
    both = sums(recorded, "known").join(sums(found, "there"), list(by), "full_outer")
    error = (
        F.when(F.col("__known_rows").isNull(), "unrecorded rows")
        .when(F.col("__there_rows").isNull(), "no rows left")
        .when(F.col("__known_rows") != F.col("__there_rows"), "row count mismatch")
        .when(F.col("__known") != F.col("__there"), "row mismatch")
    )
    return both.select(error.alias("error"), *by).filter(F.col("error").isNotNull())


def table_fingerprint(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """SHA-256 of row count and sum of row codes per group.

    Addition makes it independent of row order and partitioning, and it combines before the
    shuffle, so a release that holds a third of the rows costs no more than any other.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    sums = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row_code(columns).cast("decimal(20,0)")).alias("codes"))
    return _fingerprint(sums, by)


def _fingerprint(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    text = F.concat_ws(":", F.col("n_rows").cast("string"), F.col("codes").cast("string"))
    return sums.select(*by, "n_rows", F.sha2(text, 256).alias("sha256"))


def release_digests(artifacts: DataFrame, by: Sequence[str] = ("survey", "year"), version: int = SCHEMA_VERSION) -> DataFrame:
    """Digest and id per release: SHA-256 over a version line and the sorted ``role:sha`` lines.

    The digest is a hash of one text, so the lines of a release meet in one place. They are as
    many as the release contract has roles (one artifact per role), not as many as rows.
    """
    lines = artifacts.select(*by, F.concat_ws(":", "role", "sha256").alias("__line"), "role")
    grouped = lines.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("role", "__line"))).alias("__lines"))
    body = F.array_join(F.transform("__lines", lambda x: F.concat(x["__line"], F.lit("\n"))), "")
    head = F.lit(f"release-schema:{version}\n" if version >= 2 else "")
    digested = grouped.select(*by, F.sha2(F.concat(head, body), 256).alias("digest"))
    return digested.withColumn("release_id", release_id(F.col("survey"), F.col("year"), F.col("digest")))


def release_id(survey: Column, year: Column, digest: Column) -> Column:
    return F.concat_ws("-", survey, year.cast("string"), F.substring(digest, 1, 12))


def detect_revision(new: DataFrame, current: DataFrame, keys: Sequence[str] = ("survey", "year")) -> DataFrame:
    """``new``, ``changed`` or ``unchanged`` per release, by digest."""
    known = current.select(*keys, F.col("digest").alias("current_digest"))
    change = (
        F.when(F.col("current_digest").isNull(), F.lit("new"))
        .when(F.col("current_digest") == F.col("digest"), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return new.join(known, list(keys), "left").withColumn("change", change)


# --- views over ledger tables --------------------------------------------------------------------


def current_releases(releases: DataFrame, keys: Sequence[str] = ("survey",)) -> DataFrame:
    """The newest promoted release per survey (or per other keys)."""
    promoted = releases.filter(F.col("status") == PROMOTED)
    rest = [c for c in releases.columns if c not in keys]
    newest = promoted.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("seq", "year", "digest")).alias("__r"))
    return newest.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*releases.columns)


def backfill_plan(available: DataFrame, releases: DataFrame, log: DataFrame) -> DataFrame:
    """Releases still to fetch. Only a successful log entry takes one off the plan; a failed
    year is planned again."""
    keys = ["survey", "year"]
    promoted = releases.filter(F.col("status") == PROMOTED).select(*keys).distinct()
    done = log.filter(F.col("status").isin(PROMOTED, UNCHANGED)).select(*keys).distinct()
    return missing_years(available, promoted, done, keys)


def require_release(releases: DataFrame, survey: str, wanted_id: str, wanted_digest: str) -> DataFrame:
    """One gate row: is the survey's current release exactly the pinned one."""
    current = current_releases(releases).filter(F.col("survey") == F.lit(survey))
    match = F.count_if((F.col("release_id") == F.lit(wanted_id)) & (F.col("digest") == F.lit(wanted_digest)))
    return run_gates(current, [Gate("required_release", match, "equal", 1, note=wanted_id)])


def scrub(
    releases: DataFrame, artifacts: DataFrame, actual: DataFrame, pointers: DataFrame | None = None
) -> DataFrame:
    """Error rows ``(error, survey, year, subject)`` from comparing the ledger with reality.

    ``artifacts``: survey, year, digest, role, bytes, sha256 as recorded. ``actual``: survey,
    year, digest, role, bytes, sha256 as found now. ``pointers``: survey, year, release_id,
    digest.
    """
    keys = ["survey", "year", "digest", "role"]
    recorded = artifacts.select(*keys, F.col("bytes").alias("__b"), F.col("sha256").alias("__s"))
    found = actual.select(*keys, F.col("bytes").alias("__ab"), F.col("sha256").alias("__as"))
    compared = recorded.join(found, keys, "full_outer")
    lost = F.col("__s").isNotNull() & F.col("__as").isNull()
    extra = F.col("__s").isNull()
    file_errors = F.array_compact(
        F.array(
            F.when(lost, F.lit("missing file")),
            F.when(extra, F.lit("unrecorded file")),
            F.when(F.col("__b") != F.col("__ab"), F.lit("byte count mismatch")),
            F.when(F.col("__s") != F.col("__as"), F.lit("sha256 mismatch")),
        )
    )
    files = compared.select(F.explode(file_errors).alias("error"), "survey", "year", F.col("role").alias("subject"))

    recomputed = _recomputed_digests(artifacts)
    checked = releases.filter(F.col("status") == PROMOTED).join(recomputed, ["survey", "year", "digest"], "left")
    wanted_id = release_id(F.col("survey"), F.col("year"), F.col("digest"))
    release_errors = F.array_compact(
        F.array(
            F.when(~F.col("__digest").eqNullSafe(F.col("digest")), F.lit("release digest mismatch")),
            F.when(F.col("release_id") != wanted_id, F.lit("release id mismatch")),
        )
    )
    out = files.unionByName(
        checked.select(F.explode(release_errors).alias("error"), "survey", "year", F.col("release_id").alias("subject"))
    )
    if pointers is not None:
        out = out.unionByName(_pointer_errors(pointers, releases))
    return out


def _recomputed_digests(artifacts: DataFrame) -> DataFrame:
    named = artifacts.withColumnRenamed("digest", "__recorded")
    again = release_digests(named, ["survey", "year", "__recorded"])
    return again.select("survey", "year", F.col("__recorded").alias("digest"), F.col("digest").alias("__digest"))


def _pointer_errors(pointers: DataFrame, releases: DataFrame) -> DataFrame:
    target = (
        releases.filter(F.col("status") == PROMOTED)
        .select("digest", *[F.col(c).alias(f"__{c}") for c in ("survey", "year", "release_id")])
        .distinct()
    )
    joined = pointers.join(target, "digest", "left")
    absent = F.col("__release_id").isNull()
    errors = F.array_compact(
        F.array(
            F.when(absent, F.lit("pointer target is no release")),
            *[
                F.when(~absent & ~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(f"pointer {c} mismatch"))
                for c in ("survey", "year", "release_id")
            ],
        )
    )
    return joined.select(F.explode(errors).alias("error"), "survey", "year", F.col("release_id").alias("subject"))


# --- the stored ledger ---------------------------------------------------------------------------


class Ledger:
    """Release storage under one root on a file system that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _dir(self, kind: str, load: str) -> str:
        base = "data" if kind == "data" else f"ledger/{kind}"
        return f"{self.root}/{base}/load={load}"

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _delete(self, path: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _read(self, kind: str, schema: str) -> DataFrame:
        path = f"{self.root}/ledger/{kind}"
        if not self._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def releases(self) -> DataFrame:
        return self._read("releases", RELEASES_SCHEMA)

    def checks(self) -> DataFrame:
        return self._read(
            "checks",
            "survey string, year int, gate string, status string, observed double, expected double, "
            "tolerance double, note string, load string",
        )

    def artifacts(self) -> DataFrame:
        return self._read(
            "artifacts",
            "survey string, year int, digest string, role string, bytes bigint, sha256 string, load string",
        )

    def files(self) -> DataFrame:
        """Every file that a load stored, by its path below the root."""
        return self._read("files", "survey string, year int, path string, bytes bigint, sha256 string, load string")

    def lanes(self) -> DataFrame:
        """Row count and ``row_lanes`` of every file that a load stored; a file's name is its own within its release."""
        sums = ", ".join(f"{c} decimal(20,0)" for c in LANES)
        return self._read("lanes", f"survey string, year int, file string, n_rows bigint, codes decimal(30,0), {sums}, load string")

    def current(self, keys: Sequence[str] = ("survey",)) -> DataFrame:
        return current_releases(self.releases(), keys)

    def promote(
        self,
        df: DataFrame,
        gates: Sequence[Gate],
        load: str,
        seq: int | None = None,
        role: str = "table",
        further: Sequence[Callable[[DataFrame], DataFrame]] = (),
    ) -> DataFrame:
        """Store every release in ``df`` (columns ``survey``, ``year``); return its ledger rows.

        ``gates`` run in one aggregation. ``further`` makes gate rows that need a join or another
        grouping, such as key uniqueness, from the stored table; they carry survey and year.

        All releases of the load are gated, fingerprinted and recorded together; no release is
        handled on its own by the driver. A failed gate quarantines that release only. Bytes of
        the artifact row are the row count of the table.

        A load that was recorded is never written again: the same content returns its rows, other
        content is an error. Without ``seq`` the load comes after all others of the ledger.
        """
        keys = ["survey", "year"]
        if not gates and not further:
            raise ValueError("a load needs gates: without any nothing says that its releases are sound")
        if self._exists(self._dir("releases", load)):
            self._drop_copies(load)
            return self._recorded(df, load, role)
        claimed = seq is None
        if claimed:
            seq = self._claim_seq()
        data_dir = self._dir("data", load)
        # Rows of a release meet in few files; adaptive execution splits a release that is too
        # large for one task and packs small ones.
        balanced = df.hint("rebalance", *keys)
        balanced.write.mode("overwrite").option("compression", "zstd").partitionBy(*keys).parquet(data_dir)
        self.spark.createDataFrame([(df.schema.json(),)], "schema string").write.mode("overwrite").parquet(self._dir("schemas", load))
        # The known schema: partition values are not guessed at, and an empty load has one too.
        stored = self.spark.read.schema(df.schema).parquet(data_dir)

        checks = merge_gates(run_gates(stored, gates, keys), *[make(stored) for make in further])
        checks.select(*keys, *GATE_COLUMNS).write.mode("overwrite").parquet(self._dir("checks", load))
        checks = self.spark.read.parquet(self._dir("checks", load))

        # Rows are hashed once, by file; the fingerprints of releases come from the files' sums.
        self._lane_rows(stored).write.mode("overwrite").parquet(self._dir("lanes", load))
        lanes = self.lanes().filter(F.col("load") == F.lit(load))
        prints = _fingerprint(joined_lanes(lanes, keys), keys).withColumn("role", F.lit(role))
        digests = release_digests(prints, keys)
        artifacts = prints.join(digests.select(*keys, "digest"), keys).select(
            *keys, "digest", "role", F.col("n_rows").alias("bytes"), "sha256"
        )
        artifacts.write.mode("overwrite").parquet(self._dir("artifacts", load))
        artifacts = self.spark.read.parquet(self._dir("artifacts", load))

        self._file_rows(load).write.mode("overwrite").parquet(self._dir("files", load))

        # Earlier loads only: a load that runs again must not see its own row.
        earlier = self.releases().filter(F.col("load") != F.lit(load))
        known = current_releases(earlier, keys).select(*keys, "digest")
        new = artifacts.select(
            *keys, "digest", F.col("bytes").alias("n_rows"), release_id(F.col("survey"), F.col("year"), F.col("digest")).alias("release_id")
        )
        verdict = gates_passed(checks, keys).select(*keys, "passed")
        rows = detect_revision(new, known).join(verdict, keys, "left")
        status = (
            F.when(~F.coalesce("passed", F.lit(False)), F.lit(QUARANTINED))
            .when(F.col("change") == "unchanged", F.lit(UNCHANGED))
            .otherwise(F.lit(PROMOTED))
        )
        rows = rows.select(
            *keys, "digest", "release_id", status.alias("status"), "change", "n_rows", F.lit(seq).cast("bigint").alias("seq")
        )
        rows.write.mode("overwrite").parquet(self._dir("releases", load))
        self._drop_copies(load)
        own = self.releases().filter(F.col("load") == F.lit(load))
        if claimed and own.isEmpty():
            # A load without releases gives its place back.
            self._delete(f"{self.root}/ledger/places/{seq}")
        return own

    def _claim_seq(self) -> int:
        """The next free place in the order of loads.

        It is taken by creating a file that must not be there yet, so loads that run side by side do not share a
        place. HDFS creates files exclusively; Hadoop's local store does not, so there the system call does.
        A load that dies leaves its place empty.
        """
        newest = self.releases().agg(F.max("seq").alias("s")).first()["s"]
        seq = 0 if newest is None else newest + 1
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.root}/ledger/places")
        store = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        local = store.getUri().getScheme() == "file"
        while True:
            place = path(folder, str(seq))
            try:
                if local:
                    open(place.toUri().getPath(), "x").close()
                else:
                    store.create(place, False).close()
                return seq
            except FileExistsError:
                seq += 1
            except Py4JJavaError as error:
                if "AlreadyExists" not in error.java_exception.getClass().getName():
                    raise
                seq += 1

    def _lane_rows(self, stored: DataFrame, load: bool = False) -> DataFrame:
        """``row_lanes`` per file of stored rows; no file's rows are read for another's sums."""
        keys = ["survey", "year", *(["load"] if load else [])]
        lanes = row_lanes(stored, [*keys, F.col("_metadata.file_name").alias("file")], [c for c in stored.columns if c not in keys])
        return lanes.select(F.col("survey").cast("string").alias("survey"), F.col("year").cast("int").alias("year"), "file", "n_rows", "codes", *LANES, *keys[2:])

    def _file_rows(self, load: str) -> DataFrame:
        """``survey, year, path, bytes, sha256`` of the files that a load has now."""
        data_dir = self._dir("data", load)
        files = with_digests(list_files(self.spark, data_dir, "part-*"))
        # A partition's folder names its release, in the escaped form of Hive paths.
        value = lambda c: F.try_url_decode(F.replace(F.regexp_extract("path", f"/{c}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
        survey = F.when(value("survey") != "__HIVE_DEFAULT_PARTITION__", value("survey"))
        return files.select(survey.alias("survey"), value("year").try_cast("int").alias("year"), self._below("path").alias("path"), "bytes", "sha256")

    def _below(self, path: str) -> Column:
        """A path from the ledger's data folder on, whatever the store calls what stands before it."""
        return F.regexp_extract(path, "/(data/load=[^/]*/.*)$", 1)

    def _drop_copies(self, load: str) -> None:
        """Remove what a load stored of releases that were current already; their first copy stays."""
        again = self.releases().filter((F.col("load") == F.lit(load)) & (F.col("status") == UNCHANGED)).select("survey", "year")
        paths = self.files().filter(F.col("load") == F.lit(load)).join(again, ["survey", "year"], "left_semi")
        # One folder per release of the load.
        for row in paths.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect():
            self._delete(f"{self.root}/{row['folder']}")

    def _recorded(self, df: DataFrame, load: str, role: str) -> DataFrame:
        """The ledger rows of a load that is there already, if its content is that of ``df``."""
        keys = ["survey", "year"]
        have = self.artifacts().filter(F.col("load") == F.lit(load)).select(*keys, "sha256")
        want = table_fingerprint(df, keys).select(F.col("survey").cast("string").alias("survey"), F.col("year").cast("int").alias("year"), "sha256")
        if not want.exceptAll(have).isEmpty() or not have.exceptAll(want).isEmpty():
            raise ValueError(f"load {load} is recorded with other content")
        return self.releases().filter(F.col("load") == F.lit(load))

    def read(self, survey: str, year: int | None = None) -> DataFrame:
        """Rows of the current release, found through the ledger."""
        keys = ["survey"] if year is None else ["survey", "year"]
        chosen = self.current(keys).filter(F.col("survey") == F.lit(survey))
        if year is not None:
            chosen = chosen.filter(F.col("year") == F.lit(year))
        row = chosen.select("load", "year").first()
        if row is None:
            raise LookupError(f"no promoted release of {survey}")
        path = self._dir("data", row["load"])
        known = {"survey": T.StringType(), "year": T.IntegerType()}
        guessed = self.spark.read.parquet(path).schema
        schema = T.StructType([T.StructField(f.name, known.get(f.name, f.dataType)) for f in guessed])
        data = self.spark.read.schema(schema).parquet(path)
        return data.filter((F.col("survey") == F.lit(survey)) & (F.col("year") == F.lit(row["year"])))

    def _stored(self, loads: DataFrame, damaged: bool = False) -> list[DataFrame]:
        """Rows of the given loads, a frame for each set of columns and types that they were stored
        with, so that a column may change its type from load to load. Lost folders are left out, and with
        ``damaged`` also what cannot be read of a file."""
        known = {"survey": T.StringType(), "year": T.IntegerType()}
        kinds = self._read("schemas", "schema string, load string").join(loads.select("load").distinct(), "load", "left_semi")
        frames = []
        # One row per schema; it lists loads, which are as many as the runs that stored them.
        for kind in kinds.groupBy("schema").agg(F.array_sort(F.collect_list("load")).alias("loads")).orderBy("schema").collect():
            folders = [d for d in (self._dir("data", load) for load in kind["loads"]) if self._exists(d)]
            if not folders:
                continue
            fields = T.StructType.fromJson(json.loads(kind["schema"])).fields
            schema = T.StructType([T.StructField(f.name, known.get(f.name, f.dataType)) for f in fields]).add("load", T.StringType())
            reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
            if damaged:
                reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
            frames.append(reader.parquet(*folders))
        return frames

    def revalidate(self, gates: Sequence[Gate], load: str) -> DataFrame:
        """Run gates again over the current releases and append the result rows under ``load``. A
        column that a release does not have is null there."""
        keys = ["survey", "year"]
        current = self.current(keys).select(*keys, "load")
        frames = self._stored(current)
        if not frames:
            # Nothing is promoted, so there is nothing to check.
            return self.checks().filter(F.col("load") == F.lit(load))
        types = {f.name: f.dataType for frame in frames for f in frame.schema}
        checks = []
        for frame in frames:
            rows = frame.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in frame.columns])
            checks.append(run_gates(rows.join(current, [*keys, "load"], "left_semi"), gates, keys).select(*keys, *GATE_COLUMNS))
        reduce(DataFrame.unionByName, checks).write.mode("overwrite").parquet(self._dir("checks", load))
        return self.checks().filter(F.col("load") == F.lit(load))

    def scrub(self) -> DataFrame:
        """Fingerprint all promoted data again and compare it with the ledger."""
        keys = ["survey", "year"]
        promoted = self.releases().filter(F.col("status") == PROMOTED)
        artifacts = self.artifacts().join(promoted.select(*keys, "digest", "load"), [*keys, "digest", "load"], "left_semi")
        none = self.spark.createDataFrame([], "survey string, year int, load string, n_rows bigint, sha256 string")
        found = reduce(DataFrame.unionByName, [table_fingerprint(frame, [*keys, "load"]) for frame in self._stored(promoted)], none)
        actual = (
            artifacts.select(*keys, "load", "digest", "role")
            .join(found, [*keys, "load"])
            .select(*keys, "digest", "role", F.col("n_rows").alias("bytes"), "sha256")
        )
        return scrub(promoted, artifacts, actual, self.current().select("survey", "year", "release_id", "digest"))

    def scrub_rows(self, survey: str | None = None, year: int | None = None, files: Sequence[str] | None = None) -> DataFrame:
        """``error, survey, year, load, file`` of stored files whose rows differ from their recorded lanes.

        Only the files of the wanted release, or of the given names, are read. A file that was written anew
        with the same rows in any order is sound here, though ``scrub_files`` reports its bytes. What
        cannot be read of a file counts as lost rows.
        """
        wanted = F.lit(True) if survey is None else F.col("survey") == F.lit(survey)
        if year is not None:
            wanted &= F.col("year") == F.lit(year)
        keys = ["survey", "year", "load"]
        promoted = self.releases().filter((F.col("status") == PROMOTED) & wanted).select(*keys)
        known = self.lanes().join(promoted, keys, "left_semi")
        if files is not None:
            known = known.filter(F.col("file").isin(list(files)))
        none = self.spark.createDataFrame([], known.select("survey", "year", "file", "n_rows", "codes", *LANES, "load").schema)
        found = []
        for frame in self._stored(promoted, damaged=True):
            part = frame.filter(wanted)
            if files is not None:
                part = part.filter(F.col("_metadata.file_name").isin(list(files)))
            found.append(self._lane_rows(part, load=True))
        # Folders of a load also hold its releases that are not promoted.
        there = reduce(DataFrame.unionByName, found, none).join(promoted, keys, "left_semi")
        return lane_errors(known, there, [*keys, "file"])

    def recover(self, survey: str, year: int, source: DataFrame) -> DataFrame:
        """Rows of ``source`` that the damaged files of the current release held.

        They are the rows that no sound file has. Their lanes must be the sum of the lost files' recorded
        ones, so a source of another wording, or one that lacks a row, is an error and nothing is returned.
        """
        row = self.current(["survey", "year"]).filter((F.col("survey") == F.lit(survey)) & (F.col("year") == F.lit(year))).select("load").first()
        if row is None:
            raise LookupError(f"no promoted release of {survey} {year}")
        of_load = F.col("load") == F.lit(row["load"])
        damaged = self.scrub_rows(survey, year).filter(of_load).select("survey", "year", "load", "file")
        here = (F.col("survey") == F.lit(survey)) & (F.col("year") == F.lit(year))
        lost = self.lanes().filter(of_load).join(damaged, ["survey", "year", "load", "file"], "left_semi")
        frames = self._stored(self.releases().filter(of_load), damaged=True)
        columns = [c for c in source.columns if c not in ("survey", "year")]
        rows = source.filter(here).select("survey", "year", *columns)
        for frame in frames:
            names = damaged.select(F.col("file").alias("__file"))
            sound = frame.filter(here).withColumn("__file", F.col("_metadata.file_name")).join(names, "__file", "left_anti")
            rows = rows.exceptAll(sound.select("survey", "year", *columns))
        found = row_lanes(rows, ["survey", "year"], columns).select("n_rows", *LANES)
        want = joined_lanes(lost, ["survey", "year"]).select("n_rows", *LANES)
        # One row each.
        if found.collect() != want.collect():
            raise ValueError(f"the source does not hold what the damaged files of {survey} {year} lost")
        return rows

    def scrub_files(self) -> DataFrame:
        """``error, survey, year, path`` of stored files that differ from the ledger in bytes or SHA-256, are lost or
        are not recorded.

        Files of promoted releases are compared. A file in the folder of such a load that no row names is
        unrecorded; loads that the ledger does not know are not looked at.
        """
        promoted = self.releases().filter(F.col("status") == PROMOTED).select("survey", "year", "load")
        recorded = self.files().join(promoted, ["survey", "year", "load"], "left_semi")
        if not self._exists(f"{self.root}/data"):
            there = self.spark.createDataFrame([], "path string, bytes bigint, sha256 string")
        else:
            listed = list_files(self.spark, f"{self.root}/data", "part-*").withColumn("load", F.regexp_extract("path", "/load=([^/]*)/", 1))
            # Copies of releases that are not promoted are known, so they are no strangers.
            others = self.files().join(promoted, ["survey", "year", "load"], "left_anti").select(F.col("path").alias("below"))
            listed = listed.join(promoted.select("load").distinct(), "load", "left_semi").withColumn("below", self._below("path"))
            there = with_digests(listed.join(others, "below", "left_anti")).select(F.col("below").alias("path"), "bytes", "sha256")
        names = recorded.select("path", "survey", "year")
        return file_errors(recorded, there).join(names, "path", "left").select("error", "survey", "year", "path")


def failed_gates(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("status") == FAIL)
