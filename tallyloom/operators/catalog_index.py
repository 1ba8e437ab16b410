"""A catalog that follows the ledger, and search through stored postings of letter triples.

Layout under the ledger's root, a folder per promoted load and written once:

    catalog/entries/load=<id>/               variables from stored schemas, documents from stored rows
    catalog/postings/load=<id>/bucket=<n>/   which entries hold a triple, sorted by triple
    catalog/indexed/load=<id>/               written last; a load without it is indexed again

A text that holds the wanted words holds all triples of them. Postings give the entries with all
triples, and only those are read and compared. Wanted texts of one or two characters have no triple,
so all entries are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_text
from .catalog import VARIABLES_SCHEMA, search_catalog, search_documents, search_variables
from .ledger import PROMOTED, Ledger

#: Folders that postings of a load are dealt over.
BUCKETS = 64
DOCUMENTS_SCHEMA = "survey string, year int, release_id string, document_role string, source_file string, content string"
ENTRIES_SCHEMA = "entry bigint, kind string, survey string, year int, release_id string, source_file string, variable_name string, data_type string, document_role string, content string, load string"
#: The columns that make a stored table one of documents.
DOCUMENT_COLUMNS = ("document_role", "source_file", "content")


def triples(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1)))


def bucket(triple: Column) -> Column:
    return F.pmod(F.xxhash64(triple), F.lit(BUCKETS)).cast("int")


class CatalogIndex:
    """Variables and documents of a ledger's promoted releases, as far as ``update`` has followed the ledger."""

    def __init__(self, ledger: Ledger):
        self.ledger = ledger
        self.spark = ledger.spark
        self.root = f"{ledger.root}/catalog"

    def _read(self, kind: str, schema: str) -> DataFrame:
        path = f"{self.root}/{kind}"
        if not self.ledger._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _pending(self) -> DataFrame:
        """Promoted releases of loads that are not indexed: ``survey, year, release_id, load``."""
        promoted = self.ledger.releases().filter(F.col("status") == PROMOTED).select("survey", "year", "release_id", "load")
        return promoted.join(self._read("indexed", "done boolean, load string").select("load"), "load", "left_anti")

    def _variables(self, releases: DataFrame) -> DataFrame:
        """A row per release and column, from the schemas that loads recorded. Columns of documents are no variables."""
        kind = "struct<fields:array<struct<name:string,type:string>>>"
        schemas = self.ledger._read("schemas", "schema string, load string")
        schemas = schemas.withColumn("fields", F.from_json("schema", kind)["fields"])
        own = F.size(F.array_except(F.array(*[F.lit(c) for c in DOCUMENT_COLUMNS]), F.col("fields.name"))) > 0
        fields = schemas.filter(own).select("load", F.explode("fields").alias("f"))
        fields = fields.filter(~F.col("f.name").isin("survey", "year"))
        return releases.join(fields, "load").select(
            "load", F.lit("variable").alias("kind"), "survey", "year", "release_id", F.concat("survey", F.lit("-"), "year", F.lit(".parquet")).alias("source_file"),
            F.col("f.name").alias("variable_name"), F.when(F.col("f.type").startswith("{"), F.get_json_object("f.type", "$.type")).otherwise(F.col("f.type")).alias("data_type"), F.lit(None).cast("string").alias("document_role"), F.lit(None).cast("string").alias("content"),
        )

    def _documents(self, releases: DataFrame) -> DataFrame:
        """A row per stored document of the releases that hold documents."""
        out = self.spark.createDataFrame([], "load string, kind string, " + DOCUMENTS_SCHEMA)
        for frame in self.ledger._stored(releases):  # one per schema
            if set(DOCUMENT_COLUMNS) <= set(frame.columns):
                rows = frame.join(releases, ["survey", "year", "load"])
                out = out.unionByName(rows.select("load", F.lit("document").alias("kind"), "survey", "year", "release_id", *[F.col(c).cast("string").alias(c) for c in DOCUMENT_COLUMNS]))
        return out

    def update(self) -> list[str]:
        """Index the releases that were promoted since; the ids of their loads.

        Every load has folders of its own, so loads that were indexed are not touched, and one whose
        indexing was cut off is written again.
        """
        pending = self._pending()
        loads = sorted(r["load"] for r in pending.select("load").distinct().collect())
        if not loads:
            return []
        entries = self._variables(pending).unionByName(self._documents(pending), allowMissingColumns=True)
        names = ["load", "kind", "survey", "year", "source_file", "variable_name", "document_role"]
        keyed = entries.withColumn("entry", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\\0")) for c in names]))
        mode = "dynamic"
        writer = lambda df, *by: df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by)
        writer(keyed.hint("rebalance", "load"), "load").parquet(f"{self.root}/entries")
        stored = self._read("entries", ENTRIES_SCHEMA).filter(F.col("load").isin(loads))
        postings = stored.select("load", "entry", F.explode(triples(F.coalesce("variable_name", "content"))).alias("triple"))
        postings = postings.withColumn("bucket", bucket(F.col("triple")))
        # A bucket of a load is cut where it is large, and sorted so that a reader skips what it does not ask for.
        sorted_rows = postings.hint("rebalance", "load", "bucket").sortWithinPartitions("load", "bucket", "triple", "entry")
        writer(sorted_rows, "load", "bucket").parquet(f"{self.root}/postings")
        writer(self.spark.createDataFrame([(True, load) for load in loads], "done boolean, load string"), "load").parquet(f"{self.root}/indexed")
        return loads

    def entries(self) -> DataFrame:
        """Entries of the current release of each survey and year."""
        current = self.ledger.current(("survey", "year")).select("survey", "year", "load")
        done = self._read("indexed", "done boolean, load string").select("load")
        rows = self._read("entries", ENTRIES_SCHEMA).join(done, "load", "left_semi")
        return rows.join(current, ["survey", "year", "load"], "left_semi")

    def postings(self, query: str) -> DataFrame | None:
        """``load, entry`` of entries that hold every triple of the text; none for a text without triples."""
        low = query.lower()
        wanted = sorted({low[k : k + 3] for k in range(len(low) - 2)})
        if not wanted:
            return None
        rows = self._read("postings", "triple string, entry bigint, load string, bucket int")
        held = self.spark.createDataFrame([(t,) for t in wanted], "triple string").select(bucket(F.col("triple")).alias("b")).distinct()
        buckets = [r["b"] for r in held.collect()]
        rows = rows.filter(F.col("bucket").isin(buckets) & F.col("triple").isin(wanted))
        return rows.groupBy("load", "entry").agg(F.count_distinct("triple").alias("n")).filter(F.col("n") == len(wanted)).select("load", "entry")

    def _candidates(self, query: str, kind: str, schema: str) -> DataFrame:
        rows = self.entries().filter(F.col("kind") == kind)
        found = self.postings(query)
        if found is not None:
            rows = rows.join(found, ["load", "entry"], "left_semi")
        return rows.select(*[x.split()[0] for x in schema.split(", ")])

    def variables(self, query: str = "") -> DataFrame:
        """Variables that may hold the text."""
        return self._candidates(query, "variable", VARIABLES_SCHEMA)

    def documents(self, query: str = "") -> DataFrame:
        """Documents that may hold the text."""
        return self._candidates(query, "document", DOCUMENTS_SCHEMA)

    def search_variables(self, query: str) -> DataFrame:
        return search_variables(self.variables(query), query)

    def search_documents(self, query: str, limit: int | None = None) -> DataFrame:
        return search_documents(self.documents(query), query, limit)

    def search(self, query: str, limit: int = 20) -> DataFrame:
        """Variables first, then documents, as ``search_catalog`` gives them."""
        return search_catalog(self.variables(query), self.documents(query), query, limit)

    def scan(self, query: str) -> DataFrame:
        """``load, entry`` of entries that hold the text, without postings."""
        return self.entries().filter(contains_text(F.coalesce("variable_name", "content"), query)).select("load", "entry")
