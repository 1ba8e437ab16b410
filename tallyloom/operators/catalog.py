"""Variable and document catalog, and search over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_text, snippet
from .series import limited_union

VARIABLES_SCHEMA = (
    "survey string, year int, release_id string, source_file string, variable_name string, data_type string"
)


def catalog_variables(spark: SparkSession, tables: Sequence[tuple[str, int, str, str, DataFrame]]) -> DataFrame:
    """One row per column of each ``(survey, year, release_id, file, frame)``, from schemas only."""
    rows = [
        (survey, year, release, file, field.name, field.dataType.simpleString())
        for survey, year, release, file, frame in tables
        for field in frame.schema.fields
    ]
    return spark.createDataFrame(rows, VARIABLES_SCHEMA)


def catalog_documents(docs: DataFrame, survey: str, year: int | str, release_id: str) -> DataFrame:
    """Attach release identity to documents with ``document_role``, ``source_file``, ``content``."""
    return docs.select(
        F.lit(survey).alias("survey"),
        F.lit(year).cast("int").alias("year"),
        F.lit(release_id).alias("release_id"),
        "document_role",
        "source_file",
        "content",
    )


def read_documents(spark: SparkSession, path: str, survey: str, year: int, release_id: str) -> DataFrame:
    """Text files as catalog documents, one row per file."""
    text = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    docs = text.select(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("document_role"),
        name.alias("source_file"),
        F.col("value").alias("content"),
    )
    return catalog_documents(docs, survey, year, release_id)


def search_variables(variables: DataFrame, query: str) -> DataFrame:
    """Variables whose name holds the text, newest year first within a survey."""
    hits = variables.filter(contains_text("variable_name", query))
    return hits.orderBy("survey", F.col("year").desc(), "variable_name", "source_file")


def search_documents(documents: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """Documents that hold the text, with a snippet around the first hit. With ``limit`` the first
    ones in survey, newest year, role order; without it all hits, unordered."""
    hits = documents.filter(contains_text("content", query))
    if limit is not None:
        hits = hits.orderBy("survey", F.col("year").desc(), "document_role", "source_file").limit(limit)
    return hits.select(
        "survey", "year", "release_id", "document_role", "source_file", snippet("content", query).alias("snippet")
    )


def search_catalog(variables: DataFrame, documents: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Variables first, then documents, up to ``limit`` rows in total.

    Documents are cut to ``limit`` by their keys, and only then are snippets taken.
    """
    v = variables.filter(contains_text("variable_name", query)).select(
        F.lit("variable").alias("kind"),
        "survey",
        "year",
        "release_id",
        F.col("variable_name").alias("name"),
        "data_type",
        F.lit(None).cast("string").alias("role"),
        "source_file",
        F.lit(None).cast("string").alias("content"),
    )
    d = documents.filter(contains_text("content", query)).select(
        F.lit("document").alias("kind"),
        "survey",
        "year",
        "release_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("data_type"),
        F.col("document_role").alias("role"),
        "source_file",
        "content",
    )
    order = ["survey", F.col("year").desc(), F.coalesce("name", "role"), "source_file"]
    hits = limited_union(v, d, limit, order)
    shown = F.when(F.col("content").isNotNull(), snippet("content", query))
    return hits.withColumn("snippet", shown).drop("content")
