"""A corpus pipeline: classify, join near-duplicates, cut repeats, mix sources, encode.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import BLANK, id_key, stage, text_or_empty
from tallyloom.llm.mixing import curriculum, training_order
from tallyloom.llm.ngram_join import similar_groups
from tallyloom.llm.piece_codec import encoded
from tallyloom.llm.quality_model import learn, scored
from tallyloom.llm.substring_dedup import remove_repeats


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = scored(docs, model, keep_text=True, prefix="__quality_")
    return rows.filter("__quality_predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest id; of rows
    that repeat an id and text, one."""
    groups = similar_groups(docs, words=5, percent=80)
    first = groups.filter("doc_id <=> component_id").select(id_key().alias("__keep")).distinct()
    rows = docs.withColumns({"__key": id_key(), "__h": F.xxhash64(text_or_empty())})
    rows = rows.join(first, rows["__key"] == first["__keep"], "left_semi")
    one = Window.partitionBy("__key", "__h").orderBy(F.lit(0))
    return rows.withColumn("__n", F.row_number().over(one)).filter("__n = 1").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that earlier documents hold; what is blank then goes."""
    cut = remove_repeats(docs, keep=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")))
    cut = cut.filter((F.col("n_removed") == 0) | F.col("kept").rlike(f"[^{BLANK}]"))
    made = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the order of training, a row for each time a document is taken. Documents stay
    whole: a copy that the target cuts short counts if at least half of it is taken."""
    rows = training_order(curriculum(docs, keep_text=True))
    return rows.filter(2 * F.col("__words") >= F.col("__size")).select(*docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and the text that they decode to, as digests."""
    return encoded(docs.select("doc_id", "text"), tokenizers.path("piece_bpe_32k.model"), with_ids=False)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", piece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL states neither the classifier nor the encoder.
ORACLE_SQL = None
