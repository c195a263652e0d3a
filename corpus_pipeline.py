"""From raw documents to token ids: five stages, each written as Parquet and read again.

A row is named by its id and a hash of its text, in the near deduplication by a number, so
ids that are repeated or null cannot mix rows up. Of rows with the same id and text the
exact deduplication leaves one. All
stages but the last return the columns of documents; extra columns are carried along.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, cuckoo, jaccard, language, mixing
from tidemark.llm.queries import vocabulary
from tidemark.session import discard, written

#: SQL has no counterpart of the language model and the tokenizer.
ORACLE_SQL = None


def chosen(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents named by ``doc_id`` and ``mark``, with the other columns of ``rows``."""
    named = docs.withColumn("__mark", F.xxhash64(F.col("text").cast("string")))
    picked = rows.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark_of"),
                         *(F.col(c).alias(f"__{c}") for c in rows.columns
                           if c not in ("doc_id", "mark"))).dropDuplicates(["__id", "__mark_of"])
    return named.join(picked, same(named["doc_id"].cast("bigint"), picked["__id"])
                      & (named["__mark"] == picked["__mark_of"]))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those that are rejected go."""
    found = language.document_languages(docs)
    return chosen(docs, found.where("kept").select("doc_id", "mark")).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: that of the largest id."""
    found = cuckoo.exact_duplicates(docs).where("kept").select("doc_id", "mark")
    return chosen(docs, found).dropDuplicates(["doc_id", "__mark"]).select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number that is the same whenever they are read.

    Rows of Parquet files, as every stage gets them, go by file and place in it; other rows are
    written first. There is one entry on the driver for each file.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("__file"),
                             F.col("_metadata.row_index").alias("__at"))
    except AnalysisException:
        return written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    names = sorted(r[0] for r in placed.select("__file").distinct().collect())
    files = docs.sparkSession.createDataFrame(list(enumerate(names)), "__no bigint, __file string")
    number = F.shiftleft(F.col("__no"), 40) + F.col("__at")
    return placed.join(F.broadcast(files), "__file").select(*docs.columns, number.alias("__row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on five words and a similarity of 0.8.

    Every row is a node of its own by a number. Of a group the row of the smallest id
    stays, one without id only if no row of the group has any.
    """
    rows = numbered(docs)
    found = jaccard.near_duplicates(rows, n=5, percent=80, id_col="__row").select(
        F.col("doc_id").alias("__row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("bigint"),
                     F.xxhash64(F.col("text").cast("string")).alias("mark"), "__row")
    first = rows.select("__row", order.alias("order")).join(found, "__row").groupBy(
        "component_id").agg(F.min("order").alias("order")).select("order.__row")
    return rows.join(first, "__row", "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document that is taken several times is repeated, one not taken goes."""
    found = mixing.mixed(docs).where("taken > 0").select(
        "doc_id", "mark", (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    repeated = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return chosen(docs, found).withColumn("__copy", repeated).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe.encode_decode(docs, vocabulary("word_bpe_49k.json"), finish=bpe.digest_rows,
                             schema=bpe.DIGESTS)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, rows = rows, written(stage(spark, rows, sf_dir), name)
        if k:
            discard(before)
    return rows
