"""A pipeline from raw documents to a mixed training corpus.

Stages, each over all that the one before it kept:

1. quality rules: documents that fail go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. substring dedup: passages of 35 words or more that occur again are cut;
4. benchmark decontamination: documents with benchmark text go;
5. mixing sources to target weights: a row for each reading of a document, in
   training order.

A stage returns the columns of its input (the last one more); ``n_chars`` follows
the text.  Nulls, empty texts and repeated rows are handled as the operators'
docstrings say; extra columns pass through whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termite.llm.curriculum import readings
from termite.llm.decontaminate import decontaminate
from termite.llm.ngram_join import one_of_each
from termite.llm.quality import quality
from termite.llm.substring_dedup import remove_repeats
from termite.session import scratch_path, ship_package, table_path


def _under_other_names(docs: DataFrame, work) -> DataFrame:
    """``work`` on ``docs`` with all columns but ``doc_id`` and ``text`` renamed,
    then the columns of ``docs`` again: what ``work`` adds meets no column."""
    names = [c if c in ("doc_id", "text") else f"__in{i}" for i, c in enumerate(docs.columns)]
    out = work(docs.toDF(*names))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _under_other_names(docs, lambda d: quality(d).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = _under_other_names(docs, remove_repeats)
    kinds = dict(docs.dtypes)
    return out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else out


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark")).select("item_id", "text")
    return decontaminate(docs, benchmark, remove="documents")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return readings(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
]

# The operators' SQL is not chained here; tests/llm compares every row with a
# brute-force version of all five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
