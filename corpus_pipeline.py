"""A training-data pipeline over ``documents``: quality rules, toxicity, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result as Parquet and rereads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm import decontam, packing, partenum, quality, toxicity
from headway.llm.common import read_table, written
from headway.llm.queries import TOKENIZER
from headway.session import scratch_path, scratch_scope

#: A side of at most so many ids may be broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


#: The columns that the operators read.
READ = ("doc_id", "text", "lang")


def _shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with all other columns under names that no operator adds."""
    return docs.toDF(*[c if c in READ else f"_column_{i}" for i, c in enumerate(docs.columns)])


def _as_before(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*_shielded(docs).columns).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    judged = quality.quality_rules(_shielded(docs), read_table(spark, sf_dir, "labels"))
    return _as_before(judged.filter("kept"), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below a half."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return _as_before(toxicity.score(_shielded(docs), model).filter("score < 0.5"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: that with the smallest id (none comes last), then text hash.

    Different texts of one id are documents of their own.  Of rows that repeat an
    id and its text the first by all columns stays.  Texts without words are like
    no other: of those without an id all rows stay.
    """
    keyed = docs.withColumn("_hw_key", F.xxhash64("doc_id", "text"))
    grouped = partenum.jaccard_groups(keyed, id_col="_hw_key").select(F.col("doc_id").alias("_key"), "n_shingles", "component_id")
    grouped = written(grouped.groupBy("_key").agg(F.max("n_shingles").alias("n"), F.min("component_id").alias("c"), F.count("*").alias("m")), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"), "_hw_key")
    places = keyed.groupBy("_hw_key").agg(F.min(place).alias("place"))
    placed = written(grouped.join(places, grouped["_key"] == places["_hw_key"]).select("_key", "n", "c", "m", "place"), "places")
    first = placed.groupBy("c").agg(F.min("place").alias("first")).select(F.col("first._hw_key").alias("_first"))
    gone = written(placed.join(first, placed["_key"] == first["_first"], "left_anti").select(F.col("_key").alias("_hw_gone")), "gone")
    if gone.count() <= BROADCAST_IDS:  # 8 bytes each
        gone = F.broadcast(gone)
    left = keyed.join(gone, keyed["_hw_key"] == gone["_hw_gone"], "left_anti")
    again = placed.filter("m > 1 and (n > 0 or not place.no_id)").select(F.col("_key").alias("_hw_again"))
    again = written(again, "again")
    if again.isEmpty():
        return left.drop("_hw_key")
    once = left.join(again, left["_hw_key"] == again["_hw_again"], "left_semi")
    order = Window.partitionBy("_hw_key").orderBy(*[F.col(c).asc_nulls_first() for c in docs.columns])
    one = once.withColumn("_hw_place", F.row_number().over(order)).filter("_hw_place = 1").drop("_hw_place")
    return left.join(again, left["_hw_key"] == again["_hw_again"], "left_anti").unionByName(one).drop("_hw_key")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    marked = decontam.decontaminate(_shielded(docs), read_table(spark, sf_dir, "benchmark"))
    return _as_before(marked.filter("not contaminated"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 ids."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), capacity=1024, end_id=2, digests=True)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", pack),
]

#: Toxicity and packing are no SQL; the pipeline is tested against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):  # what the stage writes for itself goes when its result is written
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
