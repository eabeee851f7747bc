"""Corpus pipeline: from raw documents to sharded training data, one operator of eventflow.llm a stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``docs``.  Null and empty texts are rejected by the first stage;
rows without doc_id pass the others as documents of their own.  An empty table stays empty.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import wraps

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventflow.llm.base import table  # noqa: E402
from eventflow.llm.common import broadcast_if_small, quoted, release, store  # noqa: E402
from eventflow.llm.decontaminate import leaks, without_leaks  # noqa: E402
from eventflow.llm.jaccard_join import similar_documents  # noqa: E402
from eventflow.llm.mixing import in_training_order, mix  # noqa: E402
from eventflow.llm.quality import classify  # noqa: E402
from eventflow.llm.sharding import reshard  # noqa: E402

# Layout that the last stage starts from (by a hash of the text), and the one it makes.
OLD_SHARDS, SHARDS = 12, 16

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def released(stage: Stage) -> Stage:
    """The stage between two releases: it begins without what the stages before it left on the driver, and its result is written without
    what its own jobs left."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        out = stage(spark, docs, sf_dir)
        release(spark)
        return out

    return run


@released
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return classify(docs, table(spark, sf_dir, "labels")).filter("keep").select(*quoted(docs.columns))


@released
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of five-word shingles of 0.8 or more: the smallest doc_id.

    Of rows that share that doc_id one stays.  Rows without doc_id all stay.
    """
    groups = similar_documents(docs)
    dropped = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("__of")).distinct()
    dropped = broadcast_if_small(store(dropped, "dropped"))
    left = docs.join(dropped, F.col("doc_id") == F.col("__of"), "left_anti")
    again = left.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__of")).agg(F.count("*").alias("n"))
    again = store(again.filter("n > 1").select("__of"), "again")
    if again.isEmpty():
        return left
    again = broadcast_if_small(again)
    same = F.col("doc_id") == F.col("__of")
    one = left.join(again, same, "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, same, "left_anti").unionByName(one)


@released
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return without_leaks(docs, leaks(docs, table(spark, sf_dir, "benchmark")))


@released
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, in training order; a document taken twice is there twice.

    The rows are range-sorted, so the files that they are written to have them in order of training.
    """
    return in_training_order(mix(docs)).select(*quoted(docs.columns))


def training_rank(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with ``training_rank``: the place of a row in the training order, which its file and its place there tell.

    Counts by file, as many as the writing job had partitions, give each file's first rank; no row is moved.  Rows that are not read from
    files have null.
    """
    docs = docs.drop("training_rank")
    try:
        placed = docs.withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
    except AnalysisException:
        return docs.withColumn("training_rank", F.lit(None).cast("bigint"))
    part = F.regexp_extract("__file", r"part-(\d+)[^/]*$", 1).cast("long")
    files = placed.groupBy("__file").agg(F.count("*").alias("n"), F.first(part).alias("part")).collect()
    first, offsets = 0, []
    for f in sorted(files, key=lambda f: (f["part"], f["__file"])):
        offsets.append((f["__file"], first))
        first += f["n"]
    starts = spark.createDataFrame(offsets, "__of string, __first bigint")
    ranked = placed.join(F.broadcast(starts), F.col("__file") == F.col("__of"))
    return ranked.select(*quoted(docs.columns), (F.col("__first") + F.col("__row")).alias("training_rank"))


@released
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, its slot there, and its place in the training order."""
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(OLD_SHARDS)).cast("int")
    return reshard(training_rank(spark, docs), old, OLD_SHARDS, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The stages learn weights and hash texts, which SQL doesn't express; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
