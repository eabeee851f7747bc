"""A label leaves its own document alone; the pipeline keeps the training order."""

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from eventflow.llm.common import store
from eventflow.llm.mixing import in_training_order, mix
from eventflow.llm.quality import classify

DOCS = "doc_id bigint, text string, lang string, source string"


def test_a_label_does_not_decide_its_own_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    alone = spark.createDataFrame([(-5, "Some plain words that make up a short text.", "en", "alone.example/x")], DOCS)
    for keep in (["doc_id"], None):
        scores = {}
        for label in (0, 1, None):
            taught = labels if label is None else labels.union(spark.createDataFrame([(-5, label)], "doc_id bigint, quality int"))
            # the classifier is fitted on other labels: its sample holds all, so the one more is left out of it
            rows = classify(docs.unionByName(alone), taught, keep=keep).filter("doc_id = -5").collect()
            scores[label] = rows[0].path_rate
        # what is left of the site is its host's rate, which has no other documents either
        assert scores[0] == pytest.approx(scores[1], abs=0.02) == pytest.approx(scores[None], abs=0.02)


def test_both_ways_to_judge_agree(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    score = lambda keep: {r.doc_id: (round(r.score, 9), r.keep) for r in classify(docs, labels, keep=keep).collect()}
    assert score(["doc_id"]) == score(None)


def test_training_order_reaches_the_shards(spark, sf):
    docs = store(spark.read.parquet(f"{sf}/documents.parquet").repartition(5), "docs")
    ordered = in_training_order(mix(docs))
    positions = [(r.position, r.doc_id) for r in ordered.select("position", "doc_id").collect()]
    assert positions == sorted(positions)
    mixed = store(P.mixing(spark, docs, sf), "mixed")
    assert mixed.columns == docs.columns
    done = P.sharding(spark, mixed, sf).select("doc_id", "training_rank", "shard").collect()
    by_rank = sorted(done, key=lambda r: r.training_rank)
    assert [r.training_rank for r in by_rank] == list(range(len(positions)))
    assert [r.doc_id for r in by_rank] == [doc for _, doc in positions]
    assert P.sharding(spark, mixed.limit(0), sf).collect() == []
    made = spark.createDataFrame([(1, "a b", "en", "s")], DOCS)
    assert P.sharding(spark, made, sf).first().training_rank is None
    assert mixed.filter(F.col("doc_id").isNull()).count() == 0
