"""Every operator on nulls, empty and long texts, repeated rows, empty tables and columns with clashing names."""

import pytest

from eventflow.llm import queries as Q
from eventflow.llm.decontaminate import leaks, without_leaks
from eventflow.llm.exact_dedup import exact_dedup
from eventflow.llm.html_text import extract
from eventflow.llm.jaccard_join import similar_documents
from eventflow.llm.language_id import identify
from eventflow.llm.licenses import scan
from eventflow.llm.mixing import in_training_order, mix
from eventflow.llm.pii import replace_personal_data
from eventflow.llm.quality import classify
from eventflow.llm.sharding import reshard

SCHEMA = "doc_id bigint, text string, lang string, source string, size string, kept string, target string, `n size` int"
LONG = "word other third " * 30_000
ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a", "x", "k", "t", 1),
    (1, "the cat sat on the mat and looked at the dog", "en", "a", "x", "k", "t", 1),
    (2, "the cat sat on the mat and looked at the dog", None, None, None, None, None, None),
    (3, None, "en", "a", "x", "k", "t", 1),
    (4, "", "de", "b", "x", "k", "t", 1),
    (5, " \t\n ", "de", "b", "x", "k", "t", 1),
    (None, "kein Name", "de", "c", "x", "k", "t", 1),
    (None, None, None, None, None, None, None, None),
    (6, LONG, "en", "a", "x", "k", "t", 1),
    (7, "Été à la mer, l’eau", "fr", "b", "x", "k", "t", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 0), (7, 1, 0), (None, 0, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "cat sat on the mat and looked"), (2, None), (3, ""), (4, "Name")], "item_id bigint, text string")


def old(df):
    return Q.present_shard()


def each(docs, labels, items):
    yield "exact_dedup", exact_dedup(docs), docs.count()
    yield "classify", classify(docs, labels), docs.count()
    yield "scan", scan(docs), docs.count()
    yield "mix", mix(docs), docs.count()
    yield "reshard", reshard(docs, old(docs), Q.OLD_SHARDS, Q.SHARDS), docs.count()
    yield "replace_personal_data", replace_personal_data(docs, "key"), docs.count()
    yield "similar_documents", similar_documents(docs), docs.count()
    yield "identify", identify(docs, docs), docs.count()
    yield "without_leaks", without_leaks(docs, leaks(docs, items)), None
    yield "extract", extract(docs.withColumnsRenamed({"text": "html", "source": "url", "size": "text"})), docs.count()


def test_odd_rows(docs, labels, items):
    for name, out, n in each(docs, labels, items):
        assert len(set(map(str.lower, out.columns))) == len(out.columns), name
        rows = out.collect()
        assert n is None or len(rows) == n, name


def test_empty_tables(nothing, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    for name, out, _ in each(nothing, labels, items):
        assert out.collect() == [], name


def test_defined_results_of_odd_rows(docs, labels, items):
    dedup = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert {(1, 2, 3, False), (2, 2, 3, True), (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False), (None, None, 1, True)} <= dedup
    near = {(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(docs).collect()}
    assert {(1, 7, 1), (2, 7, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 1, None), (None, 0, None)} <= near
    found = leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1)} | {(r.doc_id, 4) for r in found if r.item_id == 4}
    languages = {(r.doc_id, r.lang_pred) for r in identify(docs, docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "fr")} <= languages
    judged = {(r.doc_id, r.keep) for r in classify(docs, labels).collect()}
    assert {(3, False), (4, False), (5, False)} <= judged
    mixed = mix(docs)
    assert sum(r.copies for r in mixed.collect()) == in_training_order(mixed).count()
    done = {r.doc_id: r.text for r in replace_personal_data(docs, "key").collect() if r.doc_id}
    assert done[3] is None and done[4] == "" and done[6] == LONG
