"""Licence scan: texts in a canonical form, joined by digest to known licences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store
from .license_texts import texts

# Equivalent spellings, in lower case; replaced in this order.
SPELLINGS = {
    "licence": "license", "licencing": "licensing", "licencee": "licensee", "non-infringement": "noninfringement", "acknowledgement": "acknowledgment",
    "organisation": "organization", "authoris": "authoriz", "recognis": "recogniz", "favour": "favor", "judgement": "judgment", "merchantibility": "merchantability",
    "redistribution and use in source and binary form,": "redistribution and use in source and binary forms,", "https://": "http://", "version 2.0": "v 2.0", "per cent": "percent",
    "copyright owner": "copyright holder",
}


def canonical_line(line: Column) -> Column:
    """Lower case, no copyright line, one spelling, words with single spaces."""
    line = F.lower(line)
    own = line.rlike(r"^[\s\p{P}\p{S}]*(?:copyright\b[\s:]*(?!notice|holder|owner|law|and\b|or\b|is\b|in\b|to\b)\S|\(c\)\s*\S|©)")
    for form, to in SPELLINGS.items():
        line = F.replace(line, F.lit(form), F.lit(to))
    return F.when(own, F.lit("")).otherwise(F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " ")))


def canonical_lines(text: Column | str) -> Column:
    """The lines of a text in canonical form; those that say nothing are empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n", -1), canonical_line)


def whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_digests(spark: SparkSession, licenses: Sequence[tuple[str, str]]) -> DataFrame:
    """``license, digest`` of the given (identifier, text) pairs."""
    rows = spark.createDataFrame(list(licenses), "license string, text string")
    return rows.select(F.sha2(whole(canonical_lines("text")), 256).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def full_lines(lines: Column) -> Column:
    """The lines that say something, as ``(line, text, words)``: the number, and how many words."""
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(i.cast("int").alias("line"), x.alias("text"))), lambda x: x["text"] != "")
    return F.transform(kept, lambda x: F.struct(x["line"].alias("line"), x["text"].alias("text"), F.size(F.split(x["text"], " ")).alias("words")))


def runs(lines: Column, lengths: Column) -> Column:
    """``(line, text)`` of the runs of two lines or more that begin with two words of a known text and have as many words as it.

    ``lines`` are those of ``full_lines``; ``lengths`` maps the first two words of the known texts to their numbers of words.
    """
    heads, text = F.map_keys(lengths), lambda i: F.get(lines, i)["text"]
    # a line of one word has the second one from the next line
    head = lambda x, i: F.when(x["words"] > 1, F.substring_index(x["text"], " ", 2)).otherwise(F.concat_ws(" ", x["text"], F.substring_index(text(i + 1), " ", 1)))
    begun = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), head(x, i).alias("head"))), lambda x: F.array_contains(heads, x["head"]))
    step = lambda s, x: F.when(s["left"] > 0, F.struct((s["left"] - x["words"]).alias("left"), (s["used"] + 1).alias("used"))).otherwise(s)

    def run(i: Column, n: Column) -> Column:
        # a run of n words has n lines at most
        end = F.aggregate(F.slice(lines, i + 1, n), F.struct(n.alias("left"), F.lit(0).alias("used")), step)
        return F.struct(i.alias("i"), end["left"].alias("left"), end["used"].alias("used"))

    hits = F.flatten(F.transform(begun, lambda x: F.transform(F.element_at(lengths, x["head"]), lambda n: run(x["i"], n))))
    hits = F.filter(hits, lambda h: (h["left"] == 0) & (h["used"] > 1))
    return F.transform(hits, lambda h: F.struct(F.get(lines, h["i"])["line"].alias("line"), F.concat_ws(" ", F.slice(lines, h["i"] + 1, h["used"])["text"]).alias("text")))


def scan(docs: DataFrame, licenses: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per document: ``doc_id, text_digest, license, notices, notice_lines``.

    ``text_digest`` is the SHA-256 of the canonical text, ``license`` the known licence whose canonical text is the same, else null.
    Each line is looked up too, and each run of lines that has the first two words and the number of words of a known text, for
    notices and texts within other text: ``notices`` are their identifiers, sorted, ``notice_lines`` the numbers of their first lines from 0.

    The canonical form lower-cases, drops lines that state a copyright, unifies spellings, and takes punctuation and white
    space for one space.  A null text is as empty; a text that is empty in canonical form matches nothing.  Rows equal in doc_id and text get
    equal results.  An empty table gives an empty table; other columns are ignored.

    ``licenses`` are (identifier, text) pairs, handed over as a list, so that the table of digests may be broadcast.
    """
    spark = docs.sparkSession
    licenses = texts() if licenses is None else licenses
    known = F.broadcast(store(known_digests(spark, licenses), "licenses"))
    heads = spark.createDataFrame(list(licenses), "license string, text string").select(F.split(whole(canonical_lines("text")), " ").alias("w")).filter("size(w) > 1")
    heads = heads.groupBy(F.concat_ws(" ", F.slice("w", 1, 2)).alias("head")).agg(F.sort_array(F.collect_set(F.size("w"))).alias("n"))
    # one row, a few words for each known text
    heads = store(heads.agg(F.map_from_entries(F.collect_list(F.struct("head", "n"))).alias("lengths")), "heads")
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), canonical_lines("text").alias("lines")).crossJoin(F.broadcast(heads))
    base = base.withColumn("full", full_lines(F.col("lines")))
    base = base.withColumn("runs", runs(F.col("full"), F.col("lengths")))
    unit = lambda line, text: F.struct(line.cast("int").alias("line"), F.sha2(text, 256).alias("digest"), (text != "").alias("some"))
    # the whole text is line -1
    units = F.concat(F.array(unit(F.lit(-1), whole(F.col("lines")))), F.transform("lines", lambda x, i: unit(i, x)), F.transform("runs", lambda r: unit(r["line"], r["text"])))
    rows = base.select("doc_id", "print", F.explode(units).alias("u")).select("doc_id", "print", "u.*")
    rows = rows.filter("some OR line = -1").drop("some").join(known, "digest", "left")
    # a row for each document, and its hits
    rows = rows.filter("line = -1 OR license IS NOT NULL")
    notice = F.when(F.col("line") >= 0, F.struct("line", "license"))
    empty = F.sha2(F.lit(""), 256)
    out = rows.groupBy("doc_id", "print").agg(
        F.count(F.when(F.col("line") == -1, 1)).alias("rows"),
        F.max(F.when(F.col("line") == -1, F.col("digest"))).alias("text_digest"),
        F.max(F.when((F.col("line") == -1) & (F.col("digest") != empty), F.col("license"))).alias("license"),
        F.sort_array(F.collect_set(notice)).alias("found"),
    )
    # as many rows as the documents had
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return out.select(
        "doc_id",
        "text_digest",
        "license",
        F.array_sort(F.array_distinct("found.license")).alias("notices"),
        F.col("found.line").alias("notice_lines"),
    )
