"""Delimited files in number, each with its own header, in one read: rows as maps from column name to text."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.enrich import fits_broadcast, lookup_join
from ..session import stored

MISMATCH = "column count mismatch"


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the header of their file, as far as the task has read it; the headers themselves have ``is_header``.

    A task reads its pieces of files one after the other; the header is the first line with text of the piece that starts a file.
    """
    at, header = (None, None), None
    for batch in batches:
        out: list[tuple] = []
        for file, start, value in zip(*[batch.column(c).to_pylist() for c in ("file", "start", "value")], strict=True):
            if (file, start) != at:
                # the next piece of the same file keeps the header
                header = header if file == at[0] and start else None
                at, wanted = (file, start), not start
            if not value.strip():
                continue
            if wanted and header is None:
                header = value.removeprefix("﻿")
                out.append((file, header, None, True))
            else:
                out.append((file, header, value, False))
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.string(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "header", "value", "is_header"])


def _parsed(delimiter: str):
    def fields(line: str) -> list[str | None]:
        # an empty field without quotes is null; lines are parsed one by one, so an open quote ends with its line
        return next(csv.reader([line], delimiter=delimiter, quoting=csv.QUOTE_NOTNULL))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headers: dict[str, list[str]] = {}
        for batch in batches:
            rows, errors = [], []
            for header, line in zip(*[batch.column(c).to_pylist() for c in ("header", "value")], strict=True):
                if header not in headers:
                    headers = {header: [n or "" for n in fields(header)]}
                names, values = headers[header], fields(line)
                # like a reader with a schema: what is there is kept, too many or too few values are an error
                rows.append(list({n: v for n, v in zip(names, [*values, *[None] * len(names)], strict=False)}.items()))
                errors.append(None if len(values) == len(names) else MISMATCH)
            raw = [v if e else None for v, e in zip(batch.column("value").to_pylist(), errors, strict=True)]
            arrays = [batch.column("file"), pa.array(rows, pa.map_(pa.string(), pa.string())), pa.array(raw, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_file", "fields", "_raw", "_error"])

    return parse


def read_delimited_records(spark: SparkSession, path: str | list[str], delimiter: str = ",", columns: list[str] | None = None) -> DataFrame:
    """CSV / TSV files of any number of headers: ``_file``, ``fields`` (map of text by column name), ``_raw`` and ``_error``.

    The data is read once, by a plan that does not depend on the number of files or headers, and no header goes to the driver.  Only files
    that may be cut into pieces are looked at before for their header, which their later pieces get by a join.  A line
    with another number of values than its header has names keeps what fits and has ``_error`` and its text in ``_raw``.  Of a
    name that stands twice in a header the last value counts.  ``columns`` gives these names as text columns instead of the map; a file
    without one of them has NULL there.
    """
    conf = spark._jsparkSession.sessionState().conf()
    piece = min(int(conf.filesMaxPartitionBytes()), int(conf.filesOpenCostInBytes()))
    text = spark.read.text(path)
    kinds = "file string, header string, value string, is_header boolean"
    given = lambda df: df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    lines = given(text).mapInArrow(_headed, kinds)
    # files that one piece holds are pruned by their size
    large = given(text.where(F.col("_metadata.file_size") > piece)).mapInArrow(_headed, kinds)
    headers = stored(large.where("is_header").select(F.col("file").alias("_key"), F.struct("header").alias("_row")), "headers")
    later = F.when(F.col("header").isNull(), F.col("file"))
    joined = lookup_join(lines.where("NOT is_header").drop("is_header"), later, headers, fits_broadcast(headers))
    ready = joined.select("file", F.coalesce("header", "_found.header").alias("header"), "value")
    out = ready.mapInArrow(_parsed(delimiter), "_file string, fields map<string,string>, _raw string, _error string")
    if columns is None:
        return out
    return out.select(*[F.try_element_at(F.col("fields"), F.lit(c)).alias(c) for c in columns], *[tx.field(c) for c in ("_file", "_raw", "_error")])
