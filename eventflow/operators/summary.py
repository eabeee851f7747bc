"""Summaries: field schemas, dataset metrics and processing statistics.

All of them are aggregates with partial results per task, so a dataset or field that holds most
of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import text as tx
from ..session import stored


def static_type(kind: T.DataType) -> str:
    """JSON type name of a column type."""
    if isinstance(kind, tx.NUMERIC):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.ArrayType):
        return "array"
    if isinstance(kind, (T.StructType, T.MapType)):
        return "object"
    if isinstance(kind, T.NullType):
        return "null"
    return "string"


def _field_rows(df: DataFrame, record: str | None, order: Column | None = None) -> DataFrame:
    """One row per field of every record: ``field``, ``type``, ``sample`` and ``ord``; each record has one more without a field."""
    at = F.lit(None).cast("string") if order is None else order
    if record is None:
        entry = "struct<field:string,type:string,sample:string>"
        entries = F.array(
            *[
                F.when(
                    tx.field(f.name).isNotNull(),
                    F.struct(
                        F.lit(f.name).alias("field"),
                        js.json_type(tx.field(f.name))
                        if isinstance(f.dataType, T.VariantType)
                        else F.lit(static_type(f.dataType)).alias("type"),
                        tx.text(tx.field(f.name), f.dataType).alias("sample"),
                    ).cast(entry),
                )
                for f in df.schema.fields
                if not f.name.startswith("_")
            ]
        ).cast(f"array<{entry}>")
        none = F.lit(None).cast("string")
        mark = F.array(F.struct(none.alias("field"), none.alias("type"), none.alias("sample")))
        listed = F.concat(mark, F.filter(entries, lambda e: e.isNotNull()))
        return df.select(F.explode(listed).alias("e"), at.alias("ord")).select("e.field", "e.type", "e.sample", "ord")
    value = tx.field(record)
    variant = value if isinstance(tx.type_of(df, record), T.VariantType) else js.strict_json(value)
    entries = F.map_entries(js.as_object(variant))
    mark = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")))
    # no object, no record
    rows = df.select(F.explode(F.concat(mark, entries)).alias("e"), at.alias("ord"))
    rows = rows.where(F.col("e.key").isNull() | ~F.col("e.key").startswith("_"))
    return rows.select(
        F.col("e.key").alias("field"),
        js.json_type(F.col("e.value")).alias("type"),
        F.col("e.value").cast("string").alias("sample"),
        "ord",
    )


def _with_total(merged: DataFrame, count: str) -> tuple[DataFrame, Column]:
    """The fields, and the number of records out of the row without a field; the small table is stored, so the input is read once."""
    kept = stored(merged, "fields")
    total = kept.where("field IS NULL").agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).scalar()
    return kept.where("field IS NOT NULL"), total


def schema_union(df: DataFrame, record: str | None = None) -> DataFrame:
    """Per field the sorted set of JSON types seen, with the number of records looked at.

    ``record`` names a JSON text or VARIANT column; without it the columns are the fields.
    """
    # The inner aggregate reduces to one row per field and type before the types are gathered.
    kinds = _field_rows(df, record).groupBy("field", "type").agg(F.count("*").alias("n"))
    kinds, total = _with_total(kinds, "n")
    return kinds.groupBy("field").agg(F.sort_array(F.collect_set("type")).alias("types")).select(
        "field", "types", total.alias("sample_count")
    )


def schema_profile(df: DataFrame, order_by: str, record: str | None = None) -> DataFrame:
    """Per field: most common type, count, whether some record lacks it, and its first value."""
    rows = _field_rows(df, record, tx.field(order_by))
    # Of equally common types the alphabetically first one is named; a field has six types at most,
    # so the counts that mode() keeps stay tiny.
    merged = rows.groupBy("field").agg(
        F.mode("type", True).alias("type"), F.count("*").alias("count"), F.min_by("sample", "ord").alias("sample")
    )
    merged, total = _with_total(merged, "count")
    return merged.select("field", "type", "count", (F.col("count") < total).alias("nullable"), "sample")


def _keys(df: DataFrame, by: list[str]) -> list[Column]:
    return [tx.field(k) for k in by]


def dataset_metrics(
    df: DataFrame,
    time_column: str,
    error_column: str = "_error",
    skipped_column: str = "_skipped",
    by: tuple[str, ...] = ("tenant_id", "dataset_id"),
) -> DataFrame:
    """Per dataset: totals, the last error and when, and the mean rows per second."""
    failed = tx.field(error_column).isNotNull() if tx.has(df, error_column) else F.lit(False)
    skipped = tx.is_true(tx.field(skipped_column)) if tx.has(df, skipped_column) else F.lit(False)
    at = tx.field(time_column)
    error = tx.field(error_column) if tx.has(df, error_column) else F.lit(None).cast("string")
    stamp = at if tx.type_of(df, time_column) == T.TimestampType() else at.cast("timestamp")
    # Numbers and times are all that the pass over the rows aggregates, by hash: a text such as the last error would make it sort
    # them.  So errors are a key here, and the last one is picked among the few rows that are left.
    keys = {f"_k{i}": tx.field(k) for i, k in enumerate(by)}
    given = df.select(
        *[c.alias(n) for n, c in keys.items()],
        F.when(failed, error.cast("string")).alias("_e"),
        failed.alias("_f"),
        skipped.alias("_s"),
        stamp.alias("_t"),
        at.alias("_at"),
    )
    timed = not isinstance(tx.type_of(df, time_column), (T.StringType, T.VarcharType, T.CharType))
    pieces = given.groupBy(*keys, "_e", *([] if timed else ["_at"])).agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("_f") & ~F.col("_s")).alias("ok"),
        F.count_if("_f").alias("bad"),
        F.count_if(F.col("_s") & ~F.col("_f")).alias("out"),
        F.min("_t").alias("first"),
        F.max("_t").alias("last"),
        *([F.max("_at").alias("_at")] if timed else []),
    )
    seconds = (F.unix_micros(F.max("last")) - F.unix_micros(F.min("first"))) / 1e6
    total = F.sum("n")
    merged = pieces.groupBy(*keys).agg(
        total.alias("total_processed"),
        F.sum("ok").alias("success_count"),
        F.sum("bad").alias("error_count"),
        F.sum("out").alias("skipped_count"),
        F.max_by("_e", F.when(F.col("bad") > 0, F.struct("_at", "_e"))).alias("last_error"),
        F.max("_at").alias("last_processed"),
        F.when(seconds > 0, total / seconds).alias("avg_rows_per_sec"),
    )
    return merged.select(*[F.col(n).alias(k) for n, k in zip(keys, by, strict=True)], *merged.columns[len(keys) :])


def transformation_summary(audited: DataFrame) -> DataFrame:
    """Success, error and skipped counts over audited rows."""
    failed = F.col("_error").isNotNull()
    skipped = tx.is_true(F.col("_skipped"))
    return audited.agg(
        F.count_if(~failed & ~skipped).alias("success_count"),
        F.count_if(failed).alias("error_count"),
        F.count_if(~failed & skipped).alias("skipped_count"),
    )


def filter_stats(audited: DataFrame) -> DataFrame:
    """Per filter: how often it applied, skipped a row or failed.

    Each row is exploded to its (few) applied filters; the counts are reduced per task first.
    """
    events = F.concat(
        F.transform("_applied", lambda f: F.struct(f.alias("filter"), F.lit("applied").alias("kind"))),
        F.when(
            tx.is_true(F.col("_skipped")), F.array(F.struct(F.col("_skipped_by").alias("filter"), F.lit("skipped").alias("kind")))
        ).otherwise(F.array().cast("array<struct<filter:string,kind:string>>")),
        F.when(
            F.col("_error").isNotNull(), F.array(F.struct(F.lit("decode").alias("filter"), F.lit("error").alias("kind")))
        ).otherwise(F.array().cast("array<struct<filter:string,kind:string>>")),
    )
    rows = audited.select(F.explode(events).alias("e"))
    counts = [F.count_if(F.col("e.kind") == k).alias(f"{k}_count") for k in ("applied", "skipped", "error")]
    return rows.groupBy(F.col("e.filter").alias("filter")).agg(*counts)


def processing_stats(
    df: DataFrame,
    by: list[str],
    input_text: str,
    output_text: str,
    error_column: str = "_error",
    skipped_column: str = "_skipped",
) -> DataFrame:
    """Per file or batch: input, output, filtered and failed records, and bytes in and out.

    Failed records are passed through, so their bytes count as written.
    """
    failed = tx.field(error_column).isNotNull()
    skipped = tx.is_true(tx.field(skipped_column)) & ~failed
    size = lambda c: F.octet_length(tx.field(c)).cast("bigint") + 1
    return df.groupBy(*_keys(df, by)).agg(
        F.count("*").alias("input_records"),
        F.count_if(~failed & ~skipped).alias("output_records"),
        F.count_if(skipped).alias("filtered_records"),
        F.count_if(failed).alias("error_records"),
        F.coalesce(F.sum(size(input_text)), F.lit(0)).alias("input_size_bytes"),
        F.coalesce(F.sum(F.when(~skipped, size(output_text))), F.lit(0)).alias("output_size_bytes"),
    )
