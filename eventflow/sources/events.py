"""Readers of newline-delimited JSON and delimited text."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import text as tx
from ..operators.parse import parse
from .paths import FORMAT_PARSERS, path_metadata, with_format_hint

_BAD = "_corrupt"


def decode_lines(lines: DataFrame, schema: str | T.StructType | None = None, keep_raw: bool = False) -> DataFrame:
    """Decode the JSON object in ``value`` of every non-blank line.

    With a schema its fields become columns; other members are kept in ``_rest``, and values of another type than
    declared, whose column is NULL, in ``_mistyped`` (both ``map<string,variant>``, NULL if empty).  Without a schema
    the record is the VARIANT column ``record``.  A line that is no JSON object has ``_error`` and its text in ``_raw``;
    ``keep_raw`` keeps the text of all lines.
    """
    lines = lines.where(tx.trim_space(F.col("value")) != "")
    others = [tx.field(c) for c in lines.columns if c != "value"]
    message = F.lit("line is not a JSON object")
    if schema is None:
        decoded = lines.withColumn("record", js.strict_object(F.col("value")))
        bad = F.col("record").isNull()
        fields = [F.col("record")]
    else:
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        full = T.StructType([*wanted.fields, T.StructField(_BAD, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        decoded = lines.withColumn("_r", F.from_json("value", full, options))
        # The corrupt mark is also set for a field of an unexpected type, which is no bad line; only
        # marked lines are looked at again.
        bad = F.col("_r").isNull() | (
            F.col("_r").getField(_BAD).isNotNull() & js.strict_object(F.col("value")).isNull()
        )
        fields = [F.col("_r").getField(f.name).alias(f.name) for f in wanted.fields]
        fields += _undeclared(wanted)
    error = tx.is_true(bad)
    raw = F.col("value") if keep_raw else F.when(error, F.col("value"))
    return decoded.select(*others, *fields, F.when(error, message).alias("_error"), raw.alias("_raw"))


def _undeclared(wanted: T.StructType) -> list[Column]:
    """``_rest`` and ``_mistyped`` of the object in ``value``; plans that use neither never compute them."""
    members = js.as_object(F.try_parse_json("value"))
    names = [f.name for f in wanted.fields]
    empty = lambda m: F.when(F.size(m) > 0, m)
    rest = tx.let(F.map_filter(members, lambda k, _: ~k.isin(names)) if names else members, empty)
    lost = F.array_compact(F.array(*[F.when(F.col("_r").getField(n).isNull(), F.lit(n)) for n in names]))
    wrong = tx.let(
        F.map_filter(members, lambda k, v: F.array_contains(lost, k) & ~F.is_variant_null(v)) if names else members, empty
    )
    # the reader marks every line in which a field has another type
    marked = F.col("_r").getField(_BAD).isNotNull()
    return [rest.alias("_rest"), F.when(marked, wrong).alias("_mistyped")]


_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*"


def _with_path(lines: DataFrame, roots: list[str]) -> DataFrame:
    """Tenant and dataset of the file a line comes from, by its key below the longest of the ``roots`` that holds it."""
    path = F.col("_metadata.file_path")
    plain = sorted({re.sub(_SCHEME, "", root).rstrip("/") for root in roots}, key=len, reverse=True)
    leads = "|".join(tx.quote_regex(root) for root in plain)
    key = F.regexp_replace(F.regexp_replace(path, _SCHEME, ""), f"^(?:{leads})/", "")
    meta = path_metadata(key)
    return lines.select(
        "value",
        path.alias("_file"),
        meta.getField("tenant_id").alias("tenant_id"),
        meta.getField("dataset_id").alias("dataset_id"),
    )


def read_lines(spark: SparkSession, path: str | list[str], path_metadata: bool = False, partitions: int | None = None) -> DataFrame:
    """Text lines of plain or compressed files.

    A gzip file is read by one task; ``partitions`` spreads few large ones before the work on them.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = _with_path(lines, [path] if isinstance(path, str) else path) if path_metadata else lines
    return lines.repartition(partitions) if partitions else lines


def read_events(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    path_metadata: bool = False,
    partitions: int | None = None,
    keep_raw: bool = False,
) -> DataFrame:
    """Events of newline-delimited JSON files; see :func:`decode_lines`."""
    return decode_lines(read_lines(spark, path, path_metadata, partitions), schema, keep_raw)


def read_events_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    max_files: int = 1000,
    path_metadata: bool = False,
    delete_source: bool = False,
    keep_raw: bool = False,
) -> DataFrame:
    """The same for files as they arrive, each read once."""
    reader = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
    )
    if delete_source:
        reader = reader.option("cleanSource", "delete")
    lines = reader.load(path)
    lines = _with_path(lines, [path]) if path_metadata else lines
    return decode_lines(lines, schema, keep_raw)


def promote(df: DataFrame, schema: str | T.StructType, record: str = "record") -> DataFrame:
    """Columns for the declared members of a VARIANT record; the record itself stays."""
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    member = lambda f: F.try_variant_get(tx.field(record), f"$[{json.dumps(f.name)}]", f.dataType.simpleString())
    return df.withColumns({f.name: member(f) for f in wanted.fields})


def parse_by_hint(
    lines: DataFrame,
    name_col: str = "_file",
    source_field: str = "value",
    settings: dict[str, dict] | None = None,
    formats: list[str] | None = None,
    **parse_options,
) -> DataFrame:
    """Parse every line with the parser that its file name hints at.

    The formats (all with a parser by default) are columns of one projection, so the lines are read once; lines of other
    formats are parsed as raw text.  A field that two formats give in different types is text.  ``settings`` holds parser settings by format.
    """
    named = [f for f in (formats or FORMAT_PARSERS) if f != "raw"]
    hinted = with_format_hint(lines, name_col)
    own, form = hinted.columns, F.col("format")
    made: dict[str, list[tuple[str, T.DataType]]] = {}
    out = hinted
    for i, kind in enumerate([*named, "raw"]):
        mine = form == kind if kind != "raw" else tx.is_true(~form.isin(named)) | form.isNull()
        # the text of other formats is hidden, so each parser sees its own lines alone
        hidden = out.withColumn("_hint_text", F.when(mine, tx.field(source_field)))
        parsed = parse(
            hidden.select(*[tx.field(c) for c in out.columns], "_hint_text"),
            parser_name=FORMAT_PARSERS[kind],
            source_field="_hint_text",
            target_field=f"_hint_{i}",
            settings=(settings or {}).get(kind),
            on_parse_failure="ignore",
        )
        out = parsed.drop("_hint_text")
        for f in tx.type_of(out, f"_hint_{i}").fields:
            made.setdefault(f.name, []).append((f"_hint_{i}", f.dataType))
    failed = tx.all_of([tx.field(f"_hint_{i}").isNull() for i in range(len(named) + 1)])
    columns = []
    for name, sources in made.items():
        kinds = {k.simpleString() for _, k in sources}
        value = lambda c, k: tx.field(c).getField(name) if len(kinds) == 1 else tx.text(tx.field(c).getField(name), k)  # noqa: B023, E731
        new = F.coalesce(*[value(c, k) for c, k in sources])
        if name in own:
            new = F.coalesce(new, tx.field(name)) if tx.is_string(out, name) and (len(kinds) > 1 or kinds == {"string"}) else new
        columns.append(new.alias(name))
    on_failure = parse_options.get("on_parse_failure", "tag")
    if on_failure == "skip":
        out = out.where(~failed)
    elif on_failure == "tag":
        reason = F.concat(F.lit("line does not match "), _parser_of(named), F.lit(" format"))
        earlier = tx.field("_parse_failure") if tx.is_string(hinted, "_parse_failure") else F.lit(None).cast("string")
        columns.append(F.coalesce(F.when(failed, reason), earlier).alias("_parse_failure"))
    if parse_options.get("preserve_raw"):
        columns.append(F.when(~failed, tx.field(source_field)).alias("_raw"))
    new_names = {*made, "_parse_failure", "_raw"} if on_failure == "tag" or parse_options.get("preserve_raw") else set(made)
    return out.select(*[tx.field(c) for c in own if c not in new_names], *columns)


def _parser_of(named: list[str]) -> Column:
    out = F.lit("raw")
    for form in named:
        out = F.when(F.col("format") == form, FORMAT_PARSERS[form]).otherwise(out)
    return out


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    headers: list[str] | None = None,
) -> DataFrame:
    """CSV / TSV files, each with its own header row: text columns, ``_error`` for a wrong number of fields.

    Files are read in groups of the same header, so a file with another order of columns, or with other ones, keeps
    its values under its own names.  ``headers`` names the columns of all files instead.
    """
    if headers is not None:
        return _delimited(spark, path, delimiter, headers)
    groups = _header_groups(spark, path, delimiter)
    if not groups:
        names = spark.read.csv(path, header=True, sep=delimiter, inferSchema=False).columns
        return _delimited(spark, path, delimiter, names)
    parts = [_delimited(spark, files, delimiter, list(names)) for names, files in groups]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    marks = ("_raw", "_error")
    return out.select(*[tx.field(c) for c in out.columns if c not in marks], *marks)


def _header_groups(spark: SparkSession, path: str | list[str], delimiter: str) -> list[tuple[tuple[str, ...], list[str]]]:
    """Files by the names in their first line; the first lines of all files are read by tasks."""
    lines = spark.read.text(path).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at")
    )
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        groups.setdefault(row["header"], []).append(row["file"])
    out = []
    for files in groups.values():
        out.append((tuple(spark.read.csv(files[0], header=True, sep=delimiter, quote='"', escape='"').columns), files))
    return out


def _delimited(spark: SparkSession, path: str | list[str], delimiter: str, names: list[str]) -> DataFrame:
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("_raw", T.StringType())])
    rows = spark.read.csv(
        path,
        schema=schema,
        header=True,
        sep=delimiter,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_raw",
        enforceSchema=True,
        quote='"',
        escape='"',
        multiLine=False,
        emptyValue="",
    )
    return rows.withColumn("_error", F.when(F.col("_raw").isNotNull(), F.lit("column count mismatch")))
