"""What object keys and file names say: tenant, dataset, date parts, format; and which files to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.enrich import fits_broadcast, lookup_join

# File-name hints (each names its own format) and the binary ones among them.
FORMAT_HINTS = [
    "ndjson", "csv", "tsv", "apache", "nginx", "iis", "squid", "influx", "prom", "statsd", "graphite",
    "syslog", "cef", "gelf", "leef", "log", "fix", "hl7", "raw", "sflow", "netflow", "ipfix",
]
BINARY_HINTS = ["sflow", "netflow", "ipfix"]

# Format -> parser of the parse step, for the formats that have one.
FORMAT_PARSERS = {
    "ndjson": "ndjson",
    "csv": "csv",
    "tsv": "tsv",
    "apache": "apache",
    "nginx": "nginx",
    "influx": "influx",
    "syslog": "syslog-rfc3164",
    "cef": "cef",
    "log": "plaintext",
    "raw": "raw",
}


def _part(parts: Column, at: int) -> Column:
    return F.get(parts, F.lit(at))


def path_metadata(key: Column) -> Column:
    """Struct of tenant_id, dataset_id, year, month, day, hour and filename; NULL for a malformed key."""
    parts = F.split(key, "/")
    name = F.element_at(parts, -1)
    pieces = F.split(name, "--")
    dashed = key.contains("--")
    deep = F.size(parts) >= 2

    def labelled(label: str) -> Column:
        hits = F.filter(parts, lambda p: p.startswith(label + "="))
        return F.substring(F.try_element_at(hits, F.lit(-1)), len(label) + 2, 1 << 30)

    named = F.exists(parts, lambda p: p.startswith("tenant=") | p.startswith("dataset="))
    several = F.size(pieces) >= 2
    # Directory parts win over the parts of a dashed file name.
    tenant = F.when(dashed, F.when(deep, _part(parts, 0)).when(several, _part(pieces, 0))).when(
        named, labelled("tenant")
    ).when(deep, _part(parts, 0))
    dataset = F.when(dashed, F.when(deep, _part(parts, 1)).when(several, _part(pieces, 1))).when(
        named, labelled("dataset")
    ).when(deep, _part(parts, 1))
    date_part = lambda label: F.when(~dashed & deep, labelled(label)).alias(label)
    filename = F.when(dashed, F.when(several, name)).otherwise(name)
    valid = (F.coalesce(tenant, F.lit("")) != "") & (F.coalesce(dataset, F.lit("")) != "") & (dashed | deep)
    return F.when(
        valid,
        F.struct(
            tenant.alias("tenant_id"),
            dataset.alias("dataset_id"),
            date_part("year"),
            date_part("month"),
            date_part("day"),
            date_part("hour"),
            filename.alias("filename"),
        ),
    )


def with_path_metadata(df: DataFrame, path_col: str) -> DataFrame:
    """Add the metadata columns; rows with a malformed key are rejected."""
    found = df.withColumn("_path", path_metadata(tx.field(path_col))).where(F.col("_path").isNotNull())
    names = ["tenant_id", "dataset_id", "year", "month", "day", "hour", "filename"]
    return found.withColumns({n: F.col("_path").getField(n) for n in names}).drop("_path")


def format_hint(name: Column) -> Column:
    """Struct of format, tenant_id, dataset_id, compression and binary flag of a file name.

    The hint table is a constant of two dozen words, so it is an IN list, not a join.
    """
    base = F.element_at(F.split(name, "/"), -1)
    compression = F.regexp_extract(base, r"\.(gz|bz2|xz)$", 1)
    clean = F.regexp_replace(base, r"\.(?:gz|bz2|xz)$", "")
    parts = F.split(clean, "--")
    count = F.size(parts)
    hint = F.array_join(F.slice(parts, 3, F.greatest(count - 2, F.lit(0))), "--")
    # The last extension goes, but not the dot of a name that starts with it.
    hint = F.regexp_replace(hint, r"(?s)^(.+)\.[^.]*$", "$1")
    known = F.when(hint.isin(FORMAT_HINTS), hint).otherwise("raw")
    by_extension = (
        F.when(clean.endswith(".json"), "ndjson").when(clean.endswith(".csv"), "csv").when(clean.endswith(".log"), "log")
    ).otherwise("raw")
    form = F.when(count >= 3, known).when(count == 2, "raw").otherwise(by_extension)
    return F.struct(
        form.alias("format"),
        F.when(count >= 2, _part(parts, 0)).otherwise("unknown").alias("tenant_id"),
        F.when(count >= 3, _part(parts, 1))
        .when(count == 2, _part(F.split(_part(parts, 1), r"\."), 0))
        .otherwise("unknown")
        .alias("dataset_id"),
        compression.alias("compression"),
        ((count >= 3) & known.isin(BINARY_HINTS)).alias("binary"),
    )


def with_format_hint(df: DataFrame, name_col: str) -> DataFrame:
    """Add ``format``, ``compression`` and ``binary`` columns."""
    hinted = df.withColumn("_hint", format_hint(tx.field(name_col)))
    names = ["format", "compression", "binary"]
    return hinted.withColumns({n: F.col("_hint").getField(n) for n in names}).drop("_hint")


def select_source_files(files: DataFrame, tenants: DataFrame, path_col: str = "path") -> DataFrame:
    """Files of active tenants and their allowed datasets that are not processed output.

    ``tenants`` has ``tenant_id``, ``active`` and ``dataset_id`` (NULL: all datasets of the tenant).
    """
    keyed = with_path_metadata(files, path_col).where(~F.coalesce(F.col("filename"), F.lit("")).endswith(".ndjson.gz"))
    separator = F.lit("\u0000")
    whole = F.concat("tenant_id", separator, F.coalesce("dataset_id", F.lit("")))
    allowed = tenants.where("active").select(whole.alias("_key")).distinct().withColumn("_row", F.lit(True))
    small = fits_broadcast(tenants)
    marked = lookup_join(keyed, F.concat("tenant_id", separator), allowed, small, "_every")
    marked = lookup_join(marked, F.concat("tenant_id", separator, "dataset_id"), allowed, small, "_listed")
    kept = marked.where(F.col("_every").isNotNull() | F.col("_listed").isNotNull())
    return kept.select(*[tx.field(c) for c in keyed.columns])
