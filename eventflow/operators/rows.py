"""Steps that change the number of rows: split and head sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from .effect import Effect, operator, require, unchanged


@operator("split")
def split(
    df: DataFrame,
    field: str = "message",
    terminator: str | None = None,
    target: str | None = None,
    emit: str = "rows",
) -> Effect:
    """One row per array element, or per trimmed piece of a string; at most one item leaves the row alone.

    ``emit="metadata"`` keeps the row and describes the pieces in ``_split_field``,
    ``_split_items`` and ``_split_count`` instead.
    """
    require(bool(field), "split needs 'field'")
    require(emit in ("rows", "metadata"), "emit must be 'rows' or 'metadata'")
    if not tx.has(df, field):
        return unchanged(df)
    kind = tx.type_of(df, field)
    target = target or field
    if isinstance(kind, T.ArrayType):
        items, element = tx.field(field), kind.elementType
    elif isinstance(kind, T.StringType) and terminator:
        items = F.transform(tx.split_literal(tx.field(field), terminator), tx.trim_space)
        element = kind
    else:
        return unchanged(df)
    several = F.coalesce(F.size(items) > 1, F.lit(False))
    if emit == "metadata":
        return Effect(
            df,
            sets={
                "_split_field": F.when(several, F.lit(target)),
                "_split_items": F.when(several, items),
                "_split_count": F.when(several, F.size(items)),
            },
            applied=several,
        )
    if tx.has(df, target) and tx.type_of(df, target) == element:
        unsplit = tx.field(target)
    elif target == field:
        # An array column becomes a column of its elements; a row that is not split keeps its
        # only element, an empty array gives NULL.
        unsplit = F.get(items, F.lit(0))
    else:
        unsplit = F.lit(None).cast(element)
        if tx.has(df, target):
            unsplit = tx.field(target).try_cast(element)
    return Effect(df, explode=(target, F.when(several, items).otherwise(F.array(unsplit))), applied=several)


def head_sample(df: DataFrame, order_by: str | list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in the given order, without the fields that start with ``_``."""
    require(n >= 0, "n must not be negative")
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    shown = [tx.field(c) for c in df.columns if not c.startswith("_")]
    return df.orderBy(*[tx.field(k) for k in keys]).limit(n).select(shown)
