"""JSON text as VARIANT: strict parsing, type tests and flattening to path/value pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

_END = "␞end-of-json␞"
_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"


def wrapped_json(value: Column) -> Column:
    """VARIANT ``[value, end marker]`` of a text, NULL where that is no JSON.

    ``try_parse_json`` ignores whatever follows the first value; the end marker behind the text
    makes such leftovers visible, see :func:`is_complete`.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), value, F.lit(f',"{_END}"]')))
    return F.when(~value.contains(_END), wrapped)


def is_complete(wrapped: Column) -> Column:
    """Whether the text of :func:`wrapped_json` was one whole JSON value."""
    end = F.try_variant_get(wrapped, "$[1]", "string") == _END
    return F.coalesce(end & F.try_variant_get(wrapped, "$[2]", "variant").isNull(), F.lit(False))


def strict_json(value: Column) -> Column:
    """VARIANT of a text that is one complete JSON value, else NULL."""
    return let(
        wrapped_json(value), lambda w: F.when(is_complete(w), F.try_variant_get(w, "$[0]", "variant"))
    )


def is_json(value: Column) -> Column:
    """Whether a text is valid JSON of any kind; FALSE for NULL."""
    return F.coalesce(let(wrapped_json(value), is_complete), F.lit(False))


def as_object(value: Column) -> Column:
    """``map<string,variant>`` of a variant object, NULL for anything else."""
    return F.try_variant_get(value, "$", _OBJECT)


def starts_object(value: Column) -> Column:
    """Whether a JSON text is an object, by its first character."""
    return F.ltrim(value, F.lit(" \t\r\n")).startswith("{")


def strict_object(value: Column) -> Column:
    """VARIANT of a text that is one JSON object, else NULL."""
    return F.when(starts_object(value), strict_json(value))


def json_type(value: Column) -> Column:
    """``null``, ``boolean``, ``number``, ``string``, ``array`` or ``object`` of a variant."""
    return let(
        F.schema_of_variant(value),
        lambda s: F.when(s == "VOID", "null")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "STRING", "string")
        .when(s.startswith("ARRAY"), "array")
        .when(s.startswith("OBJECT"), "object")
        .otherwise("number"),
    )


def flatten_object(root: Column, depth_bound: Column, separator: str) -> Column:
    """``map<string,variant>`` of all leaves below a ``map<string,variant>``, keyed by their path.

    Objects give ``a.b``, arrays ``a.0``; an array directly inside an array stays whole; empty
    objects and arrays vanish.  One fold per row opens the pending objects level by level, so nothing is
    exploded, shuffled or limited in depth; rounds after the last level only test an empty array.
    """

    def node(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.alias("value"), as_object(value).alias("members"))

    def opened(parent: Column) -> Column:
        """Children of an object, with its arrays already spread."""

        def child(entry: Column) -> Column:
            path = F.concat(parent["path"], entry["key"])
            items = F.transform(
                F.try_variant_get(entry["value"], "$", _ARRAY),
                lambda item, i: node(F.concat(path, F.lit(separator), i.cast("string")), item),
            )
            return F.coalesce(items, F.array(node(path, entry["value"])))

        return F.flatten(F.transform(F.map_entries(parent["members"]), child))

    def sorted_out(children: Column, done: Column | None) -> Column:
        leaves = F.transform(
            F.filter(children, lambda n: n["members"].isNull()),
            lambda n: F.struct(n["path"].alias("path"), n["value"].alias("value")),
        )
        inner = F.transform(
            F.filter(children, lambda n: n["members"].isNotNull()),
            lambda n: F.struct(F.concat(n["path"], F.lit(separator)).alias("path"), n["members"].alias("members")),
        )
        return F.struct(inner.alias("pending"), (leaves if done is None else F.concat(done, leaves)).alias("done"))

    def level(state: Column, _: Column) -> Column:
        children = F.flatten(F.transform(state["pending"], opened))
        return F.when(F.size(state["pending"]) == 0, state).otherwise(
            let(children, lambda c: sorted_out(c, state["done"]))
        )

    top = let(opened(F.struct(F.lit("").alias("path"), root.alias("members"))), lambda c: sorted_out(c, None))
    deeper = F.sequence(F.lit(1), F.greatest(depth_bound - 1, F.lit(1)))
    # Two paths can spell the same key ({"a.b":1,"a":{"b":2}}); the last one stays.
    return last_wins_map(F.aggregate(deeper, top, level)["done"], "path")


def brace_count(value: Column) -> Column:
    """Opening braces of a JSON text."""
    return F.length(value) - F.length(F.replace(value, F.lit("{")))


def nesting_depth(value: Column) -> Column:
    """Object depth of a JSON text: the most braces that are open at once, those in strings left out."""
    bare = F.regexp_replace(F.regexp_replace(value, r'"(?:[^"\\]|\\.)*+"', ""), "[^{}]+", "")
    # runs of braces are few next to braces: {{ }} counts as +2 -2
    runs = F.regexp_extract_all(bare, F.lit(r"(\{+|\}+)"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def step(state: Column, run: Column) -> Column:
        at = state["at"] + F.when(run.startswith("{"), F.length(run)).otherwise(-F.length(run))
        return F.struct(at.alias("at"), F.greatest(state["most"], at).alias("most"))

    return F.aggregate(runs, start, step)["most"]


def last_wins_map(nodes: Column, key: str, value: str = "value", first: bool = False) -> Column:
    """Map of an array of structs; of equal keys the last (or first) one stays.

    Without equal keys the array is the map already.  Otherwise sorting by (key, position) and
    comparing neighbours finds the ones that stay, in n log n for long arrays.
    """

    def entry(n: Column) -> Column:
        return F.struct(n[key].alias("key"), n[value].alias("value"))

    def unique(all_nodes: Column) -> Column:
        order = F.array_sort(F.transform(all_nodes, lambda n, i: F.struct(n[key].alias("k"), i.alias("i"))))

        def thinned(sorted_keys: Column) -> Column:
            neighbour = (lambda i: i - 1) if first else (lambda i: i + 1)
            kept = F.filter(
                sorted_keys,
                lambda s, i: ~F.coalesce(F.get(sorted_keys, neighbour(i))["k"] == s["k"], F.lit(False)),
            )
            return F.transform(kept, lambda s: entry(F.get(all_nodes, s["i"])))

        return let(order, thinned)

    def build(all_nodes: Column) -> Column:
        keys = F.transform(all_nodes, lambda n: n[key])
        distinct = F.size(F.array_distinct(keys)) == F.size(keys)
        entries = F.transform(all_nodes, entry)
        return F.map_from_entries(F.when(distinct, entries).otherwise(unique(all_nodes)))

    return let(nodes, build)
