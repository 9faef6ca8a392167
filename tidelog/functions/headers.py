"""Record headers, metadata maps and metric dimensions.

A header list is ``array<struct<key:string, value:binary|string>>``; metadata is
``map<string,string>``. Everything here is built-in higher-order functions and does not
depend on ``spark.sql.mapKeyDedupPolicy``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "cast(map() as map<string,string>)"
# Fixed value: the header that never becomes a metric dimension.
TRACE_HEADER = "traceparent"


def last_wins(keys: Column, values: Column) -> Column:
    """Two arrays as a map; of equal keys the last value stays.

    Without equal keys, the usual case, the arrays are the map. With them the pairs are
    sorted by key and place, and of each run of a key the last is taken.
    """
    placed = F.transform(F.arrays_zip(keys.alias("key"), values.alias("value")), lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value")))
    # In an array of its own the sorted list is a variable, made once.
    last = F.transform(
        F.array(F.array_sort(placed)),
        lambda s: F.filter(s, lambda e, i: (i == F.size(s) - 1) | (F.get(s, i + 1)["key"] != e["key"])),
    )[0]
    alone = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(alone, F.map_from_arrays(keys, values)).otherwise(F.map_from_arrays(last["key"], last["value"]))


def merge_maps(*maps: Column) -> Column:
    """Union of maps; on an equal key the later map wins. Null maps count as empty."""

    def two(early: Column, late: Column) -> Column:
        return F.map_concat(F.map_filter(early, lambda k, _v: ~F.map_contains_key(late, k)), late)

    return reduce(two, [F.coalesce(m, F.expr(EMPTY)) for m in maps])


def headers_to_map(headers: Column) -> Column:
    """Header list to map; of equal keys the last one wins."""
    return F.coalesce(last_wins(headers["key"], headers["value"].cast("array<string>")), F.expr(EMPTY))


def map_to_headers(metadata: Column) -> Column:
    """Metadata map to header list, in key order, values as bytes."""
    return F.transform(
        F.array_sort(F.map_entries(F.coalesce(metadata, F.expr(EMPTY)))),
        lambda e: F.struct(
            e["key"].alias("key"), e["value"].cast("binary").alias("value")
        ),
    )


def enrich(metadata: Column, key: Column, value: Column) -> Column:
    """Metadata with one entry added or replaced."""
    return merge_maps(metadata, F.create_map(key, value))


def header_dimensions(metadata: Column) -> Column:
    """Headers as metric dimensions: all of them but the trace header."""
    return F.map_filter(metadata, lambda k, _v: k != F.lit(TRACE_HEADER))


def record_dimensions(
    fixed: Column, metadata: Column, topic_attributes: Column, namespace: str
) -> Column:
    """All dimensions of a record metric; later sources override earlier ones."""
    parts = [fixed, header_dimensions(metadata), topic_attributes]
    if namespace:
        parts.append(F.create_map(F.lit("namespace"), F.lit(namespace)))
    return merge_maps(*parts)


def topic_attributes(many: Column | None, single: Column | None) -> Column:
    """One attribute map from the list form and the deprecated single form.

    ``many`` is a map, ``single`` a ``struct<key,value>``. With both given the single
    pair comes last and so overrides. An empty pair (key and value empty, or null) given
    alone is dropped.
    """
    if many is None and single is None:
        return F.expr(EMPTY)
    if single is None:
        return F.coalesce(many, F.expr(EMPTY))
    pair = F.create_map(
        F.coalesce(single["key"], F.lit("")), F.coalesce(single["value"], F.lit(""))
    )
    if many is not None:
        return merge_maps(many, pair)
    empty = (F.coalesce(single["key"], F.lit("")) == "") & (
        F.coalesce(single["value"], F.lit("")) == ""
    )
    return F.when(empty, F.expr(EMPTY)).otherwise(pair)
