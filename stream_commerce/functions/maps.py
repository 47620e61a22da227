"""JSON objects held as maps.

`map<string,variant>` keeps each value's JSON type, so numbers and nested objects come back out of
`to_json` the way they went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VARIANT_MAP = "map<string,variant>"
_ENTRIES = "array<struct<key:string,value:variant>>"

def merge_maps(*maps: Column) -> Column:
    """Union of the maps; a key in a later map replaces the value of the same key of an earlier one,
    and of a key that one map repeats the last value counts.

    The same under any `spark.sql.mapKeyDedupPolicy`: keys in the order in which they first come, each with
    the value that comes last. Maps are merged two by two by looking keys up; only where a map repeats a
    key are all entries gone through for each key.
    """
    held = [F.coalesce(m, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))) for m in maps]
    repeats = F.lit(False)
    for m in held:
        repeats = repeats | (F.size(F.array_distinct(F.map_keys(m))) < F.size(m))
    merged = held[0]
    for later in held[1:]:
        merged = _over(merged, later)
    return F.when(repeats, _by_entries(held)).otherwise(merged)


def _over(early: Column, later: Column) -> Column:
    """Two maps without repeated keys."""
    kept = F.transform_values(early, lambda k, v: F.when(F.map_contains_key(later, k), later[k]).otherwise(v))
    return F.map_concat(kept, F.map_filter(later, lambda k, _: ~F.map_contains_key(early, k)))


def _by_entries(maps: list[Column]) -> Column:
    entries = F.flatten(F.array(*[F.map_entries(m).cast(_ENTRIES) for m in maps]))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])
    return F.map_from_arrays(keys, values)


def with_json(df: DataFrame, entries: str, name: str) -> DataFrame:
    """Add the JSON text of a variant map; keys whose value is null are left out.

    The text is made first and only made again without nulls where it may contain one.
    """
    present = F.map_filter(entries, lambda _, v: v.isNotNull() & ~F.is_variant_null(v))
    text = df.withColumn(name, F.to_json(entries))
    may_hold_null = F.contains(F.col(name), F.lit(":null"))
    return text.withColumn(name, F.when(may_hold_null, F.to_json(present)).otherwise(F.col(name)))
