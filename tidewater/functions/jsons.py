"""JSON columns and nested structures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_map(c: Column | str) -> Column:
    """A JSON object as a map of strings."""
    return F.from_json(c, "map<string,string>")


def contains(c: Column, wanted: dict[str, str]) -> Column:
    """Whether the object has all the given keys with the given values."""
    m = as_map(c)
    cond = F.lit(True)
    for k, v in wanted.items():
        cond = cond & F.coalesce(F.try_element_at(m, F.lit(k)) == F.lit(v), F.lit(False))
    return cond


def merged(left: Column, right: Column) -> Column:
    """Two maps as one; keys of the right one win."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def without_key(c: Column, key: str) -> Column:
    return F.map_filter(c, lambda k, _: k != key)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs become columns and arrays become rows until nothing nested is left.

    Rows with an empty array stay, with nulls.
    """
    while True:
        nested = next((f for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType))), None)
        if nested is None:
            return df
        name = nested.name
        if isinstance(nested.dataType, T.ArrayType):
            df = df.withColumn(name, F.explode_outer(name))
        else:
            parts = [F.col(f"`{name}`").getField(f.name).alias(f"{name}{sep}{f.name}") for f in nested.dataType]
            df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], *parts)
