"""Open key sets (requirements, resources) flattened into `<key><suffix>` columns.

With a key list that names the types the flattening is a projection of map
lookups: no shuffle.  Without one, the keys and their types are found by one
aggregate over the maps as VARIANT objects: a key is numeric (double) if every value it has
is a number, else its values stay text, so no value is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys become columns of a plan; more of them than this is an error, not a table.
MAX_KEYS = 10_000


# A name in the text of a schema (in back quotes if it is no plain word) with its type, or a closing bracket.
_FIELD = re.compile(r"(?:`((?:[^`]|``)*)`|(\w+)): (OBJECT<|\w+)|>")


def discover_keys_of(maps: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """For each (name, DataFrame with one map column): its keys with their types,
    'double' or 'string', in name order; one aggregate for all of them.

    Every map becomes a VARIANT object whose values say only what they are (true for a
    number or NULL, else empty text), and `schema_of_variant_agg` merges the objects'
    schemas: no entry is exploded, and a task holds key names, never values.
    """
    parts = None
    for name, df in maps.items():
        kinds = F.transform_values(df.columns[0], lambda k, v: F.when(
            v.isNull() | v.try_cast("double").isNotNull(), F.lit(True).cast("variant")).otherwise(F.lit("").cast("variant")))
        part = df.select(F.to_variant_object(F.create_map(F.lit(name), kinds)).alias("v"))
        parts = part if parts is None else parts.unionAll(part)
    out: dict[str, dict[str, str]] = {name: {} for name in maps}
    inside = None
    for quoted, plain, kind in _FIELD.findall(parts.agg(F.schema_of_variant_agg("v")).first()[0] or ""):
        name = quoted.replace("``", "`") or plain
        if kind == "OBJECT<":
            inside = out[name]
        elif kind and inside is not None:
            inside[name] = "double" if kind == "BOOLEAN" else "string"
        elif not kind:
            inside = None
    if sum(map(len, out.values())) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} different keys in {', '.join(maps)}")
    return {name: dict(sorted(keys.items())) for name, keys in out.items()}


def discover_keys(df: DataFrame, map_col: str) -> dict[str, str]:
    return discover_keys_of({map_col: df.select(map_col)})[map_col]


def flatten_map(df: DataFrame, map_col: str, suffix: str,
                keys: Mapping[str, str] | Iterable[str] | None = None,
                drop: Iterable[str] = ()) -> DataFrame:
    """Replace `map_col` by one column per key.

    `keys`: a mapping of key to 'double' or 'string'; a plain list takes the
    keys' types from the data; None takes keys and types from the data.
    """
    if not isinstance(keys, Mapping):
        found = discover_keys(df, map_col)
        keys = found if keys is None else {k: found.get(k, "double") for k in keys}
    drop = set(drop)
    cols = {f"{k}{suffix}": (F.col(map_col)[k].try_cast("double") if kind == "double" else F.col(map_col)[k])
            for k, kind in keys.items() if k not in drop}
    return df.withColumns(cols).drop(map_col) if cols else df.drop(map_col)
