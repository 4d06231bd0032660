"""Schema operators: normalisation by a rename map, null padding, identifier and unit clean-up, export hygiene."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import flag_text, snake_name, stringify_id


def load_schema(path: str | Path) -> dict:
    """Rename maps by entity, and identifier columns, of a TOML file ([attributes.<entity>], [identifiers] columns)."""
    with open(path, "rb") as f:
        return tomllib.load(f)


def normalize_attributes(df: DataFrame, renames: dict[str, str], identifiers: tuple[str, ...] = ()) -> DataFrame:
    """One projection: every column in snake case, then `renames` (source to target), missing targets as nulls,
    identifiers as clean texts, *_cm columns as metres (they go before a target that is there already).

    A source is looked up by its own and by its snake name. Several sources of one target are taken in the map's order,
    the first that isn't null. Unknown columns stay."""
    by_name = {**{snake_name(c): c for c in df.columns}, **{c: c for c in df.columns}}
    targets: dict[str, list[Column]] = {}
    used = set()
    for source, target in renames.items():
        own = targets.setdefault(target, [])
        if found := by_name.get(source) or by_name.get(snake_name(source)):
            own.append(F.col(f"`{found}`"))
            used.add(found)
    columns = {snake_name(c): F.col(f"`{c}`") for c in df.columns if c not in used and snake_name(c) not in {t for t, own in targets.items() if own}}
    for target, own in targets.items():
        if own:
            columns[target] = F.coalesce(*own) if len(own) > 1 else own[0]
        else:
            columns.setdefault(target, F.lit(None).cast("string"))
    for name in [c for c in columns if c.endswith("_cm") and targets.get(c) != []]:
        metres, base = columns.pop(name) / 100.0, name.removesuffix("_cm")
        columns[base] = F.coalesce(metres, columns[base].cast("double")) if base in columns else metres
    for name in identifiers:
        if name in columns:
            columns[name] = stringify_id(columns[name])
    return df.select(*[c.alias(n) for n, c in columns.items()])


def cm_to_m(cm: Column, metres: Column) -> Column:
    return F.coalesce(cm / 100.0, metres)


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def rename_and_drop(df: DataFrame, renames: dict[str, str], drop: tuple[str, ...] = ("Length", "length", "length_km")) -> DataFrame:
    return df.withColumnsRenamed(renames).drop(*drop)


def first_present(df: DataFrame, names: tuple[str, ...], target: str) -> DataFrame:
    """target: the first non-null of the columns of these names that are there (null if none is)."""
    own = [F.col(f"`{n}`") for n in names if n in df.columns]
    return df.withColumn(target, F.coalesce(*own) if own else F.lit(None).cast("string"))


def sanitized(df: DataFrame, nested: str = "drop", flags: tuple[str, ...] = (), identifiers: tuple[str, ...] = ()) -> DataFrame:
    """Scalar columns only, for export: nested ones dropped, or as JSON texts (nested='json'); NaN as null; flags and
    identifiers as clean texts."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            if nested == "json":
                out.append(F.to_json(c).alias(f.name))
            continue
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if f.name in flags:
            c = flag_text(c)
        elif f.name in identifiers or f.name.endswith("_id"):
            c = stringify_id(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def exploded(df: DataFrame, children: str, keys: tuple[str, ...]) -> DataFrame:
    """A row for each child of a nested array: keys, then the child's fields (keys win where names clash)."""
    rows = df.select(*keys, F.explode(children).alias("_child"))
    fields = [f.name for f in rows.schema["_child"].dataType.fields if f.name not in keys]
    return rows.select(*keys, *[F.col("_child")[f].alias(f) for f in fields])


def nested(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, name: str, order: str) -> DataFrame:
    """parent with name: the array of its children (structs without the key, by `order`), empty without any."""
    fields = [c for c in child.columns if c != child_key]
    own = child.groupBy(F.col(child_key).alias("_key")).agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in fields if c != order]))).alias(name))
    kind = own.schema[name].dataType.simpleString()
    return parent.join(own, parent[parent_key] == own["_key"], "left").drop("_key").withColumn(name, F.coalesce(F.col(name), F.expr(f"cast(array() as {kind})")))
