"""Pack, unpack, flatten, explode and re-nest structs and arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import PART, SESSION_KEY
from sessionlake.operators.skew import PART_ITEMS, counted_keys, expand_parts, with_part


def pack(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Move ``columns`` into one struct column."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.struct(*columns).alias(name))


def unpack(df: DataFrame, name: str) -> DataFrame:
    """Replace a struct column by its fields; a NULL struct gives NULL fields."""
    return df.select(*[c for c in df.columns if c != name], f"{name}.*")


def flatten(df: DataFrame, prefix: str = "", sep: str = "_") -> DataFrame:
    """Every struct leaf as a column ``prefix + path``; arrays stay arrays.

    Explode the array to be flattened first, see ``explode_hits``.
    """

    def leaves(schema: StructType, path: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, StructType):
                out += leaves(f.dataType, here)
            else:
                source = ".".join(f"`{p}`" for p in here)
                out.append(F.col(source).alias(prefix + sep.join(here)))
        return out

    return df.select(leaves(df.schema, []))


def explode_hits(
    df: DataFrame, column: str = "hits", outer: bool = True, fields: list[str] | None = None
) -> DataFrame:
    """One row per array item, the item replacing the array.

    ``outer`` keeps rows whose array is empty or NULL, as a left join of the
    array would; without it they are dropped, as by a cross join. ``fields``
    names the leaves to keep, ``page.pagePath`` as ``page_pagePath``; a scan
    then reads these only, which it cannot see behind a plain explode.
    """
    items = F.col(column)
    if fields is not None:
        items = F.arrays_zip(*[F.col(f"{column}.{f}").alias(f.replace(".", "_")) for f in fields])
    explode = F.explode_outer if outer else F.explode
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, explode(items).alias(column))


def unwrap_list(c: Column) -> Column:
    """``struct<list: array<struct<element: T>>>`` of foreign files as ``array<T>``."""
    return F.transform(c.getField("list"), lambda x: x.getField("element"))


def _ordered(c: Column, order_by: Column) -> Column:
    pairs = F.collect_list(F.struct(order_by.alias("order"), c.alias("item")))
    return F.sort_array(pairs).getField("item")


def renest(
    df: DataFrame,
    keys: list[str],
    item: Column,
    out: str,
    order_by: Column,
    spread_by: list[str],
    part_items: int = PART_ITEMS,
    hot: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Group items back into arrays, sorted by ``order_by`` and then by the item.

    One row per key and part. Keys with up to ``part_items`` items have part 0
    only. Bigger ones spread over several rows, so no task or row has to hold a
    whole hot group. The rows are shuffled as they are: collecting arrays
    before the shuffle would sort them and save nothing. They go to ``tasks``
    tasks, as many as ``counted_keys`` gives where it is asked, so that a task
    sorts its items in memory however many there are.
    """
    if hot is None:
        hot, tasks = counted_keys(df, keys, part_items)
    return (
        with_part(df, hot, keys, spread_by)
        .repartition(*([] if tasks is None else [tasks]), *keys, PART)
        .groupBy(*keys, PART)
        .agg(_ordered(item, order_by).alias(out))
    )


#: What a NULL key is taken for while rows are matched, beside a mark that it was NULL.
_FILL = {"string": "", "date": "1970-01-01", "boolean": "false"}


def _with_filled(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with keys that are never NULL, so that a plain join matches NULL with NULL."""
    for k in keys:
        kind = df.schema[k].dataType.simpleString()
        fill = F.lit(_FILL.get(kind, "1970-01-01" if kind.startswith("timestamp") else "0")).cast(kind)
        df = df.withColumns({f"_null_{k}": F.col(k).isNull(), k: F.coalesce(F.col(k), fill)})
    return df


def nest(
    roots: DataFrame,
    items: DataFrame,
    keys: list[str],
    item: Column,
    out: str,
    order_by: Column,
    spread_by: list[str],
    part_items: int = PART_ITEMS,
) -> DataFrame:
    """Attach the items of each root row to it as an array; a NULL key matches NULL.

    ``n_items`` is the number of items of the key, over all its parts. Items
    whose key no root has belong to no row; make roots for them first.

    Both sides are hashed on (keys, part), so the join reuses the shuffle of
    the grouping and a hot key is spread on both sides.
    """
    roots, items = _with_filled(roots, keys), _with_filled(items, keys)
    marks = [f"_null_{k}" for k in keys]
    all_keys = [*keys, *marks]
    hot, tasks = counted_keys(items, all_keys, part_items)
    arrays = renest(items, all_keys, item, out, order_by, spread_by, hot=hot, tasks=tasks)
    joined = expand_parts(roots, hot, all_keys).join(arrays, [*all_keys, PART], "left")
    size = F.when(F.col(out).isNull(), 0).otherwise(F.size(out))
    joined = joined.withColumn("n_items", F.coalesce("_n", size).cast("bigint"))
    restored = {k: F.when(~F.col(f"_null_{k}"), F.col(k)) for k in keys}
    return joined.withColumns(restored).drop("_n", *marks)


def rejoin(sessions: DataFrame, spread_by: list[str], part_items: int = PART_ITEMS) -> DataFrame:
    """Explode the hits, group them by session key and join them to the sessions.

    The inner-join shape: sessions whose key has no hit, or a NULL, drop out.
    Every copy of a session keeps its row; the hits of all copies are with the
    first of them (the least ``spread_by``), and the others have none, so
    nothing is doubled. ``spread_by`` identifies the row a hit came from. The
    default path of the library keeps hits in place instead and needs none of
    this.
    """
    kept = sessions.dropna(subset=SESSION_KEY)
    hits = kept.select(
        *SESSION_KEY, *spread_by, F.posexplode("hits").alias("_pos", "_hit")
    )
    hot, tasks = counted_keys(hits, SESSION_KEY, part_items)
    arrays = renest(
        hits, SESSION_KEY, F.col("_hit"), "hits",
        F.col("_hit.hitNumber"), [*spread_by, "_pos"], hot=hot, tasks=tasks,
    )
    drop = {*SESSION_KEY, *spread_by, "hits", PART}
    rest = [c for c in sessions.columns if c not in drop]
    # the least of one column needs no sort, as that of a struct does
    plain = len(spread_by) == 1 and not sessions.schema[spread_by[0]].nullable
    own = F.col(spread_by[0]) if plain else F.struct(*spread_by)
    first = kept.groupBy(*SESSION_KEY).agg(
        F.min(own).alias("_first"), F.bool_or(F.coalesce(F.size("hits") > 0, F.lit(False))).alias("_any")
    )
    roots = kept.join(first.filter("_any"), SESSION_KEY).select(*SESSION_KEY, *rest, (own == F.col("_first")).alias("_is_first"))
    with_hits = expand_parts(roots.filter("_is_first"), hot, SESSION_KEY).join(arrays, [*SESSION_KEY, PART], "inner")
    none = F.array().cast(sessions.schema["hits"].dataType)
    others = roots.filter("NOT _is_first").select(*SESSION_KEY, F.lit(0).alias(PART), *rest, none.alias("hits"))
    return with_hits.select(*SESSION_KEY, PART, *rest, "hits").unionByName(others)
