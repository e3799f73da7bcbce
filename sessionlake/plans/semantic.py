"""Named dimensions and measures over nested sessions, and the tiles that use them."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from sessionlake.contracts import GOLD, PART, SESSION_KEY
from sessionlake.functions.dates import date_group, month_number
from sessionlake.workspace import materialize


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def _views(schema: StructType, view: str, path: str, out: dict[str, dict[str, str]]) -> None:
    dims = out.setdefault(view, {})
    for f in schema.fields:
        here = f"{path}.{f.name}" if path else f.name
        if isinstance(f.dataType, ArrayType):
            _views(f.dataType.elementType, snake(f.name), here, out)
        elif isinstance(f.dataType, StructType):
            nested = snake(f.name) if not path else f"{view}_{snake(f.name)}"
            _views(f.dataType, nested, here, out)
        else:
            dims[snake(f.name)] = here


def views(contract: StructType = GOLD) -> dict[str, dict[str, str]]:
    """View → dimension → field path, read off the contract.

    The root is ``sessions``; every struct and the hits array is a view of its
    own, e.g. ``geo_network.city`` and ``hits_page.page_path``.
    """
    out: dict[str, dict[str, str]] = {}
    _views(contract, "sessions", "", out)
    return out


VIEWS = views()
PRIMARY_KEY = "fullVisitorId"


def dimension(ref: str) -> Column:
    """The column of ``view.dimension``; ``date.<timeframe>`` is the date group.

    A hit dimension is the array of that leaf over the session's hits.
    """
    view, _, name = ref.partition(".")
    if view == "date":
        return date_group(F.col("date"))[f"date_{name}"]
    return F.col(VIEWS[view][name])


def label(ref: str) -> str:
    return ref.replace(".", "_")


def is_hit_level(ref: str) -> bool:
    return ref.startswith("hits")


@dataclass(frozen=True)
class Not:
    """A filter value: all but ``value``. NULLs stay unless ``keep_null`` is off."""

    value: object
    keep_null: bool = True


def predicate(ref: str, value: object, columns: list[str]) -> Column:
    """The session filter ``ref = value``, or "is not" for ``Not(value)``.

    Year and month filters use the partition columns where the sessions have
    them, else a date range or the month number, so whole partitions drop out
    of the scan.
    """
    if ref == "date.year":
        if "year" in columns:
            return F.col("year") == value
        first, last = dt.date(value, 1, 1), dt.date(value, 12, 31)
        return F.col("date").between(F.lit(first), F.lit(last))
    if ref == "date.month_name":
        month = F.col("month") if "month" in columns else F.month("date")
        return month == month_number(value)
    return compare(dimension(ref), value)


def compare(c: Column, value: object) -> Column:
    if isinstance(value, Not):
        return ~c.eqNullSafe(value.value) if value.keep_null else c != value.value
    return c == value


def _keeps(ref: str, value: object) -> Callable[[Column], Column]:
    return lambda hit: compare(hit[label(ref)], value)


def explore(
    sessions: DataFrame,
    fields: list[str],
    filters: Mapping[str, object] | None = None,
    hidden: Mapping[str, Column] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """The named fields of the sessions, one row per hit if a field is hit-level.

    Sessions without hits stay, with NULL hit fields. Session filters run
    before the hits are exploded, hit filters inside the array. ``hidden`` adds
    further session columns. With ``distinct`` a session has each combination
    of its hit fields once; that is settled inside its row.
    """
    filters = dict(filters or {})
    hit_refs = [r for r in (*fields, *filters) if is_hit_level(r)]
    for ref in [r for r in filters if not is_hit_level(r)]:
        sessions = sessions.filter(predicate(ref, filters.pop(ref), sessions.columns))
    session_fields = [dimension(r).alias(label(r)) for r in fields if not is_hit_level(r)]
    session_fields += [c.alias(n) for n, c in (hidden or {}).items()]
    if not hit_refs:
        if PART in sessions.columns:
            sessions = sessions.filter(F.col(PART) == 0)
        return sessions.select(*session_fields).select(*[label(r) for r in fields], *(hidden or {}))
    # only the leaves in use, so the scan does not read whole hits
    leaves = {label(r): dimension(r) for r in dict.fromkeys(hit_refs)}
    zipped = F.arrays_zip(*[c.alias(n) for n, c in leaves.items()])
    # a session without hits has one of NULLs
    none = F.transform(F.array(F.lit(0)), lambda _: F.get(zipped, F.lit(-1)))
    hits = F.when(F.size(zipped) > 0, zipped).otherwise(none)
    for ref, value in filters.items():
        hits = F.filter(hits, _keeps(ref, value))
    shown = [r for r in dict.fromkeys(fields) if is_hit_level(r)]
    if distinct:
        hits = F.array_distinct(
            F.transform(hits, lambda h: F.named_struct(*[x for r in shown for x in (F.lit(label(r)), h[label(r)])]))
            if shown else F.transform(hits, lambda _: F.lit(0))
        )
    rows = sessions.select(*session_fields, F.explode(hits).alias("_hit"))
    return rows.select(
        *[F.col("_hit")[label(r)].alias(label(r)) if is_hit_level(r) else label(r) for r in fields],
        *(hidden or {}),
    )


def count(
    sessions: DataFrame,
    by: list[str],
    filters: Mapping[str, object] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """The measure ``count``: sessions, or distinct visitors once hits fan the rows out.

    ``approximate`` estimates the distinct visitors from one sketch per group,
    which saves the shuffle of all visitors.
    """
    if any(is_hit_level(r) for r in (*by, *(filters or {}))):
        rows = explore(sessions, by, filters, {"_visitor": F.col(PRIMARY_KEY)})
        distinct = F.approx_count_distinct if approximate else F.count_distinct
        measure = distinct("_visitor")
    else:
        rows = explore(sessions, by, filters)
        measure = F.count(F.lit(1))
    return rows.groupBy(*[label(r) for r in by]).agg(measure.alias("count"))


def total_sessions(
    sessions: DataFrame, by: list[str], filters: Mapping[str, object] | None = None
) -> DataFrame:
    """The measure ``sum(visits)``, each session counted once per group however many hits it has.

    Hits are made distinct inside the row of their session, so copies and
    sessions without a key count as they do without hits, and nothing is
    shuffled by session. Only sessions of several rows are grouped by key.
    """
    names = [label(r) for r in by]
    value = {"_visits": F.col("totals.visits")}
    rows = _visits(sessions, by, filters, value)
    return rows.groupBy(*names).agg(F.sum("_visits").alias("total_sessions"))


def _visits(
    sessions: DataFrame, by: list[str], filters: Mapping[str, object] | None, value: Mapping[str, Column]
) -> DataFrame:
    names = [label(r) for r in by]
    if not any(is_hit_level(r) for r in (*by, *(filters or {}))):
        return explore(sessions, by, filters, value)
    if PART not in sessions.columns:
        return explore(sessions, by, filters, value, distinct=True)
    further = sessions.filter(F.col(PART) > 0).select(*SESSION_KEY)
    if further.isEmpty():
        return explore(sessions, by, filters, value, distinct=True)
    split = materialize(further.distinct(), "split_sessions")
    whole = explore(sessions.join(split, SESSION_KEY, "left_anti"), by, filters, value, distinct=True)
    keys = {f"_{k}": F.col(k) for k in SESSION_KEY}
    parts = explore(sessions.join(split, SESSION_KEY, "left_semi"), by, filters, {**value, **keys}, distinct=True)
    once = parts.groupBy(*names, *keys).agg(F.max("_visits").alias("_visits"))
    return whole.unionByName(once.select(*names, "_visits"))


MEASURES = {"count": count, "total_sessions": total_sessions}


@dataclass(frozen=True)
class Tile:
    """A dashboard tile: the top groups of a measure, largest first."""

    by: list[str]
    limit: int
    measure: str = "count"
    filters: Mapping[str, object] = field(default_factory=dict)

    def rows(self, sessions: DataFrame) -> DataFrame:
        """At most ``limit`` groups; equal measures are ordered by dimension."""
        groups = MEASURES[self.measure](sessions, self.by, self.filters)
        order = [F.col(self.measure).desc(), *[F.col(label(r)).asc_nulls_last() for r in self.by]]
        return groups.orderBy(*order).limit(self.limit)

    def report(self, sessions: DataFrame, highlight: int | None = None) -> DataFrame:
        """The rows with row number, grand total and share of the shown total.

        The windows have no partition but see ``limit`` rows at most. With
        ``highlight`` rows above that value are marked.
        """
        rows = self.rows(sessions)
        value = F.col(self.measure)
        order = [value.desc(), *[F.col(label(r)).asc_nulls_last() for r in self.by]]
        shown = Window.partitionBy(F.lit(0))
        total = F.sum(value).over(shown)
        extra = {
            "row_number": F.row_number().over(shown.orderBy(*order)),
            "total": total,
            "share": F.round(value / total, 6),
        }
        if highlight is not None:
            extra["highlight"] = flag_above(value, highlight)
        return rows.select("*", *[c.alias(n) for n, c in extra.items()])


def flag_above(c: Column, threshold: int) -> Column:
    """True where a value is above the threshold, False where it is not or is NULL."""
    return F.coalesce(c > threshold, F.lit(False))
