"""Row and column policies: what a principal may see, as predicates and projections below everything else.

Grants are rows of a table, so they are kept like other data. The grants of one
principal become literal predicates on the scan, which prunes partitions and
row groups by them; where there are more than ``MAX_VALUES`` for a column, they
become a semi join, which Spark prunes by at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: Values of a column that become literals of a predicate.
MAX_VALUES = 1000

#: The grant of every value.
ALL = "*"

ROW_GRANTS = "principal string, path string, value string"
COLUMN_GRANTS = "principal string, path string"


def _has(path: str, allowed: set[str]) -> bool:
    """Whether a path or one that it is part of is allowed."""
    parts = path.split(".")
    return any(".".join(parts[:k]) in allowed for k in range(1, len(parts) + 1))


def _shown(c: Column, kind: DataType, path: str, allowed: set[str]) -> Column | None:
    """The column with the leaves that are allowed, None if none of them is."""
    if _has(path, allowed):
        return c
    if not any(a.startswith(f"{path}.") for a in allowed):
        return None
    if isinstance(kind, StructType):
        made = {f.name: _shown(c[f.name], f.dataType, f"{path}.{f.name}", allowed) for f in kind.fields}
        held = [x.alias(n) for n, x in made.items() if x is not None]
        return F.when(c.isNotNull(), F.struct(*held)) if held else None
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        if _shown(F.lit(None).cast(inner), inner, path, allowed) is None:
            return None
        return F.transform(c, lambda x: _shown(x, inner, path, allowed))
    return None


@dataclass(frozen=True)
class Policies:
    """Row grants (principal, path, value) for the ``guarded`` paths, and column grants (principal, path).

    A principal sees a row if it has a grant for the row's value, or for every
    value, of each guarded path; a NULL is seen with a grant for every value
    only. It sees the leaves it has grants for, and those below. Without grants
    it sees nothing: no rows, and no columns.
    """

    rows: DataFrame
    columns: DataFrame
    guarded: tuple[str, ...]
    max_values: int = MAX_VALUES

    def _values(self, principal: str, path: str) -> DataFrame:
        return self.rows.where((F.col("principal") == principal) & (F.col("path") == path)).select("value").where("value IS NOT NULL").distinct()

    def filtered(self, df: DataFrame, principal: str) -> DataFrame:
        """The rows that the principal may see, with all columns."""
        for path in self.guarded:
            granted = self._values(principal, path)
            held = [r["value"] for r in granted.limit(self.max_values + 1).collect()]
            c = F.col(path)
            kind = df.select(c.alias("v")).schema["v"].dataType
            if ALL in held or (len(held) > self.max_values and not granted.where(F.col("value") == ALL).isEmpty()):
                continue
            if len(held) <= self.max_values:
                df = df.where(c.isin(*[F.lit(v).try_cast(kind) for v in held]) if held else F.lit(False))
            else:
                wanted = granted.select(F.col("value").try_cast(kind).alias("_granted"))
                df = df.join(wanted, c == F.col("_granted"), "left_semi")
        return df

    def allowed(self, principal: str) -> set[str]:
        """Paths of the columns that the principal may see; as many as the table has at most."""
        found = self.columns.where(F.col("principal") == principal).select("path").distinct()
        return {r["path"] for r in found.collect()}

    def view(self, df: DataFrame, principal: str) -> DataFrame:
        """What the principal may see. Filters that follow go below the policy's only if both are on the scan's columns."""
        allowed = self.allowed(principal)
        out = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            shown = c if ALL in allowed else _shown(c, f.dataType, f.name, allowed)
            if shown is not None:
                out.append(shown.alias(f.name))
        return self.filtered(df, principal).select(*out)
