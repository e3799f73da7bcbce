"""Personal data: rules through structs and arrays, keyed pseudonyms, and detection by checksums.

Everything is a column expression, so masking costs no shuffle and a masked
column that nobody selects is not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

#: No ASCII letter, digit or underscore before a piece, and none after it.
_BEFORE, _AFTER = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"

#: A card number: 13 to 19 digits, or groups of four, or of four, six and five, with a blank or hyphen between.
CARD = "(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"

#: An IBAN: country, check digits and 11 to 30 letters or digits, as one or in groups of four.
IBAN = "(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"

Rule = Callable[[Column, DataType], Column]


def hmac(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 of a text or binary column, as hex digits."""
    block = (key if len(key) <= 64 else sha256(key).digest()).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in block)) for x in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


@dataclass(frozen=True)
class Pseudonym:
    """A keyed pseudonym of a value's text: equal values stay equal, so masked keys still join.

    Values of one ``domain`` get equal pseudonyms whatever their column is.
    Without the key they can be neither found nor checked. NULL stays NULL.
    """

    key: bytes
    domain: str = ""
    digits: int = 32

    def __call__(self, c: Column, kind: DataType) -> Column:
        return F.substring(hmac(F.concat(F.lit(f"{self.domain}:"), c.cast("string")), self.key), 1, self.digits)


@dataclass(frozen=True)
class Remove:
    """NULL in place of any value, of the column's own type."""

    def __call__(self, c: Column, kind: DataType) -> Column:
        return F.lit(None).cast(kind)


@dataclass(frozen=True)
class Keep:
    """The first characters of a text, such as the area of a postcode."""

    first: int
    rest: str = "*"

    def __call__(self, c: Column, kind: DataType) -> Column:
        return F.concat(F.substring(c, 1, self.first), F.when(F.length(c) > self.first, self.rest).otherwise(""))


@dataclass(frozen=True)
class Scrub:
    """A text without the personal data that ``find`` detects in it: each piece gives way to its kind's name."""

    kinds: tuple[str, ...] = ("card", "iban", "email")

    def __call__(self, c: Column, kind: DataType) -> Column:
        return scrub(c, self.kinds)


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the checksum of card numbers."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))

    def value(d: Column, i: Column) -> Column:
        twice = 2 * d
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def iban_valid(text: Column) -> Column:
    """Whether a text of capital letters and digits passes the checksum of IBANs, 1 modulo 97."""
    turned = F.split(F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4)), "")
    point = F.transform(turned, lambda c: F.ascii(c))
    number = F.transform(point, lambda p: F.when(p >= 65, p - 55).otherwise(p - 48))
    return F.aggregate(number, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97) == 1


#: How each kind is found: its pattern, and what a match is checked by after its blanks and hyphens are gone.
_KINDS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "card": (CARD, luhn),
    "iban": (IBAN, iban_valid),
    "email": (EMAIL, lambda _: F.lit(True)),
}


def find(c: Column, kind: str) -> Column:
    """The pieces of a text that are personal data of a kind, in order; NULL for NULL.

    Numbers that only look like cards or IBANs fail their checksum and are left.
    """
    pattern, check = _KINDS[kind]
    found = F.regexp_extract_all(c, F.lit(f"{_BEFORE}({pattern}){_AFTER}"), 1)
    return F.filter(found, lambda x: check(F.regexp_replace(x, "[ -]", "")))


def _without(kind: str) -> Callable[[Column, Column], Column]:
    """Replaces a piece where it stands alone."""

    def replaced(text: Column, piece: Column) -> Column:
        quoted = F.concat(F.lit(_BEFORE + r"\Q"), piece, F.lit(r"\E" + _AFTER))
        return F.regexp_replace(text, quoted, F.lit(f"[{kind}]"))

    return replaced


def scrub(c: Column, kinds: tuple[str, ...] = ("card", "iban", "email")) -> Column:
    """The text with each piece that ``find`` finds replaced by its kind in brackets."""
    out = c
    for kind in kinds:
        pieces = F.array_distinct(find(out, kind))
        out = F.when(F.size(pieces) > 0, F.aggregate(pieces, out, _without(kind))).otherwise(out)
    return out


def _masked(c: Column, kind: DataType, path: str, rules: Mapping[str, Rule], used: set[str]) -> Column | None:
    """The column under the rules, or None if none of them concerns it."""
    if isinstance(kind, ArrayType):
        return _lifted(c, kind.elementType, path, rules, used)
    if path in rules:
        used.add(path)
        return rules[path](c, kind)
    if isinstance(kind, StructType):
        fields = {f.name: _masked(c[f.name], f.dataType, f"{path}.{f.name}", rules, used) for f in kind.fields}
        made = {n: x for n, x in fields.items() if x is not None}
        if not made:
            return None
        whole = F.struct(*[(made.get(f.name) if f.name in made else c[f.name]).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), whole)
    if isinstance(kind, MapType):
        probe = _masked(F.lit(None).cast(kind.valueType), kind.valueType, f"{path}.*", rules, used)
        if probe is None:
            return None
        return F.transform_values(c, lambda _, v: _masked(v, kind.valueType, f"{path}.*", rules, used))
    if "*" in rules and isinstance(kind, StringType):
        return rules["*"](c, kind)
    return None


def _lifted(c: Column, kind: DataType, path: str, rules: Mapping[str, Rule], used: set[str]) -> Column | None:
    """An array with its elements masked."""
    if _masked(F.lit(None).cast(kind), kind, path, rules, used) is None:
        return None
    return F.transform(c, lambda x: _masked(x, kind, path, rules, used))


def mask(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """``df`` under rules by path: ``device.browser``, ``hits.page.pagePath`` (inside arrays), ``tags.*`` (values of a map).

    A rule on an array is for each of its elements. The rule ``"*"`` applies to every text that no other rule reaches. Names are
    case-sensitive; a path that the table does not have is an error, so that a
    misspelt rule does not leave data bare. NULL structs and arrays stay NULL.
    """
    used: set[str] = set()
    out = {}
    for f in df.schema.fields:
        made = _masked(F.col(f"`{f.name}`"), f.dataType, f.name, rules, used)
        if made is not None:
            out[f.name] = made
    missing = sorted(set(rules) - used - {"*"})
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in df.columns])


def leaves(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """(path, value): every text in every row, from structs, arrays and maps alike; NULL is left out.

    With ``paths`` only the texts there, and no other column is read.
    """

    def texts(c: Column, kind: DataType, path: str) -> list[tuple[str, Column]]:
        """Paths with an array of the texts there."""
        if isinstance(kind, StringType):
            return [(path, F.array(c))]
        if isinstance(kind, StructType):
            return [x for f in kind.fields for x in texts(c[f.name], f.dataType, f"{path}.{f.name}")]
        if isinstance(kind, MapType):
            return [*texts(F.map_keys(c), ArrayType(kind.keyType), f"{path}.keys"), *texts(F.map_values(c), ArrayType(kind.valueType), f"{path}.*")]
        if isinstance(kind, ArrayType):
            inner = texts(F.lit(None).cast(kind.elementType), kind.elementType, path)
            return [(p, F.flatten(F.transform(c, inside(kind.elementType, path, k)))) for k, (p, _) in enumerate(inner)]
        return []

    def inside(kind: DataType, path: str, k: int) -> Callable[[Column], Column]:
        """The texts of the k-th path in an element."""
        return lambda x: texts(x, kind, path)[k][1]

    found = [x for f in df.schema.fields for x in texts(F.col(f"`{f.name}`"), f.dataType, f.name) if paths is None or x[0] in paths]
    if not found:
        return df.sparkSession.createDataFrame([], "path string, value string")
    each = F.array(*[F.struct(F.lit(p).alias("path"), c.alias("values")) for p, c in found])
    rows = df.select(F.explode(each).alias("x")).select("x.path", F.explode("x.values").alias("value"))
    return rows.where("value IS NOT NULL")
