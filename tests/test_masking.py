from __future__ import annotations

import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from sessionlake.operators import masking as m

KEY = b"a key of the tests"


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def card(rng, size=16):
    start = "".join(rng.choice("0123456789") for _ in range(size - 1))
    return next(start + d for d in "0123456789" if luhn(start + d))


def iban(country, rest):
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{country}{98 - number % 97:02}{rest}"


@pytest.mark.parametrize("key", [KEY, b"k" * 64, b"long" * 40])
def test_pseudonyms_are_hmacs(spark, key):
    texts = ["", "user-1", "é漢", None]
    want = [None if t is None else hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in texts]
    assert values(spark, texts, lambda c: m.hmac(c, key)) == want


def test_checksums(spark):
    rng = random.Random(1)
    cards = [card(rng, n) for n in range(13, 20)]
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in cards]
    assert values(spark, cards + wrong, m.luhn) == [True] * 7 + [False] * 7
    ibans = [iban("DE", "370400440532013000"), iban("GB", "WEST12345698765432"), iban("NO", "86011117947")]
    assert values(spark, [*ibans, *(i[:-1] + ("1" if i[-1] != "1" else "2") for i in ibans)], m.iban_valid) == [True] * 3 + [False] * 3


def test_what_is_found_in_text(spark):
    rng = random.Random(2)
    c = card(rng)
    grouped, hyphens = " ".join(c[i : i + 4] for i in range(0, 16, 4)), "-".join(c[i : i + 4] for i in range(0, 16, 4))
    amex = card(rng, 15)
    i = iban("DE", "370400440532013000")
    spaced = " ".join(i[k : k + 4] for k in range(0, len(i), 4))
    texts = [
        f"pay {c}.", f"pay {grouped} 12", f"{hyphens},{c}", f"x{c}", f"{c}9", f"{amex[:4]} {amex[4:10]} {amex[10:]}!",
        f"to {i} or {spaced}.", f"to {i[:-1]}9{i[-1]}", "mail a.b+c@d-e.example, or @x.y", "", None,
    ]
    cards = [[c], [grouped], [hyphens, c], [], [], [f"{amex[:4]} {amex[4:10]} {amex[10:]}"], [], [], [], [], None]
    assert values(spark, texts, lambda t: m.find(t, "card")) == cards
    assert values(spark, texts[6:8], lambda t: m.find(t, "iban")) == [[i, spaced], []]
    assert values(spark, texts[8:], lambda t: m.find(t, "email")) == [["a.b+c@d-e.example"], [], None]
    assert values(spark, texts, m.scrub) == [
        "pay [card].", "pay [card] 12", "[card],[card]", f"x{c}", f"{c}9", "[card]!", "to [iban] or [iban].",
        f"to {i[:-1]}9{i[-1]}", "mail [email], or @x.y", "", None,
    ]
    # a piece that is part of a longer number goes only where it stands alone
    assert values(spark, [f"{c} {c}7"], m.scrub) == [f"[card] {c}7"]


NESTED = "id string, n long, s struct<a:string,b:struct<c:string,d:int>>, xs array<struct<u:string,v:array<string>>>, tags map<string,string>"


@pytest.fixture
def nested(spark):
    rows = [
        ("u1", 1, ("a1", ("c1", 1)), [("x", ["p", None]), (None, [])], {"k": "t1"}),
        (None, None, None, None, None), ("u3", 3, (None, None), [], {}), ("u4", 4, ("a4", (None, 4)), [None], {"k": None}),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_rules_reach_into_structs_arrays_and_maps(nested):
    rules = {"id": m.Pseudonym(KEY), "s.b.c": m.Remove(), "s.b.d": m.Remove(), "xs.u": m.Keep(0), "xs.v": m.Keep(0, "?"), "tags.*": m.Keep(1)}
    got = m.mask(nested, rules)
    assert got.columns == nested.columns and [f.dataType for f in got.schema] == [f.dataType for f in nested.schema]
    rows = got.collect()
    assert len(rows[0]["id"]) == 32 and rows[1]["id"] is None and rows[1]["s"] is None and rows[1]["xs"] is None
    assert rows[0]["s"].asDict(True) == {"a": "a1", "b": {"c": None, "d": None}}
    assert [x and x.asDict() for x in rows[0]["xs"]] == [{"u": "*", "v": ["?", None]}, {"u": None, "v": []}]
    assert rows[3]["xs"] == [None] and rows[2]["s"]["b"] is None and rows[0]["tags"] == {"k": "t*"} and rows[3]["tags"] == {"k": None}


def test_the_rule_for_all_other_text(nested):
    got = m.mask(nested, {"*": m.Pseudonym(KEY), "s.a": m.Keep(9)})
    raw = {r["value"] for r in m.leaves(nested).collect()}
    left = [(r["path"], r["value"]) for r in m.leaves(got).collect() if r["value"] in raw]
    assert sorted(left) == [("s.a", "a1"), ("s.a", "a4"), ("tags.keys", "k"), ("tags.keys", "k")]
    assert got.select("n").collect() == nested.select("n").collect()


def test_a_path_that_is_not_there_is_an_error(nested):
    with pytest.raises(ValueError, match="s.b.z, tegs"):
        m.mask(nested, {"s.b.z": m.Remove(), "tegs": m.Remove(), "id": m.Remove()})


def test_leaves_of_every_kind(nested):
    got = sorted((r["path"], r["value"]) for r in m.leaves(nested).collect())
    assert got == sorted([
        ("id", "u1"), ("id", "u3"), ("id", "u4"), ("s.a", "a1"), ("s.a", "a4"), ("s.b.c", "c1"), ("tags.*", "t1"),
        ("tags.keys", "k"), ("tags.keys", "k"), ("xs.u", "x"), ("xs.v", "p"),
    ])


def test_masked_columns_that_nobody_selects_are_not_read(spark, nested, tmp_path):
    nested.write.parquet(str(tmp_path / "t"))
    masked = m.mask(spark.read.parquet(str(tmp_path / "t")), {"s.a": m.Pseudonym(KEY), "xs.v": m.Remove()})
    plan = masked.select("s.b.d")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:struct<b:struct<d:int>>>" in plan.replace("a:string,", "")
    assert "Python" not in plan and "Exchange" not in plan


def test_masked_keys_join(spark):
    a = spark.createDataFrame([(f"user-{i % 7}", i) for i in range(50)], "visitor string, v int")
    b = spark.createDataFrame([(f"user-{i}", i) for i in range(5)], "id string, w int")
    x, y = m.mask(a, {"visitor": m.Pseudonym(KEY, "person")}), m.mask(b, {"id": m.Pseudonym(KEY, "person")})
    assert x.join(y, x["visitor"] == y["id"]).count() == a.join(b, a["visitor"] == b["id"]).count()
    other = m.mask(b, {"id": m.Pseudonym(b"another key", "person")})
    assert x.join(other, x["visitor"] == other["id"]).count() == 0
