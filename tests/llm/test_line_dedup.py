from __future__ import annotations

import random

from sessionlake.llm import line_dedup as ld
from tests.llm.conftest import SCHEMA, words


def near(a, b):
    """Whether one edit or none makes ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + 1 :] == b[p:] if len(a) > len(b) else a[p:] == b[p + 1 :]


def by_hand(docs):
    spots = []
    for i, t, *_ in docs:
        spots += [(i, k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")]
    first = {}
    for n, (_, _, x) in enumerate(sorted(spots, key=lambda s: (s[0], s[1]))):
        first.setdefault(x, n)
    gone_near = {x for x, n in first.items() if len(x) >= ld.MIN_CHARS and any(
        m < n and len(y) >= ld.MIN_CHARS and near(x, y) for y, m in first.items())}
    out, seen = {}, set()
    for i, t, *_ in sorted(docs, key=lambda r: r[0]):
        kept, copies, nears = [], 0, 0
        for x in (t or "").split("\n"):
            blank = not x.strip(" \t\n\r\x0b\x0c")
            if not blank and x in gone_near:
                nears += 1
            elif not blank and x in seen:
                copies += 1
            else:
                kept.append(x)
                seen.add(x)
        out[i] = (copies, nears, "\n".join(kept) if t is not None else None)
    return out


def test_against_all_pairs(spark):
    rng = random.Random(2)
    base = [words(i, 1 + i % 30).replace("\n", " ") for i in range(30)] + ["short", "shor", "x" * 19, "x" * 20, "x" * 21, "x" * 22]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 9)):
            x = rng.choice(base)
            p = rng.randrange(len(x) + 1)
            kind = rng.randrange(6)
            x = {0: x[:p] + "Q" + x[p:], 1: x[:p] + x[p + 1 :], 2: x[:p] + "é" + x[p + 1 :], 3: x[:p] + "Z" + x[p + 2 :]}.get(kind, x)
            lines.append(x)
            lines += ["", "  "][: rng.randrange(3)]
        docs.append((i, "\n".join(lines), "en", "s", 1))
    rows = ld.remove_lines(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r["doc_id"]: (r["n_copies"], r["n_near"], r["text"]) for r in rows} == by_hand(docs)
    assert sum(r["n_near"] for r in rows) > 20


def test_long_lines_and_a_line_everyone_has(spark):
    line = "a line that every document of this table begins with"
    long = words(3, 2000).replace("\n", " ")
    docs = [(i, f"{line}\n{words(i, 10)}", "en", "s", 1) for i in range(200)]
    docs += [(900, long, "en", "s", 1), (901, long[:3000] + "#" + long[3000:], "en", "s", 1), (902, long[:9] + "##" + long[9:], "en", "s", 1)]
    rows = {r["doc_id"]: r for r in ld.remove_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert sum(r["n_copies"] for r in rows.values()) == 199 and line in rows[0]["text"]
    assert rows[901]["n_near"] == 1 and rows[901]["text"] == "" and rows[902]["n_near"] == 0


def test_edges(edge, edge_rows, empty):
    rows = ld.remove_lines(edge).collect()
    assert len(rows) == len(edge_rows)
    text = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    # rows that repeat are treated alike; of equal texts the first document keeps its lines
    assert text[5] == edge_rows[4][1] and text[6] == "" and text[1] is None and text[3] == " \n\t \n"
    left = ld.without_copies(edge)
    # the copies go; of the long text nothing repeats; the row without doc_id comes last
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "10", "None"])
    assert ld.remove_lines(empty).count() == 0 and ld.without_copies(empty).count() == 0


def test_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(i, words(i, 20), "en", "s", 1) for i in range(20)], SCHEMA)
    plan = ld.remove_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
