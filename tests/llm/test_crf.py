from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sessionlake.llm import crf
from sessionlake.llm.arrow import text_bytes
from tests.llm.conftest import SCHEMA

WORDS = {"xx": "alpha beta gamma delta omega sigma kappa".split(), "yy": "één twee drie vier vijf zès zeven".split()}


def sentence(lang, seed, n=9):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n)).capitalize() + "."


def table(spark, n=80):
    rows = [(i, "\n".join(sentence("xx" if i % 2 else "yy", 10 * i + k) for k in range(4)), "xx" if i % 2 else "yy", "s", 1) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_forward_backward_as_by_all_labelings():
    rng = np.random.default_rng(0)
    line, k = np.array([1, 4, 3, 4]), 3
    scores, moves = rng.normal(size=(line.sum(), k)), rng.normal(size=(k, k))
    got, got_moves = crf.marginals(scores, line, moves)
    want, want_moves, at = np.zeros_like(scores), np.zeros((k, k)), 0
    for n in line:
        total, own, steps = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=int(n)):
            p = np.exp(sum(scores[at + i, x] for i, x in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += p
            own[np.arange(n), path] += p
            for a, b in itertools.pairwise(path):
                steps[a, b] += p
        want[at : at + n], at = own / total, at + n
        want_moves += steps / total
    assert np.allclose(got, want) and np.allclose(got_moves, want_moves)


def test_words_and_lines():
    data, at = text_bytes(pa.array(["Ab1c é\n\nd", None, "", "x\ny z", "ab"]))
    w = crf.read_words(data, at)
    assert w.text.tolist() == [0, 0, 0, 0, 3, 3, 3, 4] and w.line.tolist() == [3, 1, 1, 2, 1]
    # equal words are the same in any text and place, whatever their case
    assert w.whole[0] == w.whole[7] and (w.affix[0] == w.affix[7]).all() and len(set(w.whole.tolist())) == 7


def test_learns_languages_and_sees_switches(spark):
    docs = table(spark)
    model = crf.fit_on_documents(docs, F.col("doc_id") < 60)
    rows = crf.identify(docs, model).collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in rows)
    mixed = f"{sentence('xx', 1)[:-1]} {sentence('yy', 2, 30)}"
    best, share, chances = model.label(*text_bytes(pa.array([mixed])))[:2] + (model.label(*text_bytes(pa.array([mixed])))[2],)
    assert model.labels[best[0]] == "yy" and 0.6 < share[0] < 0.95
    assert chances[:9].argmax(1).tolist() == [model.labels.index("xx")] * 9
    assert chances[9:].argmax(1).tolist() == [model.labels.index("yy")] * 30


def test_held_out_languages_are_never_learned_from(spark):
    docs = table(spark, 40)
    other = docs.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "zz").otherwise(F.col("lang")))
    may = F.col("doc_id") % 5 != 0
    rows = [[(r["lang_pred"], r["score"]) for r in crf.identify(d, crf.fit_on_documents(d, may)).collect()] for d in (docs, other)]
    assert rows[0] == rows[1]


def test_edges(spark, edge, edge_rows, empty):
    model = crf.fit_on_documents(edge, F.lit(True))
    rows = crf.identify(edge, model).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        und = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und" and r["score"] == 0) if und else r["lang_pred"] in ("en", "de", "fr")
    assert crf.fit_on_documents(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in crf.identify(edge, None).collect()} == {"und"}
    assert crf.identify(empty, model).count() == 0
    odd = spark.createDataFrame([(1, "12 — …", "en", "s", 1), (2, "漢", "en", "s", 1), (3, "№ ½ ²", "en", "s", 1)], SCHEMA)
    assert [r["lang_pred"] == "und" for r in sorted(crf.identify(odd, model).collect())] == [True, False, True]


def test_documents_of_one_long_line_are_learned_from(spark):
    rows = [(i, " ".join(sentence(lang, 1000 * i + k, 20) for k in range(50))[:5000], lang, "s", 1) for i in range(24) for lang in ("xx" if i % 2 else "yy",)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = crf.fit_on_documents(docs, F.col("doc_id") < 16)
    assert model is not None and model.labels == ["xx", "yy"]
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in crf.identify(docs, model).collect())


def test_lines_are_cut_at_blanks_and_nothing_is_lost(spark):
    texts = ["é " * 3000, "漢" * 3000, "short line\n" + "alpha beta " * 400 + "\n\nend", "x" * 1990 + " " + "y" * 700]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", crf._lines(F.col("text")).alias("lines"))
    for text, lines in df.collect():
        assert max(len(x.encode()) for x in lines) <= crf.FIT_BYTES
        assert "".join("".join(lines).split()) == "".join(text.split())
    assert set(df.collect()[0]["lines"][0].split()) == {"é"} and "short line" in df.collect()[2]["lines"]


def test_a_document_of_many_lines_does_not_take_the_sample(spark, monkeypatch):
    rows = [(1, "\n".join(f"{sentence('xx', k)} {k}" for k in range(4000)), "xx", "s", 1)]
    rows += [(10 + i, "\n".join(sentence("yy", 10 * i + k) for k in range(10)), "yy", "s", 1) for i in range(40)]
    monkeypatch.setattr(crf, "FIT_LINES", 200)
    drawn = []
    monkeypatch.setattr(crf, "fit", drawn.extend)
    crf.fit_on_documents(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    langs = [lang for _, lang in drawn]
    assert len(langs) == 200 and 0 < langs.count("xx") < 30
