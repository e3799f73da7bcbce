from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sessionlake.llm import neighbours as n
from sessionlake.llm.arrow import text_bytes
from tests.llm.conftest import SCHEMA, words


def test_scores_as_by_all_cosines():
    texts = [words(i, 60) for i in range(40)] + [words(i, 60).upper() for i in range(40)]
    counts = n.term_counts(*text_bytes(pa.array(texts)))
    labels = np.array([1.0] * 40 + [0.0] * 40)
    voters = n.fit(counts, labels)
    other = n.term_counts(*text_bytes(pa.array([words(100, 50), words(101, 50).upper()])))
    got, place = voters.scores(other), voters.place(other)
    for s, v in zip(got, place, strict=True):
        near = voters.vectors @ v
        best = np.argsort(-near)[: n.NEIGHBOURS]
        assert abs(s - (near[best] * labels[best]).sum() / near[best].sum()) < 1e-5
    assert got[0] > 0.9 and got[1] < 0.1


def test_equally_near_ones_vote_in_order():
    counts = n.term_counts(*text_bytes(pa.array([words(1, 60)] * 20 + [words(2, 60)] * 20)))
    for first in (1.0, 0.0):
        labels = np.array([first] * n.NEIGHBOURS + [1 - first] * (40 - n.NEIGHBOURS))
        voters = n.fit(counts, labels)
        assert voters.scores(n.term_counts(*text_bytes(pa.array([words(1, 60), "", None])))).tolist() == [first] * 3


def test_empty_texts_get_the_labels_of_the_smallest_ids(spark):
    docs = spark.createDataFrame([(i, words(i, 60), "en", "s", 1) for i in range(40)] + [(99, None, "en", "s", 0)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i < n.NEIGHBOURS), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rows = n.vote(docs, n.fit_on_labels(docs, labels, F.lit(True))).where("doc_id = 99").collect()
    assert [r["score"] for r in rows] == [1.0]


def test_held_out_rows_are_never_learned_from(spark):
    docs = [(i, words(i, 60) if i % 2 else words(i, 60).upper(), "en", "s", 1) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, SCHEMA)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rows = n.vote(df, n.fit_on_labels(df, labels, ~held)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)
    # other labels of held-out rows change nothing
    wrong = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    again = n.vote(df, n.fit_on_labels(df, wrong, ~held)).collect()
    assert [r["score"] for r in again] == [r["score"] for r in rows]


def test_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert n.fit_on_labels(edge, none, F.lit(True)) is None
    rows = n.vote(edge, None).collect()
    assert {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {1}
    few = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (9, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = n.vote(edge, n.fit_on_labels(edge, few, F.lit(True))).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert n.vote(empty, None).count() == 0
