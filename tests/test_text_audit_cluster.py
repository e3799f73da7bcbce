from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.contracts import FEATURES, RAW
from sessionlake.operators.audit import audited, peek, row_count
from sessionlake.operators.cluster import cluster_sessions, features, fit_clusters, prepare
from sessionlake.operators.conform import conform
from sessionlake.operators.text import word_count
from sessionlake.plans.batch import assign_clusters, model_sessions


def test_word_count(spark):
    df = spark.createDataFrame([("Hi  there hi",), ("",), (None,), (" there\tyou ",)], "value string")
    assert {r.word: r.n for r in word_count(df).collect()} == {"Hi": 1, "hi": 1, "there": 2, "you": 1}
    assert {r.word: r.n for r in word_count(df, lower=True).collect()} == {"hi": 2, "there": 2, "you": 1}


def test_audit_counts_while_writing(spark, tmp_path):
    df, seen = audited(spark.range(7), "step", top=F.max("id"))
    df.write.parquet(str(tmp_path / "p"))
    assert seen.get == {"rows": 7, "top": 6}
    assert row_count(spark.range(5)).collect()[0].n_rows == 5
    assert peek(spark.range(50)).count() == 10


@pytest.fixture
def raw(spark):
    rows = [
        (str(i), "20170601" if i % 2 else "20170602", {"continent": "Asia" if i < 20 else "Europe"},
         [{"type": "PAGE", "dataSource": "web", "page": {"pagePath": f"/{i % 3}"}}])
        for i in range(40)
    ]
    made = spark.createDataFrame(
        rows,
        "visitStartTime string, date string, geoNetwork struct<continent: string>, "
        "hits array<struct<type: string, dataSource: string, page: struct<pagePath: string>>>",
    )
    return conform(made, RAW)


def test_features_of_one_load_day(raw):
    df = features(raw, dt.date(2017, 6, 1), dt.date(2017, 6, 1))
    assert df.columns == FEATURES and len(FEATURES) == 14
    assert df.count() == 20
    assert features(raw).count() == 40


def test_clusters_are_reproducible_and_cover_every_row(spark, raw, tmp_path):
    rows = features(raw)
    one = cluster_sessions(rows, k=4, seed=3)
    two = cluster_sessions(rows, k=4, seed=3)
    assert one.count() == 40 and one.columns == [*FEATURES, "cluster"]
    assert one.exceptAll(two).isEmpty()
    model = model_sessions(raw, str(tmp_path / "features"), k=2)
    assigned = assign_clusters(model, spark.read.parquet(str(tmp_path / "features")))
    assert {r.cluster for r in assigned.collect()} <= {0, 1} and assigned.count() == 40


def test_rows_go_to_the_nearest_centre(spark, raw):
    """Brute force over the fitted features."""
    rows = features(raw)
    model = fit_clusters(rows, k=3, seed=5, hash_size=64)
    got = model.transform(prepare(rows)).select("features", "cluster").collect()
    centres = np.array(model.stages[-1].clusterCenters())
    for r in got:
        distance = ((centres - r.features.toArray()) ** 2).sum(axis=1)
        assert distance[r.cluster] == pytest.approx(distance.min())
    members = {}
    for r in got:
        members.setdefault(r.cluster, []).append(r.features.toArray())
    for cluster, points in members.items():
        assert np.mean(points, axis=0) == pytest.approx(centres[cluster], abs=1e-6)
