from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sessionlake.operators.cluster import NUMERIC_FEATURES, fit_clusters, prepare
from sessionlake.plans.catalog import clustering
from sessionlake.session import file_a_task

COLUMNS = ", ".join(f"{c} string" for c in [*NUMERIC_FEATURES, "kind", "path"])


def feature_rows(n: int) -> list[tuple]:
    return [(str(i % 3), str(i * i), str(i % 11), None if i % 13 == 0 else "1", f"k{i % 5}", f"/{i % 17}") for i in range(n)]


def test_a_fit_reads_its_rows_three_times(spark):
    """For means, deviations and vectors, however often the vectors are passed over."""
    read, n = spark.sparkContext.accumulator(0), 300

    def seen(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(feature_rows(n), 2).map(seen), COLUMNS)
    model = fit_clusters(df, k=3, hash_size=64, max_iter=5)
    assert read.value == 3 * n
    assert sum(model.stages[-1].summary.clusterSizes) == n


@pytest.mark.parametrize("hash_size", [4, 64])  # rows of few features become dense vectors
def test_rows_of_other_clusters_are_not_nearest(spark, hash_size):
    df = spark.createDataFrame(feature_rows(200), COLUMNS)
    model = fit_clusters(df, k=4, hash_size=hash_size)
    placed = model.transform(prepare(df))
    centres = np.array(model.stages[-1].clusterCenters())
    for shift in range(4):
        moved = placed.withColumn("cluster", (F.col("cluster") + shift) % 4)
        got = moved.select("features", "cluster", clustering.is_nearest(model).alias("is")).collect()
        assert {type(r.features).__name__ for r in got} == {"DenseVector" if hash_size == 4 else "SparseVector"}
        for r in got:
            squares = ((centres - r.features.toArray()) ** 2).sum(axis=1)
            assert r["is"] == (squares[r.cluster] <= squares.min() + 1e-6)


class Fitted:
    """Two centres as the last stage of a model."""

    def clusterCenters(self):
        return [np.zeros(5000), np.full(5000, 0.5)]


def test_nearest_of_zero_and_dense_rows(spark):
    zero, ones = Vectors.sparse(5000, {}), Vectors.dense([1.0] * 5000)
    half = Vectors.sparse(5000, {4999: 1.0})
    rows = spark.createDataFrame([(zero, 0), (zero, 1), (ones, 0), (ones, 1), (half, 0), (half, 1)], ["features", "cluster"])
    model = type("Model", (), {"stages": [Fitted()]})
    got = rows.withColumn("cluster", F.col("cluster").cast("int")).select(clustering.is_nearest(model).alias("is")).collect()
    assert [r["is"] for r in got] == [True, False, False, True, True, False]


def test_every_small_file_has_a_task(spark, tmp_path):
    key = "spark.sql.files.openCostInBytes"
    before, path = spark.conf.get(key), str(tmp_path / "p")
    spark.range(900).coalesce(1).write.option("maxRecordsPerFile", 30).parquet(path)
    with file_a_task(spark):
        rows = spark.read.parquet(path).rdd.mapPartitions(lambda found: [sum(1 for _ in found)]).collect()
    assert rows == [30] * 30 and spark.conf.get(key) == before
