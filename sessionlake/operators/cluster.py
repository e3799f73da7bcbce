"""k-means over flat session features."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import FeatureHasher, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.contracts import FEATURES
from sessionlake.operators.nested import explode_hits, flatten
from sessionlake.session import file_a_task
from sessionlake.workspace import child_paths, scratch

HIT_FIELDS = ["dataSource", "page.pagePath", "page.hostname", "page.pageTitle"]
NUMERIC_FEATURES = ["body_visitNumber", "body_visitStartTime", "body_date", "body_totals_visits"]

#: Features that all categories are hashed to, and passes of a fit.
HASH_SIZE = 1 << 14
MAX_ITER = 20

#: Rows of a fit that one task holds; a split of a vector table has many more, since such files are small.
TASK_ROWS = 250_000


def features(
    raw: DataFrame, start: dt.date | None = None, end: dt.date | None = None, columns: list[str] = FEATURES
) -> DataFrame:
    """The flat ``body_*`` columns, one row per hit, of the days from ``start`` to ``end``.

    ``raw`` keeps its text date, and the filter works on that text, where it
    can be pushed into the scan. A zone by year and month, or by day, is also
    pruned by these.
    """
    for bound, inside in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is None:
            continue
        raw = raw.filter(inside(F.col("date"), F.lit(bound.strftime("%Y%m%d"))))
        if {"year", "month"} <= set(raw.columns):
            month = F.col("year") * 100 + F.col("month")
            raw = raw.filter(inside(month, F.lit(bound.year * 100 + bound.month)))
    hits = explode_hits(raw, fields=HIT_FIELDS)
    return flatten(hits, prefix="body_").select(*columns)


def fit_clusters(
    df: DataFrame, k: int = 4, seed: int = 1, hash_size: int = HASH_SIZE, max_iter: int = MAX_ITER
) -> PipelineModel:
    """Scaled numbers plus hashed categories into k clusters, over all rows.

    Categories are hashed to ``hash_size`` features, not indexed: an index of
    page paths or cities would have to be collected and would grow with the
    data; values that share a feature count as one. A missing number is the
    mean of the others, or 0 if there are none.

    The vectors are made once and written, as the fit passes over them ``max_iter`` times
    at most, beside a few passes for its first centres and the sizes of its clusters.
    """
    categories = [c for c in df.columns if c not in NUMERIC_FEATURES]
    filled = [f"{c}_filled" for c in NUMERIC_FEATURES]
    rows = prepare(df)
    means = rows.agg(*[F.avg(c).alias(c) for c in NUMERIC_FEATURES]).first()
    given = ", ".join(f"coalesce({c}, {means[c] or 0.0!r}D) AS {c}_filled" for c in NUMERIC_FEATURES)
    vectors = Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {given} FROM __THIS__"),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        FeatureHasher(inputCols=categories, outputCol="categories", numFeatures=hash_size),
        VectorAssembler(inputCols=["scaled", "categories"], outputCol="features"),
    ]).fit(rows)
    made, path = vectors.transform(rows).select("features"), scratch(df.sparkSession, "vectors")
    made.write.option("maxRecordsPerFile", TASK_ROWS).parquet(path)
    # a folder lists its files in any order, and the first centres depend on it
    files = sorted(f for f in child_paths(df.sparkSession, path) if f.endswith(".parquet"))
    # the solver that "auto" takes for sparse rows, without its pass that counts how sparse they are
    kmeans = KMeans(k=k, seed=seed, maxIter=max_iter, solver="row", featuresCol="features", predictionCol="cluster")
    with file_a_task(df.sparkSession):
        clusters = kmeans.fit(df.sparkSession.read.schema(made.schema).parquet(*files))
    return PipelineModel([*vectors.stages, clusters])


def prepare(df: DataFrame) -> DataFrame:
    """Numbers as doubles, categories as text with an empty NULL."""
    return df.select(
        [
            F.col(c).try_cast("double").alias(c)
            if c in NUMERIC_FEATURES
            else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
            for c in df.columns
        ]
    )


def cluster_sessions(df: DataFrame, k: int = 4, seed: int = 1) -> DataFrame:
    """The feature rows with the number of their cluster."""
    model = fit_clusters(df, k, seed)
    return model.transform(prepare(df)).select(*df.columns, "cluster")
