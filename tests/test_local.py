"""Rows that the driver has are a part of the plan: no Python workers are started to make them."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from fundalake.operators import models, stats


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_importance_starts_no_workers(spark):
    rows = [(float(i % 7), float(-i % 5), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v"), LogisticRegression(featuresCol="v", labelCol="y")]).fit(df)
    got = models.importance(spark, model, ["a", "b"])
    size = dict(zip(["a", "b"], abs(model.stages[-1].coefficients.toArray())))
    assert "RDD" not in _plan(got)
    assert got.dtypes == [("feature", "string"), ("importance", "double")]
    assert [tuple(r) for r in got.collect()] == sorted(size.items(), key=lambda x: (-x[1], x[0]))
    assert models.importance(spark, model, []).count() == 0


def test_pairs_of_columns_start_no_workers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, None), (3.0, 7.0, 1.0)], "x double, y double, z double").write.parquet(path)
    df = spark.read.parquet(path)
    for method, r in (("pearson", 0.993399), ("spearman", 1.0), ("kendall", 1.0)):
        got = stats.correlations(df, ["x", "y", "z"], method)
        assert "RDD" not in _plan(got)
        assert got.dtypes == [("a", "string"), ("b", "string"), ("correlation", "double")]
        values = {(a, b): v and round(v, 6) for a, b, v in got.collect()}
        assert values == {("x", "y"): r, ("x", "z"): None, ("y", "z"): None}, method
