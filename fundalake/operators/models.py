"""Classifiers for the distress target, on pyspark.ml."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.functions.local import small
from fundalake.operators import isotonic
from fundalake.operators.features import walk_forward
from fundalake.operators.ranks import running

LABEL = "target_bankruptcy"
SEED = 42


def weighted(df: DataFrame) -> DataFrame:
    """A weight column that makes both classes count the same: n / (2 * n of the class)."""
    sizes = df.groupBy(LABEL).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("weight", F.sum("_n").over(W.partitionBy()) / (2 * F.col("_n"))).drop("_n")
    return df.join(F.broadcast(sizes), LABEL)  # a row per class


def random_forest(columns: list[str], trees: int = 300, depth: int = 10) -> Pipeline:
    return _pipeline(columns, RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", minInstancesPerNode=5, weightCol="weight", labelCol=LABEL, seed=SEED))


def boosted_trees(columns: list[str], rounds: int = 300, depth: int = 6) -> Pipeline:
    return _pipeline(columns, GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=5, weightCol="weight", labelCol=LABEL, seed=SEED))


def logistic(columns: list[str], n_rows: int, c: float = 1.0, rounds: int = 1000) -> Pipeline:
    """The inverse strength c is for a sum of losses; Spark's strength is for their mean."""
    return _pipeline(columns, LogisticRegression(regParam=1 / (c * max(1, n_rows)), elasticNetParam=0.0, maxIter=rounds, weightCol="weight", labelCol=LABEL), scale=True)


def _pipeline(columns: list[str], classifier, scale: bool = False) -> Pipeline:
    raw = "raw_features" if scale else "features"
    stages = [VectorAssembler(inputCols=columns, outputCol=raw, handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True))
    return Pipeline(stages=[*stages, classifier])


def train(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    return pipeline.fit(weighted(df))


def score(model: Transformer, df: DataFrame) -> DataFrame:
    """``df`` with a column score: the probability of the positive class."""
    # a model trained on one class has one probability
    return model.transform(df).withColumn("score", F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))).drop("rawPrediction", "probability", "prediction", "features", "raw_features")


def folds(df: DataFrame, k: int) -> DataFrame:
    """A fold for each row, by a hash of its key: the same at every run."""
    return df.withColumn("fold", F.pmod(F.xxhash64("ticker", "date"), F.lit(k)))


class Calibrated:
    """Pairs of a model and the calibrator that was fitted on its scores of rows it had not seen."""

    def __init__(self, pairs: list[tuple[PipelineModel, Transformer | isotonic.Isotonic]]) -> None:
        self.pairs = pairs

    def score(self, df: DataFrame) -> DataFrame:
        """``df``, of the training rows or of new ones, with score, the mean of the models, and calibrated, the mean of the pairs."""
        out, k = df, len(self.pairs)
        for i, (model, calibrator) in enumerate(self.pairs):
            out = score(model, out).withColumnRenamed("score", f"_s{i}")
            if isinstance(calibrator, isotonic.Isotonic):
                out = calibrator.apply(out, f"_s{i}", f"_c{i}")
            else:
                out = calibrator.transform(VectorAssembler(inputCols=[f"_s{i}"], outputCol="_v").transform(out)).drop("_v", "_raw", "_said")
                out = out.withColumn(f"_c{i}", F.coalesce(F.get(vector_to_array("_p"), F.lit(1)), F.lit(0.0))).drop("_p")
        mean = lambda name: sum((F.col(f"{name}{i}") for i in range(k)), F.lit(0.0)) / k
        return out.select(*df.columns, mean("_s").alias("score"), mean("_c").alias("calibrated"))


def calibrate(pipeline: Pipeline, df: DataFrame, method: str = "sigmoid", k: int = 3) -> Calibrated:
    """For each of ``k`` folds a model trained on the others and a calibrator fitted on its scores of the fold."""
    if method not in ("sigmoid", "isotonic"):
        raise ValueError(method)
    fit = LogisticRegression(featuresCol="_v", labelCol="_label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_said")
    dealt, pairs = folds(df, k), []
    for i in range(k):
        model = train(pipeline, dealt.filter(F.col("fold") != i))
        seen = score(model, dealt.filter(F.col("fold") == i)).select("score", F.col(LABEL).cast("double").alias("_label"))
        pairs.append((model, isotonic.fit(seen, "score", "_label") if method == "isotonic" else fit.fit(VectorAssembler(inputCols=["score"], outputCol="_v").transform(seen))))
    return Calibrated(pairs)


def _importances(model: PipelineModel) -> list[float]:
    last = model.stages[-1]
    return [float(v) for v in (last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray()))]


def importance(spark, model: PipelineModel | Calibrated, columns: list[str], n: int = 20) -> DataFrame:
    """(feature, importance): of the trees, or the size of the coefficients; of a calibrated model the mean over its folds' models."""
    each = [_importances(m) for m, _ in model.pairs] if isinstance(model, Calibrated) else [_importances(model)]
    rows = small(spark, [(c, sum(v) / len(each)) for c, v in zip(columns, zip(*each))], pa.schema({"feature": pa.string(), "importance": pa.float64()}))
    return rows.orderBy(F.col("importance").desc(), "feature").limit(n)


def roc_points(scored: DataFrame, buckets: int = 1000) -> DataFrame:
    """(threshold, tp, fp, fn, tn, precision, recall, f1) per bucket of the score: one aggregation and a window over the buckets."""
    b = scored.select(F.floor(F.col("score") * buckets).cast("long").alias("b"), F.col(LABEL).cast("long").alias("y")).groupBy("b").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    down = W.orderBy(F.col("b").desc()).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    r = b.select((F.col("b") / buckets).alias("threshold"), F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(everything).alias("p"), F.sum("neg").over(everything).alias("n"))
    r = r.withColumns({"fn": F.col("p") - F.col("tp"), "tn": F.col("n") - F.col("fp"), "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), "recall": F.try_divide(F.col("tp"), F.col("p"))})
    return r.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).drop("p", "n")


def best_threshold(scored: DataFrame) -> DataFrame:
    """The threshold with the best F1 (ties: the highest)."""
    return roc_points(scored).orderBy(F.col("f1").desc_nulls_last(), F.col("threshold").desc()).limit(1)


def metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(roc_auc, pr_auc, n, positives, accuracy, precision, recall, f1).

    The ROC area by average ranks of the scores; the area under precision and
    recall as the mean precision over the positives, at their own scores.
    """
    by_score = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum(F.col(LABEL).cast("long")).alias("pos"), F.sum((F.col("score") >= threshold).cast("long") * F.col(LABEL)).alias("tp"), F.sum((F.col("score") >= threshold).cast("long")).alias("said"))
    ranked = running(by_score, [], "score").withColumn("rank", F.col("_below") + (F.col("n") + 1) / 2).withColumnsRenamed({"_below": "_under", "_total": "_all"})
    ranked = running(ranked, [], "score", "pos")
    at = (F.col("_total") - F.col("_below")) / (F.col("_all") - F.col("_under"))  # precision from this score on
    g = ranked.agg(F.try_divide(F.sum(F.col("pos") * at), F.sum("pos")).alias("pr_auc"), F.sum("n").alias("n"), F.sum("pos").alias("positives"), F.sum(F.col("pos") * F.col("rank")).alias("r"), F.sum("tp").alias("tp"), F.sum("said").alias("said"))
    neg = F.col("n") - F.col("positives")
    auc = F.try_divide(F.col("r") - F.col("positives") * (F.col("positives") + 1) / 2, F.col("positives") * neg)
    precision, recall = F.try_divide(F.col("tp"), F.col("said")), F.try_divide(F.col("tp"), F.col("positives"))
    right = F.col("tp") + neg - (F.col("said") - F.col("tp"))
    return g.select(auc.alias("roc_auc"), "pr_auc", "n", "positives", (right / F.col("n")).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"))


def cross_validate(pipeline: Pipeline, df: DataFrame, k: int = 3) -> DataFrame:
    """Metrics of the out-of-fold scores."""
    dealt = folds(df, k)
    return metrics(reduce(DataFrame.unionByName, [score(train(pipeline, dealt.filter(F.col("fold") != i)), dealt.filter(F.col("fold") == i)) for i in range(k)]))


def validate_forward(pipeline: Pipeline, df: DataFrame, folds: int = 5, embargo_months: int = 12) -> DataFrame:
    """Metrics of each fold of ``walk_forward``, trained on what was known before it.  Folds without rows to train on are left out."""
    dealt = walk_forward(df, folds, embargo_months)
    # an inner read of a row a fold: which folds have both sides
    both = [r.fold for r in dealt.groupBy("fold").agg(F.countDistinct("side").alias("sides")).filter("sides = 2").orderBy("fold").collect()]
    side = lambda i, x: dealt.filter((F.col("fold") == i) & (F.col("side") == x)).drop("fold", "side")
    return reduce(DataFrame.unionByName, [metrics(score(train(pipeline, side(i, "train")), side(i, "test"))).withColumn("fold", F.lit(i)) for i in both])


def compare(pipelines: dict[str, Pipeline], train_side: DataFrame, test_side: DataFrame) -> DataFrame:
    """Metrics of each model on the test side, the best area first."""
    rows = [metrics(score(train(p, train_side), test_side)).withColumn("model", F.lit(name)) for name, p in pipelines.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.col("roc_auc").desc_nulls_last(), "model")


def report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(label, precision, recall, f1, support) for each class at a threshold."""
    said, label = (F.col("score") >= threshold).cast("int"), F.col(LABEL).cast("int")
    sides = F.array(*[F.struct(F.lit(c).alias("label"), (label == c).alias("is"), (said == c).alias("said")) for c in (0, 1)])
    g = scored.select(F.explode(sides).alias("s")).groupBy("s.label").agg(F.count_if("s.is").alias("support"), F.count_if("s.said").alias("_said"), F.count_if(F.col("s.is") & F.col("s.said")).alias("_right"))
    precision, recall = F.try_divide("_right", "_said"), F.try_divide("_right", "support")
    return g.select("label", precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"), "support")


@dataclass(frozen=True)
class Result:
    """A trained model with its scores of the test side, their metrics, the report by class and the best threshold."""

    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    report: DataFrame
    threshold: DataFrame


def evaluate(pipeline: Pipeline, train_side: DataFrame, test_side: DataFrame, threshold: float = 0.5) -> Result:
    model = train(pipeline, train_side)
    scored = score(model, test_side)
    return Result(model, scored, metrics(scored, threshold), report(scored, threshold), best_threshold(scored))
