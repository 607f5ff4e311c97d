"""A model of true and false detections on coverage summaries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions.stage import stage

# The model's features, in this order.
FEATURES = [
    "weighted_breadth", "unmasked_weighted_breadth", "unique_fraction", "multi_fraction", "masked_fraction", "log_total_reads",
    "log_unique_reads", "unique_breadth_frac", "segments_detected", "best_entropy", "avg_entropy", "strain_count",
    "log_genome_len", "both_frac",
]


def ml_features(summary: DataFrame) -> DataFrame:
    """Add the features to a coverage summary (with both_frac); what is null or missing is 0."""
    for c in ("both_frac", "masked_reads", "best_entropy", "avg_entropy", "strain_count", "segments_detected"):
        if c not in summary.columns:
            summary = summary.withColumn(c, F.lit(0.0))
    total = F.when(F.col("total_reads") == 0, 1).otherwise(F.col("total_reads"))
    bases = F.col("unique_breadth_bp") + F.col("multi_breadth_bp")
    log = lambda c: F.log10(F.greatest(F.col(c).cast("double"), F.lit(1.0)))
    out = summary.withColumns({
        "unique_fraction": F.col("unique_reads") / total, "multi_fraction": F.col("multi_reads") / total, "masked_fraction": F.col("masked_reads") / total,
        "log_total_reads": log("total_reads"), "log_unique_reads": log("unique_reads"), "log_genome_len": log("avg_genome_length"),
        "unique_breadth_frac": F.col("unique_breadth_bp") / F.when(bases == 0, 1).otherwise(bases),
    })
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})


def _pipeline() -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="weight", regParam=0.01, maxIter=200),
    ])


def balanced(rows: DataFrame) -> DataFrame:
    """Add weight: n / (2 * the class's n)."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(n.values())
    return rows.withColumn("weight", F.when(F.col("label") == 1, total / (2 * max(n.get(1, 0), 1))).otherwise(total / (2 * max(n.get(0, 0), 1))))


def fit_tp_fp_model(rows: DataFrame) -> PipelineModel:
    """The model of train_tp_fp_model() alone: one fit, where held-out scores take one more for each fold."""
    return _pipeline().fit(stage(balanced(rows)))


def train_tp_fp_model(rows: DataFrame, folds: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Fit on ml_features() with a label 0 or 1; also the held-out scores of folds grouped by sample (fold, auc, precision, recall, f1)."""
    rows = balanced(rows.withColumn("fold", F.pmod(F.xxhash64("sample"), F.lit(folds))))
    rows = stage(rows)
    spark, out = rows.sparkSession, []
    for k in range(folds):
        train, test = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
        if train.select("label").distinct().count() < 2 or test.isEmpty():
            continue
        scored = _pipeline().fit(train).transform(test)
        auc = BinaryClassificationEvaluator(labelCol="label").evaluate(scored) if test.select("label").distinct().count() == 2 else None
        c = scored.agg(F.count_if(F.expr("label = 1 and prediction = 1")), F.count_if(F.expr("label = 0 and prediction = 1")), F.count_if(F.expr("label = 1 and prediction = 0"))).first()
        p, r = c[0] / max(c[0] + c[1], 1), c[0] / max(c[0] + c[2], 1)
        out.append((k, auc, p, r, 2 * p * r / (p + r) if p + r else 0.0))
    return _pipeline().fit(rows), spark.createDataFrame(out, "fold int, auc double, precision double, recall double, f1 double")


def score_tp_fp(model: PipelineModel | dict[str, float], rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add tp_probability and accepted. model: a fitted one, or weights of features as they are, with an `intercept`."""
    if isinstance(model, dict):
        unknown = set(model) - {*FEATURES, "intercept"}
        if unknown:
            raise ValueError(f"no such features: {sorted(unknown)}")
        total = F.lit(float(model.get("intercept", 0.0)))
        for name in FEATURES:
            if name in model:
                total = total + float(model[name]) * F.col(name)
        out = rows.withColumn("tp_probability", 1 / (1 + F.exp(-total)))
    else:
        out = model.transform(rows).withColumn("tp_probability", vector_to_array("probability")[1]).drop("raw_features", "scaled", "rawPrediction", "probability", "prediction")
    return out.withColumn("accepted", F.col("tp_probability") >= threshold)


def coefficients(model: PipelineModel) -> dict[str, float]:
    return dict(zip(FEATURES, model.stages[-1].coefficients.toArray().tolist(), strict=True))
