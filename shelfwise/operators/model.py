"""Price model (K1-K6).

The pricing pipeline pulls the mart to the driver and fits a single-machine
boosted-tree model.  Here training and scoring stay distributed: a
VectorAssembler over the 19 features, trees grown leaf by leaf with patience
(:mod:`shelfwise.operators.boosting`), SQL aggregates for the hold-out metrics,
and saved models.  Spark's own depth-wise GBTRegressor is kept beside it, also
with patience: it fits all rounds, every prefix of the ensemble is scored on
the validation slice in one pass, and the best prefix is kept.

Splits are by a hash of ``sku_id`` (stable under any partitioning): 80% train
(of which the top eighth is the early-stopping validation slice), 20% test.
Early stopping uses that validation slice, never the test set.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import pricing
from . import boosting
from .target import with_price_target

TRAIN_FRACTION = 0.8
#: rounds at most, and rounds without a better error on the validation slice after which the rest is given up
MAX_ITER, PATIENCE = 300, 30
VALIDATION_FROM = 0.7   # hash in [0.7, 0.8) -> validation slice of train


def feature_frame(mart: DataFrame) -> DataFrame:
    """B11 + K1 input: features with NULL -> 0, plus the split hash."""
    return (mart.fillna(0, subset=config.FEATURES)
            .withColumn("_split", pricing.unit_hash(F.concat(F.lit("split:"), F.col("sku_id")))))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K2: hash split on sku_id; train keeps a validation indicator."""
    train = (df.filter(F.col("_split") < TRAIN_FRACTION)
             .withColumn("is_validation", F.col("_split") >= VALIDATION_FROM))
    test = df.filter(F.col("_split") >= TRAIN_FRACTION)
    return train, test


def assembler() -> VectorAssembler:
    """K1: the 19 features as one vector, in order."""
    return VectorAssembler(inputCols=config.FEATURES, outputCol="features", handleInvalid="keep")


@dataclass
class LeafWiseModel:
    """K1 + K3: the assembler and the fitted trees."""
    booster: boosting.Booster

    def transform(self, df: DataFrame) -> DataFrame:
        return self.booster.transform(assembler().transform(df))


def train(mart: DataFrame, params: boosting.Params = boosting.Params(rounds=MAX_ITER, patience=PATIENCE),
          label: str = "optimal_price") -> tuple[LeafWiseModel, DataFrame]:
    """Fit on the train split; return the model and the labelled test split."""
    train_df, test_df = split(feature_frame(with_price_target(mart)))
    fitted = boosting.fit(assembler().transform(train_df), "features", label, "sku_id", "is_validation", params)
    return LeafWiseModel(fitted), test_df


# --- Spark's own trees --------------------------------------------------------------
def build_pipeline(max_iter: int = MAX_ITER, max_depth: int = 6, step: float = 0.05,
                   seed: int = 42, label: str = "optimal_price") -> Pipeline:
    """K1 + K3: assembler + gradient-boosted trees (L2 loss), all rounds."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       maxDepth=max_depth, stepSize=step, maxIter=max_iter,
                       subsamplingRate=0.8, featureSubsetStrategy="0.8", lossType="squared", seed=seed)
    return Pipeline(stages=[assembler(), gbt])


def best_prefix(errors: list[float], patience: int = PATIENCE) -> int:
    """Number of rounds to keep: the first best one that ``patience`` rounds
    after it don't better (``errors[i]`` is the error after i + 1 rounds)."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1 if errors else 0


def train_depth_wise(mart: DataFrame, max_iter: int = MAX_ITER, patience: int = PATIENCE, seed: int = 42,
                     label: str = "optimal_price") -> tuple[PipelineModel, DataFrame, list[float]]:
    """Spark's GBTRegressor on the train split without its validation slice,
    cut to the best prefix; also the mean absolute error of every prefix."""
    train_df, test_df = split(feature_frame(with_price_target(mart)))
    fitted = build_pipeline(max_iter, seed=seed, label=label).fit(train_df.where(~F.col("is_validation")))
    first, gbt = fitted.stages
    errors = list(gbt.evaluateEachIteration(first.transform(train_df.where("is_validation")), "absolute"))
    return PipelineModel([first, prefix(gbt, best_prefix(errors, patience))]), test_df, errors


def prefix(gbt: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` trees."""
    java = gbt._java_obj
    make = SparkSession.active()._jvm.org.apache.spark.ml.regression.GBTRegressionModel
    cut = make(gbt.uid, java.trees()[:rounds], java.treeWeights()[:rounds])
    return gbt._copyValues(GBTRegressionModel(cut))


def regression_metrics(df: DataFrame, label: str = "optimal_price",
                       prediction: str = "prediction") -> DataFrame:
    """K4: MAE, R² (1 - SSE/SST) and MAPE% with the label floored at 0.01."""
    y, yhat = F.col(label), F.col(prediction)
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - yhat)).alias("mae"),
        F.sum((y - yhat) * (y - yhat)).alias("sse"),
        # total sum of squares, in the same pass
        (F.var_pop(y) * F.count(y)).alias("sst"),
        F.avg(F.abs((y - yhat) / F.greatest(y, F.lit(0.01)))).alias("mape_frac"))
    return stats.select(
        "n",
        F.round("mae", 6).alias("mae"),
        F.round(F.lit(1.0) - pricing.safe_ratio("sse", "sst"), 6).alias("r2"),
        F.round(F.col("mape_frac") * 100, 6).alias("mape_pct"))


def checks(fitted: LeafWiseModel, reloaded: LeafWiseModel, test: DataFrame, label: str = "optimal_price") -> DataFrame:
    """K1 + K3 + K5 as one row of facts: the feature vectors hold the columns in
    order, the reloaded model scores as the fitted one, the scores are closer to
    the label than the shelf price is and than those of the first four rounds,
    the rounds kept are the best on the validation slice, and training went on
    until patience or the rounds ran out."""
    few = LeafWiseModel(replace(fitted.booster, trees=fitted.booster.trees[:4]))
    rows = fitted.transform(test)
    for name, other in (("_again", reloaded), ("_few", few)):
        side = other.transform(test).select(F.col("sku_id").alias(f"_sku{name}"), F.col("prediction").alias(name))
        rows = rows.join(side, F.col("sku_id") == F.col(f"_sku{name}"))
    columns = F.array(*[F.col(c).cast("double") for c in config.FEATURES])
    y, b = F.col(label), fitted.booster
    error = F.avg(F.abs(y - F.col("prediction")))
    return rows.agg(
        F.bool_and(vector_to_array("features") == columns).alias("vectors_hold_columns"),
        F.bool_and(F.col("prediction") == F.col("_again")).alias("reloaded_scores_equal"),
        (error < F.avg(F.abs(y - F.col("current_price")))).alias("beats_shelf_price"),
        (error < F.avg(F.abs(y - F.col("_few")))).alias("beats_four_rounds"),
        F.lit(len(b.trees) == b.best_round and min(b.errors) == b.errors[b.best_round]).alias("best_rounds_kept"),
        F.lit(b.rounds == min(MAX_ITER, b.best_round + PATIENCE)).alias("patience_kept"))


def save(model: LeafWiseModel, path: str) -> None:
    """K5: persist the fitted model (overwrite)."""
    model.booster.save(SparkSession.active(), path)


def load(path: str) -> LeafWiseModel:
    return LeafWiseModel(boosting.Booster.load(SparkSession.active(), path))


def score(model: LeafWiseModel | PipelineModel, mart: DataFrame) -> DataFrame:
    """K6: score every mart row (no sampling, no driver round trip)."""
    return model.transform(feature_frame(mart)).drop("features", "_split")
