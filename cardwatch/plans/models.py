"""Model training variants, persistence and evaluation (MLlib pipelines).

The four variants the reference ran, with their parameters:
- ``gbt``: gradient-boosted trees, 20 iterations, depth 5, on an exactly 1:1 undersampled set;
- ``rf_balanced``: random forest, 100 trees, depth 8, undersampled and class-weighted;
- ``rf_medium``: random forest, 50 trees, depth 6, 10 % sample, class-weighted;
- ``rf_basic``: random forest, 50 trees, default depth, 30 % sample when the input is large.
Every variant splits 80/20 with a hash of the id and reports metrics in label space.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators import evaluate, features, sampling
from cardwatch.plans.gold import score_with_model
from cardwatch.schemas import CATEGORY_FEATURES, NUMERIC_FEATURES
from cardwatch.session import ensure_checkpoint_dir

SEED = 42


@dataclass(frozen=True)
class Variant:
    name: str
    learner: str  # "gbt" | "rf"
    params: dict
    prepare: str  # "balance" | "sample10" | "sample_if_large"
    weighted: bool


# Hyper-parameters and preparation of the four trained variants.
VARIANTS = {
    "gbt": Variant("gbt", "gbt", {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1}, "balance", False),
    "rf_balanced": Variant("rf_balanced", "rf", {"numTrees": 100, "maxDepth": 8}, "balance", True),
    "rf_medium": Variant("rf_medium", "rf", {"numTrees": 50, "maxDepth": 6}, "sample10", True),
    "rf_basic": Variant("rf_basic", "rf", {"numTrees": 50}, "sample_if_large", False),
}


def classifier(variant: Variant):
    common = {"labelCol": "label", "featuresCol": "features", "seed": SEED}
    if variant.weighted:
        common["weightCol"] = "class_weight"
    if variant.learner == "gbt":
        return GBTClassifier(**common, **variant.params)
    return RandomForestClassifier(**common, **variant.params)


def build_estimator(variant: Variant, null_policy: str = "skip") -> Pipeline:
    return Pipeline(stages=[features.category_indexer(), features.assembler(null_policy), classifier(variant)])


def prepare(df: DataFrame, variant: Variant) -> DataFrame:
    # the id, the label and the model's inputs; no other column travels through sampling and training
    rows = sampling.complete_rows(df).select("id", "label", *NUMERIC_FEATURES, *CATEGORY_FEATURES)
    if variant.prepare == "balance":
        rows = sampling.undersample(rows)
    elif variant.prepare == "sample10":
        rows = sampling.sample_fraction(rows, 0.1)
    else:
        rows = sampling.sample_if_large(rows, 0.3)
    if variant.weighted:
        rows = sampling.class_weights(rows)
    return rows


def train(silver: DataFrame, variant_name: str = "gbt") -> tuple[PipelineModel, DataFrame]:
    """Fit the variant on its 80 % part; return the model and the scored 20 % part.

    The prepared set (undersampled or sampled) is checkpointed to the shared folder: the fit, the
    scoring of the test part and every evaluation read it, a lost executor costs a re-read, and no
    cache is left to release.
    """
    return fit(prepared(silver, variant_name), variant_name)


def prepared(silver: DataFrame, variant_name: str) -> DataFrame:
    """The variant's training set, checkpointed."""
    ensure_checkpoint_dir(silver.sparkSession)
    return prepare(silver, VARIANTS[variant_name]).checkpoint()


def fit(data: DataFrame, variant_name: str) -> tuple[PipelineModel, DataFrame]:
    """``train`` on a prepared set."""
    variant = VARIANTS[variant_name]
    train_df, test_df = sampling.split(data, 0.8)
    model = build_estimator(variant).fit(train_df)
    scored = score_with_model(model, test_df)
    return model, scored


def mllib_auc(scored: DataFrame) -> float:
    """The binned MLlib estimate, for comparison with the exact value."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC").evaluate(
        scored.withColumn("label", F.col("label").cast("double")))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
