"""Training, explaining, storing and applying the churn models."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope import settings as S
from subscope.operators.evaluation import classification_metrics
from subscope.operators.preprocessing import fill_missing, feature_types, labelled, preprocessing
from subscope.operators.scoring import risk_tier


class ForestModel(RandomForestClassificationModel):
    """A forest whose trees are wrapped for Python when they are asked for.

    The base class wraps each tree as soon as it lists its parameters, about 75 calls to the JVM a tree. Forests that
    grow at the same time wait for one another there, since one Python thread calls at a time.
    """

    @property
    def trees(self):
        return [DecisionTreeClassificationModel(tree) for tree in self._call_java("trees")]


class Forest(RandomForestClassifier):
    def _create_model(self, java_model):
        return ForestModel(java_model)


def train_random_forest(train, **settings):
    """A forest. Rows remember their nodes while it grows; otherwise every job would ship and walk the trees so far."""
    columns = {"featuresCol": "features", "labelCol": "label", "cacheNodeIds": True}
    return Forest(**columns, **(S.FOREST | settings)).fit(train)


def train_gbt(train, **settings):
    return GBTClassifier(featuresCol="features", labelCol="label", **(S.BOOSTING | settings)).fit(train)


def train_logistic(train, **settings):
    return LogisticRegression(featuresCol="features", labelCol="label", **(S.LOGISTIC | settings)).fit(train)


def predictions(model, data):
    """Key, label, hard prediction and churn probability."""
    return model.transform(data).select(
        "user_id", "label", "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("churn_probability")
    )


def evaluate_models(scored_by_model):
    """One row of metrics per model; each is one pass over that model's predictions."""
    rows = [
        classification_metrics(scored, "churn_probability", "prediction", "label").select(
            F.lit(name).alias("model_name"), "*"
        )
        for name, scored in scored_by_model.items()
    ]
    return reduce(lambda left, right: left.unionByName(right), rows)


def evaluator_metrics(transformed):
    """The same metrics from Spark ML's evaluators; the areas use the raw score of every row."""
    areas = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    cells = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    return {
        "roc_auc": areas.setMetricName("areaUnderROC").evaluate(transformed),
        "pr_auc": areas.setMetricName("areaUnderPR").evaluate(transformed),
        "accuracy": cells.setMetricName("accuracy").evaluate(transformed),
        "precision": cells.setMetricName("weightedPrecision").evaluate(transformed),
        "recall": cells.setMetricName("weightedRecall").evaluate(transformed),
    }


def tuning_improvement(tuned_scores, baseline_scores):
    """Tuned metrics and their change against the baseline in percent."""
    both = evaluate_models({"tuned": tuned_scores, "baseline": baseline_scores})

    def of(model, name):
        return F.max(F.when(F.col("model_name") == model, F.col(name)))

    def change(name):
        gain = of("tuned", name) - of("baseline", name)
        return F.round(F.try_divide(gain, of("baseline", name)) * 100, 2)

    return both.agg(
        of("tuned", "roc_auc").alias("roc_auc"),
        of("tuned", "pr_auc").alias("pr_auc"),
        of("tuned", "accuracy").alias("accuracy"),
        change("roc_auc").alias("roc_auc_improvement_pct"),
        change("pr_auc").alias("pr_auc_improvement_pct"),
    )


def feature_importance(spark, model, processed):
    """Importance per source column, highest first: the slots of a one-hot column are summed under its name."""
    attributes = processed.schema["features_raw"].metadata["ml_attr"]["attrs"]
    encoded = [name for name in processed.columns if name.endswith("_encoded")]
    totals = {}
    for attribute in (entry for group in attributes.values() for entry in group):
        source = next((name for name in encoded if attribute["name"].startswith(f"{name}_")), attribute["name"])
        source = source.removesuffix("_encoded")
        totals[source] = totals.get(source, 0.0) + float(model.featureImportances[attribute["idx"]])
    rows = list(totals.items())
    return spark.createDataFrame(rows, "feature_name string, importance double").orderBy(
        F.desc("importance"), "feature_name"
    )


def importance_share(importance, top=15):
    """Rounded scores and shares of all features' total, the first ``top``; one row per feature, so the window is small."""
    total = F.sum("importance").over(W.partitionBy())
    return (
        importance.select(
            "feature_name",
            F.round("importance", 4).alias("importance_score"),
            F.round(F.col("importance") * 100 / total, 2).alias("importance_percentage"),
        )
        .orderBy(F.desc("importance_score"), "feature_name")
        .limit(top)
    )


def full_model(fitted_preprocessing, classifier):
    """Preprocessing and classifier as one model, so that stored models can score raw feature rows."""
    return PipelineModel(stages=[*fitted_preprocessing.stages, classifier])


def save_model(model, path):
    model.write().overwrite().save(path)
    return path


def load_model(path):
    return PipelineModel.load(path)


def score_users(model, matrix, version=S.MODEL_VERSION):
    """Scores, tier and provenance for every feature row; works on static and streaming input."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return (
        model.transform(fill_missing(matrix))
        .select("user_id", "prediction", probability.alias("churn_probability"))
        .withColumns({
            "churn_risk": risk_tier(F.col("prediction"), F.col("churn_probability")),
            "prediction_timestamp": F.current_timestamp(),
            "model_version": F.lit(version),
        })
    )


def time_series_auc(windowed, folds=5, train_model=train_random_forest, **settings):
    """ROC-AUC per expanding fold: preprocessing and model see the windows before the validated one only."""
    filled = fill_missing(windowed)
    numeric, categorical = feature_types(filled)
    numeric = [name for name in numeric if name != "time_window"]
    rows = []
    for fold in range(1, folds + 1):
        past = filled.where(F.col("time_window") < fold)
        fitted = preprocessing(numeric, categorical).fit(past)
        model = train_model(labelled(fitted.transform(past)), **settings)
        now = labelled(fitted.transform(filled.where(F.col("time_window") == fold)))
        metrics = classification_metrics(predictions(model, now), "churn_probability", "prediction", "label")
        rows.append(metrics.select(F.lit(fold).alias("fold"), "roc_auc", "pr_auc"))
    return reduce(lambda left, right: left.unionByName(right), rows)
