"""Model metrics as DataFrame jobs over scored, labelled users.

Input: one row per user with a score in [0, 1] and a boolean or 0/1 label. Rows are counted per distinct score
first, and ranks come from ``ranking.running_totals``, so no segment is ordered in one task.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions import ranking
from subscope.functions.exprs import lower_band

SCORE_BUCKETS = 65536


def _score_counts(scored, score, label, by=(), **sums):
    """Rows, positives and further sums per distinct score, with the totals below each score."""
    known = scored.where(F.col(label).isNotNull())
    hist = ranking.histogram(known, score, by, pos=F.col(label).cast("int").cast("long"), **sums)
    return ranking.running_totals(hist, score, by, ["n", "pos"], SCORE_BUCKETS)


def _area_columns():
    """ROC and PR areas as aggregates over distinct scores; NULL where one class is missing.

    ROC-AUC is the rank sum with average ranks for ties. PR-AUC joins the points of all distinct thresholds
    by straight lines, starting at recall 0 with the precision of the highest threshold.
    """
    n, pos = F.col("n"), F.col("pos")
    everyone, positives = F.col("n_total"), F.col("pos_total")
    negatives_below = F.col("n_before") - F.col("pos_before")
    pairs_won = pos * (negatives_below + (n - pos) / 2)
    flagged = everyone - F.col("n_before")
    hits = positives - F.col("pos_before")
    precision = hits / flagged
    precision_above = F.coalesce(F.try_divide(hits - pos, flagged - n), precision)
    area = pos * (precision + precision_above) / 2
    two_classes = (F.max(positives) > 0) & (F.max(positives) < F.max(everyone))
    pairs = F.max(positives).cast("double") * F.max(everyone - positives)
    return [
        F.when(two_classes, F.try_divide(F.sum(pairs_won), pairs)).alias("roc_auc"),
        F.when(two_classes, F.try_divide(F.sum(area), F.max(positives))).alias("pr_auc"),
    ]


def segment_auc(scored, score, label, by=()):
    """Users, positives, ROC-AUC and PR-AUC per segment."""
    counts = _score_counts(scored, score, label, by)
    return counts.groupBy(*by).agg(
        F.max("n_total").alias("n"), F.max("pos_total").alias("positives"), *_area_columns()
    )


def classification_metrics(scored, score, prediction, label):
    """The five metrics of the model comparison in one row: two areas, accuracy, weighted precision and recall."""
    real, said = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = _score_counts(scored, score, label, said=said, both=real * said)
    cells = counts.agg(
        *_area_columns(),
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.sum("said").alias("said"),
        F.sum("both").alias("tp"),
    )
    n, pos, flagged, tp = (F.col(name) for name in ("n", "pos", "said", "tp"))
    tn = n - pos - flagged + tp

    def share(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    accuracy = share(tp + tn, n)
    precision = share(pos * share(tp, flagged) + (n - pos) * share(tn, n - flagged), n)
    return cells.select(
        "roc_auc",
        "pr_auc",
        accuracy.alias("accuracy"),
        precision.alias("precision"),
        accuracy.alias("recall"),
    )


def ranking_metrics(scored, score, label, precision_at=0.1, recall_at=0.2, threshold=0.5):
    """Precision among the top scores, recall among the flagged scores, false-positive rate at a threshold.

    The cut keeps ceil(fraction x users). Users tied at the cut share the remaining places evenly, so the
    result does not depend on an order among equal scores and nobody has to be sorted.
    """
    counts = _score_counts(scored, score, label)
    ahead = F.col("n_total") - F.col("n_before") - F.col("n")

    def hits(fraction):
        places = F.ceil(F.col("n_total") * F.lit(fraction))
        taken = F.greatest(F.lit(0), F.least(F.col("n"), places - ahead))
        return F.sum(F.col("pos") * taken / F.col("n"))

    negatives = F.col("n") - F.col("pos")
    alarms = F.sum(F.when(F.col(score) >= threshold, negatives).otherwise(0))
    return counts.agg(
        F.max("n_total").alias("users"),
        F.try_divide(hits(precision_at), F.max(F.ceil(F.col("n_total") * F.lit(precision_at)))).alias(
            "precision_at_top"
        ),
        F.try_divide(hits(recall_at), F.max("pos_total")).alias("recall_at_flagged"),
        F.try_divide(alarms.cast("double"), F.sum(negatives)).alias("false_positive_rate"),
    )


def calibration(scored, score, label, bins=10):
    """Per probability bin: users, mean score, observed rate; the Brier score over all users on every row."""
    real = F.col(label).cast("double")
    grouped = (
        scored.where(F.col(label).isNotNull())
        .groupBy(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.round(F.avg(score), 6).alias("mean_score"),
            F.round(F.avg(real), 6).alias("observed_rate"),
            F.sum(F.pow(F.col(score) - real, 2)).alias("squared"),
        )
    )
    brier = grouped.agg(F.sum("squared") / F.sum("n")).scalar()
    return grouped.withColumn("brier_score", F.round(brier, 6)).drop("squared").orderBy("bin")


def risk_bands(scored, score="churn_probability"):
    """Users per traffic-light band."""
    return (
        scored.groupBy(lower_band(F.col(score), S.RISK_BANDS).alias("band"))
        .agg(F.count("*").alias("user_count"), F.round(F.avg(score), 4).alias("avg_probability"))
        .orderBy("band")
    )


def compare_models(results):
    """Rounded metrics with the best areas marked; one row per model, so the window is a handful of rows."""
    whole = W.partitionBy()

    def best(name, text):
        return F.when(F.col(name) == F.max(name).over(whole), text).otherwise("")

    return (
        results.withColumns({
            "best_roc_auc": best("roc_auc", "Best ROC-AUC"),
            "best_pr_auc": best("pr_auc", "Best PR-AUC"),
        })
        .withColumns({
            name: F.round(name, 4) for name in ("roc_auc", "pr_auc", "accuracy", "precision", "recall")
        })
        .orderBy(F.desc("roc_auc"), "model_name")
    )
