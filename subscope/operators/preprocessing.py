"""From the feature matrix to labelled feature vectors."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.functions.exprs import churn_rate, churned_count, hash_below

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)
KEYS_AND_LABELS = ("user_id", "is_churned", "churn_reason")
# Known only once a subscription has ended, or derived from its end.
LEAKING = ("subscription_length_days", "days_since_subscription", "subscription_stage")
ROWS_PER_FILE = 20_000


def feature_types(df, exclude=LEAKING):
    """Numeric and categorical feature columns by schema."""
    usable = [field for field in df.schema.fields if field.name not in (*KEYS_AND_LABELS, *exclude)]
    numeric = [field.name for field in usable if isinstance(field.dataType, NUMERIC)]
    categorical = [field.name for field in usable if isinstance(field.dataType, T.StringType)]
    return numeric, categorical


def fill_missing(df, exclude=()):
    """Numbers become 0, categories 'unknown'; keys and labels stay as they are."""
    numeric, categorical = feature_types(df, exclude)
    return df.fillna(0, subset=numeric).fillna("unknown", subset=categorical)


def preprocessing(numeric, categorical):
    """Index, one-hot encode, assemble and scale. All categories are counted in a single pass."""
    indexed = [f"{name}_indexed" for name in categorical]
    encoded = [f"{name}_encoded" for name in categorical]
    stages = []
    if categorical:
        stages += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
    stages += [
        VectorAssembler(inputCols=numeric + encoded, outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
    ]
    return Pipeline(stages=stages)


def category_index(spark, fitted):
    """The fitted index of every category: most frequent first, equal counts by name."""
    indexer = next(stage for stage in fitted.stages if stage.hasParam("stringOrderType"))
    rows = [
        (column, value, float(place))
        for column, labels in zip(indexer.getInputCols(), indexer.labelsArray, strict=True)
        for place, value in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "column_name string, value string, category_index double")


def scaled_values(processed, numeric, key="user_id"):
    """Standardised numeric features as plain columns; they come first in the vector."""
    values = vector_to_array("features")
    return processed.select(key, *[F.get(values, F.lit(i)).alias(name) for i, name in enumerate(numeric)])


def labelled(processed, label="is_churned"):
    """Key, vector and 0/1 label; users without a label cannot be trained on."""
    return processed.where(F.col(label).isNotNull()).select(
        "user_id", "features", F.col(label).cast("double").alias("label")
    )


def write_training(df, path, key="user_id"):
    """Training rows as a table whose files hold about ROWS_PER_FILE rows, so that fits run in as many tasks.

    Where there are several, what they hold depends on the rows alone, and so do the bags that trees draw.
    """
    files = -(-df.count() // ROWS_PER_FILE)
    dealt = df.repartition(files, key).sortWithinPartitions(key) if files > 1 else df.hint("rebalance")
    dealt.write.parquet(path)
    return path


def train_test_split(df, fraction=0.8, seed=42, key="user_id"):
    """Split by hash of the key, the same for any partitioning of the data."""
    chosen = hash_below(key, seed, fraction)
    return df.where(chosen), df.where(~chosen)


def split_balance(df, fraction=0.8, seed=42, label="is_churned"):
    """Users and churn rate on either side of the split."""
    side = F.when(hash_below("user_id", seed, fraction), "train").otherwise("test")
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(side.alias("side"))
        .agg(
            F.count("*").alias("users"),
            churned_count(label).alias("churned_users"),
            churn_rate(label).alias("churn_rate"),
        )
        .orderBy("side")
    )


def time_windows(subs, folds=5, start="subscription_start"):
    """Assign users to ``folds + 1`` equal spans of start dates; fold i validates on span i, trains on 0..i-1."""
    days = F.datediff(F.col(start), F.lit("1970-01-01").cast("date"))
    ends = subs.agg(F.struct(F.min(days).alias("first"), F.max(days).alias("last")).alias("ends")).scalar()
    first, last = ends["first"], ends["last"]
    span = (last - first + 1).cast("double")
    number = F.floor((days - first) * (folds + 1) / span).cast("int")
    return subs.withColumn("time_window", number)


def fold_sizes(windowed, folds=5):
    """Users and churned users per fold and role, from one count per window."""
    counts = windowed.groupBy("time_window").agg(
        F.count("*").alias("users"), churned_count().alias("churned_users")
    )
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    role = F.when(F.col("time_window") < F.col("fold"), "train").otherwise("validate")
    return (
        counts.withColumn("fold", fold)
        .where(F.col("time_window") <= F.col("fold"))
        .groupBy("fold", role.alias("role"))
        .agg(F.sum("users").alias("users"), F.sum("churned_users").alias("churned_users"))
        .orderBy("fold", "role")
    )
