"""Every operator as a query over the given tables.

Doubles whose last digits depend on the order of summation are rounded here, not in the library.
"""

from pyspark.sql import functions as F

from checks.oracle import snapshot_name
from checks.oracle_inputs import SNAPSHOT_DAY
from subscope import settings as S
from subscope.functions.exprs import age_days, upper_band
from subscope.operators import (
    classifiers,
    daily_refresh,
    dashboards,
    distinct_state,
    distributions,
    evaluation,
    features,
    journeys,
    kpis,
    point_in_time,
    preprocessing,
    profiles,
    scoring,
    seasonality,
    tuning,
    validation,
)
from subscope.plans import ingestion, medallion
from subscope.session import model_root, settled, shared_dir
from subscope.sources import driver_tables as D
from subscope.sources import layers, pageview_files
from subscope.streaming import activity, alerts

BASE_URL = "https://example.org/pageviews"
CUTOFF = "2024-01-16"
HOLIDAYS = ["2024-01-01", "2024-01-15"]

METRICS = ("roc_auc", "pr_auc", "accuracy", "precision", "recall")

_written = {}


def _once(spark, sf_dir, name, build):
    """Build a written input or a fitted model once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def _behavior(spark, sf_dir):
    return D.behavior(spark, sf_dir)


def _engagement(spark, sf_dir):
    return features.engagement_features(D.behavior(spark, sf_dir))


def _lifecycle(spark, sf_dir):
    return features.subscription_lifecycle(D.subscriptions(spark, sf_dir))


def _matrix(spark, sf_dir):
    return features.feature_matrix(D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir))


def _scores(spark, sf_dir):
    return D.scores(D.subscriptions(spark, sf_dir))


def _labelled_scores(spark, sf_dir):
    subs = D.subscriptions(spark, sf_dir).select("user_id", "is_churned")
    return _scores(spark, sf_dir).join(subs, "user_id")


def _on(operator, *inputs):
    """A query that applies an operator to mapped inputs."""
    return lambda spark, sf_dir: operator(*[read(spark, sf_dir) for read in inputs])


def _rounded(query, digits, *columns):
    return lambda spark, sf_dir: query(spark, sf_dir).withColumns({c: F.round(c, digits) for c in columns})


# Ingestion


def _line_files(spark, sf_dir):
    def build():
        path = shared_dir(spark, "lines")
        pageview_files.write_pageview_lines(D.pageviews(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "lines", build)


def _manifest_file(spark, sf_dir):
    def build():
        path = shared_dir(spark, "manifest")
        pageview_files.write_file_manifest(D.manifest(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "manifest", build)


def _lines(spark, sf_dir):
    return pageview_files.parse_pageview_lines(spark, _line_files(spark, sf_dir))


def _manifest(spark, sf_dir):
    return pageview_files.read_file_manifest(spark, _manifest_file(spark, sf_dir), BASE_URL)


def _ingested(spark, sf_dir):
    """The bronze table of the sampled files, written, compacted and read back."""
    base = shared_dir(spark, "bronze")
    written = ingestion.ingest_pageviews(
        spark,
        _manifest_file(spark, sf_dir),
        _line_files(spark, sf_dir),
        f"{base}/written",
        BASE_URL,
        "{folder}/source_file={name}",
    )
    compacted = layers.read_layer(spark, ingestion.compact(spark, written, f"{base}/compacted"))
    return compacted.drop("source_file", "ingestion_timestamp")


def _parsed(spark, sf_dir):
    return _lines(spark, sf_dir).drop("source_file", "ingestion_timestamp")


def _enriched(spark, sf_dir):
    joined = pageview_files.enrich_pageviews(_lines(spark, sf_dir), _manifest(spark, sf_dir))
    return joined.drop("source_file", "ingestion_timestamp")


def _behavior_layer(spark, sf_dir):
    def build():
        dated = D.behavior(spark, sf_dir).withColumn("event_date", F.to_date("timestamp"))
        return layers.write_layer(dated, shared_dir(spark, "behavior"), ["event_date"])

    return _once(spark, sf_dir, "behavior", build)


def _write_layer(spark, sf_dir):
    written = layers.read_layer(spark, _behavior_layer(spark, sf_dir))
    return written.groupBy("event_date").agg(F.count("*").alias("row_count")).orderBy("event_date")


def _read_layer(spark, sf_dir):
    return layers.read_layer(spark, _behavior_layer(spark, sf_dir))


def _clustered(spark, sf_dir):
    path = shared_dir(spark, "clustered")
    columns = ["project", "access_method", "view_count"]
    return spark.read.parquet(layers.clustered_rewrite(D.pageviews(spark, sf_dir), path, columns))


def _table_stats(spark, sf_dir):
    path = shared_dir(spark, "subscriptions")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    layers.write_layer(D.subscriptions(spark, sf_dir), path, table=table)
    return layers.collect_table_stats(spark, table, ["plan_type"]).select(
        F.lit("subscriptions").alias("table_name"), "row_count"
    )


# Distinct counts from daily states


def _user_state(spark, sf_dir):
    """Bitmaps of users per day, written in two runs of which the second replaces a day of the first."""
    path = shared_dir(spark, "user-bitmaps")
    keyed = D.behavior(spark, sf_dir).withColumn("key", F.col("user_id").cast("long"))
    early = keyed.where(F.to_date("timestamp") <= CUTOFF)
    late = keyed.where(F.to_date("timestamp") >= CUTOFF)
    for part in (early, late):
        distinct_state.write_days(distinct_state.daily_bitmaps(part, "key"), path)
    return spark.read.parquet(path)


def _title_state(spark, sf_dir):
    """Bitmaps of page titles per day; titles of later days get keys behind those of the first."""
    views = D.pageviews(spark, sf_dir)
    first = settled(distinct_state.add_keys(views.where(F.to_date("file_timestamp") < CUTOFF), "page_title"), "keys")
    keys = settled(distinct_state.add_keys(views, "page_title", first), "keys")
    keyed = views.join(keys, "page_title", "left")
    return distinct_state.daily_bitmaps(keyed, "key", "file_timestamp")


def _sketch_errors(spark, sf_dir):
    """Per period: whether the estimates of titles and files lie within four standard errors of the exact counts."""
    views, columns = D.pageviews(spark, sf_dir), ["page_title", "source_file"]
    state = distinct_state.daily_sketches(views, columns, "file_timestamp")
    exact = [
        views.groupBy(distinct_state._start(period, "file_timestamp").alias("period_start"))
        .agg(*[F.countDistinct(c).alias(f"exact_{c}") for c in columns])
        .select(F.lit(period).alias("period"), "*")
        for period in distinct_state.PERIODS
    ]
    exact = exact[0].unionByName(exact[1]).unionByName(exact[2]).unionByName(exact[3])
    found = distinct_state.estimates_by_period(state, columns).alias("s").join(
        exact.alias("e"), (F.col("s.period") == F.col("e.period")) & F.col("s.period_start").eqNullSafe(F.col("e.period_start"))
    )
    bound = 4 * 0.83 / 2 ** (distinct_state.LOG_SIZE / 2)
    within = [
        (F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.greatest(F.lit(1.0), bound * F.col(f"exact_{c}"))).alias(f"{c}_within") for c in columns
    ]
    return found.select("s.period", "s.period_start", "s.rows", *within)


# Profiles and features


def _null_profile(spark, sf_dir):
    return profiles.null_profile(
        D.pageviews(spark, sf_dir), ["project", "page_title", "view_count", "access_method"]
    )


def _validation(spark, sf_dir):
    return validation.bronze_validation(
        D.pageviews(spark, sf_dir), D.behavior(spark, sf_dir, ["event_id"]), D.subscriptions(spark, sf_dir)
    )


def _calendar(spark, sf_dir):
    days = spark.createDataFrame([(day,) for day in HOLIDAYS], "date string")
    holidays = days.select(F.to_date("date").alias("date"))
    actions = D.behavior(spark, sf_dir).groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("actions")
    )
    return seasonality.calendar_features(actions, holidays)


def _refreshed_matrix(spark, sf_dir):
    """The matrix after a first load and three daily refreshes, the last of which is repeated."""
    base, behavior = shared_dir(spark, "refresh"), D.behavior(spark, sf_dir)
    for day in ("2024-01-28", "2024-01-29", "2024-01-30", S.AS_OF, S.AS_OF):
        daily_refresh.refresh(behavior, base, day)
    return daily_refresh.refreshed_matrix(spark, base, D.subscriptions(spark, sf_dir), S.AS_OF)


def _cutoff(spark, sf_dir):
    return features.cutoff_features(D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir), CUTOFF)


def _cutoffs(spark, sf_dir):
    """Three cutoffs: the given one, a week before it, and the last day."""
    days = spark.createDataFrame([("2024-01-09",), (CUTOFF,), (S.AS_OF,)], "cutoff string")
    cutoffs = days.select(F.to_date("cutoff").alias("cutoff"))
    return point_in_time.features_at_cutoffs(D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir), cutoffs)


def _last_use(spark, sf_dir):
    return point_in_time.preceding_action(D.behavior(spark, sf_dir), "support_ticket", "feature_use")


def _stratified(spark, sf_dir):
    subs = D.subscriptions(spark, sf_dir).select("user_id", "plan_type", "is_churned")
    return features.stratified_sample(subs, "is_churned", {True: 1.0, False: 0.25})


def _segment_auc(spark, sf_dir):
    """Segments by age stage, plan and region, as one long table."""
    subs = D.subscriptions(spark, sf_dir)
    region = dashboards.modal_value(D.behavior(spark, sf_dir), "location")
    people = subs.select(
        "user_id", "is_churned", "plan_type", upper_band(age_days(S.AS_OF), S.MATRIX_STAGES).alias("stage")
    ).join(region, "user_id", "left")
    scored = _scores(spark, sf_dir).select("user_id", "churn_probability").join(people, "user_id")
    long = scored.unpivot(
        ["churn_probability", "is_churned"], ["plan_type", "stage", "location"], "segment_type", "segment"
    )
    return evaluation.segment_auc(
        long.where(F.col("segment").isNotNull()), "churn_probability", "is_churned", ["segment_type", "segment"]
    )


def _new_high_risk(spark, sf_dir):
    """The previous snapshot scores everyone 20 points lower."""
    now = _scores(spark, sf_dir)
    lower = F.col("churn_probability") - 0.2
    before = now.withColumn("churn_risk", scoring.risk_tier(F.when(lower >= 0.5, 1.0).otherwise(0.0), lower))
    return scoring.new_high_risk(before, now).select("user_id", "churn_probability", "churn_risk")


# Models


def _silver(spark, sf_dir):
    """The matrix as a written table: training reads it many times and must not recompute it."""

    def build():
        return layers.write_layer(_matrix(spark, sf_dir), shared_dir(spark, "silver"), ["subscription_stage"])

    return spark.read.parquet(_once(spark, sf_dir, "silver", build))


def _filled(spark, sf_dir):
    return preprocessing.fill_missing(_silver(spark, sf_dir))


def _fitted(spark, sf_dir):
    def build():
        filled = _filled(spark, sf_dir)
        return preprocessing.preprocessing(*preprocessing.feature_types(filled)).fit(filled)

    return _once(spark, sf_dir, "preprocessing", build)


def _processed(spark, sf_dir):
    return _fitted(spark, sf_dir).transform(_filled(spark, sf_dir))


def _category_index(spark, sf_dir):
    return preprocessing.category_index(spark, _fitted(spark, sf_dir))


def _scaled(spark, sf_dir):
    numeric, _ = preprocessing.feature_types(_filled(spark, sf_dir))
    scaled = preprocessing.scaled_values(_processed(spark, sf_dir), numeric)
    return scaled.withColumns({name: F.round(name, 6) for name in numeric})


def _training_preprocessing(spark, sf_dir):
    """Preprocessing fitted on the labelled users of the training side only."""

    def build():
        filled = _filled(spark, sf_dir)
        known, _ = preprocessing.train_test_split(filled.where(F.col("is_churned").isNotNull()))
        return preprocessing.preprocessing(*preprocessing.feature_types(filled)).fit(known)

    return _once(spark, sf_dir, "training preprocessing", build)


def _vectors(spark, sf_dir):
    return _training_preprocessing(spark, sf_dir).transform(_filled(spark, sf_dir))


def _halves(spark, sf_dir):
    return preprocessing.train_test_split(preprocessing.labelled(_vectors(spark, sf_dir)))


TRAINERS = {
    "Random Forest": classifiers.train_random_forest,
    "Gradient Boosting": classifiers.train_gbt,
    "Logistic Regression": classifiers.train_logistic,
}


def _training_table(spark, sf_dir):
    """The training side as a written table: a grid of forests reads it thousands of times."""

    def build():
        return preprocessing.write_training(_halves(spark, sf_dir)[0], shared_dir(spark, "training"))

    return spark.read.parquet(_once(spark, sf_dir, "training", build))


def _model(spark, sf_dir, name):
    return _once(spark, sf_dir, name, lambda: TRAINERS[name](_training_table(spark, sf_dir)))


def _predicted(name):
    def query(spark, sf_dir):
        return classifiers.predictions(_model(spark, sf_dir, name), _halves(spark, sf_dir)[1])

    return query


def _evaluate(spark, sf_dir):
    return classifiers.evaluate_models({name: _predicted(name)(spark, sf_dir) for name in TRAINERS})


def _compared_scores(spark, sf_dir):
    """The comparison of three fixed sets of scores: as given, reversed, and coarse."""
    given = _labelled_scores(spark, sf_dir)
    p, said = F.col("churn_probability"), F.col("prediction")
    compared = {
        "given": given,
        "reversed": given.withColumns({"churn_probability": 1 - p, "prediction": 1 - said}),
        "coarse": given.withColumn("churn_probability", F.floor(p * 4) / 4),
    }
    scored = {name: df.withColumn("label", F.col("is_churned").cast("double")) for name, df in compared.items()}
    return evaluation.compare_models(classifiers.evaluate_models(scored))


def _tuned(spark, sf_dir):
    def build():
        cores = spark.sparkContext.defaultParallelism
        return tuning.stored_tuned_forest(_training_table(spark, sf_dir), model_root(spark), parallelism=cores)

    return _once(spark, sf_dir, "tuned", build)


def _tuning_results(spark, sf_dir):
    return tuning.tuning_results(spark, _tuned(spark, sf_dir))


def _improvement(spark, sf_dir):
    tuned = classifiers.predictions(_tuned(spark, sf_dir).bestModel, _halves(spark, sf_dir)[1])
    return classifiers.tuning_improvement(tuned, _predicted("Random Forest")(spark, sf_dir))


def _importance(spark, sf_dir):
    return classifiers.feature_importance(spark, _tuned(spark, sf_dir).bestModel, _vectors(spark, sf_dir))


def _importance_share(spark, sf_dir):
    return classifiers.importance_share(_importance(spark, sf_dir))


def _whole_model(spark, sf_dir):
    return classifiers.full_model(_training_preprocessing(spark, sf_dir), _tuned(spark, sf_dir).bestModel)


def _reloaded(spark, sf_dir):
    """Scores of the stored and reloaded model."""
    path = classifiers.save_model(_whole_model(spark, sf_dir), shared_dir(spark, "model"))
    scored = classifiers.score_users(classifiers.load_model(path), _silver(spark, sf_dir))
    return scored.drop("prediction_timestamp")


def _scored_users(spark, sf_dir):
    scored = classifiers.score_users(_whole_model(spark, sf_dir), _silver(spark, sf_dir))
    return scored.drop("prediction_timestamp")


def _reload_differences(spark, sf_dir):
    """Users scored, and those whose scores change when the model is stored and loaded."""
    direct, again = _scored_users(spark, sf_dir), _reloaded(spark, sf_dir)
    changed = direct.exceptAll(again).agg(F.count("*").alias("changed_rows"))
    return changed.crossJoin(again.agg(F.count("*").alias("users")))  # one row on either side


def _score_rules(spark, sf_dir):
    """Per scored user: version, and whether the probability is one and the tier follows from it."""
    p = F.col("churn_probability")
    tier = F.when(F.col("prediction") == 1, "high_risk").when(p >= 0.3, "medium_risk").otherwise("low_risk")
    return _scored_users(spark, sf_dir).select(
        "user_id",
        "model_version",
        p.between(0, 1).alias("is_probability"),
        (F.col("churn_risk") == tier).alias("tier_follows"),
    )


def _holdout_predictions(spark, sf_dir):
    """Per model and user of the test side: the label, and whether the prediction follows from the probability."""
    parts = [
        _predicted(name)(spark, sf_dir).select(
            F.lit(name).alias("model_name"),
            "user_id",
            "label",
            F.col("churn_probability").between(0, 1).alias("is_probability"),
            ((F.col("prediction") == 1) == (F.col("churn_probability") > 0.5)).alias("prediction_follows"),
        )
        for name in TRAINERS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _tuning_grid(spark, sf_dir):
    """The settings searched, and whether their mean area is one."""
    area = F.col("mean_roc_auc").between(0, 1)
    return _tuning_results(spark, sf_dir).select("settings", area.alias("is_area"))


def _alert_differences(spark, sf_dir):
    """Alerts of the stream that the batch lacks, and the other way round."""
    batch = _scored_users(spark, sf_dir).where(F.col("churn_risk") == S.RISK_TIERS[0])
    stream = _stream_alerts(spark, sf_dir).select(*batch.columns)
    more = stream.exceptAll(batch).agg(F.count("*").alias("only_in_stream"))
    return more.crossJoin(batch.exceptAll(stream).agg(F.count("*").alias("only_in_batch")))  # one row on either side


def _risk_tiers(spark, sf_dir):
    tier = scoring.risk_tier(F.col("prediction"), F.col("churn_probability"))
    return _scores(spark, sf_dir).withColumn("churn_risk", tier)


def _fold_sizes(spark, sf_dir):
    return preprocessing.fold_sizes(preprocessing.time_windows(D.subscriptions(spark, sf_dir)))


def _fold_windows(spark, sf_dir):
    return preprocessing.time_windows(D.subscriptions(spark, sf_dir)).select("user_id", "time_window")


def _fold_auc(spark, sf_dir):
    windowed = preprocessing.time_windows(_silver(spark, sf_dir).where(F.col("is_churned").isNotNull()))
    return classifiers.time_series_auc(windowed)


# Flows and streams


def _silver_layer(spark, sf_dir):
    """The silver table built from the written bronze tables."""
    base = shared_dir(spark, "layers")
    medallion.build_bronze(base, D.pageviews(spark, sf_dir), D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir))
    return layers.read_layer(spark, medallion.build_silver(spark, base))


def _medallion(spark, sf_dir):
    """All layers written, a model trained, and the key figures read from the result."""
    base = shared_dir(spark, "layers")
    medallion.build_bronze(base, D.pageviews(spark, sf_dir), D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir))
    medallion.build_silver(spark, base)
    settings = tuning.best_settings(_tuned(spark, sf_dir))
    medallion.build_gold(spark, base, medallion.train(spark, base, **settings))
    return medallion.dashboard(spark, base)["executive_kpis"]


def _stream_actions(spark, sf_dir):
    stream = activity.behavior_stream(spark, sf_dir, "events.parquet")
    base = shared_dir(spark, "daily-actions")
    path = activity.run_update(activity.daily_actions(stream), f"{base}/table", f"{base}/checkpoint")
    return activity.latest_counts(spark.read.parquet(path))


def _stream_users(spark, sf_dir):
    stream = activity.behavior_stream(spark, sf_dir, "events.parquet")
    base = shared_dir(spark, "user-days")
    path = activity.run_update(activity.daily_user_days(stream), f"{base}/table", f"{base}/checkpoint")
    return activity.daily_active_users(spark.read.parquet(path))


def _stream_alerts(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    path = _once(spark, sf_dir, "silver", None)
    base = shared_dir(spark, "alerts")
    scored = alerts.risk_alerts(alerts.feature_stream(spark, path, silver.schema), _whole_model(spark, sf_dir))
    activity.run_append(scored, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").drop("prediction_timestamp")


def _stream_new_alerts(spark, sf_dir):
    """Users that enter the high tier, from two snapshots of the scores that arrive as files one after the other."""
    base, now = shared_dir(spark, "new-alerts"), _scores(spark, sf_dir)
    lower = F.col("churn_probability") - 0.2
    tier = scoring.risk_tier(F.when(lower >= 0.5, 1.0).otherwise(0.0), lower)
    columns = ["user_id", "churn_probability", "churn_risk"]
    for number, part in enumerate((now.withColumns({"churn_risk": tier, "churn_probability": lower}), now, now)):
        part.select(columns).write.mode("append").parquet(f"{base}/in")  # the files of one write are one batch
        stream = spark.readStream.schema(part.select(columns).schema).parquet(f"{base}/in")
        alerts.run_alerts_on_change(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out/alerts").where("batch > 0").select(columns)


def _stream_first_actions(spark, sf_dir):
    stream = activity.behavior_stream(spark, sf_dir, "events.parquet")
    base = shared_dir(spark, "first-actions")
    path = activity.run_append(activity.first_actions_of_day(stream), f"{base}/table", f"{base}/checkpoint")
    return activity.daily_active_users(spark.read.parquet(path))


def _snapshots():
    """Operators that take a date, as of a day inside the data: what happened later must not show."""
    behavior, subs, scores = _behavior, D.subscriptions, _scores
    day = SNAPSHOT_DAY

    def at(operator, *inputs):
        return lambda spark, sf_dir: operator(*[read(spark, sf_dir) for read in inputs], day)

    def engagement(spark, sf_dir):
        return features.engagement_features(behavior(spark, sf_dir), day)

    found = {
        "feature_matrix": _rounded(
            at(features.feature_matrix, behavior, subs), 6, "avg_session_duration", "stddev_session_duration"
        ),
        "activity_recency": at(features.activity_recency, behavior),
        "retention_funnel": at(dashboards.retention_funnel, subs),
        "cohort_retention": at(dashboards.cohort_retention, subs),
        "weekly_engagement_trend": at(kpis.weekly_engagement_trend, behavior),
        "monthly_churn_trend": at(kpis.monthly_churn_trend, subs),
        "kpi_scorecard": at(dashboards.kpi_scorecard, subs, scores, engagement),
    }
    return {snapshot_name(name): query for name, query in found.items()}


def queries():
    behavior, subs, views, scores = _behavior, D.subscriptions, D.pageviews, _scores
    labelled = _labelled_scores
    score, label = "churn_probability", "is_churned"
    matrix = _rounded(_matrix, 6, "avg_session_duration", "stddev_session_duration")
    engagement = _rounded(_engagement, 6, "avg_session_duration", "stddev_session_duration")
    cuts = ["p25_views", "median_views", "p75_views", "p95_views", "p99_views"]
    return {
        # ingestion and layers
        "read_file_manifest": _manifest,
        "daily_file_sample": _on(pageview_files.daily_file_sample, _manifest),
        "parse_pageview_lines": _parsed,
        "enrich_pageviews": _enriched,
        "ingestion_flow": _ingested,
        "write_layer": _write_layer,
        "read_layer": _read_layer,
        "clustered_rewrite": _clustered,
        "collect_table_stats": _table_stats,
        # profiles
        "pageview_summary": _on(profiles.pageview_summary, views),
        "project_distribution": _on(profiles.project_distribution, views),
        "view_count_stats": _rounded(_on(profiles.view_count_stats, views), 4, *cuts),
        "null_profile": _null_profile,
        "summary_long": _on(profiles.summary_long, views),
        "complete_record_ratio": _on(profiles.complete_record_ratio, views),
        "daily_pageview_trend": _on(profiles.daily_pageview_trend, views),
        "hourly_distribution": _on(profiles.hourly_distribution, views),
        "weekday_distribution": _on(profiles.weekday_distribution, views),
        "view_count_histogram": _on(profiles.view_count_histogram, views),
        "behavior_summary": _on(profiles.behavior_summary, behavior),
        "action_distribution": _on(profiles.action_distribution, behavior),
        "feature_usage_share": _on(profiles.feature_usage_share, behavior),
        "subscription_summary": _on(profiles.subscription_summary, subs),
        "plan_distribution": _on(profiles.plan_distribution, subs),
        "churn_reason_breakdown": _on(profiles.churn_reason_breakdown, subs),
        "churn_by_subscription_length": _on(profiles.churn_by_subscription_length, subs),
        "source_overview": _on(profiles.source_overview, views, behavior, subs),
        # engagement KPIs
        "daily_active_users": _on(kpis.daily_active_users, behavior),
        "weekly_active_users": _on(kpis.weekly_active_users, behavior),
        "monthly_active_users": _on(kpis.monthly_active_users, behavior),
        "session_stats": _rounded(
            _on(kpis.session_stats, behavior), 4, "p25_actions", "median_actions", "p75_actions", "p95_actions"
        ),
        "feature_adoption_histogram": _on(kpis.feature_adoption_histogram, behavior),
        "users_by_period": _on(distinct_state.distinct_by_period, _user_state),
        "titles_by_period": _on(distinct_state.distinct_by_period, _title_state),
        "sketches_by_period": _sketch_errors,
        # features
        "engagement_features": engagement,
        "action_mix": _on(features.action_mix, behavior),
        "subscription_lifecycle": _lifecycle,
        "action_count_pivot": _on(features.action_count_pivot, behavior),
        "feature_usage_pivot": _on(features.feature_usage_pivot, behavior),
        "subscription_features": _on(features.subscription_features, subs),
        "feature_matrix": matrix,
        "feature_matrix_refreshed": _rounded(_refreshed_matrix, 6, "avg_session_duration", "stddev_session_duration"),
        "feature_statistics": _rounded(
            _on(features.feature_statistics, _matrix), 4, "p25_value", "median_value", "p75_value", "p95_value"
        ),
        "churn_correlation": _on(features.churn_correlation, _matrix),
        "class_balance": _on(profiles.class_balance, _matrix),
        "feature_completeness": _on(features.feature_completeness, _matrix),
        "feature_summary": _on(features.feature_summary, _matrix),
        # models
        "missing_counts": _on(profiles.missing_counts, _matrix),
        "fill_missing": _rounded(
            _on(preprocessing.fill_missing, _matrix), 6, "avg_session_duration", "stddev_session_duration"
        ),
        "preprocess_category_index": _category_index,
        "preprocess_scaled_features": _scaled,
        "train_test_split": _on(preprocessing.split_balance, _matrix),
        "train_random_forest": _predicted("Random Forest"),
        "train_gbt": _predicted("Gradient Boosting"),
        "train_logistic": _predicted("Logistic Regression"),
        "evaluate_models": _rounded(_evaluate, 6, *METRICS),
        "classification_metrics": _rounded(
            lambda spark, sf_dir: evaluation.classification_metrics(
                labelled(spark, sf_dir), score, "prediction", label
            ),
            6,
            *METRICS,
        ),
        "compare_models": _on(evaluation.compare_models, _evaluate),
        "compare_fixed_scores": _compared_scores,
        "tune_random_forest": _tuning_results,
        "tuning_improvement": _improvement,
        "feature_importance": lambda spark, sf_dir: _importance(spark, sf_dir).limit(20),
        "importance_share": _importance_share,
        "holdout_predictions": _holdout_predictions,
        "tuning_grid": _tuning_grid,
        "save_and_reload_model": _reloaded,
        "reload_differences": _reload_differences,
        "score_rules": _score_rules,
        "alert_differences": _alert_differences,
        "score_users": _scored_users,
        "risk_tiers": _risk_tiers,
        # dashboards
        "executive_kpis": _on(dashboards.executive_kpis, subs, scores),
        "retention_funnel": _on(dashboards.retention_funnel, subs),
        "cohort_retention": _on(dashboards.cohort_retention, subs),
        "cohort_retention_by_day": _on(lambda s: dashboards.cohort_retention(s, grain="day"), subs),
        "slice_by_plan": _on(dashboards.slice_by_plan, subs, _engagement),
        "slice_by_billing": _on(dashboards.slice_by_billing, _lifecycle, _engagement),
        "slice_by_payment": _on(dashboards.slice_by_payment, _lifecycle),
        "engagement_segments": _on(dashboards.engagement_segments, _engagement, subs),
        "adoption_segments": _on(dashboards.adoption_segments, _engagement, subs),
        "risk_distribution": _on(dashboards.risk_distribution, scores, subs),
        "prediction_outcomes": _on(dashboards.prediction_outcomes, scores, subs),
        "geographic_churn": _on(dashboards.geographic_churn, behavior, _engagement, subs),
        "device_churn": _on(dashboards.device_churn, behavior, _engagement, subs),
        "churn_slices": _on(dashboards.churn_slices, behavior, _engagement, subs),
        "monthly_churn_trend": _on(kpis.monthly_churn_trend, subs),
        "churn_by_end_month": _on(kpis.churn_by_end_month, subs),
        "weekly_engagement_trend": _on(kpis.weekly_engagement_trend, behavior),
        "risk_by_stage": _on(dashboards.risk_by_stage, scores, subs),
        "kpi_scorecard": _on(dashboards.kpi_scorecard, subs, scores, _engagement),
        "silver_layer": _rounded(_silver_layer, 6, "avg_session_duration", "stddev_session_duration"),
        "medallion_flow": _medallion,
        # described extensions
        "rolling_averages": _on(lambda b: seasonality.rolling_averages(seasonality.daily_users(b)), behavior),
        "rolling_averages_by_project": _on(
            lambda v: seasonality.rolling_averages(seasonality.daily_views(v), by=["project"]), views
        ),
        "seasonal_decomposition": _on(
            lambda v: seasonality.seasonal_decomposition(seasonality.daily_views(v), ["project"]), views
        ),
        "calendar_features": _calendar,
        "seasonal_minmax": _on(
            lambda v: seasonality.seasonal_minmax(seasonality.daily_views(v), ["project"]), views
        ),
        "log_transform": _rounded(_on(distributions.log_transform, views), 6, "log_view_count"),
        "percentile_bins": _on(distributions.percentile_bins, views),
        "robust_stats": _rounded(_on(distributions.robust_stats, views), 4, "p25", "median", "p75", "iqr"),
        "cap_outliers": _rounded(_on(distributions.cap_outliers, views), 4, "capped_view_count"),
        "cutoff_features": _rounded(_cutoff, 6, "avg_session_duration", "stddev_session_duration"),
        "features_at_cutoffs": _rounded(_cutoffs, 6, "avg_session_duration", "stddev_session_duration"),
        "last_use_before_ticket": _last_use,
        "time_series_folds": _fold_sizes,
        "time_series_windows": _fold_windows,
        "time_series_auc": _rounded(_fold_auc, 6, "roc_auc", "pr_auc"),
        "stratified_sample": _stratified,
        "ranking_metrics": _rounded(
            _on(lambda s: evaluation.ranking_metrics(s, score, label), labelled),
            6,
            "precision_at_top",
            "recall_at_flagged",
            "false_positive_rate",
        ),
        "calibration": _on(lambda s: evaluation.calibration(s, score, label), labelled),
        "segment_auc": _rounded(_segment_auc, 6, "roc_auc", "pr_auc"),
        "risk_bands": _on(evaluation.risk_bands, scores),
        "intervention_queue": _on(scoring.intervention_queue, scores, subs),
        "new_high_risk": _new_high_risk,
        "activity_recency": _on(features.activity_recency, behavior),
        "early_adoption_effect": _on(journeys.early_adoption_effect, behavior, subs),
        "bronze_validation": _validation,
        "early_churn_share": _on(kpis.early_churn_share, subs),
        "adoption_journey": _on(journeys.adoption_journey, behavior),
        "adoption_transitions": _on(journeys.adoption_transitions, behavior),
        "insight_ratios": _on(dashboards.insight_ratios, behavior, _engagement, subs),
        # streams
        "stream_daily_actions": _stream_actions,
        "stream_active_users": _stream_users,
        "stream_first_actions": _stream_first_actions,
        "stream_new_alerts": _stream_new_alerts,
        "stream_risk_alerts": _stream_alerts,
    } | _snapshots()
