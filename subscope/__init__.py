"""Subscriber analytics as Spark jobs: ingestion, profiles, KPIs, features, churn models, dashboards."""
