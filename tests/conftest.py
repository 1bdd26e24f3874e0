import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from subscope.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "subscope-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.ansi.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def make(spark):
    """Builds tables from short rows; missing fields are NULL unless a default is given."""
    from datetime import datetime

    from subscope import schemas

    def instant(text):
        return datetime.fromisoformat(text) if text else None

    class Make:
        @staticmethod
        def behavior(*rows):
            names = schemas.BEHAVIOR.names
            full = []
            for row in rows:
                row = {"user_id": "u", "timestamp": "2024-01-30", "action_type": "login"} | row
                row["timestamp"] = instant(row["timestamp"])
                full.append(tuple(row.get(name) for name in names))
            return spark.createDataFrame(full, schemas.BEHAVIOR)

        @staticmethod
        def subscriptions(*rows):
            names = schemas.SUBSCRIPTIONS.names
            full = []
            for row in rows:
                row = {
                    "user_id": "u",
                    "subscription_start": "2023-01-01",
                    "plan_type": "basic",
                    "billing_cycle": "monthly",
                    "payment_method": "paypal",
                    "is_churned": bool(row.get("subscription_end")),
                } | row
                row["subscription_start"] = instant(row["subscription_start"])
                row["subscription_end"] = instant(row.get("subscription_end"))
                full.append(tuple(row.get(name) for name in names))
            return spark.createDataFrame(full, schemas.SUBSCRIPTIONS)

        @staticmethod
        def pageviews(*rows):
            names = schemas.PAGEVIEWS.names
            full = []
            for row in rows:
                row = {"project": "en", "page_title": "A", "access_method": "desktop"} | row
                row["file_timestamp"] = instant(row.get("file_timestamp", "2024-01-01T13:00:00"))
                full.append(tuple(row.get(name) for name in names))
            return spark.createDataFrame(full, schemas.PAGEVIEWS)

        @staticmethod
        def scored(*rows):
            """(segment, score, label) rows with a hard prediction at 0.5."""
            full = [(f"u{i}", s, p, y, 1.0 if p >= 0.5 else 0.0) for i, (s, p, y) in enumerate(rows)]
            return spark.createDataFrame(
                full, "user_id string, segment string, score double, label boolean, prediction double"
            )

    return Make
