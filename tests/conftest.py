import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from laborlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Build a demand table: series({"a": [1, 2, 3]}, "2000-01-01") with one value per month, None for a gap."""
    import datetime as dt

    def build(values, start="2000-01-01"):
        first = dt.date.fromisoformat(start)
        rows = []
        for name, points in values.items():
            for i, y in enumerate(points):
                month = first.month - 1 + i
                if y is not None:
                    rows.append((name, dt.date(first.year + month // 12, month % 12 + 1, 1), float(y)))
        return spark.createDataFrame(rows, "skill_name string, period_start date, demand_count double")

    return build
