import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratavid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from tuples and a schema text; ISO texts become zoneless timestamps."""

    def build(schema: str, *rows):
        kinds = [c.strip().split(" ")[1] for c in schema.split(",")]
        converted = [
            tuple(
                datetime.fromisoformat(v) if k == "timestamp_ntz" and v is not None else v
                for k, v in zip(kinds, row)
            )
            for row in rows
        ]
        return spark.createDataFrame(converted, schema)

    return build


def rows_of(df, *cols):
    """Rows as sorted tuples, times as text."""
    picked = df.select(*cols) if cols else df
    shown = [
        tuple(str(v) if isinstance(v, date) else v for v in row)
        for row in picked.collect()
    ]
    return sorted(shown, key=repr)


def final_plan(df) -> str:
    """Executed plan after AQE."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
