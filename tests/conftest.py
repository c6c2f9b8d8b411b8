import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from trialweave.session import build_session
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate an expression of column ``c`` over some values."""
    def run(expression, items, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, c {kind}")
        return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]
    return run
