import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from obsengine.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "obsengine-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # The trusted test tables have thousands of small date folders.
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def frame(spark):
    """Build a DataFrame from a DDL schema and rows."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def plan():
    """The final physical plan of a frame, after running it."""

    def text(df):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text


def multiset(df):
    """Rows as a sorted list of texts, for comparing frames whatever their order."""
    return sorted(repr(tuple(row)) for row in df.select(*sorted(df.columns)).collect())
