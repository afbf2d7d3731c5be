import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        spark_sql_shuffle_partitions=2,
        spark_ui_enabled="false",
        # Tiny inputs: compiling code would cost more than it saves.
        spark_sql_codegen_wholeStage="false",
        spark_sql_warehouse_dir=folder / "warehouse",
        spark_checkpoint_dir=folder / "scratch",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def as_set(df, *columns):
    picked = df.select(*columns) if columns else df
    return {tuple(r) for r in picked.collect()}


def as_list(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]
