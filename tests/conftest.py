import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from equifacts.session import configure  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("equifacts-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function on single texts."""
    def run(function, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, c {kind}")
        return [r.v for r in df.select("i", function(df.c).alias("v")).orderBy("i").collect()]
    return run
