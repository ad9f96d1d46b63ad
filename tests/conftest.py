import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from skyweave.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, partitions=4, app="tests")


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def ts(spark):
    """Catalog rows from (source, 'HH:MM') pairs of one day."""
    from pyspark.sql import functions as F

    def make(rows, day="2025-01-28"):
        df = spark.createDataFrame([(s, f"{day} {t}") for s, t in rows], "source string, t string")
        return df.select("source", F.to_timestamp("t", "yyyy-MM-dd HH:mm").alias("ts"))

    return make
