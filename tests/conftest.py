import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from speechviews.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"
SESSION = local_session(4, partitions=4, checkpoint_dir=tempfile.mkdtemp(prefix="speechviews-tests-"))  # before test modules name columns


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def one(spark):
    """Value of one expression over one row."""

    def evaluate(expression, **columns):
        names = ", ".join(f"{k} {v[0]}" for k, v in columns.items())
        df = spark.createDataFrame([tuple(v[1] for v in columns.values())], names)
        return df.select(expression.alias("x")).first().x

    return evaluate


@pytest.fixture
def recordings(spark):
    """Recordings from (id, dept, zone, time, date, text) with a duration of one minute."""

    def build(rows):
        return spark.createDataFrame(
            [(i, d, z, t, day, 1.0, text) for i, d, z, t, day, text in rows],
            "id string, dept_name string, zone string, time_of_day string, date_of_event string, "
            "duration double, text string",
        )

    return build
