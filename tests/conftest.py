import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    def make(values, **columns):
        rows = [(i, value, *(column[i] for column in columns.values())) for i, value in enumerate(values)]
        kinds = "".join(f", {name} string" for name in columns)
        return spark.createDataFrame(rows, f"doc_id bigint, text string{kinds}").repartition(3)

    return make
