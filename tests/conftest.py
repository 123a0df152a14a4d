import os

import pytest

from corpuslens.session import build_session, ship_code

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('tables')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_code(session, ROOT, "corpuslens", "workload", "tests")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def f1(spark):
    """Cleaning fixture."""
    return spark.createDataFrame(
        [
            (1, "Great film!<br /><br />I can't wait, the END.", "positive"),
            (2, "Bad<BR>plot_line 42%", "negative"),
            (3, "", "positive"),
            (4, "ok ok", None),
            (5, "the, THE the", "negative"),
        ],
        "doc_id LONG, review STRING, sentiment STRING",
    )


@pytest.fixture
def docs(spark):
    """Frame of word arrays: ``docs([["a", "b"], ...])``."""

    def make(rows, sentiment="positive"):
        return spark.createDataFrame(
            [(i, list(r), sentiment) for i, r in enumerate(rows)], "doc_id LONG, _words ARRAY<STRING>, sentiment STRING"
        )

    return make
