import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from jobsift.session import get_spark

    session = get_spark(
        "jobsift-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark):
    """Build a postings table from texts (and titles)."""

    def build(*rows):
        data = [
            (i, r[1] if isinstance(r, tuple) else None, r[0] if isinstance(r, tuple) else r)
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(data, "doc_id long, titulo string, descricao_texto string")

    return build
