import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacancia.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over a list of arguments (texts, or tuples of texts)."""

    def run(fn, *args, kind="string"):
        rows = [(i, *(a if isinstance(a, tuple) else (a,))) for i, a in enumerate(args)]
        names = [f"c{j}" for j in range(len(rows[0]) - 1)]
        df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} {kind}" for n in names))
        result = df.select("i", fn(*[df[n] for n in names]).alias("r")).orderBy("i").collect()
        return [r["r"] for r in result]

    return run
