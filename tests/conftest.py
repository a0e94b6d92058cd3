import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a INT, d DATE", [(1, "2024-01-01"), ...]): dates and times given as text."""
    def make(ddl, rows):
        text, casts = [], []
        for part in ddl.split(","):
            name, kind = part.split()
            text.append(f"{name} STRING")
            casts.append(f"CAST({name} AS {kind.replace(';', ',')}) AS {name}")
        data = [tuple(None if v is None else str(v) for v in r) for r in rows]
        return spark.createDataFrame(data, ", ".join(text)).selectExpr(*casts)
    return make
