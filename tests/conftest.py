import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from churnloom.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
