import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def panel(spark):
    """Frame of one entity's series: panel([1, None, 2]) -> iso_code, year, v."""
    def make(values, name="v", entity="A"):
        rows = [(entity, 2000 + i, None if v is None else float(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"iso_code string, year int, {name} double")
    return make
