import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import SCHEMA, invented  # noqa: E402


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls, empty and long texts, repeated rows, one id twice, and columns with clashing names."""
    rows = [(i, t) for i, t in invented(7)]
    rows += [(100, None), (101, ""), (102, "  \n\t "), (103, "a" * 3000), (104, "x " * 4000), (104, "another row of one id"), (None, rows[5][1]), (None, None)]
    rows += [rows[9], rows[9], (105, "Ärger\x0bÉtude " * 40), (106, "one\u00a0word\u2003here"), (107, "one word here")]
    return spark.createDataFrame([(i, t, "en", 7, None, None) for i, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
