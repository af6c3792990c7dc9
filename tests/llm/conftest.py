import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    """Edge texts with a null id, a repeated row, null labels, and clashing extra columns."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "web", 1, "x", 2.0) for i, t in enumerate(brute.EDGES)]
    rows += [(None, "no id", "en", "web", 1, "x", 2.0), rows[3]]
    names = "doc_id long, text string, lang string, source string, n_words int, kept string, position double"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
