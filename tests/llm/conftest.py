import os

import pytest

# Workers import the package by name, wherever the tests are started.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows."""

    def make(*rows):
        full = [(*r, *("en", "s")[len(r) - 2 :]) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string")

    return make
