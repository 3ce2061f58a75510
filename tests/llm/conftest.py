import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, spans int, score double, `rank` int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with extra columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 0.5, 7) for i, t in rows], DOCS)

    return make
