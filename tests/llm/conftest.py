import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows (id, text) as a documents table."""

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
