import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tonearm.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}"
