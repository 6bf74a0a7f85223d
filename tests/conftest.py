import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import session  # noqa: E402
from sparecost.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = configure(session())
    yield spark
    spark.stop()
