import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskmart.llm.tables import ready  # noqa: E402


@pytest.fixture(autouse=True)
def workers(spark):
    ready(spark)
