from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers_llm import frame, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd():
    return odd_texts()


@pytest.fixture(scope="session")
def docs(spark, odd):
    return frame(spark, odd).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
