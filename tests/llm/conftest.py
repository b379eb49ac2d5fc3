from __future__ import annotations

import pytest

from tallyhouse.llm.common import library_for_workers


@pytest.fixture(autouse=True)
def library(spark):
    library_for_workers(spark)
