from __future__ import annotations

import pytest
from samples import COLUMNS, awkward_rows


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(d, t, None, s, None, *["clash"] * 16) for d, t, s in awkward_rows()]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
