import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import oracle
from trailmart.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    oracle.compare(spark, oracle.connect(data), registry.queries()[name], registry.oracle_sql()[name], data)
