"""The registered queries that have SQL twins, at the smallest scale, and that all give rows."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from compare import connect, spark_digest, sql_digest  # noqa: E402

from clipyard.llm.oracle import ORACLE_SQL  # noqa: E402
from clipyard.llm.queries import QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, name):
    assert spark_digest(QUERIES[name](spark, SF)) == sql_digest(connect(SF), ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_one_row_per_document(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
