"""Every registered query: equal to its SQL, or, without SQL, with rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import check

# Minutes each with the full model sizes; `compare.py` runs them as well.
SLOW = {
    "grid_search", "elbow_sweep", "best_k", "leakage_safe_fit", "ablation_single", "ablation_leave_one_out",
    "compare_models", "cross_validate_refit", "mlp",
}
QUERIES, SQL = queries(), oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, small, name):
    passed, message, _ = check(spark, small, name, QUERIES[name], SQL.get(name))
    assert passed, message


def test_entry(spark):
    assert entry(spark).columns == ["accuracy", "precision", "recall", "f1"]
