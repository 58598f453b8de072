import pytest
from tests_support import compare

from titlewright.plans import artifacts, queries  # noqa: F401

SQL = queries.oracle_sql()


def test_every_query_has_sql():
    assert set(SQL) == set(queries.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    compare(spark, name, queries.queries()[name], SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_a_library():
    """The engine's queries stay when something that the other operators need is missing."""
    import os
    import subprocess
    import sys

    code = "import sys; sys.modules['regex'] = None; import __spark_entry__ as e; n = e.queries(); assert 'index_records' in n and not any(q.startswith('op') for q in n) and 'pipeline' not in n, n; assert set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
