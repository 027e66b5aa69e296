"""Every registered query against its reference SQL over whole tables."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_points
import oracle
import pytest

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    sql = entry_points.oracle_sql()[name]
    assert oracle.difference(entry_points.queries()[name](spark, SF_DIR), db, sql) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_entry_works_without_the_text_operators():
    program = (
        "import sys; sys.modules['tillspark.llm'] = None; import __spark_entry__ as e;"
        "names = set(e.queries()); assert names == set(e.oracle_sql()) and len(names) > 70, names;"
        "assert not any(n.startswith('op1_') or n == 'pipeline' for n in names)"
    )
    subprocess.run([sys.executable, "-c", program], cwd=ROOT, check=True)
