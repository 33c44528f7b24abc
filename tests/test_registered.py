"""Every registered query against its SQL on the smallest test tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from checks import oracle, queries
from checks.compare import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert queries.registered().keys() == oracle.statements().keys()


@pytest.mark.parametrize("name", queries.registered())
def test_query_agrees_with_sql(spark, duck, name):
    got, want = queries.registered()[name](spark, SF).toPandas(), duck.execute(oracle.statements()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and rows_of(got) == rows_of(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("absent", ["tallyshelf.llm", "corpus_pipeline", "ahocorasick"])
def test_entry_without_what_only_training_data_needs(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print('NAMES', *e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=120)
    names = said.stdout.split("NAMES ")[1].split()
    assert set(names) == set(queries.registered()) and "left out" in said.stderr
