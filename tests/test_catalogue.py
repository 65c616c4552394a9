"""Every query against its SQL twin, and the entry points."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

from tempolith.plans.catalogue import ORACLE, QUERIES
from tests.conftest import ROOT


def rows(frame):
    cols = sorted(frame.columns)
    values = frame[cols].astype(object).where(frame[cols].notna(), None).values.tolist()
    return cols, sorted((tuple(v) for v in values), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert rows(QUERIES[name](spark, sf_dir).toPandas()) == rows(duck.sql(ORACLE[name]).df())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("missing", ["sentencepiece", "public_tokenizers", "tempolith.llm"])
def test_entry_without_the_llm_operators(missing):
    """Where a library of theirs, or they themselves, are missing, the engine's queries are still offered."""
    code = f"import sys; sys.modules['{missing}'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    assert said.split() == [str(len(QUERIES)), str(len(ORACLE))]
