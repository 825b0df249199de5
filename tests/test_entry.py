"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_every_query_has_an_oracle():
    """But for operators that SQL cannot express, which have tests of their own."""
    without = set(spark_entry.queries()) - set(spark_entry.oracle_sql())
    assert all(n == "pipeline" or re.match(r"op\d+_", n) for n in without)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_without_the_optional_operators():
    """With their files gone, the entry module still has all other queries."""
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.util, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('labelflow.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "del sys.modules['corpus_pipeline']\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 99 and 'pipeline' not in e.queries()\n"
        "assert set(e.queries()) == set(e.oracle_sql())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(spark_entry.__file__).parent)


@needs_data
def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["id", "categories", "hallucinations"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@needs_data
@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query_equals_sql(spark, database, name):
    ok, note = compare(spark, database, SF_DIR, name)
    assert ok, note
