"""Queries whose Python workers cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from labelflow.llm import queries, url_filters

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
CODE = """
import sys
sys.path.append(sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
)
for name in sys.argv[3:]:
    print("rows", name, len(entry.queries()[name](spark, sys.argv[2]).collect()))
"""


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_workers_need_no_import_path(tmp_path):
    names = [*queries.QUERIES, "pipeline"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE, str(ROOT), SF_DIR, *names],
        cwd=tmp_path, env=env, capture_output=True, text=True,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x.split()[1] for x in done.stdout.splitlines() if x.startswith("rows ")] == names


def test_rules_in_several_passes(spark, monkeypatch):
    rules = queries.url_rules()
    urls = [
        "http://a.example.org/es/1", "https://shop.com/fr/x?page=2&ref=", "http://x.net/s.xml", None,
        "http://x.net/s.xml\n", "http://blog.q.net/en/?page=1&ref=", "http://ads.x.net/", "none",
        "http://" + "a" * 300_000 + ".org/" + "b/" * 300_000, "http://ads.x.net/", "http://ads.x.net/",
    ]
    rows = [(i if i < 9 else None, u, "x") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")

    def judged():
        out = url_filters.judge_urls(df, ["page_id"], "url", rules).collect()
        return sorted(map(str, out))

    once = judged()
    monkeypatch.setattr(url_filters, "RULE_BYTES", 1)
    assert judged() == once
    by_id = {r["page_id"]: r for r in url_filters.judge_urls(df, ["page_id"], "url", rules).collect()}
    assert (by_id[2]["pattern"], by_id[4]["pattern"], by_id[3]["verdict"]) == (".xml|", None, "allow")
    assert len(by_id) == 10 and len(once) == 11
