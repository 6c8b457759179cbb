"""Queries that SQL can express, against a second engine."""

import os
import subprocess
import sys

import __spark_entry__ as contract
import pytest
from llm_helpers import SF, duck

from cuebreaks.llm.oracle import ORACLE_SQL
from cuebreaks.llm.queries import QUERIES


def test_every_query_is_registered():
    assert {*QUERIES, "pipeline"} <= contract.queries().keys()
    assert ORACLE_SQL.keys() <= contract.oracle_sql().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_result(spark, name):
    result = contract.queries()[name](spark, SF)
    answer = duck().execute(ORACLE_SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(result.columns) == sorted(names)
    expected = sorted(repr(r) for r in answer.fetchall())
    assert sorted(repr(tuple(r)) for r in result.select(*names).collect()) == expected


def test_workers_need_no_path_to_the_library(tmp_path):
    """A session begun elsewhere, by a process that knows the entry file only."""
    script = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {contract.__file__!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print("rows", entry.queries()["op8_language_id"](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
