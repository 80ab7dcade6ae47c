"""Queries where driver and executors are processes of their own."""

import subprocess
import sys
import tempfile
from pathlib import Path

RUN = """
import duckdb
from pyspark.sql import SparkSession
from tidemark import plans
from tidemark.plans.registry import ORACLE, QUERIES

spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
d = "/root/testdata/sf0.001"
got = sorted(map(tuple, QUERIES["serving_merge"](spark, d).select("n_nationkey", "n_name", "n_regionkey").collect()))
con = duckdb.connect()
con.execute(f"create view nation as select * from '{d}/nation.parquet'")
assert got == sorted(con.execute("select n_nationkey, n_name, n_regionkey from (" + ORACLE["serving_merge"] + ")").fetchall())
spark.stop()
print("same rows")
"""


def test_serving_merge_where_executors_are_apart():
    root = str(Path(__file__).parents[1])
    run = subprocess.run([sys.executable, "-c", RUN], cwd=tempfile.mkdtemp(), env={**__import__("os").environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=120)
    assert "same rows" in run.stdout, run.stderr[-2000:]
