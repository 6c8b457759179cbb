"""Small tables and brute-force versions shared by the tests of the text operators."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels conversations embeddings".split()

#: Names that the operators use inside, as columns of the input.
CLASHING = (
    "hash digest bucket kept keep_id size row part shard slot bits root score body spans own_hash stays_id "
    "stays_hash hit_id w pos term text_hash anchor lang_pred held_out"
).split()


def docs(spark, rows, clashing=True):
    """``rows`` of (doc_id, text) as documents; with every clashing column name besides."""
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in CLASHING if clashing else []:
        table = table.withColumn(name, F.lit(f"own {name}"))
    return table


def tuples(frame, *columns):
    key = lambda row: tuple((v is not None, v) for v in row)
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=key)


def duck(sf_dir=SF):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def write_tables(spark, folder, **tables):
    for name, frame in tables.items():
        frame.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def sample_texts(sf_dir=SF):
    return duck(sf_dir).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
