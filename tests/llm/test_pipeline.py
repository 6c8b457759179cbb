"""Each stage against a brute-force decision on what its predecessor kept."""

import re

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_decontam import plain as plain_hits
from test_packing import check_pieces, tokenizer  # noqa: F401
from test_simhash import plain_components, plain_fingerprint

from cuebreaks.llm.inputs import table
from cuebreaks.llm.queries import toxicity_model
from cuebreaks.sources.staging import Stage

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    stage, docs, kept = Stage(spark), table(spark, BIG, "documents"), []
    kept.append(docs)
    for name, step in corpus_pipeline.STAGES:
        kept.append(stage.write(step(spark, kept[-1], BIG), name))
    return kept


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(outputs):
    assert all(o.schema == outputs[0].schema for o in outputs[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing",
    ]


def test_toxic_documents_go(spark, outputs):
    model = toxicity_model(spark, outputs[0], BIG)
    want = {i for i, t in texts(outputs[0]).items() if model.score(t) < 0.7}
    assert texts(outputs[1]).keys() == want and len(want) < 1000


def test_copies_go(outputs):
    first = {}
    for i, t in sorted(texts(outputs[1]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    assert texts(outputs[2]).keys() == set(first.values())


def test_near_copies_go(outputs):
    rows = sorted(texts(outputs[2]).items())
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    assert texts(outputs[3]).keys() == {rows[r][0] for r in roots}


def test_contaminated_documents_go(outputs):
    bench = duckdb.sql(f"SELECT item_id, text FROM '{BIG}/benchmark.parquet'").fetchall()
    rows = plain_hits(list(texts(outputs[3]).items()), bench)
    assert texts(outputs[4]).keys() == {r[0] for r in rows if not r[5]} and any(r[5] for r in rows)


def test_the_rest_is_packed(outputs, tokenizer):  # noqa: F811
    check_pieces(outputs[5].collect(), texts(outputs[4]), tokenizer, 4096)


def test_odd_documents_pass_through(spark, tmp_path):
    odd = [(1, None), (2, ""), (2, ""), (None, "x y z"), (5, "word " * 30000)]
    frame = spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    empty = frame.limit(0)
    for name, columns in (("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    for docs, want in ((frame, {None, 1, 5}), (empty, set())):
        stage = Stage(spark)
        for name, step in corpus_pipeline.STAGES:
            docs = stage.write(step(spark, docs, str(tmp_path)), name)
        assert {r.doc_id for r in docs.collect()} == want
