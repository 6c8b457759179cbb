"""Documents to packed training sequences: five stages, each written before the next one reads.

Toxic documents, copies, near copies and contaminated documents go; what is left is packed. All stages but the last
return whole rows with the columns they were given.

Defined cases: a NULL text counts as empty, is neither toxic nor contaminated, and is a copy of other empty ones; of copies and of near
copies the row of the smallest ``doc_id`` stays (a NULL one is the smallest among exact copies, the largest among near ones), and of
rows alike in id and text one; texts are taken whole, however long; further columns are kept up to the last stage, which gives pieces; an empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuebreaks.llm import decontam, exact_dedup, packing, simhash, toxicity
from cuebreaks.llm.inputs import table
from cuebreaks.llm.queries import toxicity_model, word_tokenizer
from cuebreaks.sources.staging import Stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL has neither the tokenizer nor XXH64 nor the learned grammar; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with the result of each but the last written to the shared folder."""
    stage = Stage(spark)
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, step in filters:
        docs = stage.write(step(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
