"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.llm import decontamination, packing, secrets, simhash, toxicity
from cyclemill.llm.common import fresh, table, written
from cyclemill.llm.queries import toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity under one half; empty ones score the share of toxic labels."""
    score = fresh("score")
    model = toxicity_model(spark, sf_dir, docs)
    return docs.withColumn(score, toxicity.toxicity(model)["score"]).filter(F.col(score) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles within two bits: that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, simhash.SHINGLE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark passages."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col(found.columns[-1])["contaminated"]).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a marker and ``n_chars`` (where there is one) brought up to date."""
    made = fresh("redacted")
    clean = docs.withColumn(made, secrets.redacted())
    changed = F.col(made)["n"] > 0
    columns = {"text": F.col(made)["text"]}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length(F.col(made)["text"]).cast(kind)).otherwise(F.col("n_chars"))
    return clean.withColumns(columns).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]
# learned scores and token ids cannot be said in SQL; tests/llm/test_pipeline.py has the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``; every stage before is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
