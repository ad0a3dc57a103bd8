"""Cleaning of the documents table in stages; each works on all that the one before kept."""

from __future__ import annotations

from paygrid.llm import stages as S
from paygrid.llm.staging import written

STAGES = [
    ("quality classifier", S.keep_quality),
    ("n-gram Jaccard join", S.one_of_alike),
    ("benchmark decontamination", S.remove_benchmark),
    ("PII", S.mask_personal_data),
    ("byte-level BPE", S.tokens),
]

#: Trained scores and learned patterns are not expressible in SQL; tests run all stages on rows with known results.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows; what each stage keeps is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = written(out, f"pipeline-{i}") if i < len(STAGES) - 1 else out
    return docs
