"""Corpus pipeline over ``documents``: quality rules, fuzzy line dedup, near
duplicates, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  Rows without a ``doc_id`` cannot be named by a decision: the
filtering stages keep them, packing leaves them out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pathcredit.llm import decontamination, lines, minhash, packing, quality
from pathcredit.llm.common import documents, shared_dir, table


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the learned decision list reject go."""
    return quality.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark, docs, sf_dir):
    """Of every component of similar lines the first stays; documents stay, even
    when no line is left."""
    return lines.deduplicated(docs)


def near_dedup(spark, docs, sf_dir):
    """Of every component of similar documents the smallest ``doc_id`` stays."""
    gone = minhash.near_duplicates(docs, minhash.CORPUS).filter("not kept").select(F.col("doc_id").alias("gone_doc")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == gone.gone_doc, "left_anti")


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a benchmark passage go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark, docs, sf_dir):
    """The pieces of all remaining documents, packed into sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL cannot express the learned rules, the links or the packing; a test holds
#: the whole chain against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``."""
    shared_dir(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
