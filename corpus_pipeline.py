"""From raw documents to packed training sequences.

Stages: quality rules, near duplicates, benchmark decontamination, personal
data, packing. Each is (name, function) with function(spark, docs, sf_dir); its
result is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm import packing
from vistra.llm.common import stored, table
from vistra.llm.decontamination import drop_leaks
from vistra.llm.jaccard import drop_near_duplicates
from vistra.llm.pii import find_pii, mask_spans
from vistra.llm.quality import quality_rules


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep (operator 8)."""
    columns = docs.columns
    return quality_rules(docs, table(spark, sf_dir, "labels"), keep=columns).filter("kept").select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id (operator 7)."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that leak no benchmark item (operator 4)."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in their texts replaced by its kind (operator 1); n_chars follows the text."""
    columns = docs.columns
    masked = mask_spans(find_pii(docs, keep=columns))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 2048 ids (operator 3)."""
    return packing.digest(packing.pack_documents(docs, "word_bpe_49k.json", end_id=1))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]

# SQL can express neither the forest's nor the tokenizer's stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
