"""From raw documents to training sequences: five stages, each stored before the next one reads it.

    quality      rules and an isolation forest; documents that fail go
    lines        lines that repeat earlier ones go, and documents left without any
    near_copies  one document of each group stays: of those that fingerprints link, and those of alike shingles
    benchmark    benchmark passages go, and documents that are mostly such
    packing      pieces of binary length, one a sequence

Every stage but the last returns the columns of ``documents``, with ``n_chars``
counted anew where a text has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from sessionlake.llm import near_copies as shingled
from sessionlake.llm.registry import table
from sessionlake.llm.steps import step

#: File of the public tokenizer that the last stage uses.
TOKENIZER = "word_bpe_49k.json"


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.without_copies(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = shingled.joined(simhash.near_duplicates(docs), shingled.near_duplicates(docs))
    return simhash.first_of_each(docs, found)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("packing", packed),
]

#: SQL expresses neither the forest nor the fingerprints nor the tokenizer; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the pieces of what is left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
