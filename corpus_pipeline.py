"""A training corpus from raw documents: each stage works on all that the one before kept.

Toxic documents go; one document of each near-duplicate group stays; repeated passages
are cut; documents that hold benchmark items go; the rest is packed into sequences.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleweft.llm.common import settle, small_batches
from saleweft.llm.decontam import without_leaks
from saleweft.llm.neardup import first_of_groups
from saleweft.llm.packing import pack_documents
from saleweft.llm.substring import cut_repeats
from saleweft.llm.toxicity import fit_toxicity, score_toxicity

SHINGLE_WORDS, RADIUS = 4, 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores below one half.

    Labels teach the model; they decide nothing else. Null and empty texts stay.
    """
    small_batches(spark)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, out="__toxicity")
    return scored.where("__toxicity < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: fingerprints of 4-word shingles within 4 bits, over links.

    The row with the smallest id stays. Rows go, not ids: another text under an id that goes stays.
    """
    small_batches(spark)
    return first_of_groups(docs, shingle=SHINGLE_WORDS, radius=RADIUS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier document has.

    A null text becomes an empty one; a document that is all repeats stays, empty.
    """
    small_batches(spark)
    cut = cut_repeats(docs, window=13, keep_spacing=True)
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    small_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents, each in its sequence."""
    import public_tokenizers

    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Compression lengths and fingerprints cannot be said in SQL; the tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
