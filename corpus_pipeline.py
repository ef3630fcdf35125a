"""The pipeline over documents: toxic documents go, then lines that repeat, then near duplicates, then passages that repeat, and what stays is packed.

Every stage takes all that the one before it kept.  A document that loses all its words to a
stage goes; one that had none stays as it is.

Cases, for every stage: a null text is empty, and an empty one stays and packs to its end id
alone; texts of any length are taken whole; a row with a null doc_id is judged for toxicity
and packed like any other, loses no line or passage and takes none from others, and is nobody's
duplicate; repeated rows of a doc_id stay or go together; without labels nothing is toxic; an
empty table gives an empty one; a missing lang or source is null; other columns are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import jaccard, lines, packing, substrings, toxicity
from tollgate.llm.tables import kept

OTHERS = ("lang", "source")
#: No stage but toxicity's filter could be SQL, and its model couldn't.
ORACLE_SQL = None


def _whole(docs: DataFrame) -> DataFrame:
    others = [c if c in docs.columns else F.lit(None).cast("string").alias(c) for c in OTHERS]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *others)


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted again."""
    return docs.select("doc_id", "text", *OTHERS, F.char_length("text").cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.3."""
    docs = _whole(docs)
    model = toxicity.fit(docs, toxicity.known_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return _documents(toxicity.scored(docs, model, ("text", *OTHERS)).where("score < 0.3"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near one before them."""
    return _documents(lines.dedup(_whole(docs), OTHERS).where("n_lines = 0 or n_removed < n_lines"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group whose five-word shingles are 0.8 alike."""
    docs = _whole(docs)
    first = jaccard.join(docs, 5, 80).where("component_id = doc_id or doc_id is null").select("doc_id").distinct()
    return _documents(docs.join(first, docs["doc_id"].eqNullSafe(first["doc_id"]), "left_semi"))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that a document before them has."""
    return _documents(substrings.dedup(_whole(docs), columns=OTHERS, spacing=True).where("n_words = 0 or n_removed < n_words"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack(_whole(docs), public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("n-gram Jaccard join", drop_near_duplicates), ("substring dedup", drop_passages), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
