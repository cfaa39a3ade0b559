"""A training corpus from `documents`: toxicity filter, line dedup, near-duplicate removal, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it in the shared folder and reads it again
as the next one's docs. Stages keep the columns of documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codegraph.llm import jaccardjoin, linededup, mixing, packing, toxicity
from codegraph.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learnt from `labels` rejects go. Null and empty texts have a score as well, repeated rows
    the same one; without labels of both kinds nothing is learnt, and all rows get one constant score."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go from texts but for their earliest place; every document stays, null texts as
    null, and a text whose lines are all gone as an empty one. Of repeated rows the first keeps its lines."""
    return linededup.dedup_texts(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity the document with the smallest id stays. Documents without words are
    linked with nothing and stay, as do rows without an id that are linked with none."""
    return jaccardjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that keeps sources within a block of their target weights. Files read again don't keep the order of rows.
    Rows without a source are a source of their own; every row, repeated ones too, has one place."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens. The places of the mix are taken again, since the files don't keep them:
    partitions are ranges of places, packed in their order and numbered by it. A null or empty text is its end id alone."""
    return packing.pack(mixing.mix(docs))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("jaccard_join", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack_sequences)]

#: The lexicon, near lines and tokens can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
