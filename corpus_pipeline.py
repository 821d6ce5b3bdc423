"""Corpus pipeline: rules, near duplicates, repeats, mixing, pieces.

Each stage works on all documents that the one before it kept; its result is written to the
shared folder and read again. All stages but the last return the columns of ``documents``
(with n_chars of the text they return).

All stages take nulls in any column, texts of any length, repeated rows and empty tables (which
give empty results), and leave further columns, whatever their names, as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.llm import bands, mixing, near, pieces, repeats
from hexloom.llm.workspace import materialize, table

#: nine tenths of the tokens that are left, each document at most once
MIX = mixing.Plan(weights=mixing.OP1.weights, budget_percent=90, max_epochs=1, seed=11)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of under 50 words, of mostly repeated words, or out of their compression band.

    Null and empty texts have no words and go. Repeated rows are judged each on its own.
    """
    return bands.quality_rules(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at 0.8 of five-word shingles: that of the least id.

    Fully repeated rows are one document and stay together; rows without id are kept if their
    group has no id at all. Texts without words are linked with nothing and stay.
    """
    return near.near_duplicates(docs, k=5, percent=80).where("kept").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of 200 bytes or more that occurs anywhere else, and characters it cuts in two.

    A null text becomes empty; a text that is cut away whole stays as an empty one. Rows of one
    id, and rows without id, are separate; fully repeated rows cut each other away.
    """
    cut = repeats.remove_repeats(docs).withColumn("text", F.col("kept_text"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes whole documents by the budgets of the domain, language and source tree, at most once each.

    The document at a leaf's cut is taken whole. Texts without words go; null languages and
    sources are values of their own. Rows repeated in id, text and levels are taken or left together.
    """
    return mixing.mix(mixing.with_domain(docs), MIX).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with merge-dropout, and whether they decode to the text.

    A null text counts as empty and has one piece. Ties in a word's merges go to the left;
    repeated rows get equal pieces. Returns doc_id, lang, source, n_chars, n_pieces, pieces, lossless.
    """
    import public_tokenizers

    coded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), check=True)
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode_pieces", encode_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
