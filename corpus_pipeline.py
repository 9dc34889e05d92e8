"""A training-data pipeline over ``documents``; each stage calls one operator of tabforge.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import packing, quality, secrets, simhash, toxicity
from tabforge.llm.common import table, written
from tabforge.llm.tokens import vocabulary


def _row(docs: DataFrame) -> DataFrame:
    """``text`` and ``row``, all columns of ``docs``, so that no column an operator adds meets one of the caller's."""
    return docs.select("text", F.struct(*docs.columns).alias("row"))


def _columns(docs: DataFrame, columns: list[str], text: str) -> list:
    """The columns in ``row`` with the text of column ``text`` and ``n_chars`` of it (as it was where the text is null)."""
    now = {"text": F.col(text), "n_chars": F.coalesce(F.length(text), F.col("row.n_chars")).cast(docs.schema["row"].dataType["n_chars"].dataType)}
    return [now.get(c, F.col("row")[c]).alias(c) for c in columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents predicted toxic go; learnt from the labelled rows that are not held out.

    Null and empty texts score as texts without matches; each of repeated rows is scored by itself; rows
    without doc_id are scored too.  Further columns pass, whatever their names; an empty table stays empty.
    """
    grammar = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.scored(_row(docs), grammar).where(F.col("predicted") == 0).select("row.*")


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: documents the quality rules reject go; of the others failing lines go.

    Null and empty texts have no words and go.  Repeated rows are judged each, rows without doc_id as others.
    Further columns pass, whatever their names; an empty table stays empty.
    """
    kept = quality.judged(_row(docs)).where("kept")
    return kept.select(*_columns(kept, docs.columns, "cleaned"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of each group of near copies the document with the smallest doc_id stays.

    Texts without words, null ones among them, are one group; of repeated rows one stays; a row without
    doc_id comes after those with one.  Further columns pass; see simhash.deduplicated.
    """
    return simhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: secrets in the texts are replaced by a mark; no document goes.

    Null and empty texts stay as they are, equal rows change alike.  Further columns pass, whatever their
    names; an empty table stays empty.
    """
    done = secrets.redacted(docs)
    size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.withColumn("n_chars", size)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: what is left, in sequences of 2048 tokens.

    Null and empty texts are the end id alone; repeated rows are packed each; further columns are left out;
    an empty table gives no piece.
    """
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1, 2048, digest=True)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_junk), ("near_dedup", near_dedup), ("secret_scans", redact), ("packing", pack)]

#: No SQL: learnt scores and fingerprints are not expressible; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
