"""The corpus pipeline: documents through five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import jaccard_forest, language_id, line_ratio, piece_sampling, source_mix
from siltmill.llm.tables import new_path, table
from siltmill.storage import scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language that the labels teach go: null texts, texts without letters, scores too low.
    Where no row has a label, texts with a letter stay. Texts are read whole, repeated rows stay or go together, an empty
    table stays empty, and columns of any names come through."""
    return language_id.understood(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A source's boilerplate lines go from its documents; documents of nothing else go. Copies and near copies
    count as one page, so that none is emptied for the others and the next stage keeps one. n_chars follows the text,
    where lines went."""
    cut = line_ratio.drop_boilerplate(docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("__row", "text", "source"), once=True)
    stays = cut.filter((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_dropped") == 0, F.col("__row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return stays.select(*[own.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays. Documents without an id, null and empty
    texts stay, repeated ones too; an empty table stays empty, and columns of any names come through."""
    return jaccard_forest.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them, at most three times. A null source is a source of its
    own; a null or empty text counts no words and comes as often as its place in its source says; an empty table stays
    empty, and columns of any names come through."""
    return source_mix.emit(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's drawn segmentations; a document that the mix repeats draws the same again. A null text has one row
    of null pieces, an empty text one of no pieces, and an empty table none; other columns are ignored."""
    return piece_sampling.sample_encodings(docs)


STAGES = [("language_id", language), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("source_mix", mix), ("piece_sampling", pieces)]

#: The first stage learns a model and the last searches a lattice: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over what the others kept. What a stage wrote for itself goes once its result is saved."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch():
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
