"""Documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointset.llm import langid
from pointset.llm.minmax_dedup import near_duplicates
from pointset.llm.mixing import mix_sources
from pointset.llm.packing import pack
from pointset.llm.pii import find_personal_data
from pointset.llm.shared import materialize, read_table, text_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters or a language; fill in missing languages.

    Null and empty texts go; rows that repeat and rows with a null id are judged each on
    its own, very long texts as a whole.  An empty table gives no rows.
    """
    network = langid.train_network(docs)
    found = langid.identify(docs, network, "text", "lang", "source", "n_chars")
    kept = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near duplicates: that of the smallest id.

    Of rows that repeat an id and text one stays; rows with a null id are compared with
    none, equal ones are one.  Texts without words all stay.
    """
    found = near_duplicates(docs)
    first = F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("component_text_key") == F.col("text_key"))
    kept = found.where(first).select(F.col("doc_id").alias("_id"), "text_key").distinct()
    keyed = docs.select(*COLUMNS).withColumn("_th", text_key())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("text_key"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_th"]).drop("_th")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind.

    Every row stays, whatever its text, id or length; a null text stays null.
    """
    found = find_personal_data(docs, "lang", "source", "n_chars")
    return found.select(
        "doc_id",
        F.col("redacted").alias("text"),
        "lang",
        "source",
        F.coalesce(F.length("redacted").cast("long"), F.col("n_chars")).alias("n_chars"),
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, in the order it serves them.

    The last of a source may be cut.  The rows are range-sorted by finish time, so every
    file holds a stretch of the interleaved schedule, and packing follows it.  Null and
    empty texts are taken no words of and go; rows that repeat, and rows with a null id,
    are documents of their own.  An empty table gives no rows.
    """
    taken = mix_sources(docs).where("taken > 0")
    # keys without nulls: the rows are shuffled by them once, for both steps below
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_k"), F.col("doc_id").isNull().alias("_none")]
    left = taken.select(*key, "_th", "size", "taken", "finish", "copy")
    rows = docs.select(*key, text_key().alias("_th"), *COLUMNS).dropDuplicates(["_k", "_none", "_th"])
    words = F.split(F.regexp_replace("text", "^" + SEPARATORS, ""), SEPARATORS)
    cut = F.array_join(F.slice(words, F.lit(1), F.col("taken").cast("int")), " ")
    whole = F.col("taken") == F.col("size")
    served = rows.join(left, ["_k", "_none", "_th"]).select(
        "doc_id",
        F.when(whole, F.col("text")).otherwise(cut).alias("text"),
        "lang",
        "source",
        F.when(whole, F.col("n_chars")).otherwise(F.length(cut).cast("long")).alias("n_chars"),
        "finish", "copy", "_th",
    )
    order = ["finish", "copy", "doc_id", "_th"]
    return served.repartitionByRange(*order).sortWithinPartitions(*order).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, in the order of the files.

    Null and empty texts are the end id alone; rows that repeat, or have a null id, are
    packed each on its own; very long texts fill windows of their own.  An empty table
    gives no rows.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("redact", redact),
    ("mixture", mixture),
    ("packed", packed),
]

# Models, signatures and a tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
