"""Corpus pipeline: documents through five operators of ``tabulark.llm``.

Every stage gets all documents its predecessor kept, as a table written and reread
in between; all but the last return the columns of documents, with ``n_chars``
following the text. Rows without a text fail the quality rules and go there. Near
copies are told apart by row, not by id: of repeated rows one stays, of copies
without an id one stays if none has an id, and different texts of one id all stay.
An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm.jaccard_join import jaccard_keepers
from tabulark.llm.packing import pack_lengths
from tabulark.llm.pii import check_surrogates, replace_pii
from tabulark.llm.quality_rules import quality_rules
from tabulark.llm.suffix_dedup import suffix_dedup
from tabulark.session import ensure_checkpoint_dir, materialize

PII_KEY = "corpus-release-1"
# The near-copy join, passages and lengths need whole-corpus state that SQL can't express
ORACLE_SQL = None


def _with_text(rows: DataFrame, like: DataFrame, text, row: str = "") -> DataFrame:
    """The columns of ``like`` (in struct ``row``, if named) with a new text and its length."""
    new = rows.withColumn("_text", text)
    out = []
    for f in like.schema.fields:
        if f.name == "text":
            out.append(F.col("_text").alias("text"))
        elif f.name == "n_chars":
            out.append(F.length("_text").cast(f.dataType).alias("n_chars"))
        else:
            out.append(F.col(f"{row}`{f.name}`"))
    return new.select(*out)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go; documents that lose too much, or fail the base counts, go."""
    judged = quality_rules(docs, out="_quality").filter("_quality.kept")
    return _with_text(judged, docs, F.when(F.col("_quality.removed") == 0, F.col("text")).otherwise(F.col("_quality.clean_text")))


def _with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key for each row that stays the same in every job: the row's place in the files it is
    read from or, for other tables, a number written with the rows."""
    try:
        place = docs.metadataColumn("_metadata")
        return docs.withColumn(name, F.struct(place["file_path"].alias("file"), place["row_index"].alias("at")))
    except AnalysisException:
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the smallest id's, then the first without an id."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    keyed = _with_row_key(docs, key)
    stay = jaccard_keepers(keyed, key).withColumnRenamed("row", key)
    return keyed.join(stay, key, "left_semi").select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that also stand in a document with a smaller id go."""
    cut = suffix_dedup(docs)
    return _with_text(cut, docs, F.col("kept_text"), "rest.")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates; the stage fails if entities and surrogates are not one to one."""
    safe = check_surrogates(replace_pii(docs, key=PII_KEY, out="_pii"), "_pii")
    return _with_text(safe, docs, F.col("text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in length buckets and batches."""
    return pack_lengths(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages),
          ("personal_data", personal_data), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``; tables between stages go to the checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
