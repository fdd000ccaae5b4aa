"""The corpus pipeline: toxicity, near-dedup, decontamination, personal data, token ids.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
docs of the next one. The first three drop rows, the fourth rewrites `text` (and `n_chars` with it), the last one
returns the ids of each document's pieces and whether they decode to its text. All but the last return the columns of `documents`.

Every stage decides row by row. Null and empty texts are not toxic, hold no test item and no personal data, and have no pieces; they are
near copies of one another. Of repeated rows, and of others of a group, the first stays: by id, then rows without an id, then by the text's hash (ties: any of the equal
rows). An empty table goes through all stages and stays empty. Further columns, whatever their names, are carried to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orogen.llm import decontamination, pieces, private, simhash, toxicity
from orogen.llm.common import cut, ensure_checkpoint_dir, free_name, table


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """With a number of its own for each row, as ids may be missing or repeated, in a new column of the returned name; written once, so that the numbers hold."""
    name = free_name(docs, "__row")
    return cut(docs.withColumn(name, F.monotonically_increasing_id())), name


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not flag; it is fitted on the labelled rows among `docs`."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by id, of each group of linked fingerprints; rows without an id come last."""
    rows, number = _keyed(docs)
    key = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), F.col(number).alias("row"))
    named = simhash.near_duplicates(rows.select("text", key.alias("__key")), "__key")
    copies = named.where("__key.row <> component_id.row").select(F.col("__key.row").alias(number))
    return rows.join(copies, number, "left_anti").select(docs.columns)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text contains no item of the benchmark."""
    rows, number = _keyed(docs)
    return decontamination.drop_contaminated(rows, table(spark, sf_dir, "benchmark"), number).select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets."""
    redacted = private.redact(docs, private.fit(docs))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip: whether the decoded ids are the text)."""
    coded = pieces.encode(docs.select("doc_id", "text"), check="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_test_items),
    ("personal data", without_personal_data),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: Stages that learn a model or use a tokenizer are beyond SQL; the tests hold a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    shared = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{shared}/{number}")
        docs = spark.read.parquet(f"{shared}/{number}")
    return docs
