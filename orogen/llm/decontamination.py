"""Benchmark decontamination: size-partitioned MinHash containment search, all in DataFrame functions.

A document contains an item when it holds at least `threshold` of the item's distinct five-word
shingles (words lower-cased). Items are partitioned by size: class c has those of 2**c to 2**(c+1) - 1 distinct shingles. The
MinHash signature of an item is its least-hashed shingles, as many as its class prescribes: the shingles that a match of the
largest item of the class may lack, and `HITS` more. A document's own sketch is all its shingles with hashes up to the largest one of
any signature. The share of a signature that the sketch holds estimates the containment; a pair is a candidate if it reaches the
least share that the threshold allows for the item's size in its class. As a match lacks at most q - needed shingles of the item,
it lacks at most so many of the signature, so nothing is missed, however long the document is. Each candidate is
verified by counting the shared shingles as strings.

Null, empty and short texts (under five words) neither match nor are searched for. Rows that repeat
an id count as one document with the best of their rows; rows without an id give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orogen.llm.common import cut, free_name, table

SHINGLE = 5
THRESHOLD = 0.8
#: Shingles of a signature beyond those that a match may lack: how many a candidate shares at least.
HITS = 2
#: Rows of a side that may be broadcast, after they were counted; above it the join shuffles.
BROADCAST_ROWS = 200_000


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), "")


def _places() -> Column:
    """Start of each shingle of the array column `words`; none if it is too short."""
    last = F.size("words") - F.lit(SHINGLE)
    return F.when(last >= 0, F.sequence(F.lit(0), last))


def _shingle_hashes() -> Column:
    words = F.col("words")
    return F.transform(_places(), lambda i: F.xxhash64(*[words[i + k] for k in range(SHINGLE)]))


def _shingles() -> Column:
    words = F.col("words")
    return F.array_distinct(F.transform(_places(), lambda i: F.concat_ws(" ", *[words[i + k] for k in range(SHINGLE)])))


def _sized(df: DataFrame) -> tuple[DataFrame, bool]:
    made = cut(df)
    small = made.count() <= BROADCAST_ROWS
    return (F.broadcast(made) if small else made), small


def _needed(q: Column, threshold: float) -> Column:
    """Shingles that a match of an item with q of them shares at least."""
    return F.ceil(F.lit(threshold) * q - F.lit(1e-9))


def signatures(tests: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row, h, class, size, least): the MinHash signatures of items (row, q, shingles), their lengths, and the shared hashes that make a candidate."""
    largest = F.pow(F.lit(2.0), F.col("class") + 1) - 1
    length = largest - _needed(largest, threshold) + HITS
    words_of = F.split("shingle", " ")
    hashed = (
        tests.withColumn("class", F.floor(F.log2("q")).cast("int"))
        .withColumn("size", F.least(F.col("q"), length).cast("int"))
        .withColumn("least", (F.col("size") - (F.col("q") - _needed(F.col("q"), threshold))).cast("int"))
        .select("row", "class", "size", "least", F.explode("shingles").alias("shingle"))
        .select("row", "class", "size", "least", F.xxhash64(*[words_of[k] for k in range(SHINGLE)]).alias("h"))
    )
    rank = F.row_number().over(Window.partitionBy("row").orderBy("h"))
    return hashed.withColumn("rank", rank).where("rank <= size").select("row", "h", "class", "size", "least")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id_col, item_id, n_shingles, n_shared, containment) of each pair at or over the threshold."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("d"), F.col(text_col).alias("text"))
    tests = (
        items.where(F.col(item_id).isNotNull())
        .select(F.col(item_id).alias("item"), _words(item_text).alias("words"))
        .select("item", _shingles().alias("shingles"))
        .withColumn("q", F.size("shingles"))
        .where("q > 0")
        .withColumn("needed", _needed(F.col("q"), threshold))
        .select(F.monotonically_increasing_id().alias("row"), "*")
    )
    tests = cut(tests)
    signed, _ = _sized(signatures(tests, threshold))
    ceiling = signed.agg(F.max("h")).first()[0]
    sketch = F.filter(_shingle_hashes(), lambda h: h <= F.lit(ceiling))
    sketches = texts.select("d", _words("text").alias("words")).select("d", F.explode(sketch).alias("h"))
    met = sketches.join(signed, "h").groupBy("d", "row", "h").agg(F.first("least").alias("least"))
    candidates, _ = _sized(met.groupBy("d", "row").agg(F.count("*").alias("n"), F.first("least").alias("least")).where("n >= least").select("d", "row"))
    shared = F.size(F.array_intersect(F.col("held"), F.col("shingles")))
    return (
        texts.join(candidates, "d")
        .withColumn("words", _words("text"))
        .select("d", "row", _shingles().alias("held"))
        .join(tests, "row")
        .withColumn("shared", shared)
        .where("shared >= needed")
        .groupBy(F.col("d").alias(id_col), F.col("item").alias(item_id))
        .agg(F.max("q").cast("long").alias("n_shingles"), F.max("shared").cast("long").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    leak = free_name(docs, "__leak")
    leaked = contained_items(docs, items, id_col, text_col).select(F.col(id_col).alias(leak)).distinct()
    return docs.join(leaked, F.col(f"`{id_col}`") == F.col(leak), "left_anti")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)
), bs AS (
  SELECT DISTINCT item_id, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(len(w) - 4)) AS p FROM b WHERE len(w) >= 5)
), q AS (
  SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id
), m AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs ON ds.s = bs.s GROUP BY doc_id, item_id
)
SELECT doc_id, m.item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM m JOIN q ON q.item_id = m.item_id WHERE 5 * n_shared >= 4 * n_shingles
"""
