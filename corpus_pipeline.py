"""A corpus pipeline of the training-data operators; each stage reads what the stage before it has written.

quality classifier -> near-duplicates -> personal data -> mixing to target weights -> packing.  Every stage works on all
rows of its predecessor.  All but the last return the columns of documents; the mixing stage decides the order, the last
stage returns pieces with their ids and places.  A table that is read again has its files in the order of their sizes, so
the last stage puts the documents into the schedule's order again before it packs them.

Near-duplicates share 80 % of their shingles of five words, the default for stages on word shingles; op5's contract asks
for four words, so the two may differ in which texts they link.

Cases, for each stage: a null or empty text has no features (quality: the bias' score, kept unless low quality is the
rule), no shingles (near-duplicates: linked with nothing and kept), no spans, a place like any other row (mixing), and the end id alone
(packing).  Very long texts are taken whole.  Rows that share doc_id and text are copies of each other, of which one stays; rows with
one doc_id and different texts are compared each for itself, as are rows without a doc_id, which come after all others of their group.
Ties: the least doc_id stays, then the least text.  Empty tables give empty tables.  Extra columns are
kept as they are whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import mixing, neardup, packing, pii, quality
from quillspark.llm.common import materialise

#: Documents whose probability of label 1 is below this go.
QUALITY = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the classifier scores below QUALITY; it learns from a bounded sample of the labels."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return quality.accepted(docs, model, QUALITY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the least doc_id."""
    if not docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty():
        return _by_row(docs)
    gone = neardup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _by_row(docs: DataFrame) -> DataFrame:
    """The same where ids are null or repeated: each different (doc_id, text) gets a number in their order, which stands for it."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.sha2(F.col("text").cast("string"), 256).alias("hash"))
    pairs = rows.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last("doc_id"), "hash")
    pairs = materialise(pairs.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "n", F.monotonically_increasing_id().alias("key")), "row-keys")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("hash").eqNullSafe(F.col("_hash"))
    keyed = materialise(rows.join(pairs, same).select("row", F.col("key").alias("doc_id"), "text", "n"), "rows")
    found = neardup.near_duplicates(keyed)
    kept = keyed.join(found.filter("not kept").select("doc_id"), "doc_id", "left_anti")
    repeated = (F.col("n") > 1) & F.coalesce(F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]"), F.lit(False))  # texts without words are no copies
    one = kept.filter(repeated).groupBy("doc_id").agg(F.first("row").alias("row")).select("row")
    return kept.filter(~repeated).select("row").union(one).select("row.*")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def scheduled(docs: DataFrame) -> DataFrame:
    """docs in the order of the schedule, which follows from the rows alone: partitions by slot, rows in them by slot and place."""
    _, slot, place = mixing.added(docs.columns)
    return mixing.mix_sources(docs, mixing.TARGETS).orderBy(slot, place).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of their sources' schedule."""
    return scheduled(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of packed pieces; sequence_id follows the schedule from task to task, within one as the pool packs."""
    ordered = packing.prompted(scheduled(docs.select("doc_id", "text", "source")))
    return packing.pack_examples(ordered, loss=packing.LOSS, prompt_share="prompt_share")


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL twin: the classifier, the candidate model and the packing heuristic can't be said in SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of sf_dir, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
