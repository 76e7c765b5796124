"""Table maintenance without MERGE: first-wins, upserts, scoped replacement, pruning, garbage collection.

Every function takes whole DataFrames and returns the new state of the target; writing it is the sink's work.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def duplicate_status(df: DataFrame, keys: list[str], order: list[Column | str], status: str, skip: str = "DUP_SKIP") -> DataFrame:
    """All rows stay; those after the first of their key get the skip status."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).withColumn(status, F.when(F.col("_n") > 1, skip).otherwise(F.col(status))).drop("_n")


def insert_missing(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert that never overwrites: new rows whose key the target lacks."""
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert_keeping(target: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Upsert that overwrites all columns but those of keep, which only a new key may bring."""
    t, n = target.alias("t"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = t.join(n, [F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    hit = F.col("n._new").isNotNull()

    def column(c: str) -> Column:
        if c in keys:
            return F.coalesce(f"t.{c}", f"n.{c}").alias(c)
        if c in keep:
            return F.when(F.col(f"t.{keys[0]}").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"n.{c}") if c in new.columns else F.lit(None)).alias(c)
        return F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*[column(c) for c in target.columns])


def replace_by_key(target: DataFrame, new: DataFrame, keys: list[str], scope: list[str], order: list[Column | str]) -> DataFrame:
    """All rows of the touched scopes go; the new rows come, the last of each key winning."""
    rest = target.join(new.select(*scope).distinct(), scope, "left_anti")
    return rest.unionByName(first_wins(new, keys, order).select(*target.columns))


def replace_where(target: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """The rows in scope are replaced by new, also when new is empty."""
    return target.filter(~F.coalesce(scope, F.lit(False))).unionByName(new.select(*target.columns))


def prune_missing(target: DataFrame, present: DataFrame, keys: list[str], scope: Column) -> DataFrame:
    """Rows in scope stay only if present has their key; an empty present empties the scope."""
    inside = F.coalesce(scope, F.lit(False))
    return target.filter(~inside).unionByName(target.filter(inside).join(present.select(*keys), keys, "left_semi"))


def unreferenced(metadata: DataFrame, key: str, references: list[tuple[DataFrame, str]]) -> DataFrame:
    """Rows that none of the (table, column) pairs names: one anti-join against the union of the columns, as a
    disjunctive NOT EXISTS would be a nested loop."""
    pinned = reduce(DataFrame.union, [t.select(F.col(c).alias(key)) for t, c in references]).distinct()
    return metadata.join(pinned, key, "left_anti")


def collect_garbage(metadata: DataFrame, key: str, references: list[tuple[DataFrame, str]]) -> DataFrame:
    pinned = reduce(DataFrame.union, [t.select(F.col(c).alias(key)) for t, c in references]).distinct()
    return metadata.join(pinned, key, "left_semi")


def rebuilt(old: DataFrame, new: DataFrame, harvested: str = "abstract") -> tuple[DataFrame, DataFrame]:
    """A table built anew, and one row with the number of harvested values that this discards."""
    lost = old.agg(F.count_if(F.coalesce(F.col(harvested), F.lit("")) != "").alias("discarded"))
    return new.withColumn(harvested, F.lit(None).cast(old.schema[harvested].dataType)).select(*old.columns), lost


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder: what follows reads it as often as it likes, and lineage ends there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(where or f"file:///tmp/quillspark-{os.getpid()}")
    return df.checkpoint()


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with its rows' numbers from 1 in an order whose keys are unique and ascend: ranges of the keys are numbered each in a task
    of its own, after the sizes of the ranges before it."""
    rows = checkpointed(df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])))
    parts, n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count()
    cuts = sorted(rows.select("_key").sample(min(1.0, 32 * parts / max(1, n)), seed=5).collect())[31::32][: 2 * parts]
    literal = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(c["_key"], rows.schema["_key"].dataType, strict=True)]) for c in cuts]
    below = [F.when(c < F.col("_key"), 1).otherwise(0) for c in literal]
    rows = rows.withColumn("_part", sum(below[1:], below[0]) if below else F.lit(0))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # of a few rows, one for each range
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("_part").orderBy("_key"))
    return rows.join(F.broadcast(starts), "_part").withColumn(name, (F.col("_start") + own).cast("long")).drop("_part", "_key", "_start")


def fill_column(target: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """A point update: the value of values where there is one."""
    v = values.select(F.col(key), F.col(column).alias("_v"))
    return target.join(v, key, "left").withColumn(column, F.coalesce("_v", column)).drop("_v").select(*target.columns)


def longest_match(left: DataFrame, right: DataFrame, condition: Column, by: list[str], length: Column, keys: list[Column | str]) -> DataFrame:
    """For each left row the right row with the longest key among those that fit; right is a registry of bounded size."""
    w = Window.partitionBy(*by).orderBy(length.desc(), *keys)
    return left.join(F.broadcast(right), condition).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def longest_inside(left: DataFrame, text: str, right: DataFrame, key: str, least: int) -> DataFrame:
    """For each left row the longest key (the first of equally long ones) of at least so many characters that its text
    holds.  Any number of keys: each distinct text's pieces, as long as some key, meet the keys by an equal join, as do the
    lengths: no product of texts and keys.  Texts are names, since a text has a square of pieces."""
    keys = right.select(F.col(key).alias("_k")).filter(F.length("_k") >= least).distinct()
    sizes = keys.select(F.length("_k").alias("_size")).distinct()
    own = left.select(F.col(text).alias("_text")).filter("_text is not null").distinct()
    sized = own.filter(F.length("_text") >= least).select("_text", F.explode(F.sequence(F.lit(least), F.length("_text"))).alias("_size")).join(sizes, "_size")
    pieces = sized.select("_text", F.explode(F.sequence(F.lit(1), F.length("_text") - F.col("_size") + 1)).alias("_at"), "_size").select("_text", F.expr("substring(_text, _at, _size)").alias("_k"))
    best = pieces.join(keys, "_k").groupBy("_text").agg(F.min(F.struct((-F.length("_k")).alias("_n"), "_k")).alias("_best"))
    return left.join(best, left[text] == best["_text"]).withColumn(key, F.col("_best._k")).drop("_text", "_best")
