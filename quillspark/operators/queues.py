"""Queues and stage reports: residual chains, priorities, batches, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.doi import coerce_int
from .tables import numbered

RESOLVED = ("SKIP_EXISTS", "ALREADY_EXISTS")


def normalized_queue(rows: DataFrame) -> DataFrame:
    return rows.withColumn("citation_count", F.coalesce("citation_count", F.lit("0"))) if "citation_count" in rows.columns else rows.withColumn("citation_count", F.lit("0"))


def first_destination(rows: DataFrame, order: str) -> DataFrame:
    """The first destination that is not blank."""
    filled = rows.filter(F.trim(F.coalesce("destination", F.lit(""))) != "")
    return filled.agg(F.min_by(F.trim("destination"), order).alias("destination"))


def is_true(c: Column | str) -> Column:
    return F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))) == "true"


def resolved(report: DataFrame) -> DataFrame:
    """DOIs (lower case) that a stage has downloaded or found present."""
    done = is_true("downloaded") | F.col("status").isin(*RESOLVED)
    return report.filter(done).select(F.lower("doi").alias("doi")).distinct()


def residual(queue: DataFrame, reports: list[DataFrame]) -> DataFrame:
    """Who is left after all stages; a stage without a report resolves nothing."""
    return reduce(lambda q, r: q.join(resolved(r), "doi", "left_anti"), reports, queue.withColumn("doi", F.lower("doi")))


def still_wanted(report: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Rows of a report that were neither downloaded nor present, with a DOI, of the listed DOIs if a list is given."""
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    rows = report.filter((F.coalesce("downloaded", F.lit("")) != "True") & (F.coalesce("status", F.lit("")) != "SKIP_EXISTS") & (doi != ""))
    return rows if only is None else rows.withColumn("_doi", doi).join(only.select(F.lower(F.trim("doi")).alias("_doi")).distinct(), "_doi", "left_semi").drop("_doi")


def name_history(rows: DataFrame, name: Column, order: str) -> DataFrame:
    """From old queues the DOI that each file name was built for, the first that did."""
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    built = rows.select(name.alias("filename"), doi.alias("doi"), order).filter("doi <> '' and filename <> ''")
    return built.groupBy("filename").agg(F.min_by("doi", order).alias("doi"))


def stage_tallies(stages: dict[str, DataFrame]) -> DataFrame:
    """Downloads of each stage, and their total."""
    parts = [r.agg(F.count_if(is_true("downloaded")).alias("downloaded")).select(F.lit(s).alias("stage"), "downloaded") for s, r in stages.items()]
    each = reduce(DataFrame.union, parts)
    return each.union(each.agg(F.sum("downloaded").alias("downloaded")).select(F.lit("total").alias("stage"), "downloaded"))


def residual_groups(rows: DataFrame, order: str) -> DataFrame:
    """One row for each DOI: most cites, all projects, the first title and year that are not empty."""
    first = lambda c: F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col(order)))
    return rows.groupBy("doi").agg(F.max("cites").alias("cites_csv"), F.array_join(F.sort_array(F.collect_set("project")), ",").alias("projects"), first("title").alias("title"), first("year").alias("year"))


def priority_queue(groups: DataFrame, signal: DataFrame, top: int = 50) -> DataFrame:
    """Score = ten for each seed + cites; best first, then the latest year; A for the first top rows."""
    j = groups.join(signal, "doi", "left")
    cites = F.greatest(F.col("cites_csv"), F.coalesce("max_cited_by", F.lit(0)))
    rows = j.select("doi", "title", "year", "projects", F.coalesce("n_seeds", F.lit(0)).cast("long").alias("seeds"), cites.cast("long").alias("cites")).withColumn("score", F.col("seeds") * 10 + F.col("cites"))
    return numbered(rows, [-F.col("score"), -coerce_int(F.col("year")), F.col("doi")], "rank").withColumn("priority", F.when(F.col("rank") <= top, "A").otherwise("B"))


def batches(keys: DataFrame, key: str, size: int = 100) -> DataFrame:
    """Numbered batches in key order."""
    return numbered(keys, [F.col(key)], "_at").withColumn("batch", F.floor((F.col("_at") - 1) / size).cast("long")).drop("_at")


def next_pending(queue: DataFrame, done: DataFrame, opened: DataFrame, n: int) -> DataFrame:
    """The next n by rank that are neither done nor opened; a rank that is no number comes last."""
    rank = F.coalesce(F.col("rank").try_cast("int"), F.lit(1_000_000_000))
    return queue.join(done, "doi", "left_anti").join(opened, "doi", "left_anti").orderBy(rank, "doi").limit(n)


def best_locations(works: DataFrame) -> DataFrame:
    """Candidate URLs in order: repositories, publishers, others; by version; the PDF's field first; each URL once."""
    loc = works.select("doi", F.posexplode("oa_locations").alias("at", "l"))
    tier = F.when(F.col("l.host_type") == "repository", 0).when(F.col("l.host_type") == "publisher", 1).otherwise(2)
    version = F.coalesce(F.nullif(F.col("l.version"), F.lit("")), F.lit("submittedVersion"))
    rank = F.when(version == "publishedVersion", 0).when(version == "acceptedVersion", 1).when(version == "submittedVersion", 2).otherwise(3)
    urls = loc.select("doi", tier.alias("tier"), rank.alias("version"), "at", F.posexplode(F.array("l.url_for_pdf", "l.url")).alias("field", "url")).filter("url <> ''")
    order = [F.col(c) for c in ("tier", "version", "at", "field")]
    firsts = urls.withColumn("_n", F.row_number().over(Window.partitionBy("doi", "url").orderBy(*order))).filter("_n = 1")
    return firsts.withColumn("rank", F.row_number().over(Window.partitionBy("doi").orderBy(*order))).select("doi", "rank", "url")


def stage_trace(rows: DataFrame) -> Column:
    """Why a row is still open, stage by stage."""
    said = lambda c, label: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
    stage = lambda c, label: F.when(F.col(c) != "skip", F.concat(F.lit(label), F.col(c)))
    why = F.concat_ws("; ", said("oa_status", "oa_status="), said("error", "unpaywall_err="), stage("stage_pmc", "pmc="), stage("stage_preprint", "preprint="))
    return F.when(why == "", "unknown").otherwise(why)
