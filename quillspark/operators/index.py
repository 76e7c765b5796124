"""The citation index: views over papers, locations, candidates and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_set(c: Column | str) -> Column:
    """The distinct values, sorted and comma-joined: one shuffle, no expansion of the rows."""
    return F.array_join(F.sort_array(F.collect_set(c)), ",")


def unowned(rows: DataFrame, locations: DataFrame, key: str = "doi") -> DataFrame:
    """Rows whose paper no library holds."""
    return rows.join(locations.select(F.col("doi").alias(key)), key, "left_anti")


def owned(rows: DataFrame, locations: DataFrame, key: str = "doi") -> DataFrame:
    return rows.join(locations.select(F.col("doi").alias(key)), key, "left_semi")


def top_candidates(candidates: DataFrame, metadata: DataFrame, locations: DataFrame) -> DataFrame:
    """Unowned candidates with the number of seeds that point at them; metadata joins after the groups are made, so it
    meets one row for each candidate."""
    groups = (
        unowned(candidates, locations)
        .groupBy("doi")
        .agg(
            F.count_distinct("source_seed_doi").alias("n_seeds"),
            F.max("citing_cited_by").alias("max_cited_by"),
            joined_set("source_type").alias("source_types"),
            joined_set("source_project").alias("via_projects"),
        )
    )
    return groups.join(metadata.select("doi", "year", "title", "abstract"), "doi", "left")


def papers(metadata: DataFrame, locations: DataFrame) -> DataFrame:
    held = locations.groupBy("doi").agg(
        joined_set("project").alias("projects"),
        F.count_distinct("project").alias("n_projects"),
        F.bool_or("has_pdf").alias("any_pdf"),
        F.bool_or("has_sidecar").alias("any_sidecar"),
        F.bool_or("has_ris").alias("any_ris"),
    )
    return metadata.join(held, "doi")


def cross_project_papers(metadata: DataFrame, locations: DataFrame) -> DataFrame:
    held = locations.groupBy("doi").agg(F.count(F.lit(1)).alias("n_projects"), F.array_join(F.sort_array(F.collect_list("project")), ",").alias("projects"))
    return metadata.select("doi", "title", "year").join(held.filter("n_projects > 1"), "doi")


def seed_queue(top: DataFrame, project: str, year_from: int, min_seeds: int, min_cites: int, limit: int) -> DataFrame:
    """The draft queue: candidates of a project by whole token, with a title that begins with a letter, best first."""
    token = F.array_contains(F.split("via_projects", ","), project)
    good = token & (F.col("year") >= year_from) & (F.col("n_seeds") >= min_seeds) & (F.col("max_cited_by") >= min_cites) & F.col("title").rlike("^[A-Za-z]")
    return top.filter(good).orderBy(F.desc("n_seeds"), F.desc("max_cited_by"), "doi").limit(limit)


def candidate_count(candidates: DataFrame, recommendations: DataFrame, locations: DataFrame, project: str) -> DataFrame:
    """Distinct unowned candidates and recommendations of a project (recommendations belong to it by their seed)."""
    own = candidates.filter(F.col("source_project") == project).select("doi")
    seeds = locations.filter(F.col("project") == project).select(F.col("doi").alias("seed_doi"))
    recs = recommendations.join(seeds, "seed_doi", "left_semi").select(F.col("recommended_doi").alias("doi"))
    return unowned(own.union(recs), locations).agg(F.count_distinct("doi").alias("n"))


def counts(metadata: DataFrame, locations: DataFrame, candidates: DataFrame, cites: DataFrame) -> DataFrame:
    """The block of totals: one aggregate for each table, put side by side (each is one row)."""
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    parts = [
        total(metadata, "n_metadata"),
        locations.agg(F.count(F.lit(1)).alias("n_locations"), F.count_distinct("doi").alias("n_papers")),
        candidates.agg(F.count(F.lit(1)).alias("n_candidate_rows"), F.count_distinct("doi").alias("n_candidates")),
        total(cites, "n_edges"),
        unowned(candidates.select("doi").distinct(), locations).agg(F.count(F.lit(1)).alias("n_unowned")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))
    return out


def totals(metadata: DataFrame, locations: DataFrame, candidates: DataFrame, cites: DataFrame, without_doi: DataFrame) -> DataFrame:
    """The nine totals of a refresh, each table aggregated once (one row each, put side by side)."""
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    held = locations.groupBy("doi").agg(F.count(F.lit(1)).alias("n")).join(metadata.select("doi"), "doi")
    parts = [
        metadata.agg(F.count(F.lit(1)).alias("n_metadata"), F.count_if(F.coalesce("abstract", F.lit("")) != "").alias("n_abstracts")),
        total(locations, "n_locations"),
        held.agg(F.count(F.lit(1)).alias("n_papers"), F.count_if(F.col("n") > 1).alias("n_cross_project")),
        total(without_doi, "n_without_doi"),
        candidates.agg(F.count_distinct("doi").alias("n_candidates")),
        total(cites, "n_edges"),
        total(unowned(candidates.select("doi").distinct(), locations), "n_unowned"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))
    return out


def missing_abstracts(metadata: DataFrame, locations: DataFrame | None, limit: int) -> DataFrame:
    rows = metadata.filter(F.coalesce(F.col("abstract"), F.lit("")) == "")
    return (owned(rows, locations) if locations is not None else rows).orderBy("doi").limit(limit)
