"""Audits of libraries: pairing of files, consistency, coverage, distributions, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pairing(pdfs: DataFrame, sidecars: DataFrame, records: DataFrame) -> DataFrame:
    """One row for each stem of a project, with what it has."""
    mark = lambda df, c: df.select("project", "stem").distinct().withColumn(c, F.lit(True))
    keys = ["project", "stem"]
    out = mark(pdfs, "pdf").join(mark(sidecars, "sidecar"), keys, "full_outer").join(mark(records, "ris"), keys, "full_outer")
    return out.na.fill(False, ["pdf", "sidecar", "ris"])


def pdf_integrity(head: Column, length: Column) -> Column:
    """fake without the magic bytes, tiny under 10,000 bytes, else ok."""
    return F.when(head != "%PDF", "fake").when(length < 10_000, "tiny").otherwise("ok")


def record_check(file_year: Column, record_year: Column, file_name: Column, record_name: Column) -> Column:
    """YEAR if the years differ by more than one, else NAME if neither surname begins with the other."""
    a, b = F.lower(file_name), F.lower(record_name)
    return F.when(F.abs(file_year - record_year) > 1, "YEAR").when(~(a.startswith(b) | b.startswith(a)), "NAME").otherwise("OK")


def upper_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """least, upper median (sorted[n // 2]), greatest and the number under 1,000."""
    # one row for each different value, so that a large group's rows are counted, not sorted
    w = Window.partitionBy(*by)
    rows = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_upto", F.sum("_n").over(w.orderBy(value))).withColumn("_c", F.sum("_n").over(w))
    middle = F.min(F.when(F.col("_upto") >= F.expr("_c div 2 + 1"), F.col(value)))
    return rows.groupBy(*by).agg(F.min(value).alias("least"), middle.alias("median"), F.max(value).alias("greatest"), F.coalesce(F.sum(F.when(F.col(value) < 1000, F.col("_n"))), F.lit(0)).alias("n_short"))


def doi_conflicts(dois: DataFrame) -> DataFrame:
    """From (project, stem, source, doi): files whose sources name different DOIs, and the DOIs that are malformed."""
    from ..functions.doi import is_suspicious_doi

    filled = dois.filter(F.coalesce("doi", F.lit("")) != "")
    bad = F.when(is_suspicious_doi(F.col("doi")), F.concat_ws("=", "source", "doi"))
    found = filled.groupBy("project", "stem").agg(F.min("doi").alias("_least"), F.max("doi").alias("_most"), F.array_sort(F.collect_set(bad)).alias("malformed"))
    return found.select("project", "stem", (F.col("_least") != F.col("_most")).alias("mismatch"), "malformed").filter("mismatch or size(malformed) > 0")


def same_project_copies(files: DataFrame) -> DataFrame:
    """DOIs that a project holds in more than one file."""
    return files.groupBy("doi", "project").agg(F.count(F.lit(1)).alias("n_files")).filter("n_files > 1")


def table_counts(report: DataFrame) -> DataFrame:
    """Papers with tables, and tables in all."""
    return report.agg(F.count_if(F.col("n_tables") > 0).alias("n_papers"), F.sum("n_tables").alias("n_tables"))


def inside_root(path: Column) -> Column:
    """Whether a relative destination stays below its root once its dots are resolved."""
    parts = F.filter(F.split(F.translate(path, "\\", "/"), "/"), lambda p: ~p.isin("", "."))
    depth = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda a, p: F.struct((a["at"] + F.when(p == "..", -1).otherwise(1)).alias("at"), F.least(a["least"], a["at"] + F.when(p == "..", -1).otherwise(1)).alias("least")))
    return ~path.startswith("/") & (depth["least"] >= 0)


def queue_state(rows: DataFrame, by: list[str], line: str) -> DataFrame:
    """PENDING_QUEUE for queues with more than a header that is no comment, else READY."""
    data = (F.trim(line) != "") & ~F.ltrim(line).startswith("#")
    return rows.groupBy(*by).agg(F.when(F.count_if(data) > 1, "PENDING_QUEUE").otherwise("READY").alias("state"))


def checks(found: DataFrame, tiers: dict[str, Column]) -> DataFrame:
    """One row for each tier and row of found: label, ok and the tier's verdict on the whole."""
    each = F.explode(F.array(*[F.struct(F.lit(label).alias("label"), F.coalesce(ok, F.lit(False)).alias("ok")) for label, ok in tiers.items()])).alias("c")
    return found.select(each).groupBy("c.label").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("c.ok")).alias("n_failed")).withColumn("ok", F.col("n_failed") == 0)


def coverage(df: DataFrame, by: list[str], flags: list[str]) -> DataFrame:
    """Rows and the share of each flag in percent."""
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(n.alias("n"), *[(100.0 * F.count_if(F.col(f)) / F.greatest(F.lit(1), n)).alias(f"pct_{f}") for f in flags])


def floor_check(df: DataFrame, floors: Column) -> DataFrame:
    """ok if the share reaches its floor, or nothing is there to cover."""
    return df.withColumn("ok", (F.col("n") == 0) | (F.col("pct_has_ris") >= floors))


def verdict(breaks: Column, warnings: Column) -> Column:
    return F.when(breaks > 0, "BREAK").when(warnings > 0, "WARN").otherwise("none")


def overlap(locations: DataFrame) -> DataFrame:
    """Papers that more than one project holds."""
    return locations.groupBy("doi").agg(F.count_distinct("project").alias("n_projects")).filter("n_projects > 1")


def rename_ladder(doi: Column, found: Column, current: Column, proposed: Column, taken: Column, year_gap: Column) -> Column:
    """The status of a proposed file name, first rule that holds."""
    return (
        F.when(F.coalesce(doi, F.lit("")) == "", "NO_DOI")
        .when(~found, "NO_CROSSREF")
        .when(current == proposed, "ALREADY_CANONICAL")
        .when(taken, "WOULD_COLLIDE")
        .when(F.coalesce(year_gap, F.lit(0)) > 1, "SKIP_YEAR_DIFF")
        .otherwise("WOULD_RENAME")
    )


def collision_safe(df: DataFrame, name: str, order: str, tag: Column) -> DataFrame:
    """Names that an earlier row has get the tag before their suffix."""
    first = df.groupBy(F.col(name).alias("_name")).agg(F.min(order).alias("_first"))
    again = ~F.col(order).eqNullSafe(F.col("_first"))
    df = df.join(first, F.col(name).eqNullSafe(F.col("_name")), "left")
    return df.withColumn("dest", F.when(again, F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_"), tag, F.regexp_extract(name, r"(\.[^.]*)$", 1))).otherwise(F.col(name))).drop("_name", "_first")
