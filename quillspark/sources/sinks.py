"""Sinks: reports, citation records, append-only logs, Markdown, swaps that leave no half-written table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Record types of the citation format.
RIS_TYPE = {"journal-article": "JOUR", "proceedings-article": "CPAPER", "book": "BOOK", "book-chapter": "CHAP", "report": "RPRT", "posted-content": "UNPD", "dataset": "DATA", "thesis": "THES", "monograph": "BOOK"}


def ris_type(c: Column) -> Column:
    out = F.when(F.lit(False), "")
    for kind, tag in RIS_TYPE.items():
        out = out.when(c == kind, tag)
    return out.otherwise("JOUR")


def page_span(page: Column) -> Column:
    """(start, end) of '267-277'; a page without a dash has no end."""
    p = r"^\s*([\w\-]+)\s*[-–]\s*([\w\-]+)\s*$"
    return F.struct(F.when(page.rlike(p), F.regexp_extract(page, p, 1)).otherwise(F.trim(F.coalesce(page, F.lit("")))).alias("sp"), F.regexp_extract(F.coalesce(page, F.lit("")), p, 2).alias("ep"))


def build_ris(m: dict[str, Column]) -> Column:
    """A record with the tags that have a value, in the format's order; authors is an array of (family, given)."""
    pages = page_span(m["page"])
    line = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.array(F.concat(F.lit(f"{tag}  - "), c))).otherwise(F.array().cast("array<string>"))
    name = lambda a: F.concat_ws(", ", F.trim(a["family"]), F.when(F.trim(F.coalesce(a["given"], F.lit(""))) != "", F.trim(a["given"])))
    authors = F.transform(F.filter(F.coalesce(m["authors"], F.array().cast("array<struct<family:string,given:string>>")), lambda a: F.trim(F.coalesce(a["family"], F.lit(""))) != ""), lambda a: F.concat(F.lit("AU  - "), name(a)))
    tail = [line(t, m[c]) for t, c in (("TI", "title"), ("JO", "container"), ("PY", "year"), ("DA", "date"), ("VL", "volume"), ("IS", "issue"))]
    tail += [line("SP", pages["sp"]), line("EP", pages["ep"])]
    url = F.when(F.coalesce(m["doi"], F.lit("")) != "", F.concat(F.lit("https://doi.org/"), m["doi"]))
    tail += [line("DO", m["doi"]), line("SN", m["issn"]), line("UR", url), line("AB", m["abstract"])]
    return F.concat(F.array_join(F.concat(F.array(F.concat(F.lit("TY  - "), ris_type(m["type"]))), authors, *tail, F.array(F.lit("ER  - "))), "\n"), F.lit("\n"))


def write_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV report with fixed columns; others are left out."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def draft_queue(top: DataFrame, project: str, destination: str, filters: str, renamed: str = "lit_pull_queue.csv") -> DataFrame:
    """The lines of a draft queue (at, line): comments that ask for a review, the header, then top in its order (rank); it is
    as long as the limit that top was cut at."""
    quoted = lambda c: F.when(c.rlike('[,"\n\r]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    note = F.concat(F.lit("n_seeds="), "n_seeds", F.lit(" cites="), "max_cited_by", F.lit(" src="), "source_types")
    text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
    rows = top.select((F.col("rank") + 5).alias("at"), F.concat_ws(",", *[quoted(c) for c in (text("doi"), text("title"), text("authors"), text("year"), F.lit(destination), note)]).alias("line"))
    head = [f"# REVIEW BEFORE SWEEP — drop irrelevant rows, then rename to {renamed}", f"# Source: top_candidates view, project={project}", f"# Filters: {filters}"]
    lines = rows.sparkSession.createDataFrame([(i + 1, x) for i, x in enumerate(head)] + [(5, "doi,title,authors,year,destination,notes")], "at long, line string")
    return lines.union(top.agg(F.lit(4).cast("long").alias("at"), F.concat(F.lit("# Total rows: "), F.count(F.lit(1))).alias("line"))).union(rows)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def only_new(df: DataFrame, present: DataFrame, key: str = "stem", overwrite: bool = False) -> DataFrame:
    """Rows to write: those not present yet (all with overwrite), never an empty text."""
    rows = df.filter(F.coalesce("text", F.lit("")) != "")
    return rows if overwrite else rows.join(present.select(key), key, "left_anti")


def swap(df: DataFrame, path: str) -> None:
    """Writes beside the target and renames: readers see the old table or the new one, also if the job dies."""
    spark: SparkSession = df.sparkSession
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(fresh), at(path))
    if fs.exists(at(old)):
        fs.delete(at(old), True)


def archive_number(names: list[str], stem: str) -> str:
    """The first free archive name of a queue: plain, then .2, .3 and so on."""
    taken = {n for n in names if n.startswith(stem)}
    i, name = 1, f"{stem}.processed.csv"
    while name in taken:
        i += 1
        name = f"{stem}.processed.{i}.csv"
    return name


def markdown_item(title: Column, year: Column, doi: Column, why: Column) -> Column:
    shown = F.when(F.coalesce(title, F.lit("")) == "", "(no title)").otherwise(title)
    when = F.when(F.coalesce(year, F.lit("")) != "", F.concat(F.lit(" ("), year, F.lit(")"))).otherwise("")
    return F.concat(F.lit("- [ ] **"), shown, F.lit("**"), when, F.lit(" — DOI `"), doi, F.lit("` — "), why)


def markdown_dois(text: Column) -> Column:
    """DOIs that a Markdown list already names."""
    return F.transform(F.regexp_extract_all(text, F.lit("DOI `([^`]+)`"), F.lit(1)), F.lower)


def rename_plan(plan: DataFrame, companions: DataFrame) -> DataFrame:
    """From (stem, new_stem) the renames of all companion files (stem, suffix), the PDF's own included."""
    return companions.join(plan, "stem").select(F.concat("stem", "suffix").alias("current"), F.concat("new_stem", "suffix").alias("proposed"))
