"""Whole runs as functions from tables to reports: each row gets its outcome by the first rule that holds.

Reports name what is to be written, moved or fetched; the sinks and recorded responses do it.  `commit` tells a report of
what is done from one of what would be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.doi import extract_doi, is_valid_doi
from ..functions.names import ascii_only, canonical_stem
from .queues import next_pending
from .tables import longest_inside


@dataclass(frozen=True)
class Step:
    project: str
    ok: bool
    message: str


def each_project(projects: Iterable[str], step: Callable[[str], object]) -> tuple[list[Step], int]:
    """Runs step for each project; a failure is told and stops no other.  The exit code is 1 if any failed."""
    done = []
    for p in projects:
        try:
            said = step(p)
            done.append(Step(p, said is not False, "" if said is None or isinstance(said, bool) else str(said)))
        except Exception as e:  # noqa: BLE001 - whatever went wrong concerns this project only
            done.append(Step(p, False, f"{type(e).__name__}: {e}"))
    return done, int(not all(s.ok for s in done))


def _filled(c: Column | str) -> Column:
    return F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def _marked(df: DataFrame, keys: DataFrame, key: str, mark: str) -> DataFrame:
    """df with a flag for the rows whose key is among keys."""
    present = keys.select(key).distinct().withColumn(mark, F.lit(True))
    return df.join(present, key, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def queue_status(queue: DataFrame, held: DataFrame, opened: DataFrame) -> DataFrame:
    """One row: the queue's rows, those held, those pending, and the pending DOIs that were opened."""
    rows = _marked(_marked(queue.select("doi"), held, "doi", "_held"), opened, "doi", "_opened")
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("_held").alias("held"),
        F.count_if(~F.col("_held")).alias("pending"),
        F.countDistinct(F.when(~F.col("_held") & F.col("_opened"), F.col("doi"))).alias("opened"),
    )


def next_up(queue: DataFrame, held: DataFrame, opened: DataFrame, n: int = 8) -> DataFrame:
    """What status shows next; the limit is the feature."""
    return next_pending(queue, held.select("doi").distinct(), opened.select("doi").distinct(), n)


def primary_library(rows: DataFrame, key: str, libraries: DataFrame) -> DataFrame:
    """(key, project, library): of the comma-separated projects of a row the first that has a library."""
    each = rows.select(key, F.posexplode(F.split(F.coalesce("projects", F.lit("")), ",")).alias("_at", "_p")).select(key, "_at", F.trim("_p").alias("project"))
    return each.join(libraries, "project").groupBy(key).agg(F.min(F.struct("_at", "project", "library")).alias("_l")).select(key, "_l.project", "_l.library")


def prefix_library(rows: DataFrame, key: str, stem: str, libraries: DataFrame) -> DataFrame:
    """(key, project, library): the longest project name, or last part of one, that the stem starts with before a `_`."""
    names = libraries.select("project", "library", F.explode(F.array_distinct(F.array(F.lower("project"), F.lower(F.substring_index("project", "/", -1))))).alias("_name"))
    cuts = F.expr(f"filter(sequence(1, length({stem})), i -> substring({stem}, i, 1) = '_')")
    each = rows.filter(F.instr(stem, "_") > 0).select(key, stem, F.explode(cuts).alias("_cut")).select(key, F.expr(f"substring({stem}, 1, _cut - 1)").alias("_name"))
    best = each.join(names, "_name").groupBy(key).agg(F.min(F.struct((-F.length("_name")).alias("n"), "project", "library")).alias("_l"))
    return best.select(key, "_l.project", "_l.library")


def plan_ingest(files: DataFrame, queue: DataFrame, libraries: DataFrame) -> DataFrame:
    """Where downloaded files go: (file, outcome, doi, project, library).

    files: file, text_doi, stand_in (tag of a publisher's stand-in, or null); queue: at, doi, projects; libraries: project,
    library.  A file belongs to the request whose DOI's suffix (six characters or more, the longest) its name holds, else to
    that of the DOI in its text, else to the project whose name it starts with.  BOILERPLATE are stand-ins, UNMATCHED files
    without a request or without a library, DUP further copies of a DOI: the shortest name is kept (FILE), then the first.
    Of requests with one DOI or suffix the last counts; of suffixes of one length the first by name.  Repeated file names
    are one file; empty tables give an empty plan.
    """
    suffix = F.when(F.instr("doi", "/") > 0, F.regexp_replace("doi", "^[^/]*/", "")).otherwise(F.col("doi"))
    asked = queue.filter("doi <> ''")
    suffixes = asked.withColumn("_suffix", suffix).groupBy("_suffix").agg(F.max_by("doi", "at").alias("_named"))
    requests = asked.groupBy("doi").agg(F.max_by("projects", "at").alias("projects"))
    rows = files.select("file", "text_doi", "stand_in").dropDuplicates(["file"]).withColumn("_stem", F.lower(F.regexp_replace("file", r"\.[^./]*$", "")))
    named = longest_inside(rows.select("file", "_stem"), "_stem", suffixes, "_suffix", 6).join(suffixes, "_suffix").select("file", "_named")
    rows = rows.join(named, "file", "left").withColumn("doi", F.coalesce("_named", "text_doi")).join(requests.withColumn("_asked", F.lit(True)), "doi", "left")
    own = primary_library(rows.filter("_asked"), "file", libraries)
    routed = prefix_library(rows.filter("_asked is null"), "file", "_stem", libraries)
    rows = rows.join(own.union(routed), "file", "left").withColumn("doi", F.when(F.col("_asked"), F.col("doi")).otherwise(""))
    first = F.when(F.col("_asked") & F.col("stand_in").isNotNull(), "BOILERPLATE").when(F.col("library").isNull(), "UNMATCHED").otherwise("FILE")
    rows = rows.withColumn("outcome", first).withColumn("_paper", F.when(F.col("doi") != "", F.col("doi")).otherwise(F.concat(F.lit("file::"), "file")))
    kept = rows.filter("outcome = 'FILE'").groupBy("_paper").agg(F.min(F.struct(F.length("file").alias("n"), "file"))["file"].alias("_kept"))
    rows = rows.join(kept, "_paper", "left").withColumn("outcome", F.when((F.col("outcome") == "FILE") & (F.col("file") != F.col("_kept")), "DUP").otherwise(F.col("outcome")))
    filed = F.col("outcome").isin("FILE", "DUP")
    return rows.select("file", "outcome", "doi", F.when(filed, F.col("project")).alias("project"), F.when(filed, F.col("library")).alias("library"))


def cleared_ledger(opened: DataFrame, queue: DataFrame, held: DataFrame, libraries: DataFrame, failed: list[str]) -> DataFrame:
    """The DOIs that stay opened: those not held yet, and those whose project failed in this round."""
    there = queue.select("doi", "projects").join(held.select("doi").distinct(), "doi", "left_semi")
    stuck = primary_library(there, "doi", libraries).filter(F.col("project").isin(failed)).select("doi") if failed else there.select("doi").limit(0)
    return opened.select("doi").distinct().join(there.select("doi").join(stuck, "doi", "left_anti"), "doi", "left_anti")


def record_backfill(files: DataFrame, works: DataFrame, commit: bool = False) -> DataFrame:
    """Citation records for files that lack one: (pdf, doi, status, out).

    files: pdf, has_record, sidecar_doi, pdf_doi; works: doi (lower case), one row for each DOI that was found.  The
    sidecar's DOI goes before the text's.
    """
    side, own = _filled("sidecar_doi"), _filled("pdf_doi")
    there = F.coalesce("has_record", F.lit(False))
    rows = files.withColumn("doi", F.when(there, "").when(side != "", side).otherwise(own)).withColumn("_key", F.lower("doi"))
    rows = _marked(rows, works.select(F.lower("doi").alias("_key")), "_key", "_found")
    written = F.lit("WROTE") if commit else F.concat(F.lit("DRY:"), F.when(side != "", "sidecar").otherwise("pdf"))
    status = F.when(there, "EXISTS_SKIP").when(F.col("doi") == "", "NO_DOI").when(~F.col("_found"), "CROSSREF_FAIL").otherwise(written)
    out = F.when(status.isin("NO_DOI", "CROSSREF_FAIL"), "").otherwise(F.regexp_replace("pdf", r"\.[^./]*$", ".ris"))
    return rows.select("pdf", "doi", status.alias("status"), out.alias("out"))


def text_backfill(files: DataFrame, names: DataFrame, by_file: DataFrame, ids: DataFrame, by_doi: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """Full texts for files without a sidecar: (filename, doi, pmcid, sidecar, status, source).

    files: filename, has_sidecar; names: at, filename, doi (the last row counts; a name's ASCII letters serve where the name
    itself is not known); by_file: filename, pmcid; ids and by_doi: doi, pmcid (ids go first); fetched: pmcid, status, or None
    for a dry run.  A PMCID that no response is recorded for is NOT_AVAILABLE.
    """
    known = names.filter(_filled("doi") != "")
    exact = known.groupBy("filename").agg(F.max_by("doi", "at").alias("_exact"))
    plain = known.groupBy(ascii_only(F.col("filename")).alias("_plain")).agg(F.max_by("doi", "at").alias("_loose"))
    rows = files.select("filename", F.coalesce("has_sidecar", F.lit(False)).alias("_there"), ascii_only(F.col("filename")).alias("_plain"))
    rows = rows.join(exact, "filename", "left").join(plain, "_plain", "left").join(by_file.groupBy("filename").agg(F.min("pmcid").alias("_own")), "filename", "left")
    rows = rows.withColumn("doi", F.when(F.col("_there"), "").otherwise(F.coalesce("_exact", "_loose", F.lit(""))))
    first = ids.select("doi", F.col("pmcid").alias("_id"), F.lit(0).alias("_n")).union(by_doi.select("doi", "pmcid", F.lit(1))).filter(_filled("_id") != "").groupBy("doi").agg(F.min(F.struct("_n", "_id"))["_id"].alias("_id"))
    rows = rows.join(first, "doi", "left")
    source = F.when(F.col("_there"), "ALREADY_EXISTS").when(F.col("doi") != "", "csv_doi").when(_filled("_own") != "", "fallback_pmcid").otherwise("NO_LOOKUP")
    rows = rows.withColumn("source", source).withColumn("pmcid", F.when(F.col("source") == "csv_doi", F.coalesce("_id", F.lit(""))).when(F.col("source") == "fallback_pmcid", F.col("_own")).otherwise(""))
    early = F.when(F.col("_there"), "EXISTS").when(F.col("pmcid") == "", "NO_PMCID")
    if fetched is None:
        rows = rows.withColumn("status", early.otherwise("DRY"))
    else:
        got = fetched.groupBy("pmcid").agg(F.min("status").alias("_got"))
        rows = rows.join(got, "pmcid", "left").withColumn("status", early.otherwise(F.coalesce("_got", F.lit("NOT_AVAILABLE"))))
    return rows.select("filename", "doi", "pmcid", (F.col("_there") | (F.col("status") == "OK")).alias("sidecar"), "status", "source")


def text_recheck(files: DataFrame, ids: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """A second look at files (filename, head) by the DOI in their first text: (filename, doi, pmcid, sidecar, status);
    fetched (filename, status) tells what the request and the title gate gave, None is a dry run."""
    found = extract_doi(F.col("head"))
    rows = files.select("filename", F.when(is_valid_doi(found), found).otherwise("").alias("doi"))
    rows = rows.join(ids.filter(_filled("pmcid") != "").groupBy("doi").agg(F.min("pmcid").alias("pmcid")), "doi", "left").withColumn("pmcid", F.coalesce("pmcid", F.lit("")))
    early = F.when(F.col("doi") == "", "NO_DOI_IN_PDF_TEXT").when(F.col("pmcid") == "", "NO_PMCID")
    if fetched is None:
        rows = rows.withColumn("status", early.otherwise("DRY_WOULD_FETCH"))
    else:
        got = fetched.groupBy("filename").agg(F.min("status").alias("_got"))
        rows = rows.join(got, "filename", "left").withColumn("status", early.otherwise(F.coalesce("_got", F.lit("NOT_AVAILABLE"))))
    return rows.select("filename", "doi", "pmcid", (F.col("status") == "OK").alias("sidecar"), "status")


def harvest(parsed: DataFrame, works: DataFrame, searched: DataFrame, pmids: DataFrame, present: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """Canonical records from exported citations: (src, fmt, doi, status, out, title, year).

    parsed: src, fmt, read (false: not parsable), doi, pmid, lastname, title, year; works: doi, lastname, title, year by DOI;
    searched: src, doi, lastname, title, year by title; pmids: pmid, doi.  Metadata comes from the DOI, else from the title's
    search, else from the file.  present: out (names that exist) for a run that writes; None is a dry run, which names the
    metadata's origin.  Of files with one DOI the first name counts, the others are DUP_SKIP and point to its record.
    """
    meta = lambda kind, doi: F.struct(F.lit(kind).alias("kind"), doi.alias("doi"), "lastname", "title", "year")
    rows = parsed.join(pmids.groupBy("pmid").agg(F.min("doi").alias("_by_pmid")), "pmid", "left")
    rows = rows.withColumn("doi", F.when(_filled("doi") != "", _filled("doi")).when(F.col("fmt") == "nbib", _filled("_by_pmid")).otherwise("")).withColumn("_key", F.lower("doi"))
    by_doi = works.groupBy(F.lower("doi").alias("_key")).agg(F.min(meta("crossref-doi", F.col("doi"))).alias("_a"))
    by_title = searched.groupBy("src").agg(F.min(meta("crossref-search", F.col("doi"))).alias("_b"))
    rows = rows.join(by_doi, "_key", "left").join(by_title, "src", "left")
    asked = F.when(_filled("title") != "", F.col("_b"))
    own = F.struct(F.concat(F.lit("fallback-"), "fmt").alias("kind"), F.col("doi").alias("doi"), "lastname", "title", "year")
    rows = rows.withColumn("_m", F.coalesce("_a", asked, own)).withColumn("_doi", F.lower(_filled("_m.doi")))
    rows = rows.withColumn("_name", F.concat(canonical_stem(F.col("_m.year"), F.col("_m.lastname"), F.col("_m.title")), F.lit(".ris")))
    usable = F.coalesce("read", F.lit(False)) & ((_filled("_m.title") != "") | (_filled("_m.lastname") != ""))
    firsts = rows.filter(usable & (F.col("_doi") != "")).groupBy("_doi").agg(F.min(F.struct("src", "_name")).alias("_first"))
    rows = rows.join(firsts, "_doi", "left")
    early = F.when(~F.coalesce("read", F.lit(False)), "PARSE_FAIL").when(~usable, "NO_METADATA").when((F.col("_doi") != "") & (F.col("src") != F.col("_first.src")), "DUP_SKIP")
    if present is None:
        rows = rows.withColumn("status", early.otherwise(F.concat(F.lit("DRY:"), "_m.kind")))
    else:
        rows = _marked(rows, present.select(F.col("out").alias("_name")), "_name", "_there")
        rows = rows.withColumn("status", early.when(F.col("_there") & F.lit(not overwrite), "EXISTS_SKIP").otherwise("WROTE"))
    failed, plain, dup = F.col("status") == "PARSE_FAIL", F.col("status") == "NO_METADATA", F.col("status") == "DUP_SKIP"
    said = lambda own, found: F.when(failed, "").when(plain, F.coalesce(own, F.lit(""))).otherwise(F.coalesce(found, F.lit("")))
    title = said(F.col("title"), F.when(dup, F.col("_m.title")).otherwise(F.substring("_m.title", 1, 80)))
    return rows.select(
        "src", "fmt", said(F.col("doi"), F.col("_doi")).alias("doi"), "status",
        F.when(failed | plain, "").when(dup, F.col("_first._name")).otherwise(F.col("_name")).alias("out"),
        title.alias("title"), said(F.col("year"), F.col("_m.year")).alias("year"),
    )
