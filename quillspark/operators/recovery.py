"""Recovering what is missing: files without a DOI, records by title, preprints, stored references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.doi import gate_doi
from ..functions.match import title_similarity
from ..functions.text import normalize_title, parse_reference


def orphans(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Files (project, stem) without a sidecar or with one that has no DOI; one that can't be parsed (parsed = false) is no orphan."""
    told = sidecars.select("project", "stem", "parsed", F.col("doi").alias("_doi"))
    rows = files.join(told, ["project", "stem"], "left")
    missing = F.col("parsed").isNull()
    return rows.filter(missing | (F.col("parsed") & (F.trim(F.coalesce("_doi", F.lit(""))) == ""))).withColumn("why", F.when(missing, "no-sidecar").otherwise("no-doi")).drop("parsed", "_doi")


def _with_likeness(hits: DataFrame, asked: str, found: str) -> DataFrame:
    """Adds sim: the ratio of the normalised titles.  Twice the shorter length over both lengths bounds it, so hits that can't reach
    a tenth never get to Python."""
    a, b = normalize_title(F.col(asked)), normalize_title(F.col(found))
    rows = hits.withColumns({"_a": a, "_b": b})
    bound = 2 * F.least(F.length("_a"), F.length("_b")) / F.greatest(F.length("_a") + F.length("_b"), F.lit(1))
    return rows.withColumn("sim", F.when(F.col("_a") == F.col("_b"), F.when(F.col("_a") == "", 0.0).otherwise(1.0)).when(bound < 0.1, 0.0).otherwise(title_similarity(F.col("_a"), F.col("_b")))).drop("_a", "_b")


def title_lookup(asked: DataFrame, hits: DataFrame, top: int = 5, least: float = 0.85) -> DataFrame:
    """For each asked row (key, title, year) its best hit (key, at, doi, found, found_year) among the first: titles of eight
    characters or more, a likeness of at least `least`, years (where both are known) no more than one apart."""
    near = hits.filter(F.col("at") < top).join(asked.filter(F.length(F.trim("title")) >= 8).select("key", "title", "year"), "key")
    best = _with_likeness(near, "title", "found").groupBy("key").agg(F.max_by(F.struct("doi", "found", "found_year", "year", "sim"), F.struct("sim", -F.col("at"))).alias("b")).select("key", "b.*")
    four = lambda c: F.when(F.col(c).rlike(r"^\d{4}$"), F.col(c).cast("int"))
    apart = F.coalesce(F.abs(four("year") - four("found_year")) > 1, F.lit(False))
    return best.filter((F.col("sim") >= least) & ~apart).select("key", "doi", "found", "sim")


def best_candidate(asked: DataFrame, candidates: DataFrame, least: float = 0.85, years: int = 1, direct_first: bool = True) -> DataFrame:
    """For each asked row (key, title, year) the best of its candidates (key, at, found, found_year, needs_scrape): by likeness,
    then the same year, then a PDF that needs no scraping, then the earlier; known years further apart than `years` are out."""
    rows = _with_likeness(candidates.join(asked.select("key", "title", "year"), "key"), "title", "found")
    return ranked_candidates(rows, years, direct_first).filter((F.col("rank") == 1) & (F.col("sim") >= least)).drop("rank")


#: Fixed value: titles at least so alike are taken for the same; the keys that closest_titles joins by hold from it upwards.
SAME_TITLE = 0.85


def closest_titles(rows: DataFrame, key: str, title: str, block: list[str]) -> DataFrame:
    """For each key the most similar title (match, similarity) of another key in its block, if the ratio reaches SAME_TITLE; of
    equal ones that of the least key.

    Rows with one normalised title are a class: copies match the class's least other key with ratio 1, and only titles that stand
    alone meet other titles.  Where m letters of titles with s letters together match, they lie in s - 2m + 1 runs at most, so
    the titles share 3m - s - 1 pairs of letters or more (equal pairs counted apart).  Each title has its pairs in order of
    rarity and leaves out as many of the last as a partner must share, less one: two titles that are alike share one of
    the others, by which they are joined.  The edit distance, which bounds the ratio, decides who goes to Python."""
    own = [*block, "_t"]
    rows = rows.select(F.col(key).alias("_k"), *block, normalize_title(F.col(title)).alias("_t")).dropna(subset=["_k", *block])
    two = rows.distinct().withColumn("_n", F.row_number().over(Window.partitionBy(*own).orderBy("_k"))).filter("_n <= 2")
    classes = two.groupBy(*own).agg(F.min("_k").alias("_first"), F.max(F.when(F.col("_n") == 2, F.col("_k"))).alias("_second"))
    copies = rows.join(classes.filter("_second is not null"), own).select("_k", F.when(F.col("_k") == F.col("_first"), F.col("_second")).otherwise(F.col("_first")).alias("match"), F.lit(1.0).alias("similarity"))

    pairs = F.expr("transform(sequence(1, length(_t) - 1), i -> substring(_t, i, 2))")
    counted = F.expr("transform(_p, (x, i) -> concat(x, size(filter(slice(_p, 1, i + 1), y -> y = x))))")
    token = classes.filter(F.length("_t") > 1).withColumn("_p", pairs).withColumn("_p", F.explode(counted))
    often = token.groupBy("_p").agg(F.count(F.lit(1)).alias("_often"))  # as many rows as there are pairs of letters
    shared = 1.5 * SAME_TITLE - 1
    least = F.greatest(F.ceil((shared * (1 + SAME_TITLE / (2 - SAME_TITLE)) - 1e-6) * F.length("_t")) - 1, F.lit(1))
    rare = token.join(F.broadcast(often), "_p").groupBy(*own, "_first", "_second").agg(F.array_sort(F.collect_list(F.struct("_often", "_p"))).alias("_p"))
    met = rare.withColumn("_p", F.explode(F.slice(F.col("_p")["_p"], F.lit(1), (F.length("_t") - least).cast("int"))))
    alone = met.filter("_second is null").select("_p", *own, F.col("_first").alias("_k"))
    other = met.select("_p", *block, F.col("_t").alias("_t2"), F.struct("_first", "_second").alias("_c"))
    a, b = F.col("_t"), F.col("_t2")
    both = F.length(a) + F.length(b)
    apart = F.call_function("levenshtein", a, b, F.ceil((1 - SAME_TITLE) * both).cast("int"))
    near = alone.join(other, ["_p", *block]).filter((a != b) & (2.0 * F.least(F.length(a), F.length(b)) / both >= SAME_TITLE))
    near = near.withColumn("match", F.when(F.col("_c._first") != F.col("_k"), F.col("_c._first")).otherwise(F.col("_c._second")))
    near = near.filter(F.col("match").isNotNull() & (apart >= 0) & ((both - apart) / both >= SAME_TITLE)).select("_k", "_t", "_t2", "match").distinct()
    found = copies.unionByName(near.select("_k", "match", title_similarity(a, b).alias("similarity")))
    best = found.groupBy("_k").agg(F.max_by(F.struct("match", "similarity"), F.struct("similarity", -F.col("match"))).alias("b"))
    return best.select(F.col("_k").alias(key), "b.*").filter(F.col("similarity") >= SAME_TITLE)


def ranked_candidates(rows: DataFrame, years: int = 1, direct_first: bool = True) -> DataFrame:
    """Rows with a likeness (sim), ranked within their key."""
    a, b = F.col("year").try_cast("int"), F.col("found_year").try_cast("int")
    rows = rows.filter(~F.coalesce(F.abs(a - b) > years, F.lit(False)))
    direct = (~F.col("needs_scrape")) if direct_first else F.lit(True)
    order = [F.desc("sim"), F.coalesce(a == b, F.lit(False)).desc(), direct.desc(), F.asc("at")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)))


def recovery_status(doi: Column, label_rank: Column, least_rank: Column, taken: Column) -> Column:
    """What becomes of an orphan's best match, first rule that holds."""
    return F.when(F.coalesce(doi, F.lit("")) == "", "NO_MATCH").when(gate_doi(doi) == "", "BAD_DOI").when(label_rank < least_rank, "LOW_CONFIDENCE").when(taken, "ALREADY_HELD").otherwise("FILLED")


def stored_references(sidecars: DataFrame) -> DataFrame:
    """Rows of (stem, references: array of JSON): objects give their fields with the DOI gated, strings are parsed."""
    rows = sidecars.select("stem", F.posexplode("references").alias("at", "r"))
    field = lambda f: F.coalesce(F.get_json_object("r", f"$.{f}"), F.lit(""))
    whole = F.when(field("text") != "", field("text")).otherwise(F.col("r"))
    own = F.struct(field("first_author").alias("first_author"), field("year").alias("year"), F.substring(field("title"), 1, 200).alias("title_snippet"), gate_doi(field("doi")).alias("doi"), F.substring(whole, 1, 500).alias("raw"))
    return rows.select("stem", "at", F.when(F.ltrim("r").startswith("{"), own).otherwise(parse_reference(F.col("r"))).alias("p")).select("stem", "at", "p.*")
