"""Readers: queues and reports, registries, sidecars, citation records, structured papers, directory listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.doi import extract_doi, normalize_doi
from . import jats


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


QUEUE = strings("doi", "title", "authors", "year", "destination", "notes")
SIDECAR = T.StructType([
    *strings("pmcid", "pmid", "doi", "title", "subtitle", "year", "journal", "abstract", "text").fields,
    T.StructField("sections", T.ArrayType(strings("title", "text"))),
    T.StructField("figures", T.ArrayType(strings("label", "caption", "graphic_href", "image_path", "image_url"))),
    T.StructField("tables", T.ArrayType(strings("label", "caption", "text"))),
    T.StructField("formulas", T.ArrayType(strings("kind", "label", "latex", "status", "mathml_input"))),
    T.StructField("n_formulas", T.IntegerType()),
])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, comments: bool = False) -> DataFrame:
    """All columns as strings, by a given schema (never inferred); comments drops lines that begin with '#'."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema)
    return (reader.option("comment", "#") if comments else reader).csv(path)


def with_project(df: DataFrame, pattern: str) -> DataFrame:
    """The project that a file's path names, by the pattern's first group."""
    return df.withColumn("project", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def latest(df: DataFrame, stamp: str, by: list[str]) -> DataFrame:
    """The rows of the newest date of each group."""
    newest = df.groupBy(*by).agg(F.max(stamp).alias(stamp))
    return df.join(newest, [*by, stamp], "left_semi")


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first path that exists, in any file system that Spark can read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        if where.getFileSystem(conf).exists(where):
            return p
    return None


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Path, stem and length; the contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("stem"), "length")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files, with their stems."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^.]*$", 1).alias("stem"), F.col("value").alias("text"))


def registry(text: Column) -> Column:
    """Entries of a project registry: name and its settings."""
    entry = "map<string,struct<tier:int,lib_dir:string,data_dir:string,parent:string,ris_threshold:int,active:boolean>>"
    return F.map_entries(F.from_json(text, entry))


def registry_rows(df: DataFrame, text: str = "text") -> DataFrame:
    rows = df.select(F.explode(registry(F.col(text))).alias("e")).select(F.col("e.key").alias("name"), "e.value.*")
    folder = F.concat_ws("/", F.coalesce("parent", "name"), "lib_dir")
    return rows.withColumns({"ris_threshold": F.coalesce("ris_threshold", F.lit(90)), "active": F.coalesce("active", F.lit(True)), "library": folder})


def sidecar(text: Column) -> Column:
    return F.from_json(text, SIDECAR)


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def sidecar_info(text: Column, body: str = "$.body") -> Column:
    """Length of all text in a sidecar; present but unreadable counts as 0."""
    part = lambda p: F.coalesce(F.length(F.try_variant_get(F.try_parse_json(text), p, "string")), F.lit(0))
    return part("$.text") + part(body) + part("$.abstract")


def sidecar_authors(text: Column) -> Column:
    """Names from either form: plain strings, or surname and given name."""
    v = F.try_variant_get(F.try_parse_json(text), "$.authors", "array<variant>")
    pair = lambda a, p: F.try_variant_get(a, p, "string")
    named = lambda a: F.when(pair(a, "$.surname").isNotNull(), F.concat_ws(", ", pair(a, "$.surname"), pair(a, "$.given")))
    return F.transform(v, lambda a: F.coalesce(named(a), F.try_variant_get(a, "$", "string")))


# ------------------------------------------------------------------------------------------------- citation records


def _entries(text: Column, tagged: str, continues: str) -> Column:
    """(tag, value) of each tagged line; a line that continues is added to the value before it."""
    lines = F.split(text, r"\r\n|\n|\r")
    kind = "array<struct<tag:string,val:string>>"

    def add(acc: Column, line: Column) -> Column:
        entry = F.struct(F.regexp_extract(line, tagged, 1).alias("tag"), F.rtrim(F.ltrim(F.regexp_extract(line, tagged, 2))).alias("val"))
        last = F.element_at(acc, -1)
        longer = F.struct(last["tag"].alias("tag"), F.concat_ws(" ", last["val"], F.trim(line)).alias("val"))
        more = F.when((F.size(acc) > 0) & line.rlike(continues) & (F.trim(line) != ""), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer)))
        return F.when(line.rlike(tagged), F.concat(acc, F.array(entry))).otherwise(F.coalesce(more, acc))

    return F.aggregate(lines, F.array().cast(kind), add)


def _values(entries: Column, *tags: str) -> Column:
    return F.transform(F.filter(entries, lambda e: e["tag"].isin(*tags) & (e["val"] != "")), lambda e: e["val"])


def _first(entries: Column, *tags: str) -> Column:
    return F.coalesce(F.get(_values(entries, *tags), F.lit(0)), F.lit(""))


def _surname(author: Column) -> Column:
    return F.when(author.contains(","), F.trim(F.substring_index(author, ",", 1))).otherwise(F.regexp_extract(F.trim(author), r"^(\S+)", 1))


def _doi_or(direct: Column, urls: Column) -> Column:
    found = F.filter(F.transform(urls, extract_doi), lambda d: d != "")
    return F.when(direct != "", F.lower(direct)).otherwise(F.coalesce(F.get(found, F.lit(0)), F.lit("")))


def parse_ris(text: Column) -> Column:
    """doi, year, lastname, title, venue, authors; wrapped titles and venues are joined, a DOI may be in a URL."""
    e = _entries(text, r"^([A-Z][A-Z0-9])\s{2}-\s?(.*)$", r"^.")
    authors, year = _values(e, "AU"), F.filter(_values(e, "PY"), lambda y: y.rlike(r"^\d{4}"))
    return F.struct(
        _doi_or(_first(e, "DO"), _values(e, "UR")).alias("doi"),
        F.substring(F.get(year, F.lit(0)), 1, 4).cast("int").alias("year"),
        F.coalesce(_surname(F.get(authors, F.lit(0))), F.lit("")).alias("lastname"),
        _first(e, "TI", "T1").alias("title"),
        _first(e, "JO").alias("venue"),
        authors.alias("authors"),
    )


def parse_ris_harvest(text: Column) -> Column:
    """Single lines only; TI before T1, the year's first four characters as they are."""
    e = _entries(text, r"^([A-Z][A-Z0-9])\s{2}-\s?(.*)$", r"^\z.")
    title = F.when(_first(e, "TI") != "", _first(e, "TI")).otherwise(_first(e, "T1"))
    year = F.when(_first(e, "PY") != "", _first(e, "PY")).otherwise(_first(e, "Y1"))
    return F.struct(_doi_or(_first(e, "DO"), _values(e, "UR")).alias("doi"), F.substring(year, 1, 4).alias("year"), F.coalesce(_surname(F.get(_values(e, "AU"), F.lit(0))), F.lit("")).alias("lastname"), title.alias("title"))


def parse_enw(text: Column) -> Column:
    e = _entries(text, r"^%([A-Z0-9])\s+(.*)$", r"^\z.")
    return F.struct(_doi_or(_first(e, "R"), _values(e, "U")).alias("doi"), F.substring(_first(e, "D"), 1, 4).alias("year"), F.coalesce(_surname(F.get(_values(e, "A"), F.lit(0))), F.lit("")).alias("lastname"), _first(e, "T").alias("title"))


def parse_nbib(text: Column) -> Column:
    e = _entries(text, r"^([A-Z]{2,4})\s*-\s?(.*)$", "^ {6}")
    ids = F.concat(_values(e, "LID"), _values(e, "AID"))
    own = F.filter(ids, lambda v: F.lower(v).endswith("[doi]") & v.startswith("10."))
    doi = F.lower(F.trim(F.regexp_replace(F.coalesce(F.get(own, F.lit(0)), F.lit("")), r"(?i)\[doi\]$", "")))
    full = _values(e, "FAU")
    author = F.coalesce(F.get(full, F.lit(0)), F.get(_values(e, "AU"), F.lit(0)))
    return F.struct(doi.alias("doi"), F.substring(_first(e, "DP"), 1, 4).alias("year"), F.coalesce(_surname(author), F.lit("")).alias("lastname"), _first(e, "TI").alias("title"), _first(e, "PMID").alias("pmid"))


def parse_any(name: Column, text: Column) -> Column:
    """doi, year, lastname, title by the file's extension."""
    ext = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    common = lambda s: F.struct(*[s[c].cast("string").alias(c) for c in ("doi", "year", "lastname", "title")])
    return F.when(ext == "ris", common(parse_ris_harvest(text))).when(ext == "enw", common(parse_enw(text))).when(ext == "nbib", common(parse_nbib(text)))


#: What parse_jats reads of a paper's body, in the sidecar's shapes.
JATS_BODY = T.StructType([f for f in SIDECAR.fields if f.name in ("sections", "figures", "tables", "formulas", "n_formulas", "text")])


def parse_jats(xml: Column, latex: Column | None = None) -> Column:
    """Fields of a structured paper by XPath that ignores name spaces; cross-references leave no text.  Sections, figures,
    tables and formulas come with all their text; latex is a map from MathML to a converter's recorded output, without
    which formulas have the status no-converter."""
    one = lambda p: F.trim(F.regexp_replace(F.xpath_string(xml, F.lit(p)), r"\s+", " "))
    node = lambda n: f"*[local-name()='{n}']"
    surnames = F.xpath(xml, F.lit(f"//{node('contrib')}[@contrib-type='author']//{node('surname')}/text()"))
    pmc = one(f"//{node('article-id')}[@pub-id-type='pmc']")
    body = F.udf(jats.body, JATS_BODY)(xml, *([] if latex is None else [latex]))
    return F.struct(
        F.lower(one(f"//{node('article-id')}[@pub-id-type='doi']")).alias("doi"),
        F.when(pmc.rlike("^[0-9]+$"), F.concat(F.lit("PMC"), pmc)).otherwise(pmc).alias("pmcid"),
        one(f"//{node('article-title')}").alias("title"),
        one(f"//{node('pub-date')}/{node('year')}").alias("year"),
        one(f"//{node('journal-title')}").alias("journal"),
        surnames.alias("surnames"),
        F.trim(F.regexp_replace(F.array_join(F.xpath(xml, F.lit(f"//{node('abstract')}//text()[not(ancestor::{node('xref')})]")), ""), r"\s+", " ")).alias("abstract"),
        body.alias("body"),
    )


def pmcid_map(text: Column) -> Column:
    """A DOI to PMCID map in any of three shapes: an object, {map: object} or a list of records."""
    v = F.try_parse_json(text)
    flat = F.try_variant_get(v, "$", "map<string,string>")
    nested = F.try_variant_get(v, "$.map", "map<string,string>")
    listed = F.try_variant_get(v, "$", "array<struct<doi:string,pmcid:string>>")
    pairs = F.transform(listed, lambda r: F.struct(r["doi"].alias("key"), r["pmcid"].alias("value")))
    entries = F.coalesce(F.map_entries(nested), pairs, F.map_entries(flat))
    return F.transform(entries, lambda e: F.struct(normalize_doi(e["key"]).alias("doi"), e["value"].alias("pmcid")))
