"""Matching records: similarity, scored decisions, ranks of type and confidence, merges that lose nothing."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import normalize_for_match

# Record types in two classes, and the ranks of the decision's labels.
PREFERRED = ("journal-article", "proceedings-article", "book-chapter", "report", "monograph", "reference-entry", "review", "letter", "editorial", "other")
DEMOTED = ("dataset", "peer-review", "component", "grant", "book", "book-set", "book-series", "journal-issue", "journal-volume", "journal", "posted-content", "standard")
RANKS = {"HIGH": 4, "MED_NO_YEAR": 3, "MED_AUTHOR_ONLY": 3, "MED_TITLE_STRONG": 3, "MED_AUTHOR_YEAR_MISMATCH": 2, "MED_TYPE_MISMATCH": 2, "LOW_TITLE_ONLY": 1}


@F.pandas_udf(T.DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two normalised titles; no built-in function has it."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def type_class(kind: Column) -> Column:
    """0 preferred, 1 unknown, 2 demoted."""
    k = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(k.isin(*PREFERRED), 0).when(k.isin(*DEMOTED), 2).otherwise(1)


def _agree(a: Column, b: Column) -> Column:
    x, y = normalize_for_match(a), normalize_for_match(b)
    return (x != "") & (y != "") & (y.contains(x) | x.contains(y))


def score_match(year_hint: Column, author_hint: Column, top: dict[str, Column], runner: dict[str, Column], demoted: Column) -> Column:
    """The label of the best hit.  top and runner have score, family and year; demoted says that only demoted types were hit."""
    year_hint, author_hint = F.coalesce(year_hint, F.lit("")), F.coalesce(author_hint, F.lit(""))
    year, family = F.coalesce(top["year"], F.lit("")), F.coalesce(top["family"], F.lit(""))
    other = F.coalesce(runner["family"], F.lit(""))
    second = F.coalesce(runner["score"], F.lit(0.0))
    ratio = F.when(second > 0, F.try_divide(top["score"], second)).otherwise(F.lit(float("inf")))
    author, same_year = _agree(author_hint, family), (year_hint != "") & (year != "") & (year_hint == year)
    twin = (family != "") & (other != "") & (normalize_for_match(family) == normalize_for_match(other)) & (year == F.coalesce(runner["year"], F.lit("")))
    apart = F.abs(year_hint.try_cast("int") - year.try_cast("int")) >= 2
    return (
        F.when(top["score"].isNull(), "NO_RESULT")
        .when(demoted & (author | same_year), "MED_TYPE_MISMATCH")
        .when(demoted, "AMBIG")
        .when((ratio < 1.10) & ~twin, "AMBIG")
        .when(author & same_year, "HIGH")
        .when(author & (year_hint == ""), "MED_NO_YEAR")
        .when(author & (year != "") & F.coalesce(apart, F.lit(False)), "MED_AUTHOR_YEAR_MISMATCH")
        .when(author, "MED_AUTHOR_ONLY")
        .when((ratio >= 1.20) & (same_year | (year_hint == "")), "MED_TITLE_STRONG")
        .otherwise("LOW_TITLE_ONLY")
    )


def confidence_rank(label: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for name, rank in RANKS.items():
        out = out.when(label == name, rank)
    return out.otherwise(0)


def kept_if_empty(new: Column, old: Column) -> Column:
    """The new value, unless it is empty."""
    return F.coalesce(F.when(new != "", new), F.when(old != "", old), new)


# The fields of a stored record that a new extraction must not lose.
ENRICHED = ("doi", "title", "subtitle", "year", "journal", "authors", "pmid", "pmcid", "abstract", "figures", "metadata_source", "metadata_correction_note")


def _empty(c: Column, zero: bool) -> Column:
    """Null, '', [] or {}, given as JSON; 0 too where zero is."""
    return c.isNull() | c.isin("null", '""', "", "[]", "{}", *(["0"] if zero else []))


def merge_records(old: Column, new: Column) -> Column:
    """Two records as maps from field to JSON value: the new one, but an enriched field that it lacks keeps the old value."""
    kept = F.filter(F.map_keys(old), lambda k: k.isin(*ENRICHED) & ~_empty(old[k], False) & _empty(F.try_element_at(new, k), True))
    rest = F.map_filter(new, lambda k, v: ~F.array_contains(kept, k))
    return F.when(old.isNull() | (F.size(old) == 0), new).otherwise(F.map_concat(rest, F.map_from_arrays(kept, F.transform(kept, lambda k: old[k]))))


def fill_record(record: dict[str, Column], found: dict[str, Column]) -> Column:
    """A record with what a lookup found: the DOI is replaced, other fields are filled where empty; null if the DOI found is not well formed."""
    from .doi import is_valid_doi

    doi = F.trim(F.coalesce(found["doi"], F.lit("")))
    fields = [F.when(F.coalesce(record[f].cast("string"), F.lit("")).isin("", "0"), found[f]).otherwise(record[f]).alias(f) for f in record if f != "doi"]
    return F.when(is_valid_doi(doi), F.struct(doi.alias("doi"), *fields))


def title_gate(title: Column, head: Column, least: float = 0.55) -> Column:
    """Whether a record's title belongs to a file with this head: contained in it, else like its beginning; titles under 8 characters pass."""
    from .text import normalize_title

    own, first = normalize_title(title), normalize_title(F.substring(head, F.lit(1), F.greatest(F.length(title) * 3, F.lit(120))))
    contained = (own != "") & normalize_title(head).contains(own)
    unknown = (F.length(F.trim(F.coalesce(title, F.lit("")))) < 8) | (F.coalesce(head, F.lit("")) == "")
    return unknown | contained | (title_similarity(own, first) >= least)


def query_string(author: Column, title: Column, year: Column) -> Column:
    filled = lambda c: F.when(c != "", c)
    return F.concat_ws(" ", filled(author), filled(title), filled(year))
