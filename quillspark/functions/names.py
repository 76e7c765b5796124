"""Bibliographic names: ASCII folding, slugs, surnames, file names and what they tell."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters without a decomposition, and the stop-words of the two slugs and of the keywords.
LETTERS = {"ø": "o", "Ø": "O", "æ": "ae", "Æ": "Ae", "ß": "ss", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "œ": "oe", "Œ": "Oe", "ı": "i", "İ": "I"}
SHORT_STOP = ("a", "an", "the", "of", "in", "on", "and", "to", "for", "at", "from", "with", "by", "as")
SLUG_STOP = (*SHORT_STOP, "or", "is", "are", "be", "been", "this", "that", "these", "those")
KEYWORD_STOP = (*SLUG_STOP, "was", "were")


def split_authors(names: Column) -> Column:
    """(family, given) of each name: at the first comma, else the last word is the family."""
    def one(a: Column) -> Column:
        words = F.filter(F.split(F.trim(a), r"\s+"), lambda w: w != "")
        comma = F.instr(a, ",") > 0
        family = F.when(comma, F.trim(F.substring_index(a, ",", 1))).otherwise(F.element_at(words, -1))
        given = F.when(comma, F.trim(F.regexp_replace(a, "^[^,]*,", ""))).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " "))
        return F.when(comma | (F.size(words) > 0), F.struct(family.alias("family"), given.alias("given")))

    return F.filter(F.transform(names, one), lambda x: x.isNotNull())


def _accents() -> tuple[str, str]:
    """Letters up to U+024F that fold to one ASCII letter, and what they fold to."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    plain = [(c, "".join(x for x in d if not unicodedata.combining(x))) for c, d in pairs if c not in LETTERS]
    one = [(c, p) for c, p in plain if len(p) == 1 and p.isascii()]
    return "".join(c for c, _ in one), "".join(p for _, p in one)


ACCENTED, FOLDED = _accents()


def safe_ascii(c: Column) -> Column:
    """ASCII form: special letters spelt out, accents dropped, the rest removed.  Exact for Latin letters to U+024F and
    for decomposed text; safe_ascii_exact folds every script."""
    out = F.coalesce(c, F.lit(""))
    for letter, plain in LETTERS.items():
        if len(plain) > 1:
            out = F.replace(out, F.lit(letter), F.lit(plain))
    ones = {k: v for k, v in LETTERS.items() if len(v) == 1}
    out = F.translate(out, ACCENTED + "".join(ones), FOLDED + "".join(ones.values()))
    return F.regexp_replace(out, r"[^\x00-\x7F]", "")


@F.pandas_udf(T.StringType())
def safe_ascii_exact(c: pd.Series) -> pd.Series:
    table = str.maketrans(LETTERS)

    def fold(s):
        text = unicodedata.normalize("NFKD", (s or "").translate(table))
        return "".join(x for x in text if not unicodedata.combining(x)).encode("ascii", "ignore").decode()

    return c.map(fold)


def normalize_for_match(c: Column) -> Column:
    return F.lower(safe_ascii(c))


def ascii_only(c: Column) -> Column:
    """Everything else dropped, nothing folded."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x00-\x7F]", "")


def _no_tags(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 100_000)))


def _camel(text: Column, stop: tuple[str, ...], n: int, clean: bool) -> Column:
    words = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda w: (w != "") & ~F.lower(w).isin(*stop))
    tidy = (lambda w: F.regexp_replace(w, r"[^A-Za-z0-9\-]", "")) if clean else (lambda w: w)
    return F.array_join(F.transform(F.slice(words, 1, n), lambda w: _capital(tidy(w))), "")


def _or(c: Column, other: str) -> Column:
    return F.when(c == "", F.lit(other)).otherwise(c)


def slug(title: Column, n: int = 6) -> Column:
    """The first n telling words in camel case (letters, digits and hyphens)."""
    return _or(_camel(F.regexp_replace(safe_ascii(_no_tags(title)), r"[^A-Za-z0-9\s\-]", " "), SLUG_STOP, n, True), "Untitled")


def slug_title(title: Column, n: int = 6) -> Column:
    """As slug, with the shorter stop list, and underscores kept."""
    return _or(_camel(F.regexp_replace(safe_ascii(_no_tags(title)), r"[^\w\s\-]", " "), SHORT_STOP, n, False), "Untitled")


def last_name(authors: Column) -> Column:
    """The first author's surname from a list in any of the usual orders."""
    text = F.trim(F.regexp_replace(F.trim(safe_ascii(authors)), r"(?i),?\s*et\s+al\.?\s*$", ""))
    first = F.trim(F.get(F.split(F.trim(F.get(F.split(text, ";"), F.lit(0))), ","), F.lit(0)))
    parts = F.filter(F.split(first, r"\s+"), lambda p: p != "")
    tail = F.element_at(parts, -1)
    pick = F.when((F.size(parts) > 1) & tail.rlike(r"^[A-Z]{1,3}\.?$"), F.get(parts, F.lit(0))).otherwise(tail)
    return F.when(F.size(parts) == 0, F.lit("Unknown")).otherwise(_or(F.regexp_replace(pick, r"[^A-Za-z0-9\-]", ""), "Unknown"))


def _year(c: Column) -> Column:
    return F.when(c.cast("string").rlike(r"^\d{4}$"), c.cast("string")).otherwise(F.lit("Unknown"))


def canonical_stem(year: Column, surname: Column, title: Column) -> Column:
    own = _or(safe_ascii(F.regexp_replace(F.coalesce(surname, F.lit("")), r"(?U)[^\w\-]", "")), "Unknown")
    return F.concat_ws("_", _year(year), own, slug(title))


def build_filename(year: Column, authors: Column, title: Column) -> Column:
    return F.concat(F.concat_ws("_", _year(year), last_name(authors), slug_title(title)), F.lit(".pdf"))


def preprint_filename(year: Column, authors: Column, title: Column) -> Column:
    """The year as it is; the suffix says that it is a preprint."""
    return F.concat(F.concat_ws("_", F.coalesce(year.cast("string"), F.lit("Unknown")), last_name(authors), slug_title(title)), F.lit("_preprint.pdf"))


def companion(name: Column, ext: str) -> Column:
    """The last suffix replaced."""
    return F.regexp_replace(name, r"\.[^./]*$", ext)


def keywordize(title: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-zA-Z0-9]{3,}"), F.lit(0))
    return F.substring(F.array_join(F.filter(words, lambda w: ~w.isin(*KEYWORD_STOP)), " "), 1, 200)


CANONICAL = r"^(\d{4})_([A-Z][A-Za-z\-']+)_([A-Z][A-Za-z0-9\-]+)\.pdf$"
LOOSE = r"^(\d{4})_([A-Z][A-Za-z\-']+)_(.+)\.pdf$"
LEGACY = r"^([a-z]+)_(\d{4})_([a-z0-9_]+)\.pdf$"
BUNDLE = r"(?i)(?<![A-Za-z0-9])(vol\d|edition\d|issue\d|volume\d)(?![A-Za-z0-9])"


def filename_hints(name: Column) -> Column:
    """(year, author, title, kind): what a PDF's name tells; kind is canonical, canonical-loose, legacy or gibberish."""
    canonical, loose, legacy = name.rlike(CANONICAL), name.rlike(LOOSE), name.rlike(LEGACY)
    part = lambda p, i: F.regexp_extract(name, p, i)
    known = lambda y: F.when(y == "0000", F.lit("")).otherwise(y)
    words = lambda c, p: F.array_join(F.regexp_extract_all(c, F.lit(p), F.lit(0)), " ")
    free = F.regexp_extract(name, r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1)
    base = F.regexp_replace(name, r"(?i)\.pdf$", "")
    rest = F.when(free != "", F.replace(base, free, F.lit(""))).otherwise(base)
    return F.struct(
        F.when(canonical, known(part(CANONICAL, 1))).when(loose, known(part(LOOSE, 1))).when(legacy, part(LEGACY, 2)).otherwise(free).alias("year"),
        F.when(canonical, part(CANONICAL, 2)).when(loose, part(LOOSE, 2)).when(legacy, F.initcap(part(LEGACY, 1))).alias("author"),
        F.when(canonical, words(part(CANONICAL, 3), r"[A-Z][a-z0-9\-']*"))
        .when(loose, words(part(LOOSE, 3), r"[A-Z][a-z0-9\-']*|[A-Z]+(?=[A-Z][a-z])|[A-Z]+|[a-z0-9]+"))
        .when(legacy, F.replace(part(LEGACY, 3), F.lit("_"), F.lit(" ")))
        .otherwise(F.trim(F.regexp_replace(rest, "_+", " ")))
        .alias("title"),
        F.when(canonical, "canonical").when(loose, "canonical-loose").when(legacy, "legacy").otherwise("gibberish").alias("kind"),
    )


def is_bundle(name: Column, title: Column) -> Column:
    return name.rlike(BUNDLE) | F.coalesce(title, F.lit("")).rlike(BUNDLE)


def library_name(name: Column) -> Column:
    """(year, author, title) of a library file's name; '?' where it follows no rule."""
    p = r"^([12]\d{3}|Unknown)_([A-Za-z\-]+?)_(.+?)\.pdf$"
    ok = name.rlike(p)
    part = lambda i, other: F.when(ok, F.regexp_extract(name, p, i)).otherwise(other)
    return F.struct(
        part(1, F.lit("?")).alias("year"),
        part(2, F.lit("?")).alias("author"),
        F.when(ok, F.replace(F.regexp_extract(name, p, 3), F.lit("_"), F.lit(" "))).otherwise(F.regexp_replace(name, ".{4}$", "")).alias("title"),
    )


def name_flags(name: Column) -> Column:
    """Signs of a badly built file name."""
    surname = F.regexp_extract(name, r"^[^_]*_([^_]*)_", 1)
    return F.struct(name.contains("_al_").alias("et_al"), name.startswith("Unknown_").alias("no_year"), surname.rlike("^[A-Z]{3,}$").alias("all_caps"))
