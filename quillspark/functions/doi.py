"""DOI grammar as Column expressions: normalising, gating, extracting, hashing, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the DOI grammar.
FULL = r"^10\.\d{4,9}/\S+$"
PREFIXES = r"^(?:https://doi\.org/|http://dx\.doi\.org/|doi:)"
TRAILING = r"[.,;:)\]}>]+$"
BODY = r"[A-Za-z0-9._;:()/\-]"
WRAP = r"[ \t\r\n\u00AD]"
PREPRINT_SERVER = "10.1101/"
# Prefixes whose publishers serve a stand-in instead of the article.
BYPASSED = ("10.1249/", "10.1519/", "10.2196/")


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_doi(c: Column) -> Column:
    """Lower case, without one resolver prefix and trailing punctuation; null gives ''."""
    bare = F.regexp_replace(F.lower(_stripped(F.coalesce(c, F.lit("")))), PREFIXES, "")
    return F.regexp_replace(bare, TRAILING, "")


def is_valid_doi(c: Column) -> Column:
    return F.coalesce(_stripped(c).rlike(FULL), F.lit(False))


def is_suspicious_doi(c: Column) -> Column:
    """Invalid, or a suffix without digit and dot: what a broken line leaves of a DOI."""
    suffix = F.regexp_replace(c, r"^[^/]*/", "")
    return ~is_valid_doi(c) | (~suffix.rlike("[0-9]") & ~suffix.contains("."))


def gate_doi(c: Column) -> Column:
    """The normalised DOI, or '' if it is suspicious."""
    d = normalize_doi(c)
    return F.when(is_suspicious_doi(d), F.lit("")).otherwise(d)


def extract_doi(text: Column) -> Column:
    """The first sound DOI of a text, joined again where a line was broken after '.', '-' or '/'; else ''."""
    wrapped = rf"(?i)10\.\d{{4,9}}/(?:{BODY}+(?:(?<=[.\-/]){WRAP}+{BODY}+)*)?"  # a line is joined after a character of the body only
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(wrapped), F.lit(0))
    tidy = F.transform(found, lambda d: normalize_doi(F.regexp_replace(d, f"{WRAP}+", "")))
    return F.coalesce(F.get(F.filter(tidy, lambda d: ~is_suspicious_doi(d)), F.lit(0)), F.lit(""))


def scan_dois(text: Column) -> Column:
    """All DOIs up to white space: the older scan that does not join lines."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"10\.\d{4,9}/[^\s\"'<>]+"), F.lit(0))
    return F.transform(found, lambda d: F.regexp_replace(F.lower(d), TRAILING, ""))


def norm_queue_doi(c: Column) -> Column:
    """Lower case, stripped; trailing dots go first, then trailing brackets."""
    return F.regexp_replace(F.regexp_replace(F.lower(_stripped(F.coalesce(c, F.lit("")))), r"\.+$", ""), r"\)+$", "")


def coerce_int(c: Column, default: int = 0) -> Column:
    """'1,234' or '2020.7' as a whole number, cut towards zero; anything else the default."""
    number = F.regexp_replace(_stripped(c.cast("string")), ",", "").try_cast("double")
    sane = F.when(~F.isnan(number) & (F.abs(number) < 2147483648.0), number)
    return F.coalesce(sane.cast("int"), F.lit(default))


def safe_int(c: Column, default: int = 0) -> Column:
    """A plain whole number, or the default: no commas, no decimals."""
    bare = _stripped(c.cast("string"))
    return F.coalesce(F.when(bare.rlike(r"^[+-]?\d+$"), bare.try_cast("int")), F.lit(default))


def doi_hash(c: Column, n: int = 6) -> Column:
    return F.substring(F.sha1(F.lower(_stripped(F.coalesce(c, F.lit(""))))), 1, n)


def quoted_doi(c: Column) -> Column:
    """Percent-encoded, a space as %20."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def access_url(c: Column, proxy_host: str = "") -> Column:
    """The resolver's URL, through a proxy's rewritten host name if one is given."""
    return F.concat(F.lit(f"https://doi-org.{proxy_host}/" if proxy_host else "https://doi.org/"), c)


def preprint_pdf_url(c: Column) -> Column:
    """(url, scrape): a direct PDF where the server has a rule, else the DOI's page, to be searched for one."""
    direct = F.lower(c).startswith(PREPRINT_SERVER)
    url = F.when(direct, F.concat(F.lit("https://www.biorxiv.org/content/"), c, F.lit(".full.pdf"))).otherwise(F.concat(F.lit("https://doi.org/"), c))
    return F.struct(url.alias("url"), (~direct).alias("scrape"))


def bypasses_publisher(doi: Column, pdf_url: Column) -> Column:
    """A DOI whose publisher's page is not worth trying: a known prefix, and no PDF link of its own."""
    known = F.lower(F.coalesce(doi, F.lit(""))).rlike("^(?:" + "|".join(p.replace(".", "[.]") for p in BYPASSED) + ")")
    return known & (F.coalesce(pdf_url, F.lit("")) == "")


def doi_mismatch(found: Column, asked: Column, published: Column | None = None) -> Column:
    """A DOI found in a file is neither the one asked for nor the published one."""
    out = (found != "") & (found != normalize_doi(asked))
    return out & ((published == "") | (found != normalize_doi(published))) if published is not None else out
