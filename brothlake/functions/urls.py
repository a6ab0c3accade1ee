"""URLs of recipe pages: found in text, chosen by keyword, named by medium."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import contains_any

# Fixed values.

URL = r"""https?://[^\s"'<>)}\],]*"""
KEYWORDS = ["mediadive", "medium", "media", "dsmz.de/microorganisms/medium", "catalogue/milieux", "fiche_milieu"]


def urls_in(text: Column) -> Column:
    """Distinct URLs of a text."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL), 0))


def about_media(url: Column, keywords: list[str] = KEYWORDS) -> Column:
    return F.coalesce(contains_any(F.lower(url), keywords), F.lit(False))


def _group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def medium_id(url: Column) -> Column:
    """The medium a URL names, by page path or by file name; null if none."""
    return F.coalesce(_group(url, "/medium/([^/?]+)"), _group(url, r"DSMZ_Medium([^.]+)\.pdf"))


def source_medium_id(url: Column) -> Column:
    """A name for any URL: by the rules of its collection, else host and last part of the path, else a short digest."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.regexp_replace(F.element_at(F.split(F.trim(path, F.lit("/")), "/"), -1), r"\.pdf|\.html|\.ashx", "")
    named = lambda prefix, *patterns: F.concat(F.lit(prefix), F.coalesce(*[_group(url, p) for p in patterns]))
    by_source = (
        F.when(host.contains("dsmz.de"), named("dsmz_", r"DSMZ_Medium([^./]+)", r"/medium/([^/?]+)"))
        .when(host.contains("jcm.riken.jp"), named("jcm_", r"GRMD=([^&]+)"))
        .when(host.contains("ccap.ac.uk"), named("ccap_", r"MR_([^./]+)"))
        .when(host.contains("atcc.org"), F.coalesce(named("atcc_", r"atcc-medium-([^./]+)"), F.concat(F.lit("atcc_"), last)))
        .when(host.contains("cyanosite.bio.purdue.edu"), named("cyanosite_", r"/([^./]+)\.html"))
    )
    domain = F.regexp_replace(F.regexp_replace(host, r"www\.", ""), r"\.", "_")
    return F.coalesce(by_source, F.when(last != "", F.concat(domain, F.lit("_"), last)), F.concat(F.lit("url_"), F.substring(F.md5(url.cast("binary")), 1, 8)))
