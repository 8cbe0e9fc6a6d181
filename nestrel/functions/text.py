"""Text cleaning and extraction expressions (all JVM-side regex functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns of the two text kinds. Alternatives are
# written longest first, so "\n\n" is one replacement (as the relational
# engine the workload came from picks the longest alternative).
FLAVOR_PATTERN = "[\n\f]"
EFFECT_PATTERN = "\n\n|\n|\f|  "

# Trailing numeric id of a resource URL, optionally followed by "/", "?" or "#"
URL_ID_PATTERN = r".+/([0-9]+)(?:[/?#].*)?$"
# Strict form: the id must be followed by a final slash
URL_ID_STRICT = r".+/([0-9]+)/$"


def clean(text: Column, pattern: str, repl: str = " ") -> Column:
    """Global regex replace; replaced output is not rescanned."""
    return F.regexp_replace(text, pattern, repl)


def clean_flavor(text: Column) -> Column:
    return clean(text, FLAVOR_PATTERN)


def clean_effect(text: Column) -> Column:
    return clean(text, EFFECT_PATTERN)


def url_id(url: Column, pattern: str = URL_ID_PATTERN) -> Column:
    """Integer id captured from a URL; NULL when the URL has no id."""
    # regexp_extract gives '' on no match; try_cast('' as int) is NULL
    return F.regexp_extract(url, pattern, 1).try_cast("int")


def url_id_lost(url: Column, pattern: str = URL_ID_PATTERN) -> Column:
    """Whether the URL has an id that is too large for an INTEGER, which ``url_id`` gives as NULL."""
    return (F.regexp_extract(url, pattern, 1) != "") & url_id(url, pattern).isNull()


def translate_chars(text: Column, src: str, dst: str) -> Column:
    return F.translate(text, src, dst)


def round_to_int(x: Column) -> Column:
    """Numeric -> integer with rounding half away from zero.

    A plain cast truncates; going through DECIMAL keeps the rounding exact for
    values that arrive as DOUBLE (no binary 2.4999... surprises).
    """
    return F.round(x.cast("decimal(38,18)"), 0).cast("int")


def html_links(html: Column) -> tuple[Column, Column]:
    """(href array, link text array) of the ``<a href>`` anchors in a page."""
    hrefs = F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)">[^<]*</a>'), 1)
    names = F.regexp_extract_all(html, F.lit(r'<a href="[^"]*">([^<]*)</a>'), 1)
    return hrefs, names
