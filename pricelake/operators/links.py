"""Link extraction from raw page html as native Spark expressions (H1-H4).

Anchors are found with ``regexp_extract_all`` over the raw html and
``posexplode``-d with their document position, so the work is a narrow,
codegen'd projection per page: no Python, no shuffle until a dedup.

Covered forms: ``<a …>`` open tags (any case, ``>`` allowed inside quoted
attribute values), attribute values double-quoted, single-quoted or bare,
read one after the other so that a value may hold any text, with all character
references; comments, scripts and styles are cut first, so anchors inside
them do not count (as for an HTML parser).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.html import TAG_PATTERN, unescape
from pricelake.functions.text import _col, let
from pricelake.functions.urls import url_normalize, is_category_url, is_product_url
from pricelake.operators.merge import stable_distinct

_B = r"[ \t\n\f\r]"
A_TAG_PATTERN = r"(?i)<a" + _B + r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
# Comments, scripts and styles: their text is not markup.
NON_MARKUP_PATTERN = r"(?is)<!--.*?-->|<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>"
ANCHOR_PATTERN = r"(?is)<a(?:" + _B + r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>(.*?)</a" + _B + r"*>"


# One attribute after the other: a name, and its value if it has one.
ATTRIBUTE_PATTERN = (r"[^ \t\n\f\r\"'>/=]+(?:" + _B + r"*=" + _B + r"*(?:\"[^\"]*\"|'[^']*'|[^ \t\n\f\r\"'>]+))?")


def markup(html) -> Column:
    """The html with comments, scripts and styles cut out."""
    return F.regexp_replace(_col(html), NON_MARKUP_PATTERN, " ")


def attr_value(tag, name: str) -> Column:
    """Value of the first attribute ``name`` of an open tag; null when absent
    or without a value."""
    every = F.regexp_extract_all(_col(tag), F.lit(ATTRIBUTE_PATTERN), F.lit(0))
    hit = F.get(F.filter(every, lambda a: F.lower(F.regexp_extract(a, r"^([^ \t\n\f\r=]+)", 1)) == name), F.lit(0))

    def value(raw):
        quoted = raw.startswith('"') | raw.startswith("'")
        val = F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        return F.when(raw != "", unescape(val))

    return let(F.regexp_extract(hit, r"(?s)^[^=]*=" + _B + r"*(.*)$", 1), value)


def links_extract(pages: DataFrame, base, html_col: str = "html", keep=("page_id",)) -> DataFrame:
    """H1: all ``<a href>`` as normalised absolute URLs, in document order,
    duplicates kept. ``base`` is a base URL string or a column."""
    cols = list(keep) + ([base] if isinstance(base, str) and base in pages.columns else [])
    t = pages.select(*cols, F.posexplode(F.regexp_extract_all(markup(html_col), F.lit(A_TAG_PATTERN), 0))
                     .alias("pos", "tag"))
    b = F.col(base) if isinstance(base, str) and base in pages.columns else base
    out = t.select(*keep, "pos", url_normalize(attr_value("tag", "href"), b).alias("url"), "tag")
    return out.where(F.col("url").isNotNull())


def product_links(links: DataFrame, source: str = "carrefour", group_cols=("page_id",)) -> DataFrame:
    """H2: links that pass the product predicate, first occurrence kept."""
    prods = links.where(is_product_url(F.col("url"), source)).select(*group_cols, "pos", "url")
    return stable_distinct(prods, ["url"], "pos", group_cols)


# The fallback regex as meant: a carrefour product path ending in /R-…/p.
# (The source job's raw-string escapes double every backslash, so its own
# patterns never match a normal URL; ``as_written=True`` reproduces that.)
def product_link_patterns(base: str, as_written: bool = False) -> list[str]:
    host = base.split("://", 1)[1].replace(".", r"\.")
    if as_written:
        cls = r"[^\"'\\s>]"
        return [r"(?i)https?://" + host.replace("\\", "\\\\") + r"/supermercado/" + cls + r"+/R-" + cls + r"+/p",
                r"(?i)/supermercado/" + cls + r"+/R-" + cls + r"+/p"]
    cls = r"[^\"'\t\n\f\r >]"
    return [r"(?i)https?://" + host + r"/supermercado/" + cls + r"+/R-" + cls + r"+/p",
            r"(?i)/supermercado/" + cls + r"+/R-" + cls + r"+/p"]


def product_links_regex(pages: DataFrame, base: str, html_col: str = "html", keep=("page_id",),
                        as_written: bool = False) -> DataFrame:
    """H3: regex over raw html; all matches of pattern 1, then pattern 2,
    relative ones made absolute; first occurrence kept."""
    pats = product_link_patterns(base, as_written)
    parts = []
    for i, p in enumerate(pats):
        m = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(p), 0)).alias("pos", "m"))
        url = F.when(F.col("m").startswith("/"), F.concat(F.lit(base), F.col("m"))).otherwise(F.col("m"))
        parts.append(m.select(*keep, F.struct(F.lit(i).alias("pattern"), F.col("pos").alias("pos")).alias("ord"),
                              url.alias("url")))
    found = parts[0].unionByName(parts[1])
    return stable_distinct(found, ["url"], "ord", keep)


def pagination_links(pages: DataFrame, category_url_col: str, base, html_col: str = "html",
                     keep=("page_id",)) -> DataFrame:
    """H4: ``rel~next`` links, plus category links under the category URL
    (before ``?``) that carry ``?``, ``page``, ``pag`` or ``no=``; a set."""
    cols = list(dict.fromkeys(list(keep) + [category_url_col] +
                              ([base] if isinstance(base, str) and base in pages.columns else [])))
    links = links_extract(pages.select(*cols, html_col), base, html_col, keep=tuple(cols))
    cat_base = F.substring_index(F.col(category_url_col), "?", 1)

    def under_category(url):
        low = F.lower(url)
        return (is_category_url(url, "carrefour") & url.startswith(cat_base)
                & (url.contains("?") | low.contains("pag") | low.contains("no=")))

    # the filter is evaluated below the projection, where a link is its whole expression
    paged = let(F.col("url"), under_category)
    # one pass over the pages; a null on either side takes no link
    kept = F.coalesce(attr_value("tag", "rel").contains("next"), F.lit(False)) | F.coalesce(paged, F.lit(False))
    return links.where(kept).select(*keep, "url").distinct()


def anchors_with_text(pages: DataFrame, base, html_col: str = "html", keep=("page_id",)) -> DataFrame:
    """Anchors with href and visible text (tags removed, blanks collapsed)."""
    from pricelake.functions.text import collapse_blanks
    cols = list(keep) + ([base] if isinstance(base, str) and base in pages.columns else [])
    t = pages.select(*cols, F.posexplode(F.regexp_extract_all(markup(html_col), F.lit(ANCHOR_PATTERN), 0))
                     .alias("pos", "a"))
    b = F.col(base) if isinstance(base, str) and base in pages.columns else base
    tag = F.regexp_extract(F.col("a"), r"(?is)^(" + TAG_PATTERN + ")", 1)
    inner = F.regexp_extract(F.col("a"), ANCHOR_PATTERN, 1)
    text = collapse_blanks(unescape(F.regexp_replace(inner, TAG_PATTERN, " ")))
    return t.select(*keep, "pos", url_normalize(attr_value(tag, "href"), b).alias("url"), text.alias("text"))
