"""URL predicates and rewrites as Catalyst expressions.

``parse_url`` is not used: it returns null as soon as a URL holds a blank,
and it does not cut ``;params`` off the path the way the source jobs' URL
splitting does. An RFC-3986 style regex gives the parts instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions.text import _col, fold_text, let, strip, url_unquote, contains_any, coalesce_blank

_SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?"
NETLOC_PATTERN = r"^" + _SCHEME + r"//([^/?#]*)"
PATH_PATTERN = r"^" + _SCHEME + r"(?://[^/?#]*)?([^?#]*)"


def base_for(source: str) -> str:
    return K.BASE_URLS[source]


def url_normalize(href, base) -> Column:
    """``//x`` -> ``https://x``; ``/x`` -> base + ``/x``; ``http(s)://``
    kept; anything else (``#x``, ``mailto:``, ``./x``, ``""``) -> null."""
    b = F.lit(base) if isinstance(base, str) else base
    return let(strip(_col(href)), lambda h: F.when(h.startswith("//"), F.concat(F.lit("https:"), h))
               .when(h.startswith("/"), F.concat(b, h))
               .when(h.startswith("http://") | h.startswith("https://"), h))


def url_clean(url) -> Column:
    """Drop query and fragment."""
    return F.substring_index(F.substring_index(_col(url), "?", 1), "#", 1)


def url_netloc(url) -> Column:
    return F.regexp_extract(coalesce_blank(url), NETLOC_PATTERN, 1)


def url_path(url) -> Column:
    """Path without ``;params`` of the last segment."""
    return let(F.regexp_extract(coalesce_blank(url), PATH_PATTERN, 1),
               lambda p: F.when(p.contains(";"), F.regexp_replace(p, r";[^/]*$", "")).otherwise(p))


def raw_segments(url) -> Column:
    """Non-empty path segments, not decoded."""
    return F.filter(F.split(url_path(url), "/"), lambda s: s != "")


def url_segments(url) -> Column:
    """Decoded non-empty path segments."""
    return F.transform(raw_segments(url), lambda s: url_unquote(s))


def seg_at(segs: Column, i: int) -> Column:
    """0-based index, out of range -> ``""``."""
    return F.coalesce(F.try_element_at(segs, F.lit(i + 1 if i >= 0 else i)), F.lit(""))


# ---- P4 / P5 per source ---------------------------------------------------

def is_product_url(url, source: str) -> Column:
    return let(coalesce_blank(url), lambda u: _is_product(u, source))


def _is_product(u: Column, source: str) -> Column:
    if source == "carrefour":
        return u.contains("/p")
    if source == "alcampo":
        return u.contains("/products/") & let(url_netloc(u), lambda host: (host == "") | host.contains(K.ALCAMPO_HOST))
    if source == "dia":
        return (u != "") & let(url_netloc(u), lambda host: (host == "") | host.contains(K.DIA_HOST)) & \
            contains_any(F.lower(url_path(u)), K.DIA_PRODUCT_MARKERS)
    raise ValueError(source)


def is_category_url(url, source: str) -> Column:
    return let(coalesce_blank(url), lambda u: _is_category(u, source))


def _is_category(u: Column, source: str) -> Column:
    if source == "carrefour":
        return u.contains("/c")
    if source == "dia":
        return ((u != "") & ~_is_product(u, "dia") & let(url_netloc(u), lambda host: (host == "") | host.contains(K.DIA_HOST))
                & contains_any(F.lower(url_path(u)), ["/compra-online", *K.DIA_CATEGORY_MARKERS]))
    raise ValueError(source)


# ---- P6 / P7 ---------------------------------------------------------------

_LEVEL_ID = r"^[Ll][0-9]+$"


def dia_menu_level(url) -> Column:
    """P6: 'category' for ``/x/c/L<digits>``, 'subcategory' for
    ``…/c/L<digits>`` with at least 4 segments, else ''."""
    segs = url_segments(url)
    n = F.size(segs)
    cat = (n == 3) & (seg_at(segs, 1) == "c") & seg_at(segs, 2).rlike(_LEVEL_ID)
    sub = (n >= 4) & (seg_at(segs, -2) == "c") & seg_at(segs, -1).rlike(_LEVEL_ID)
    return F.when(cat, "category").when(sub, "subcategory").otherwise("")


def group_slug(url, source: str) -> Column:
    if source == "carrefour":
        segs = raw_segments(url)
        return F.when((F.size(segs) >= 2) & (seg_at(segs, 0) == "supermercado"), seg_at(segs, 1)).otherwise("")
    if source == "alcampo":
        segs = raw_segments(url)
        return F.when((F.size(segs) >= 2) & (seg_at(segs, 0) == "categories"),
                      url_unquote(seg_at(segs, 1))).otherwise("")
    if source == "dia":
        segs = url_segments(url)
        n = F.size(segs)
        i_co = F.array_position(segs, "compra-online")
        i_c = F.array_position(segs, "c")
        return (F.when(i_co > 0, F.when(i_co < n, F.element_at(segs, (i_co + 1).cast("int")))
                       .otherwise("compra-online"))
                .when(i_c > 1, F.element_at(segs, (i_c - 1).cast("int")))
                .when((i_c == 1) & (n > 1), F.element_at(segs, 2))
                .when(n > 0, F.element_at(segs, -1))
                .otherwise(""))
    raise ValueError(source)


def nav_link_denied(text, url) -> Column:
    """Folded text or url contains one of the deny words."""
    return contains_any(fold_text(coalesce_blank(text)), K.NAV_DENY_WORDS) | \
        contains_any(fold_text(coalesce_blank(url)), K.NAV_DENY_WORDS)


# ---- P9 / P10 --------------------------------------------------------------

def category_api_url(cat_id) -> Column:
    pre, post = K.MERCADONA_CATEGORY_API.split("{category_id}")
    return F.concat(F.lit(pre), _col(cat_id).cast("string"), F.lit(post))


def mercadona_product_url(share_url, product_id, slug) -> Column:
    """share_url, else /product/{id}/{slug}, else /product/{id}, else ''."""
    s = strip(coalesce_blank(share_url))
    i = strip(coalesce_blank(product_id))
    g = strip(coalesce_blank(slug))
    pre = K.MERCADONA_PRODUCT_URL.split("{product_id}")[0]
    return (F.when(s != "", s)
            .when((i != "") & (g != ""), F.concat(F.lit(pre), i, F.lit("/"), g))
            .when(i != "", F.concat(F.lit(pre), i))
            .otherwise(""))


def category_id_from_url(url) -> Column:
    """P10: id at the end of ``/api/categories/{id}/?``; null if absent."""
    return F.regexp_extract(coalesce_blank(url), r"/api/categories/([0-9]+)/?$", 1).try_cast("bigint")
