"""Page-level predicates over raw html (P14, P15) and visible text (H9).

``visible_text`` is a native approximation of a DOM text walk: comments,
scripts and styles are removed, the rest is cut at tags, each text piece
is unescaped and stripped, and the non-empty pieces are joined by one blank
(the ``get_text(" ", strip=True)`` shape).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions.html import TAG_PATTERN, unescape
from pricelake.functions.text import _col, contains_any, fold_text, strip

def visible_text(html) -> Column:
    x = F.regexp_replace(_col(html), r"(?is)<!--.*?-->", "\u0000")
    x = F.regexp_replace(x, r"(?is)<script[^>]*>.*?</script[^>]*>", "\u0000")
    x = F.regexp_replace(x, r"(?is)<style[^>]*>.*?</style[^>]*>", "\u0000")
    x = F.regexp_replace(x, TAG_PATTERN, "\u0000")
    pieces = F.filter(F.transform(F.split(x, "\u0000"), lambda s: strip(unescape(s))), lambda s: s != "")
    return F.array_join(pieces, " ")


def page_blocked(status, html) -> Column:
    """Status 403 or a block marker anywhere in the raw html."""
    return (F.coalesce(_col(status), F.lit(0)) == 403) | \
        contains_any(F.lower(F.coalesce(_col(html), F.lit(""))), K.BLOCKED_HTML_MARKERS)


def page_markers(text, source: str) -> dict[str, Column]:
    """Location gate, empty results and block flags from visible text.
    Dia folds accents first; Al Campo lower-cases and lists both spellings
    for one phrase only."""
    t = _col(text)
    if source == "dia":
        f = fold_text(t)
        return {"location_gate": contains_any(f, K.LOCATION_GATE_DIA),
                "empty_results": contains_any(f, K.EMPTY_RESULTS),
                "blocked": contains_any(f, K.BLOCKED_TEXT)}
    low = F.lower(t)
    return {"location_gate": contains_any(low, K.LOCATION_GATE_ALCAMPO),
            "empty_results": contains_any(low, K.EMPTY_RESULTS),
            "blocked": contains_any(low, K.BLOCKED_TEXT)}
