"""Character references and tags of raw html as Catalyst expressions."""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions.text import let

#: A tag; ``>`` may stand inside quoted attribute values.
TAG_PATTERN = r"<(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"

_SEP = "\x01"
#: How Windows-1252 reads the code points 80-9F that references must not name.
_CP1252 = {i: bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xA0)}


@lru_cache(maxsize=None)
def _tables() -> tuple[str, str, str]:
    """(names, values, open): all named references without ``&`` and ``;``,
    and an alternation of those that also count without a semicolon."""
    whole = {n[:-1]: v for n, v in html5.items() if n.endswith(";")}
    bare = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return _SEP.join(whole), _SEP.join(whole.values()), "|".join(bare)


def _char(code: Column) -> Column:
    """The character of a code point, as references name it."""
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    out = F.when((code > 0x10FFFF) | (code == 0) | code.between(0xD800, 0xDFFF), F.lit("�")).otherwise(text)
    for cp, ch in _CP1252.items():
        if ch != "�":
            out = F.when(code == cp, F.lit(ch)).otherwise(out)
    return out


def unescape(c) -> Column:
    """Decoded character references: decimal, hexadecimal and every named
    one, the legacy names also without a semicolon. Text without ``&``
    passes untouched."""
    names, values, bare = _tables()
    table = F.map_from_arrays(F.split(F.lit(names), _SEP), F.split(F.lit(values), _SEP))
    token = rf"&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?|&[A-Za-z][A-Za-z0-9]*;|&(?:{bare})|[^&]+|&"

    def decoded(piece):
        hexa = F.regexp_extract(piece, "^&#[xX]([0-9A-Fa-f]+);?$", 1)
        deci = F.regexp_extract(piece, "^&#([0-9]+);?$", 1)
        name = F.regexp_extract(piece, "^&([A-Za-z][A-Za-z0-9]*);?$", 1)
        start = F.regexp_extract(piece, f"^&({bare})", 1)
        code = F.coalesce(F.try_to_number(F.conv(F.nullif(hexa, F.lit("")), 16, 10), F.lit("9" * 20)),
                          F.try_to_number(F.nullif(deci, F.lit("")), F.lit("9" * 20))).cast("double")
        numeric = (hexa != "") | (deci != "")
        whole = F.try_element_at(table, name)
        legacy = F.when(start != "", F.concat(F.try_element_at(table, start),
                                              F.substring(piece, F.length(start) + 2, F.length(piece))))
        return (F.when(~piece.startswith("&"), piece)
                .when(numeric, _char(F.least(F.coalesce(code, F.lit(2.0 ** 31)), F.lit(2.0 ** 31)).cast("long")))
                .otherwise(F.coalesce(whole, legacy, piece)))

    def whole_text(x):
        pieces = F.transform(F.regexp_extract_all(x, F.lit(token), F.lit(0)), decoded)
        return F.when(x.contains("&"), F.array_join(pieces, "")).otherwise(x)

    return let(c, whole_text)
