"""SQL text fragments for the DuckDB oracle queries.

These mirror the Spark column functions with DuckDB built-ins, written
independently so the oracle checks the Spark plans rather than sharing
their code. Fixed values come from ``pricelake.functions.constants``.
"""

from __future__ import annotations

from pricelake.functions import constants as K


def lit(s: str) -> str:
    """A SQL string literal; control characters spelled with chr()."""
    parts, buf = [], []
    for ch in s:
        if ord(ch) < 32 or 0x7F <= ord(ch) < 0xA0 or ch in "  ":
            if buf:
                parts.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not parts:
        parts.append("'" + "".join(buf).replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")" if len(parts) > 1 else parts[0]


WS = lit(K.WHITESPACE_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def blank(x: str) -> str:
    return f"coalesce({x}, '')"


def fold(x: str, ascii_only: bool = False) -> str:
    """Accents off by DuckDB's own rule (canonical decomposition), with the
    compatibility letters of Spanish text spelled out."""
    compat = f"translate({x}, {lit('ªº²³¹' + chr(160))}, 'ao231 ')"
    plain = f"strip_accents({compat})"
    return f"regexp_replace({plain}, '[^\\x{{0}}-\\x{{7F}}]', '', 'g')" if ascii_only else plain


def fold_text(x: str) -> str:
    return fold(f"lower({strip(x)})")


def contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def initcap_words(x: str) -> str:
    """Capitalise each blank-separated word of a single-blank string."""
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def collapse(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{K.WS_CLASS}+', ' ', 'g')"


def title(x: str) -> str:
    """Python str.title(): per run of letters."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[^\\pL]*\\pL*'), "
            f"lambda p: regexp_extract(p, '^([^\\pL]*)', 1) || upper(regexp_extract(p, '(\\pL*)$', 1)[1:1]) "
            f"|| lower(regexp_extract(p, '(\\pL*)$', 1)[2:])), '')")


def unquote(x: str) -> str:
    """Percent-decoding that keeps '+' (inputs hold only valid escapes)."""
    return f"CASE WHEN contains({x}, '%') THEN url_decode(replace({x}, '+', '%2B')) ELSE {x} END"


def first_upper(x: str) -> str:
    tok = f"trim(split_part({x}, ' ', 1), '.,()')"
    return f"CASE WHEN length({tok}) > 1 AND upper({tok}) = {tok} THEN {tok} ELSE '' END"
