"""Text functions as Catalyst expressions (Column -> Column).

Every function here stays JVM-side: built-in string, regex and array
functions only, so they run inside whole-stage codegen. Regexes use explicit
character classes so that Java regex and RE2 (the SQL oracle) agree.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache, reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions import constants as K

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c, f) -> Column:
    """``f(c)`` with ``c`` computed once a row, however often ``f`` names it."""
    return F.get(F.transform(F.array(_col(c)), f), F.lit(0))


_HANGUL = (0xAC00, 0xD7A3)
#: Consonant, vowel and final jamo by their index in a syllable (index 0 of the finals: none).
_LEAD, _VOWEL, _TAIL = ("".join(chr(base + i) for i in range(n)) for base, n in
                        ((0x1100, 19), (0x1161, 21), (0x11A7, 28)))


@lru_cache(maxsize=None)
def fold_table(ascii_only: bool) -> tuple[str, str, dict[str, str], str]:
    """(from_chars, to_chars, multi, dropped) for accent folding, built from
    NFKD over all of Unicode.

    ``ascii_only=False``: NFKD with combining marks dropped (other
    characters kept). ``ascii_only=True``: NFKD then everything non-ASCII
    dropped. Characters that fold to one char are for ``translate``,
    longer results in ``multi``; ``dropped`` is a regex class of what goes.
    Hangul syllables fold by arithmetic and are in none of them.
    """
    src, dst, multi, gone = [], [], {}, []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or _HANGUL[0] <= cp <= _HANGUL[1]:
            continue
        ch = chr(cp)
        d = unicodedata.normalize("NFKD", ch)
        out = "".join(c for c in d if (ord(c) < 128 if ascii_only else not unicodedata.combining(c)))
        if out == ch:
            continue
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif out:
            multi[ch] = out
        elif not ascii_only:
            gone.append(ch)
    return "".join(src), "".join(dst), multi, r"[^\x00-\x7F]" if ascii_only else char_class(gone)


#: Latin letters, punctuation and currency signs: what texts in European languages consist of.
_COMMON = (range(0x80, 0x250), range(0x2010, 0x2070), range(0x20A0, 0x20D0))


@lru_cache(maxsize=None)
def common_letters(ascii_only: bool) -> tuple[str, str, str]:
    """(regex class of all characters but ASCII and the common ones that fold to
    one character, to themselves or, with ``ascii_only``, to nothing; from_chars,
    to_chars for ``translate``, which drops those behind the last of to_chars)."""
    src, dst, multi, _ = fold_table(ascii_only)
    to = dict(zip(src, dst))
    stay = [c for c in map(chr, chain(*_COMMON)) if c in to or c not in multi and (ascii_only or not unicodedata.combining(c))]
    mapped = [c for c in stay if c in to]
    gone = [c for c in stay if c not in to] if ascii_only else []
    return "[^\\x00-\\x7F" + char_class(stay)[1:], "".join(mapped + gone), "".join(to[c] for c in mapped)


#: Code points in one block of ``fold_blocks``.
_BLOCK = 64


@lru_cache(maxsize=None)
def fold_blocks(ascii_only: bool) -> str:
    """JSON of what every code point folds to, by block and place in it; null
    for what stays (what goes, with ``ascii_only``) and for Hangul syllables."""
    src, dst, multi, _ = fold_table(ascii_only)
    to = dict(zip(src, dst)) | multi
    if not ascii_only:
        to |= {c: "" for c in map(chr, range(0x80, sys.maxunicode + 1))
               if c not in to and all(map(unicodedata.combining, unicodedata.normalize("NFKD", c)))}
    blocks: list[list] = [[] for _ in range(max(map(ord, to)) // _BLOCK + 1)]
    for c, out in to.items():
        block, place = blocks[ord(c) // _BLOCK], ord(c) % _BLOCK
        block += [None] * (place + 1 - len(block))
        block[place] = out
    return json.dumps(blocks, ensure_ascii=False)


def char_class(chars) -> str:
    """A regex class of the given characters, as ranges of code points."""
    cps = sorted(map(ord, chars))
    runs = []
    for cp in cps:
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{z:X}}}" if z > a else "") for a, z in runs) + "]"


def strip(c) -> Column:
    """Python ``str.strip()``: trims every Unicode blank, not just U+0020."""
    return F.btrim(_col(c), F.lit(K.WHITESPACE_CHARS))


def strip_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)``."""
    return F.btrim(_col(c), F.lit(chars))


def coalesce_blank(c) -> Column:
    """``x or ""`` for strings."""
    return F.coalesce(_col(c), F.lit(""))


def nfkd_fold(c, ascii_only: bool = False) -> Column:
    """NFKD without combining marks (or without anything non-ASCII). Plain
    ASCII text passes untouched, and of other text than that of European
    languages every character is looked up by its code point."""
    blocks = F.from_json(F.lit(fold_blocks(ascii_only)), "array<array<string>>")

    def jamo(letters, at):
        return F.substring(F.lit(letters), at.cast("int") + 1, F.lit(1))

    def folded(piece):
        code = F.ascii(piece)
        out = F.get(F.get(blocks, F.floor(code / _BLOCK).cast("int")), code % _BLOCK)
        if ascii_only:
            return F.when(code < 0x80, piece).otherwise(F.coalesce(out, F.lit("")))
        n = code - _HANGUL[0]
        tail = n % 28
        return (F.when(code < 0x80, piece)
                .when(n.between(0, _HANGUL[1] - _HANGUL[0]), F.concat(
                    jamo(_LEAD, F.floor(n / 588)), jamo(_VOWEL, F.floor(n % 588 / 28)),
                    F.when(tail > 0, jamo(_TAIL, tail)).otherwise(F.lit(""))))
                .otherwise(F.coalesce(out, piece)))

    # letters of European languages fold one to one
    plain, few_src, few_dst = common_letters(ascii_only)

    def fold(x):
        pieces = F.regexp_extract_all(x, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0))
        return (F.when(~x.rlike(r"[^\x00-\x7F]"), x).when(~x.rlike(plain), F.translate(x, few_src, few_dst))
                .otherwise(F.array_join(F.transform(pieces, folded), "")))

    return let(c, fold)


def fold_text(c) -> Column:
    """strip, lower, NFKD, drop combining marks."""
    return nfkd_fold(F.lower(strip(c)))


def url_unquote(c) -> Column:
    """percent-decoding that keeps ``+`` and leaves bad input as it is."""
    x = _col(c)
    return F.when(x.contains("%"),
                  F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)).otherwise(x)


def slug_key(c) -> Column:
    """unquote, strip, lower, NFKD fold."""
    return nfkd_fold(F.lower(strip(url_unquote(c))))


def first_token(c) -> Column:
    """Text before the first U+0020 (``s.split(" ", 1)[0]``)."""
    return F.substring_index(_col(c), " ", 1)


def brand_first_upper(name) -> Column:
    """first blank-separated token stripped of ``.,()`` when it is
    longer than one char and equal to its upper case; else ``""``."""
    tok = strip_chars(first_token(name), ".,()")
    return F.when((F.length(tok) > 1) & (F.upper(tok) == tok), tok).otherwise(F.lit(""))


# FIXED VALUES: price and unit price patterns (WS stands for the blank class).
PRICE_PATTERN = r"([0-9]{1,3}(?:[.,][0-9]{3})*[.,][0-9]{2})WS*€".replace("WS", K.WS_CLASS)
PPU_DIA_PATTERN = (r"(?i)([0-9]{1,3}(?:[.,][0-9]{3})*[.,][0-9]{2}WS*€WS*(?:/|por)WS*[\p{L}\p{N}_%]+)"
                   .replace("WS", K.WS_CLASS))
PPU_ALCAMPO_PATTERN = r"(?i)([0-9]+[.,][0-9]+WS*€WS*(?:/|por)WS*[\p{L}\p{N}_]+)".replace("WS", K.WS_CLASS)


def price_extract(c) -> Column:
    """the first ``d{1,3}([.,]ddd)*[.,]dd`` followed by the euro sign."""
    return strip(F.regexp_extract(coalesce_blank(c), PRICE_PATTERN, 1))


def ppu_tidy(c) -> Column:
    return F.replace(c, F.lit("€/"), F.lit("€ / "))


def ppu_extract_dia(c) -> Column:
    """Price + euro + ``/`` or ``por`` + unit word, NBSP as blank."""
    m = F.regexp_extract(coalesce_blank(c), PPU_DIA_PATTERN, 1)
    return ppu_tidy(strip(F.replace(m, F.lit("\xa0"), F.lit(" "))))


def ppu_extract_alcampo(c) -> Column:
    """F6b (regex branch): looser number, no ``%`` in the unit."""
    m = strip(F.regexp_extract(coalesce_blank(c), PPU_ALCAMPO_PATTERN, 1))
    return ppu_tidy_alcampo(m)


def ppu_tidy_alcampo(c) -> Column:
    """NBSP to blank, strip ``() ``, ``€/`` -> ``€ / ``."""
    return ppu_tidy(strip_chars(F.replace(_col(c), F.lit("\xa0"), F.lit(" ")), "() "))


def contains_any(c, words) -> Column:
    return let(c, lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in words]))


def offer_flag_lower(c, keywords) -> Column:
    """F7 for Al Campo / Carrefour: lower-cased text contains a keyword."""
    return contains_any(F.lower(coalesce_blank(c)), [k.lower() for k in keywords])


def offer_flag_dia(c) -> Column:
    """F7 for Dia: accent-folded text contains a keyword."""
    return contains_any(fold_text(coalesce_blank(c)), K.OFFER_KEYWORDS_DIA)


def price_text_clean(c, nbsp: bool = True) -> Column:
    """NBSP to blank (Al Campo), drop the euro sign, strip."""
    x = _col(c)
    if nbsp:
        x = F.replace(x, F.lit("\xa0"), F.lit(" "))
    return strip(F.replace(x, F.lit("€"), F.lit("")))


_LETTER_RUN = r"[^\p{L}]*\p{L}*"


def title_case(c) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run
    of letters and lower-case the rest (so ``l'oréal`` -> ``L'Oréal``)."""
    parts = F.regexp_extract_all(_col(c), F.lit(_LETTER_RUN), 0)
    fixed = F.transform(parts, lambda p: F.concat(
        F.regexp_extract(p, r"^([^\p{L}]*)", 1),
        F.upper(F.substring(F.regexp_extract(p, r"(\p{L}*)$", 1), 1, 1)),
        F.lower(F.substring(F.regexp_extract(p, r"(\p{L}*)$", 1), 2, 1 << 30))))
    return F.array_join(fixed, "")


def collapse_blanks(c) -> Column:
    """``" ".join(s.split())``."""
    return F.regexp_replace(strip(c), K.WS_CLASS + "+", " ")


def capitalize_words(c) -> Column:
    """``" ".join(t.capitalize() for t in s.split())``."""
    return F.initcap(collapse_blanks(c))


def slug_to_label(c) -> Column:
    """strip blanks and ``/``, unquote, ``-``/``_`` to blank, capitalise words."""
    s = strip_chars(strip(coalesce_blank(c)), "/")
    s = url_unquote(s)
    return capitalize_words(F.translate(s, "-_", "  "))


def subcategory_label(target, leaf) -> Column:
    """``target / leaf`` when both set and different ignoring case."""
    t = strip(coalesce_blank(target))
    lf = strip(coalesce_blank(leaf))
    both = (lf != "") & (t != "") & (F.lower(lf) != F.lower(t))
    return F.when(both, F.concat(t, F.lit(" / "), lf)).when(lf != "", lf).otherwise(t)


def slugify(c) -> Column:
    """NFKD to ASCII, non-alphanumeric runs to ``-``, strip ``-``, lower;
    empty -> ``mercadona``."""
    a = nfkd_fold(coalesce_blank(c), ascii_only=True)
    s = F.lower(strip_chars(F.regexp_replace(a, "[^a-zA-Z0-9]+", "-"), "-"))
    return F.when(s == "", F.lit(K.MERCADONA_SLUG_DEFAULT)).otherwise(s)


def brand_tail(name) -> Column:
    """Up to three trailing title-case tokens without digits."""
    tok_class = "[A-Za-z0-9" + K.BRAND_TOKEN_EXTRA + "]+"
    toks = F.reverse(F.regexp_extract_all(_col(name), F.lit(tok_class), 0))
    bad = F.transform(toks, lambda t: ~(t.rlike("^[A-Z" + K.BRAND_TAIL_UPPER + "]") & ~t.rlike("[0-9]")))
    first_bad = F.array_position(bad, True)
    n = F.when(first_bad == 0, F.size(toks)).otherwise(first_bad - 1)
    take = F.least(n, F.lit(K.BRAND_TAIL_MAX))
    return F.array_join(F.reverse(F.slice(toks, 1, take)), " ")


def known_brand(name) -> Column:
    """First known brand contained in the lower-cased name (list order)."""
    low = F.lower(_col(name))
    out = F.lit(None).cast("string")
    for b in reversed(K.KNOWN_BRANDS):
        out = F.when(F.contains(low, F.lit(b.lower())), F.lit(b)).otherwise(out)
    return out


def brand_ladder(brand, display_name) -> Column:
    """F8: direct brand -> known brand in the name -> F4 -> trailing
    title-case tokens -> ``""``."""
    direct = strip(coalesce_blank(brand))
    name = strip(coalesce_blank(display_name))
    f4 = brand_first_upper(name)
    tail = brand_tail(name)
    return (F.when(direct != "", direct)
            .when(known_brand(name).isNotNull(), known_brand(name))
            .when(name == "", F.lit(""))
            .when(f4 != "", f4)
            .otherwise(tail))


def join_text(*cols) -> Column:
    """``" ".join`` of the non-null parts."""
    return F.concat_ws(" ", *[_col(c) for c in cols])


def iso_utc(ts) -> Column:
    """F16: seconds-precision ISO text with ``Z``."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
