"""Driver queries for the scalar text functions (F1, F4-F13) over card
texts built from ``part`` and over the whole ``documents`` texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions import text as T
from pricelake.plans import sqlfrag as S
from pricelake.plans.registry import query
from pricelake.plans.views import load_view, read_table, with_views

_C = with_views("cards_base")


def _cards(spark, sf_dir):
    return load_view(spark, sf_dir, "cards_base")


# -- F5 / F9 ------------------------------------------------------------------

_PRICE_SQL = _C + f"""
SELECT pos,
  {S.strip(f"regexp_extract({S.blank('card_text')}, '{T.PRICE_PATTERN}', 1)")} AS price,
  {S.strip("replace(replace(price_text, chr(160), ' '), '€', '')")} AS price_clean,
  {S.strip("replace(price_text, '€', '')")} AS price_clean_keep_nbsp
FROM cards_base
"""


@query("price_extract", _PRICE_SQL)
def q_price_extract(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return c.select("pos", T.price_extract("card_text").alias("price"),
                    T.price_text_clean("price_text").alias("price_clean"),
                    T.price_text_clean("price_text", nbsp=False).alias("price_clean_keep_nbsp"))


# -- F6a / F6b ------------------------------------------------------------------

def _ppu_tidy_sql(x: str) -> str:
    return f"replace({x}, '€/', '€ / ')"


_PPU_SQL = _C + f"""
SELECT pos,
  {_ppu_tidy_sql(S.strip(f"replace(regexp_extract(card_text, '{T.PPU_DIA_PATTERN}', 1), chr(160), ' ')"))} AS ppu_dia,
  {_ppu_tidy_sql(f"trim(replace({S.strip(f"regexp_extract(card_text, '{T.PPU_ALCAMPO_PATTERN}', 1)")}, chr(160), ' '), '() ')")} AS ppu_alcampo,
  {_ppu_tidy_sql("trim(replace(ppu_text, chr(160), ' '), '() ')")} AS ppu_alcampo_element
FROM cards_base
"""


@query("ppu_extract", _PPU_SQL)
def q_ppu_extract(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return c.select("pos", T.ppu_extract_dia("card_text").alias("ppu_dia"),
                    T.ppu_extract_alcampo("card_text").alias("ppu_alcampo"),
                    T.ppu_tidy_alcampo("ppu_text").alias("ppu_alcampo_element"))


# -- F7 -------------------------------------------------------------------------

def _offer_sql(x: str) -> str:
    return (f"{S.contains_any(f'lower({x})', [k.lower() for k in K.OFFER_KEYWORDS_ALCAMPO])} AS offer_alcampo, "
            f"{S.contains_any(f'lower({x})', [k.lower() for k in K.OFFER_KEYWORDS_CARREFOUR])} AS offer_carrefour, "
            f"{S.contains_any(S.fold_text(x), K.OFFER_KEYWORDS_DIA)} AS offer_dia")


def _offer_cols(c):
    return [T.offer_flag_lower(c, K.OFFER_KEYWORDS_ALCAMPO).alias("offer_alcampo"),
            T.offer_flag_lower(c, K.OFFER_KEYWORDS_CARREFOUR).alias("offer_carrefour"),
            T.offer_flag_dia(c).alias("offer_dia")]


@query("offer_flag", _C + f"SELECT pos, {_offer_sql('card_text')} FROM cards_base")
def q_offer_flag(spark, sf_dir):
    return _cards(spark, sf_dir).select("pos", *_offer_cols("card_text"))


@query("offer_flag_documents", f"SELECT doc_id, {_offer_sql('text')} FROM documents")
def q_offer_flag_documents(spark, sf_dir):
    """Keyword flags over whole document texts."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", *_offer_cols("text"))


# -- F4 / F8 --------------------------------------------------------------------

@query("brand_first_upper", _C + f"SELECT pos, {S.first_upper('name')} AS brand FROM cards_base")
def q_brand_first_upper(spark, sf_dir):
    return _cards(spark, sf_dir).select("pos", T.brand_first_upper("name").alias("brand"))


def _brand_ladder_sql() -> str:
    name = S.strip(S.blank("name"))
    direct = S.strip(S.blank("brand_direct"))
    known = " ".join(f"WHEN contains(lower({name}), {S.lit(b.lower())}) THEN {S.lit(b)}" for b in K.KNOWN_BRANDS)
    cls = S.lit("[A-Za-z0-9" + K.BRAND_TOKEN_EXTRA + "]+")
    upper_start = S.lit("^[A-Z" + K.BRAND_TAIL_UPPER + "]")
    rev = f"list_reverse(regexp_extract_all({name}, {cls}))"
    bad = (f"coalesce(list_position(list_transform({rev}, lambda t: NOT (regexp_matches(t, {upper_start}) "
           f"AND NOT regexp_matches(t, '[0-9]'))), true), 0)")
    take = f"least(CASE WHEN {bad} = 0 THEN len({rev}) ELSE {bad} - 1 END, {K.BRAND_TAIL_MAX})"
    tail = f"array_to_string(list_reverse({rev}[1:{take}]), ' ')"
    return (f"CASE WHEN {direct} <> '' THEN {direct} {known} WHEN {name} = '' THEN '' "
            f"WHEN {S.first_upper(name)} <> '' THEN {S.first_upper(name)} ELSE {tail} END")


@query("brand_ladder", _C + f"SELECT pos, {_brand_ladder_sql()} AS brand FROM cards_base")
def q_brand_ladder(spark, sf_dir):
    return _cards(spark, sf_dir).select("pos", T.brand_ladder("brand_direct", "name").alias("brand"))


# -- F13 / F1 / F10 -------------------------------------------------------------

def _slugify_sql(x: str) -> str:
    s = f"lower(trim(regexp_replace({S.fold(S.blank(x), ascii_only=True)}, '[^a-zA-Z0-9]+', '-', 'g'), '-'))"
    return f"CASE WHEN {s} = '' THEN 'mercadona' ELSE {s} END"


@query("slugify", _C + f"SELECT pos, {_slugify_sql('name')} AS slug, {_slugify_sql('category_label')} AS "
                       f"group_slug FROM cards_base")
def q_slugify(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return c.select("pos", T.slugify("name").alias("slug"), T.slugify("category_label").alias("group_slug"))


@query("slugify_documents", f"SELECT doc_id, {_slugify_sql('text')} AS slug FROM documents")
def q_slugify_documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.slugify("text").alias("slug"))


@query("fold_text", f"SELECT doc_id, {S.fold_text('text')} AS folded FROM documents")
def q_fold_text(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", T.fold_text("text").alias("folded"))


@query("title_case", _C + f"SELECT pos, {S.title('name')} AS title, {S.title('card_text')} AS card_title "
                          f"FROM cards_base")
def q_title_case(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return c.select("pos", T.title_case("name").alias("title"), T.title_case("card_text").alias("card_title"))


# -- F11 / F12 ------------------------------------------------------------------

def _slug_to_label_sql(x: str) -> str:
    s = f"trim({S.strip(S.blank(x))}, '/')"
    s = S.unquote(s)
    return S.initcap_words(S.collapse(f"translate({s}, '-_', '  ')"))


_LABEL_SQL = with_views("targets_base") + f"""
, slugs AS (
  SELECT target_index, regexp_extract(url, '([^/]*)$', 1) || '/' AS slug FROM targets_base
  UNION ALL SELECT target_index, ' ' || replace("group", 'o', '_O') || '_-x%20y/' FROM targets_base)
SELECT target_index, slug, {_slug_to_label_sql('slug')} AS label FROM slugs
"""


@query("slug_to_label", _LABEL_SQL)
def q_slug_to_label(spark, sf_dir):
    t = load_view(spark, sf_dir, "targets_base")
    slugs = t.select("target_index", F.concat(F.regexp_extract("url", "([^/]*)$", 1), F.lit("/")).alias("slug")) \
        .unionByName(t.select("target_index", F.concat(F.lit(" "), F.replace("group", F.lit("o"), F.lit("_O")),
                                                       F.lit("_-x%20y/")).alias("slug")))
    return slugs.select("target_index", "slug", T.slug_to_label("slug").alias("label"))


_SUBCAT_SQL = _C + f"""
, pairs AS (
  SELECT pos, category_label AS target, leaf FROM cards_base
  UNION ALL SELECT pos, category_label, upper(category) FROM cards_base
  UNION ALL SELECT pos, '', leaf FROM cards_base
  UNION ALL SELECT pos, ' ' || category_label, '' FROM cards_base)
SELECT pos, target, leaf,
  CASE WHEN {S.strip('leaf')} <> '' AND {S.strip('target')} <> '' AND lower({S.strip('leaf')}) <> lower({S.strip('target')})
       THEN {S.strip('target')} || ' / ' || {S.strip('leaf')}
       WHEN {S.strip('leaf')} <> '' THEN {S.strip('leaf')} ELSE {S.strip('target')} END AS label
FROM pairs
"""


@query("subcategory_label", _SUBCAT_SQL)
def q_subcategory_label(spark, sf_dir):
    c = _cards(spark, sf_dir)
    pairs = (c.select("pos", F.col("category_label").alias("target"), "leaf")
             .unionByName(c.select("pos", F.col("category_label").alias("target"), F.upper("category").alias("leaf")))
             .unionByName(c.select("pos", F.lit("").alias("target"), "leaf"))
             .unionByName(c.select("pos", F.concat(F.lit(" "), F.col("category_label")).alias("target"),
                                   F.lit("").alias("leaf"))))
    return pairs.select("pos", "target", "leaf", T.subcategory_label("target", "leaf").alias("label"))


# -- F1 / F2 / F13 on decorated letters ---------------------------------------------
# Each text is a plain one whose letters were replaced by composed, decomposed,
# ligature, full-width, mathematical and Hangul forms; the expected fold is the
# plain text itself, so the check shares no table with the Spark side.

#: (plain, decorated): composed, decomposed, ligature, full-width, mathematical.
_DECORATED = [("fi", "\ufb01"), ("a", "\u00e1"), ("e", "e\u0301"), ("o", "\uff4f"), ("n", "n\u0303"), ("s", "\U0001d4c8"),
              ("u", "\u01d8"), ("c", "\u1e09"), ("kg", "\u338f")]


def _decorate_sql(x: str, chars) -> str:
    for plain, fancy in chars:
        x = f"replace({x}, '{plain}', '{fancy}')"
    return x


_PLAIN = "'kg fi ' || lower(name)"
_FOLD_IN = _decorate_sql(_PLAIN, _DECORATED)


@query("fold_decorated", _C + f"""
SELECT pos, {S.strip(_PLAIN)} AS folded, {_slugify_sql(_PLAIN)} AS slug FROM cards_base WHERE name = strip_accents(name)
""")
def q_fold_decorated(spark, sf_dir):
    c = _cards(spark, sf_dir).where("name RLIKE '^[\\\\x00-\\\\x7F]*$'")
    x = F.expr(_FOLD_IN)
    return c.select("pos", T.fold_text(x).alias("folded"), T.slugify(x).alias("slug"))
