"""Product rows from page cards and JSON-LD.

The page job (``sources.html_job``) reports every node a card selector
matched with the named elements around and below it, and raw ld+json blocks.
Here, in Catalyst: the element each field is read from, the product URL rule
per shop, the first selector that yields a card with a URL (the least rank of
the page), dedup by URL inside the page (first node wins), and the field
rules; JSON-LD is walked and read as VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions import text as T
from pricelake.functions.urls import url_clean, url_normalize, is_product_url
from pricelake.session import materialize
from pricelake.sources import html_job as H
from pricelake.sources import payloads as P

PRODUCT_FIELDS = ["product", "brand", "price", "price_per_unit", "offer", "product_url"]


def page_facts(pages: DataFrame, source: str | None, blocks: bool = False, anchors: bool = False, bare: bool = False,
               html_col: str = "html") -> DataFrame:
    """Run the page job: facts of every page next to its other columns."""
    keys = [f for f in pages.schema.fields if f.name != html_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keys] + [H.fields_schema(H.fact_fields(source))])
    return pages.select(*[f.name for f in keys], html_col).mapInPandas(
        H.page_facts_job(source, blocks, anchors, bare, html_col), schema)


def card_facts(pages: DataFrame, source: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per (page, card node)."""
    return page_facts(pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html")), source)


# ---- the element each field is read from (H7) -------------------------------------

def _element(role: str) -> Column:
    """The value of a role's element, or the values of all of them in document order; null without one."""
    return F.col(H.element_column(role))


def _filled(*columns) -> Column:
    """The first of the columns that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def _roles(source: str, name: str) -> list[str]:
    return [r for r in H.ELEMENTS[source] if r.startswith(name + " ") and r.rsplit(" ", 1)[-1].isdigit()]


def _priced(role: str, need_amount: bool) -> Column:
    """First text of a role with a euro sign (and something besides it)."""
    def ok(t):
        has = t.contains("€")
        return has & (T.strip(F.replace(t, F.lit("€"), F.lit(""))) != "") if need_amount else has
    return F.get(F.filter(_element(role), ok), F.lit(0))


def read_elements(facts: DataFrame, source: str) -> DataFrame:
    """Card facts with link_href, name, brand_el, price_raw, ppu_raw and
    offer_link taken from their named elements."""
    none = F.lit(None).cast("string")
    names = [_element(r) for r in _roles(source, "name")]
    if source == "dia":
        cols = {"link_href": _element("link"), "name": _filled(*names, T.strip(_element("image"))), "brand_el": _element("brand"),
                "price_raw": F.coalesce(*[_priced(r, True) for r in _roles(source, "price")]), "ppu_raw": none,
                "offer_link": F.lit(False)}
    elif source == "alcampo":
        pack = F.filter(_element("pack size"), lambda t: t.contains("€") & F.lower(t).contains("por"))
        cols = {"link_href": _element("link"), "name": _filled(*names, T.strip(_element("image"))), "brand_el": none,
                "price_raw": _filled(_element("price"), _element("old price"),
                                     *[_priced(r, False) for r in _roles(source, "price")]),
                "ppu_raw": _filled(_element("unit price"), T.strip_chars(F.get(pack, F.lit(0)), "() ")),
                "offer_link": _element("offer link").isNotNull()}
    else:
        titles = _element("title link")
        cols = {"link_href": F.when(titles.isNotNull(), F.get(titles, F.lit(0))).otherwise(_element("media link")),
                "name": _filled(_element("name")), "brand_el": _filled(_element("brand")),
                "price_raw": _filled(T.strip(_element("parent price")), _element("price")),
                "ppu_raw": _filled(T.strip(_element("parent unit price")), _element("unit price")),
                "offer_link": F.lit(False)}
    gone = {"raw", "kind", *(H.element_column(r) for r in H.ELEMENTS[source])}
    return facts.select(*[c for c in facts.columns if c not in gone], *[c.alias(n) for n, c in cols.items()])


def _url_rule(source: str):
    base = K.BASE_URLS[source]

    def ok(href):
        n = F.coalesce(url_normalize(href, base), F.lit(""))
        return T.let(url_clean(n) if source == "dia" else n, lambda u: F.when(is_product_url(u, source), u))

    return ok


def product_cards(facts: DataFrame, source: str) -> DataFrame:
    """H5 + H6: the cards of the first productive selector per page, one
    per product URL (the first node wins). Carrefour takes every
    ``div.product-card`` as it is. ``facts`` are card facts of the page job."""
    facts = read_elements(facts, source)
    if source == "carrefour":
        url = F.coalesce(url_normalize(F.col("link_href"), K.BASE_URLS["carrefour"]), F.lit(""))
        return facts.withColumn("product_url", url)
    ok = _url_rule(source)
    # A filter would be evaluated below the projection, with the rule once more.
    url = F.coalesce(ok(F.col("own_href")), ok(F.col("link_href")))
    with_url = facts.withColumn("product_url", F.explode(F.array_compact(F.array(url))))
    # One shuffle by page: the first productive selector of the page, then
    # the first node per product URL. A page's cards are bounded by the
    # page, so the window partitions stay small.
    page = Window.partitionBy("page_id")
    first_node = Window.partitionBy("page_id", "product_url").orderBy("node_pos")
    least = F.col("ranks").bitwiseAND(F.negate("ranks"))  # the lowest bit
    chosen = with_url.withColumn("_r", F.min(least).over(page)).where(F.col("ranks").bitwiseAND(F.col("_r")) != 0)
    return chosen.withColumn("_n", F.row_number().over(first_node)).where(F.col("_n") == 1).drop("_r", "_n")


def card_fields(cards: DataFrame, source: str, keys=("page_id",)) -> DataFrame:
    """H7a/b/c: product, brand, price, unit price and offer flag."""
    text = F.coalesce(F.col("card_text"), F.lit(""))
    name = F.coalesce(F.col("name"), F.lit(""))
    if source == "dia":
        raw = F.col("price_raw")
        from_el = T.let(T.price_extract(raw), lambda p: F.when(p != "", p)
                        .otherwise(T.strip(F.replace(raw, F.lit("€"), F.lit("")))))
        price = F.when(raw.isNotNull(), from_el).otherwise(T.price_extract(text))
        ppu_el = F.when(raw.isNotNull(), T.ppu_extract_dia(raw)).otherwise(F.lit(""))
        ppu = T.let(ppu_el, lambda p: F.when(p != "", p).otherwise(T.ppu_extract_dia(text)))
        brand_el = F.coalesce(F.col("brand_el"), F.lit(""))
        brand = F.when(brand_el != "", brand_el).otherwise(T.brand_first_upper(name))
        offer = T.offer_flag_dia(text)
    elif source == "alcampo":
        raw = F.coalesce(F.col("price_raw"), F.lit(""))
        price = F.when(raw != "", T.price_text_clean(raw)).otherwise(F.lit(""))
        ppu_raw = F.coalesce(F.col("ppu_raw"), F.lit(""))
        ppu = F.when(ppu_raw != "", T.ppu_tidy_alcampo(ppu_raw)).otherwise(T.ppu_extract_alcampo(text))
        brand = T.brand_first_upper(name)
        offer = F.col("offer_link") | T.offer_flag_lower(text, K.OFFER_KEYWORDS_ALCAMPO)
    else:
        price = F.coalesce(F.col("price_raw"), F.lit(""))
        ppu = F.coalesce(F.col("ppu_raw"), F.lit(""))
        brand = F.coalesce(F.col("brand_el"), F.lit(""))
        offer = T.offer_flag_lower(text, K.OFFER_KEYWORDS_CARREFOUR)
    return cards.select(*keys, "node_pos", name.alias("product"), brand.alias("brand"),
                        price.alias("price"), ppu.alias("price_per_unit"), offer.alias("offer"), "product_url")


def page_products(pages: DataFrame, source: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Cards -> product rows for one shop (P12: Al Campo and Dia need a
    product URL, which the card rule already demands)."""
    facts = card_facts(pages, source, id_col, html_col)
    return card_fields(product_cards(facts, source), source)


# ---- JSON-LD (H8) ----------------------------------------------------------------

def jsonld_blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Raw ld+json blocks of each page."""
    return page_facts(pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html")), None, blocks=True)


def jsonld_objects(blocks: DataFrame, keys=("page_id",)) -> DataFrame:
    """Every JSON-LD object of each parsable block with its place
    (``block_pos``, ``path``): an object, the objects of its ``@graph`` list,
    then the ``item`` objects of its ``itemListElement`` list; lists are
    walked element by element. Paths sort in document order. A round unfolds
    one level of all blocks, until no level is left; each level is written once,
    with the type of its values, so a round reads the level above it, no block is
    parsed twice and no value is looked through twice for its type."""
    def written(values):
        kind = F.when(P.is_object("v"), "object").when(P.is_array("v"), "array")
        return materialize(values.where(F.col("v").isNotNull()).select(*keys, "block_pos", "path", "v", kind.alias("_kind")))

    # the filter on v is not pushed through the generator, below which v would be parsed once more
    level = written(blocks.where("kind = 'block'").select(*keys, F.col("node_pos").alias("block_pos"),
                                                  F.array().cast("array<int>").alias("path"),
                                                  F.explode(F.array(F.try_parse_json("raw"))).alias("v")))
    none = F.array().cast("array<variant>")

    def listed(v, path="$"):
        return F.coalesce(F.try_variant_get(v, path, "array<variant>"), none)

    out = []
    while True:
        kind = F.col("_kind")
        out.append(level.where(kind == "object").drop("_kind"))
        items = F.filter(F.transform(listed(F.col("v"), "$.itemListElement"), lambda e: F.try_variant_get(e, "$.item", "variant")),
                         lambda e: P.is_object(e))
        below = F.when(kind == "array", listed(F.col("v"))).when(
            kind == "object", F.concat(listed(F.col("v"), "$['@graph']"), items)).otherwise(none)
        level = written(level.select(*keys, "block_pos", "path", F.posexplode(below).alias("_i", "v"))
                        .select(*keys, "block_pos", F.concat("path", F.array("_i")).alias("path"), "v"))
        if level.isEmpty():
            break
    objects = out[0]
    for o in out[1:]:
        objects = objects.unionByName(o)
    return objects


def jsonld_products(objects: DataFrame, keys=("page_id",)) -> DataFrame:
    """Objects whose type mentions a product or that have a name, with a
    non-empty name; key = cleaned URL or lower name; first wins per page.
    Unit price only from a dict offer; offer always false."""
    def f(name, of="v"):
        return F.try_variant_get(of, f"$.{name}", "variant")

    # field by field in projections of their own, so that each is looked up once
    found = objects.select(*keys, "block_pos", "path", F.try_variant_get("v", "$['@type']", "variant").alias("type"),
                           f("name").alias("named"), f("brand").alias("maker"), f("offers").alias("offers"), f("url").alias("link"))
    found = found.select("*", P.is_object("offers").alias("one"), F.try_variant_get("offers", "$[0]", "variant").alias("listed"),
                         F.when(P.is_object("maker"), f("name", "maker")).when(P.vtype("maker") == "STRING", F.col("maker"))
                         .alias("maker_name"))
    found = found.select("*", F.when(F.col("one"), f("price", "offers")).when(P.is_object("listed"), f("price", "listed"))
                         .alias("amount"), F.when(F.col("one"), f("priceSpecification", "offers")).alias("specification"))
    rows = found.select(
        *keys, "block_pos", "path", P.py_text("type").alias("type_text"), F.col("named").isNotNull().alias("has_name"),
        # a generator: the filter below takes its column as it is and does not compute it once more
        F.explode(F.array(P.py_text("named"))).alias("name"),
        P.py_text("maker_name").alias("brand"), P.py_text("amount").alias("price"),
        P.py_text("specification").alias("price_spec"), P.py_text("link").alias("url_raw"))
    rows = rows.where((T.fold_text(F.col("type_text")).contains("product") | F.col("has_name")) & (F.col("name") != ""))
    n = url_normalize(F.col("url_raw"), K.BASE_URLS["dia"])
    url = F.coalesce(F.when(n.isNotNull(), url_clean(n)), F.lit(""))
    rows = rows.select(*keys, "block_pos", "path", F.col("name").alias("product"), "brand", "price",
                       T.ppu_extract_dia(F.col("price_spec")).alias("price_per_unit"),
                       F.lit(False).alias("offer"), url.alias("product_url"))
    rows = rows.withColumn("_key", F.when(F.col("product_url") != "", F.col("product_url"))
                           .otherwise(F.lower(F.col("product"))))
    w = Window.partitionBy(*keys, "_key").orderBy("block_pos", "path")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_key", "_n")
