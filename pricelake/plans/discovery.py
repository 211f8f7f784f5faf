"""Weekly target discovery per shop, as Spark plans (H10-H14, J6, J7, A1,
A3, O1, O4, P16).

Navigation pages come from the page snapshot table; the page job reports
their anchors (href, text, slide context) and everything after that is
joins, aggregates and Catalyst expressions. Each function returns targets
``(target_index, group, category, subcategory, url)`` after the
first-wins distinct (A1); ``targets_sort`` (O1) orders them for writing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions import text as T
from pricelake.functions import urls as U
from pricelake.operators import merge as M
from pricelake.operators.targets import group_label
from pricelake.plans.daily import fetched_pages, last_snapshots
from pricelake.session import materialize
from pricelake.sources import html_job as H

def anchors(pages: DataFrame) -> DataFrame:
    """Anchor facts of the last fetched snapshot of every page, keyed by the
    page URL. The navigation pages are parsed once, where they are stored;
    facts, not html, meet the groups and categories."""
    p = fetched_pages(pages)
    a = p.select("url", "page_seq", "html").mapInPandas(H.anchors_job(), "url string, page_seq long, " + H.fields_schema(H.ANCHOR_FIELDS))
    return materialize(last_snapshots(a, p).drop("page_seq").withColumnRenamed("url", "page_url"))


def slice_groups(groups: DataFrame, n: int | None) -> DataFrame:
    """Python-slice ``[:n]`` of the group URL list (``n < 0`` drops
    from the end, ``0`` keeps none). ``groups``: (group_index, url)."""
    if n is None:
        return groups
    if n >= 0:
        return groups.where(F.col("group_index") < n)
    total = groups.agg(F.count(F.lit(1))).scalar()
    return groups.where(F.col("group_index") < total + n)


# ---- Al Campo (H10 + H13) --------------------------------------------------------

def discover_alcampo(groups: DataFrame, pages: DataFrame) -> DataFrame:
    """Group pages -> category links under the same group (accent-folded
    slug match), first per cleaned URL, named by the link text or the
    title-cased last segment; a group page without such links is its own
    target. ``groups``: (group_index, url)."""
    base = K.BASE_URLS["alcampo"]
    g = groups.select("group_index", F.col("url").alias("group_url"),
                      U.group_slug(F.col("url"), "alcampo").alias("group")).where(F.col("group") != "")
    a = anchors(pages).join(g.select(F.col("group_url").alias("page_url")), "page_url", "left_semi")
    clean = U.url_clean(U.url_normalize(F.col("href"), base))
    links = a.select(F.col("page_url").alias("group_url"), "pos", "text", clean.alias("link")) \
        .where(F.col("link").isNotNull())
    segs = U.url_segments(F.col("link"))
    links = links.select("*", segs.alias("segs"))
    links = links.join(g, "group_url")
    ok = (F.size("segs") >= 3) & (U.seg_at(F.col("segs"), 0) == "categories") & \
        (T.slug_key(U.seg_at(F.col("segs"), 1)) == T.slug_key(F.col("group")))
    links = links.where(ok)
    first = M.stable_distinct(links.select("group_index", "group_url", "group", "pos", "link", "text", "segs"),
                              ["link"], "pos", ["group_index", "group_url"])
    name = F.when(T.strip(F.coalesce(F.col("text"), F.lit(""))) != "", F.col("text")) \
        .otherwise(T.title_case(F.replace(U.seg_at(F.col("segs"), -1), F.lit("-"), F.lit(" "))))
    children = first.select("group_url", "pos", name.alias("subcategory"), F.col("link").alias("url"))
    # J7 in one left join: a group without links keeps one row, its fallback.
    j = g.join(children, "group_url", "left")
    has = F.col("url").isNotNull()
    out = j.select(F.struct("group_index", F.coalesce(F.col("pos"), F.lit(-1)).alias("pos")).alias("target_index"),
                   "group", group_label(F.col("group")).alias("category"),
                   F.when(has, F.col("subcategory")).otherwise(F.lit("")).alias("subcategory"),
                   F.when(has, F.col("url")).otherwise(F.col("group_url")).alias("url"))
    return M.targets_distinct(out)


# ---- Dia category links of a group page (H11) ----------------------------------

def category_links_dia(groups: DataFrame, pages: DataFrame) -> DataFrame:
    """Category links of each group page that are not the group page,
    not denied, inside the group's branch (by URL or text); a URL is taken
    once (marked before the empty-name check); named by the text or the
    label of the last path segment; ``(lower(name), url)`` order.
    ``groups``: (group_index, url, group) with the group slug."""
    base = K.BASE_URLS["dia"]
    g = groups.select("group_index", F.col("url").alias("group_url"), F.col("group"))
    a = anchors(pages).join(g.select(F.col("group_url").alias("page_url")), "page_url", "left_semi")
    clean = U.url_clean(U.url_normalize(F.col("href"), base))
    links = a.select(F.col("page_url").alias("group_url"), "pos", "text", clean.alias("url")) \
        .where(F.col("url").isNotNull()).join(g, "group_url")
    wanted = T.fold_text(F.col("group"))
    in_branch = (wanted.isin("", "compra online", "compra-online") |
                 T.fold_text(F.col("url")).contains(wanted) | T.fold_text(F.col("text")).contains(wanted))
    links = links.where((F.col("url") != U.url_clean(F.col("group_url"))) & U.is_category_url(F.col("url"), "dia")
                        & ~U.nav_link_denied(F.col("text"), F.col("url")) & in_branch)
    first = M.stable_distinct(links.select("group_index", "group_url", "pos", "url", "text"), ["url"], "pos",
                              ["group_index", "group_url"])
    name = F.when(F.col("text") != "", F.col("text")).otherwise(
        T.slug_to_label(F.element_at(F.split(U.url_path(F.col("url")), "/"), -1)))
    return first.select("group_index", name.alias("name"), "url").where(F.col("name") != "")


# ---- Dia (H14) --------------------------------------------------------------------

def merge_items(items: DataFrame) -> DataFrame:
    """Collected link items ``(page_url, seq, title, href)`` merged per page
    by absolute URL: the last title wins, the first position stays."""
    abs_url = U.url_normalize(F.col("href"), K.BASE_URLS["dia"])
    it = items.select("page_url", "seq", F.coalesce(F.col("title"), F.lit("")).alias("title"),
                      abs_url.alias("item_url")).where(F.col("item_url").isNotNull())
    return it.groupBy("page_url", "item_url").agg(
        F.min("seq").alias("seq"), F.max_by("title", "seq").alias("title"))


def _dia_links(items: DataFrame, level: str) -> DataFrame:
    """Cleaned, deduplicated category (level 'category') or subcategory
    links of each page, with their title or a label from the path."""
    it = items.select("page_url", "seq", "title", U.url_clean(F.col("item_url")).alias("url"))
    it = it.where(F.col("url") != "")
    segs = U.url_segments(F.col("url"))
    it = it.withColumn("segs", segs).where(U.dia_menu_level(F.col("url")) == level)
    if level == "subcategory":
        root = U.seg_at(U.url_segments(F.col("page_url")), 0)
        it = it.where((F.col("url") != U.url_clean(F.col("page_url"))) &
                      ((root == "") | (U.seg_at(F.col("segs"), 0) == root)))
        fallback = T.slug_to_label(F.when(F.size("segs") >= 3, U.seg_at(F.col("segs"), -3)).otherwise(F.lit("")))
    else:
        fallback = T.slug_to_label(U.seg_at(F.col("segs"), 0))
    title = F.when(T.strip(F.col("title")) != "", T.strip(F.col("title"))).otherwise(fallback)
    it = it.withColumn("name", title).where(F.col("name") != "")
    return M.stable_distinct(it.select("page_url", "seq", "url", "name"), ["url"], "seq", ["page_url"])


def discover_dia(items: DataFrame, home_url: str = K.BASE_URLS["dia"]) -> DataFrame:
    """Home menu items -> categories; each category page's items ->
    subcategories under the same first path segment; categories without
    any become their own target. Category and subcategory lists are in
    ``(lower(name), url)`` order (O2)."""
    merged = merge_items(items)
    cats = _dia_links(merged.where(F.col("page_url") == home_url), "category")
    cats = cats.select(F.col("url").alias("cat_url"), F.col("name").alias("category"),
                       F.struct(F.lower("name").alias("n"), F.col("url").alias("u")).alias("cat_rank"))
    segs = U.url_segments(F.col("cat_url"))
    group = U.group_slug(F.col("cat_url"), "dia")
    group = F.when(group != "", group).when(U.seg_at(segs, 0) != "", U.seg_at(segs, 0)) \
        .otherwise(F.replace(F.lower(T.strip(F.col("category"))), F.lit(" "), F.lit("-")))
    cats = cats.withColumn("group", group)
    subs = _dia_links(merged.join(cats.select(F.col("cat_url").alias("page_url")), "page_url", "left_semi"),
                      "subcategory")
    subs = subs.select(F.col("page_url").alias("cat_url"), F.col("url").alias("url"),
                       F.col("name").alias("subcategory"),
                       F.struct(F.lower("name").alias("n"), F.col("url").alias("u")).alias("sub_rank"))
    j = cats.join(subs, "cat_url", "left")
    has = F.col("url").isNotNull()
    none = F.struct(F.lit("").alias("n"), F.lit("").alias("u"))
    out = j.select(F.struct("cat_rank", F.when(has, F.col("sub_rank")).otherwise(none).alias("sub_rank"))
                   .alias("target_index"), "group", "category",
                   F.when(has, F.col("subcategory")).otherwise(F.lit("")).alias("subcategory"),
                   F.when(has, F.col("url")).otherwise(F.col("cat_url")).alias("url"))
    return M.targets_distinct(out)


# ---- Carrefour (H12) ----------------------------------------------------------------

def _nav_text():
    title = T.strip(F.coalesce(F.col("slide_title"), F.lit("")))
    return F.when(title != "", title).when(F.col("slide_text").isNotNull(), F.col("slide_text")) \
        .otherwise(F.coalesce(F.col("text"), F.lit("")))


def discover_carrefour(groups: DataFrame, pages: DataFrame) -> DataFrame:
    """Group page slides -> categories (first URL per name, sorted by
    name); each category page's nav links -> subcategories. The
    ``bebidas`` group is one level. A category whose page is missing, has
    no nav or no usable link is its own target; a group page without nav
    gives nothing. Names containing 'oferta' or empty are skipped (P16)."""
    base = K.BASE_URLS["carrefour"]
    g = groups.select("group_index", F.col("url").alias("group_url"),
                      U.group_slug(F.col("url"), "carrefour").alias("group")).where(F.col("group") != "")
    every = anchors(pages)
    ga = every.join(g.select(F.col("group_url").alias("page_url")), "page_url", "left_semi")
    ga = ga.where(F.col("in_nav") & F.col("slide_idx").isNotNull() & F.col("href").isNotNull())
    # the first anchor with href of each slide
    firsts = ga.groupBy("page_url", "slide_idx").agg(F.min(F.struct("pos", "href", "text", "slide_title",
                                                                    "slide_text")).alias("a"))
    slides = firsts.select("page_url", "slide_idx", "a.*")
    url = U.url_normalize(F.col("href"), base)
    slides = slides.select(F.col("page_url").alias("group_url"), "pos", url.alias("url"), _nav_text().alias("name"))
    slides = slides.where(F.col("url").isNotNull() & U.is_category_url(F.col("url"), "carrefour")
                          & (F.col("name") != "") & ~F.lower(F.col("name")).contains("oferta"))
    slides = slides.join(g, "group_url")
    one_level = slides.where(F.col("group") == "bebidas").select(
        F.struct("group_index", F.lit("").alias("cat"), "pos").alias("target_index"), "group",
        F.lit("Bebidas").alias("category"), F.col("name").alias("subcategory"), "url")
    cats = M.first_url_per_name(slides.where(F.col("group") != "bebidas"), "name", "url", "pos",
                                ["group_index", "group"])
    cats = cats.select("group_index", "group", F.col("name").alias("category"), F.col("url").alias("cat_url"))
    ca = every.join(cats.select(F.col("cat_url").alias("page_url")), "page_url", "left_semi")
    ca = ca.where(F.col("in_nav") & F.col("href").isNotNull())
    sub_url = U.url_normalize(F.col("href"), base)
    subs = ca.select(F.col("page_url").alias("cat_url"), "pos", sub_url.alias("url"), _nav_text().alias("name"))
    subs = subs.where(F.col("url").isNotNull() & U.is_category_url(F.col("url"), "carrefour")
                      & (F.col("name") != "") & ~F.lower(F.col("name")).contains("oferta"))
    j = cats.join(subs, "cat_url", "left")
    has = F.col("url").isNotNull()
    two_level = j.select(
        F.struct("group_index", F.col("category").alias("cat"), F.coalesce(F.col("pos"), F.lit(-1)).alias("pos"))
        .alias("target_index"), "group", "category",
        F.when(has, F.col("name")).otherwise(F.lit("")).alias("subcategory"),
        F.when(has, F.col("url")).otherwise(F.col("cat_url")).alias("url"))
    return M.targets_distinct(one_level.unionByName(two_level))
