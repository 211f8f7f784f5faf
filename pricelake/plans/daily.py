"""The daily product job per shop, as one Spark plan.

targets -> (A5+J3 first N categories) -> J1 join to the page snapshots ->
page job (cards, JSON-LD, payloads) -> U3 branch choice -> P12 row filter ->
W2 cap per target -> A2/J4 merge per target (Dia) -> W1 first-wins across
the run -> O3 total limit -> P13 projection with the run date -> S7 sink.

The page table replaces fetching: one row per fetched snapshot with its
``status``. An error status or a block page is a failed fetch, as is a target
without any page row; it yields no rows and the run goes on. The table handed
in is the shop's and day's own (a partition of the page store), so it is
parsed as it stands: facts, never html, are joined to the targets.

``pos`` places a row inside its page as ``(part, path)``: card rows before
JSON-LD rows, links before regex finds, paths in document order.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.operators import cards as C
from pricelake.operators import merge as M
from pricelake.operators.pages import page_blocked
from pricelake.session import materialize
from pricelake.sources import payloads as PL

_PAGE = ("page_id", "url", "page_seq")


def position(part: int, *path):
    """A row's place in its page; any number of any size sorts right."""
    return F.struct(F.lit(part).alias("part"), F.concat(*path).alias("path"))


def fetched_pages(pages: DataFrame) -> DataFrame:
    """The snapshots that were fetched: (page_id, url, page_seq, html)
    without error statuses and block pages. ``snapshot_seq``, ``status`` and
    ``blocked`` (as the page store keeps it) are optional columns."""
    seq = F.col("snapshot_seq") if "snapshot_seq" in pages.columns else F.lit(0)
    status = F.col("status") if "status" in pages.columns else F.lit(200)
    blocked = F.col("blocked") if "blocked" in pages.columns else page_blocked(status, F.col("html"))
    p = pages.where((F.coalesce(status, F.lit(0)) < 400) & ~blocked)
    return p.select(F.concat_ws("\u0000", F.col("url"), seq.cast("string")).alias("page_id"), "url",
                    seq.cast("long").alias("page_seq"), "html")


def last_snapshots(facts: DataFrame, pages: DataFrame) -> DataFrame:
    """Facts of the last fetched snapshot of each URL. ``pages`` are fetched
    pages; only their keys are read."""
    last = pages.groupBy("url").agg(F.max("page_seq").alias("page_seq"))
    return facts.join(last, ["url", "page_seq"], "left_semi")


def _page_facts(pages: DataFrame, source: str):
    """Pages parsed once (cards and, for Dia, JSON-LD from the same parse):
    (card rows, JSON-LD rows)."""
    facts = materialize(C.page_facts(fetched_pages(pages), source, blocks=source == "dia"))
    ld = None
    if source == "dia":
        objects = C.jsonld_objects(facts.where("kind = 'block'"), _PAGE)
        ld = C.jsonld_products(objects, _PAGE).select(
            *_PAGE, F.lit("jsonld").alias("kind"),
            position(1, F.array("block_pos"), F.col("path")).alias("pos"), *C.PRODUCT_FIELDS)
    return _card_rows(facts, source), ld


def _card_rows(facts: DataFrame, source: str) -> DataFrame:
    cards = C.card_fields(C.product_cards(facts.where("kind = 'card'"), source), source, _PAGE)
    return cards.select(*_PAGE, F.lit("card").alias("kind"), position(0, F.array("node_pos")).alias("pos"),
                        *C.PRODUCT_FIELDS)


def _to_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.select("target_index", "category", "subcategory", "url")
    return rows.join(t, "url").drop("url", "page_id")


def daily_products(targets: DataFrame, pages: DataFrame, source: str, run_date: dt.date | str,
                   max_products: int | None = None, max_categories: int | None = None,
                   allow_duplicates: bool = False, max_pages: int | None = None, chosen: bool = False) -> DataFrame:
    """Product rows of one daily run of ``source`` (html shops). ``chosen``
    says that ``pages`` holds the last good snapshot of each URL only (from
    ``page_store.last_pages``).

    Al Campo and Dia read every snapshot of a target page as the scroll
    feed: rows merge per key across snapshots (last wins, first position
    kept); Dia also takes JSON-LD rows of snapshots while no URL row has been
    seen (W3) and keys URL-less rows by name (J4). The HTML
    fallback of the original loop reads the same final snapshot, so it can
    add nothing a non-empty feed lacks and is not a separate branch here.
    Carrefour walks pagination links from each target page (I1, capped by
    ``max_pages``) and takes per page cards, else product links, else
    regex URLs (U3)."""
    t = M.keep_first_n_values(targets, "category", max_categories)
    if source == "carrefour":
        rows = carrefour_rows(t, pages, max_pages, chosen).withColumn("merge_rank", F.lit(0))
    else:
        cards, ld = _page_facts(pages, source)
        feed = cards if ld is None else cards.unionByName(ld)
        rows = _to_targets(feed, t)
        rows = rows.where((F.col("product") != "") | (F.col("product_url") != ""))
        if source == "dia":
            # The gate reads the rows twice: computed once.
            rows = M.jsonld_gate(materialize(rows), "target_index", "page_seq", "kind")
        rows = M.merge_last_wins(rows.drop("kind"), trim_used_names=False)
        rows = M.cap_per_group(rows, max_products, ["target_index"], ["merge_rank", "page_seq", "pos"])
        if source == "dia":
            rows = M.merge_last_wins(rows)
    # The run's rows feed two branches of the dedup: computed once.
    rows = M.dedup_first_wins(materialize(rows), allow_duplicates=allow_duplicates)
    rows = M.limit_total(rows, max_products)
    return project(rows, run_date)


def carrefour_rows(targets: DataFrame, pages: DataFrame, max_pages: int | None = None, chosen: bool = False) -> DataFrame:
    """I1 + U3 for Carrefour, on the last snapshot of each page: walk each
    target's pagination (links of the visited page under the target URL, or
    ``rel=next``), then per visited page the card rows, else the product
    links (H2), else regex product URLs (H3). A page without a row is a
    failed fetch: it counts as visited and gives nothing. Pages are parsed
    once; the html of pages without a card is kept for the regexes, and only
    theirs. Without ``chosen``, older snapshots are parsed too and dropped by
    their keys, since choosing first would shuffle html."""
    from pricelake.operators import links as L
    from pricelake.operators.walk import pagination_walk
    base = K.BASE_URLS["carrefour"]
    p = fetched_pages(pages)
    every = C.page_facts(p, "carrefour", anchors=True, bare=True)
    facts = materialize(every if chosen else last_snapshots(every, p))
    # Every round of the walk reads the anchors: their links are made once.
    anchors = materialize(facts.where("kind = 'anchor'").select(
        F.col("url").alias("src_id"), F.col("node_pos").alias("pos"),
        F.explode(F.array_compact(F.array(L.url_normalize(F.col("own_href"), base)))).alias("link"),
        F.coalesce(F.col("raw"), F.lit("")).alias("rel")))
    roots = targets.select(F.col("target_index").alias("root_id"), F.col("url").alias("page_id"), "url")
    cat = targets.select(F.col("target_index").alias("root_id"),
                         F.substring_index(F.col("url"), "?", 1).alias("_base"))

    def expand(frontier):
        f = frontier.select("root_id", F.col("page_id").alias("src_id")).join(cat, "root_id")
        a = f.join(anchors, "src_id")
        low = F.lower(F.col("link"))
        keep = F.col("rel").contains("next") | (
            L.is_category_url(F.col("link"), "carrefour") & F.col("link").startswith(F.col("_base"))
            & (F.col("link").contains("?") | low.contains("pag") | low.contains("no=")))
        return a.where(keep).select("root_id", "src_id", F.col("link").alias("page_id"), F.col("link").alias("url")) \
            .distinct()

    visits = pagination_walk(roots, expand, max_pages=max_pages)
    cards = _card_rows(facts, "carrefour").drop("kind", "page_id", "page_seq")
    blank = [F.lit("").alias("product"), F.lit("").alias("brand"), F.lit("").alias("price"),
             F.lit("").alias("price_per_unit"), F.lit(False).alias("offer")]
    bare = facts.where("kind = 'bare'").select("url", F.col("raw").alias("html"))
    linked = L.product_links(anchors.join(bare.select(F.col("url").alias("src_id")), "src_id", "left_semi")
                             .select(F.col("src_id").alias("page_id"), "pos", F.col("link").alias("url")),
                             "carrefour", ("page_id",))
    links = linked.select(F.col("page_id").alias("url"), position(1, F.array("pos")).alias("pos"), *blank,
                          F.col("url").alias("product_url"))
    rx = L.product_links_regex(bare.withColumnRenamed("url", "pid"), base, keep=("pid",))
    rx = rx.join(linked.select(F.col("page_id").alias("pid")).distinct(), "pid", "left_anti")
    rx = rx.select(F.col("pid").alias("url"), position(2, F.array("ord.pattern", "ord.pos")).alias("pos"), *blank,
                   F.col("url").alias("product_url"))
    v = visits.select("root_id", F.col("page_id").alias("url"), "page_seq")
    t = targets.select(F.col("target_index").alias("root_id"), "category", "subcategory")
    return (cards.unionByName(links).unionByName(rx).join(v, "url").join(t, "root_id")
            .select(F.col("root_id").alias("target_index"), F.col("page_seq").cast("long").alias("page_seq"), "pos",
                    *C.PRODUCT_FIELDS, "category", "subcategory"))


def run_summary(targets: DataFrame, pages: DataFrame, rows: DataFrame) -> DataFrame:
    """A4 + A6: the run's counts as (metric, value) rows: targets, targets
    with a fetched page, failed fetches (no page, an error status or a block
    page: the run goes on without them), and product rows written."""
    good = fetched_pages(pages).select("url").distinct().withColumn("good", F.lit(True))
    t = targets.join(good, "url", "left").agg(
        F.count(F.lit(1)).alias("targets"), F.count_if(F.col("good")).alias("targets_fetched"),
        F.count_if(F.col("good").isNull()).alias("failed_fetches"))
    counts = t.unpivot([], ["targets", "targets_fetched", "failed_fetches"], "metric", "value")
    return counts.unionByName(rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows").alias("metric"), "value"))


def project(rows: DataFrame, run_date) -> DataFrame:
    """The nine product columns in their fixed order (plus the order
    columns), blanks for missing text, the run date as a parameter."""
    d = F.lit(str(run_date)).cast("date")
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("product", "brand", "price", "price_per_unit",
                                                          "category", "subcategory", "product_url")}
    return rows.select("target_index", "merge_rank", "page_seq", "pos", d.alias("date"), text["product"].alias("product"),
                       text["brand"].alias("brand"), text["price"].alias("price"),
                       text["price_per_unit"].alias("price_per_unit"),
                       F.coalesce(F.col("offer"), F.lit(False)).alias("offer"),
                       text["category"].alias("category"), text["subcategory"].alias("subcategory"),
                       text["product_url"].alias("product_url"))


def mercadona_products(targets: DataFrame, payload_pages: DataFrame, run_date, details: DataFrame | None = None,
                       max_products: int | None = None, max_categories: int | None = None,
                       allow_duplicates: bool = False) -> DataFrame:
    """The Mercadona run: category payloads instead of html (S3, F8, F14,
    F12, P9, J2), capped per target, first-wins across the run."""
    t = M.keep_first_n_values(targets, "category", max_categories)
    j = t.join(payload_pages.select(F.col("url"), F.col("payload")), "url")
    flat = PL.flatten_category_payload(j, "payload", keep=("target_index", "category", "subcategory"))
    rows = PL.product_rows(flat, "subcategory", keep=("target_index", "category"))
    if details is not None:
        rows = PL.fill_brand_from_details(rows, details)
    rows = rows.select("target_index", F.lit(0).alias("merge_rank"), F.lit(0).alias("page_seq"),
                       position(0, F.array("leaf_pos", "prod_pos")).alias("pos"), *C.PRODUCT_FIELDS,
                       "category", "subcategory")
    rows = M.cap_per_group(rows, max_products, ["target_index"], ["page_seq", "pos"])
    rows = M.dedup_first_wins(materialize(rows), allow_duplicates=allow_duplicates)
    rows = M.limit_total(rows, max_products)
    return project(rows, run_date)


def write_daily(rows: DataFrame, base: str, source: str, run_date, rows_per_file: int = 0) -> str:
    """The run's rows (order columns dropped, in run order) as one object
    per source and day, ``<base>/<source>/<day>/<source>_supermercado_<day>.parquet``.

    The object is a Parquet folder of as many part files as the sort has
    partitions, of ``rows_per_file`` rows at most if that is given. They are written beside it, under a name that no reader lists,
    and the finished folder gets the object's name in one rename: the name never
    holds a part of a day, and a run that fails leaves the earlier object."""
    from pricelake.sources.landing import _fs
    spark = rows.sparkSession
    folder = f"{base.rstrip('/')}/{source}/{run_date}"
    path, staging = f"{folder}/{source}_supermercado_{run_date}.parquet", f"{folder}/_staging-{uuid.uuid4().hex[:12]}"
    order = [c for c in M.ORDER_COLS if c in rows.columns]
    (rows.orderBy(*order) if order else rows).select(*K.PRODUCT_COLUMNS) \
        .write.option("maxRecordsPerFile", rows_per_file).parquet(staging)
    fs, done = _fs(spark, path)
    fs.delete(done, True)
    if not fs.rename(_fs(spark, staging)[1], done):
        raise OSError(f"{staging} could not be renamed to {path}")
    return path
