"""JSON payloads of the shop API as VARIANT.

Payload fields change type from product to product (a price may be a
number, a string, 0 or null), and the rules depend on Python truthiness,
so fields are read as VARIANT and typed with ``schema_of_variant``:
``null``/``false``/``0``/``""``/``[]``/``{}`` are false, everything else is
true; the text of a value is its Python ``str`` for scalars.
A payload that does not parse or is not an object is a failed page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import _col, let, strip, brand_ladder, slugify, subcategory_label
from pricelake.functions.urls import mercadona_product_url, category_api_url


def field(v, name: str) -> Column:
    return F.try_variant_get(_col(v), f"$.{name}", "variant")


def vtype(x) -> Column:
    return F.coalesce(F.schema_of_variant(_col(x)), F.lit("VOID"))


def is_object(x) -> Column:
    # the type as text names all that is below the value
    return F.try_variant_get(_col(x), "$", "map<string,variant>").isNotNull()


def is_array(x) -> Column:
    return F.try_variant_get(_col(x), "$", "array<variant>").isNotNull()


def truthy(x) -> Column:
    """Python ``bool(x)`` of a JSON value."""
    return _truthy_typed(_col(x), vtype(x))


def py_text(x) -> Column:
    """``str(x or "").strip()`` for JSON scalars."""
    return let(x, lambda v: let(vtype(v), lambda t: _text_typed(v, t, _truthy_typed(v, t))))


# ---- S3 -------------------------------------------------------------------------

def flatten_category_payload(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """S3: ``categories[] -> products[]`` rows with leaf and product
    positions. Non-list levels give nothing, non-object elements are
    skipped. Pages whose payload is not an object give no rows (see
    ``payload_ok``)."""
    v = F.try_parse_json(F.col(payload_col))
    cats = F.when(is_object(v), F.try_variant_get(v, "$.categories", "array<variant>"))
    leaves = df.select(*keep, F.posexplode(F.coalesce(cats, F.array().cast("array<variant>")))
                       .alias("leaf_pos", "leaf")).where(is_object("leaf"))
    prods = F.coalesce(F.try_variant_get("leaf", "$.products", "array<variant>"), F.array().cast("array<variant>"))
    out = leaves.select(*keep, "leaf_pos", py_text(field("leaf", "name")).alias("leaf_name"),
                        F.posexplode(prods).alias("prod_pos", "p"))
    return out.where(is_object("p"))


def payload_ok(payload) -> Column:
    return is_object(F.try_parse_json(_col(payload)))


def typed_fields(df: DataFrame, src: str, names, prefix: str = "") -> DataFrame:
    """Extract JSON fields of VARIANT column ``src`` once each, then their
    type, text and truthiness in later projections (so a field is read
    once, not once per use)."""
    df = df.select("*", *[field(src, n).alias(f"{prefix}{n}__v") for n in names])
    df = df.select("*", *[vtype(f"{prefix}{n}__v").alias(f"{prefix}{n}__t") for n in names])
    out = []
    for n in names:
        v, t = F.col(f"{prefix}{n}__v"), F.col(f"{prefix}{n}__t")
        out.append(_truthy_typed(v, t).alias(f"{prefix}{n}__b"))
    df = df.select("*", *out)
    texts = []
    for n in names:
        v, t, b = F.col(f"{prefix}{n}__v"), F.col(f"{prefix}{n}__t"), F.col(f"{prefix}{n}__b")
        texts.append(_text_typed(v, t, b).alias(f"{prefix}{n}"))
    return df.select("*", *texts).drop(*[f"{prefix}{n}__{x}" for n in names for x in ("v", "t")])


def _truthy_typed(v: Column, t: Column) -> Column:
    num = F.try_variant_get(v, "$", "double")
    return (F.when(t == "VOID", False)
            .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(t == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
            .when(t.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
            .when(t.startswith("OBJECT"), t != "OBJECT<>")
            .otherwise(F.coalesce(num != 0, F.lit(False))))


def _text_typed(v: Column, t: Column, b: Column) -> Column:
    s = F.try_variant_get(v, "$", "string")
    floaty = t.startswith("DECIMAL") | (t == "DOUBLE") | (t == "FLOAT")
    s = (F.when(t == "BOOLEAN", F.lit("True"))
         .when(floaty & ~s.contains(".") & ~F.upper(s).contains("E"), F.concat(s, F.lit(".0")))
         .otherwise(s))
    return F.when(b, strip(s)).otherwise(F.lit(""))


_PRODUCT_FIELDS = ["id", "display_name", "brand", "share_url", "slug"]
_PRICE_FIELDS = ["bulk_price", "reference_price", "reference_format", "unit_price", "size_format",
                 "price_decreased", "previous_unit_price"]


def product_rows(flat: DataFrame, target_subcategory: str, keep=()) -> DataFrame:
    """Mercadona product rows from flattened payload products (F8, F12,
    F14, F6c, P9)."""
    df = flat.select(*keep, target_subcategory, "leaf_pos", "prod_pos", "leaf_name", "p",
                     field("p", "price_instructions").alias("pi_raw"))
    df = df.select("*", F.when(is_object("pi_raw"), F.col("pi_raw")).alias("pi")).drop("pi_raw")
    df = typed_fields(df, "p", _PRODUCT_FIELDS, "p_")
    df = typed_fields(df, "pi", _PRICE_FIELDS, "pi_")
    rp, rf, up, sf = (F.col("pi_reference_price"), F.col("pi_reference_format"), F.col("pi_unit_price"),
                      F.col("pi_size_format"))
    ppu = (F.when((rp != "") & (rf != ""), F.concat(rp, F.lit(" €/"), rf))
           .when((up != "") & (sf != ""), F.concat(up, F.lit(" €/"), sf))
           .otherwise(F.lit("")))
    offer = F.coalesce(F.col("pi_price_decreased__b") | F.col("pi_previous_unit_price__b"), F.lit(False))
    return df.select(
        *keep, "leaf_pos", "prod_pos",
        F.col("p_id").alias("product_id"),
        F.col("p_display_name").alias("product"),
        brand_ladder("p_brand", "p_display_name").alias("brand"),
        F.col("pi_bulk_price").alias("price"), ppu.alias("price_per_unit"), offer.alias("offer"),
        subcategory_label(F.col(target_subcategory), F.col("leaf_name")).alias("subcategory"),
        mercadona_product_url("p_share_url", "p_id", "p_slug").alias("product_url"))


def fill_brand_from_details(rows: DataFrame, details: DataFrame, enabled: bool = True) -> DataFrame:
    """A blank brand with a product id is looked up in the product
    details (one row per id); a failed lookup gives ``""``."""
    if not enabled:
        return rows
    d = details.select(F.col("id").alias("_id"), F.col("brand").alias("_detail_brand")).dropDuplicates(["_id"])
    need = (F.col("brand") == "") & (F.col("product_id") != "")
    j = rows.join(d, (F.col("product_id") == F.col("_id")) & need, "left")
    return j.withColumn("brand", F.when(need, F.coalesce(strip(F.col("_detail_brand")), F.lit("")))
                        .otherwise(F.col("brand"))).drop("_id", "_detail_brand")


# ---- S4 / P11 -----------------------------------------------------------------------

def flatten_group_payload(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """``results[] -> categories[]`` as targets ``(group, category,
    subcategory, url, target_index)``; nameless groups, unpublished
    (explicit ``false``) and id/name-less categories are skipped."""
    v = F.try_parse_json(F.col(payload_col))
    res = F.when(is_object(v), F.try_variant_get(v, "$.results", "array<variant>"))
    groups = df.select(*keep, F.posexplode(F.coalesce(res, F.array().cast("array<variant>"))).alias("g_pos", "g"))
    groups = groups.where(is_object("g")).withColumn("group_name", py_text(field("g", "name"))) \
        .where(F.col("group_name") != "")
    cats = F.coalesce(F.try_variant_get("g", "$.categories", "array<variant>"), F.array().cast("array<variant>"))
    sub = groups.select(*keep, "g_pos", "group_name", F.posexplode(cats).alias("c_pos", "c")).where(is_object("c"))
    published = F.try_variant_get("c", "$.published", "boolean")
    ptype = vtype(field("c", "published"))
    sub = sub.where(~((ptype == "BOOLEAN") & (published == F.lit(False))))
    cid = field("c", "id")
    sub = sub.where(truthy(cid) & (py_text(field("c", "name")) != ""))
    # ``int(id)``: a number, or text holding an integer; anything else fails
    # the job, as it does in the original.
    t = vtype(cid)
    as_int = F.when(t == "STRING", F.try_variant_get(cid, "$", "string").try_cast("bigint")) \
        .otherwise(F.try_variant_get(cid, "$", "bigint"))
    as_int = F.when(as_int.isNull(), F.raise_error(F.lit("category id is not an integer"))
                    .cast("bigint")).otherwise(as_int)
    return sub.select(
        *keep,
        F.struct("g_pos", "c_pos").alias("target_index"),
        slugify("group_name").alias("group"),
        F.col("group_name").alias("category"),
        py_text(field("c", "name")).alias("subcategory"),
        category_api_url(as_int).alias("url"))
