"""Fixed values that must equal the source jobs' values for equal results.

Everything in the block below is data, kept in its natural order. Larger
tables (accent folding) are built from a rule in ``pricelake.functions.text``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original jobs)
# ---------------------------------------------------------------------------

BASE_URLS = {
    "carrefour": "https://www.carrefour.es",
    "alcampo": "https://www.compraonline.alcampo.es",
    "dia": "https://www.dia.es",
    "mercadona": "https://tienda.mercadona.es",
}

# Offer keywords as listed for Al Campo and Carrefour (matched lower-cased,
# accents kept) and for Dia (matched on accent-folded text).
OFFER_KEYWORDS_ALCAMPO = ["Promoción", "Promocion", "Oferta", "Descuento", "2ª unidad", "2a unidad", "Rebaja"]
OFFER_KEYWORDS_CARREFOUR = ["Promoción", "Promocion", "Oferta", "Descuento", "2ª unidad", "2a unidad", "Rebaja"]
OFFER_KEYWORDS_DIA = ["promocion", "promo", "oferta", "descuento", "2a unidad", "2 unidad", "rebaja", "pack ahorro"]

# Markers searched in the raw (lower-cased) html of a fetched page.
BLOCKED_HTML_MARKERS = ["access denied", "request blocked", "checking your browser", "captcha"]

# Visible-text markers of pages without products.
LOCATION_GATE_ALCAMPO = ["código postal", "codigo postal", "elige tu tienda", "selecciona tu tienda",
                         "introduce tu código"]
LOCATION_GATE_DIA = ["codigo postal", "elige tu tienda", "selecciona tu tienda", "introduce tu codigo"]
EMPTY_RESULTS = ["no hay resultados", "sin resultados", "no se han encontrado productos"]
BLOCKED_TEXT = ["access denied", "request blocked", "captcha", "checking your browser"]

# Navigation entries ignored when discovering Dia categories.
NAV_DENY_WORDS = ["oferta", "promocion", "cupon", "login", "registro", "tiendas", "ayuda", "contacto",
                  "carrito", "politica", "privacidad", "terminos"]

# Path markers of Dia product and category URLs.
DIA_PRODUCT_MARKERS = ["/p/", "/producto/", "/product/", "/products/", "/sku/"]
DIA_CATEGORY_MARKERS = ["/categoria", "/categorias", "/category", "/c/", "/supermercado"]

# Host fragments accepted as "same shop".
ALCAMPO_HOST = "compraonline.alcampo.es"
DIA_HOST = "dia.es"

# Known Mercadona brands, searched in this order inside the product name.
KNOWN_BRANDS = ["Hacendado", "Bosque Verde", "Deliplus", "Compy", "Royal", "Casa Tarradellas", "Danone",
                "Coca-Cola", "Coca Cola", "Pepsi", "Alpro", "Fanta", "Sprite", "Aquarius", "Nestea"]

# Characters of a trailing brand token (besides ASCII letters and digits).
BRAND_TOKEN_EXTRA = "ÁÉÍÓÚÜÑáéíóúüñºª'-"
BRAND_TAIL_UPPER = "ÁÉÍÓÚÜÑ"
BRAND_TAIL_MAX = 3

# Al Campo group slug -> category label.
ALCAMPO_GROUP_LABELS = {
    "frescos": "Frescos",
    "leche-huevos-lacteos-yogures-y-bebidas-vegetales": "Leche, Huevos y Lácteos",
    "leche-huevos-lácteos-yogures-y-bebidas-vegetales": "Leche, Huevos y Lácteos",
    "bebidas": "Bebidas",
    "congelados": "Congelados",
    "comida-preparada": "Comida Preparada",
    "desayuno-y-merienda": "Desayuno y Merienda",
}

# Source prefix of a landed object -> bronze table.
SOURCE_TABLES = {
    "carrefour": "bronze_carrefour_products_p",
    "alcampo": "bronze_alcampo_products_p",
    "dia": "bronze_dia_products_p",
    "mercadona": "bronze_mercadona_products_p",
}

# Landed object names: "<source>/<YYYY-MM-DD>/<anything>.parquet", case-insensitive.
OBJECT_PATH_PATTERN = r"(?i)^([a-z0-9_-]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/.+\.parquet$"

# Mercadona URL templates.
MERCADONA_CATEGORY_API = "https://tienda.mercadona.es/api/categories/{category_id}/"
MERCADONA_PRODUCT_URL = "https://tienda.mercadona.es/product/{product_id}"
MERCADONA_SLUG_DEFAULT = "mercadona"

# Product table written per source and day: columns in this order.
PRODUCT_COLUMNS = ["date", "product", "brand", "price", "price_per_unit", "offer", "category", "subcategory",
                   "product_url"]

# Words pandas reads as missing in a CSV (default na_values).
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# ---------------------------------------------------------------------------
# Whitespace as Python's str.strip / str.split see it (str.isspace), built by rule.
WHITESPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same set as a regex class both Java regex and RE2 accept.
WS_CLASS = "[" + "".join("\\x{%X}" % ord(c) for c in WHITESPACE_CHARS) + "]"
