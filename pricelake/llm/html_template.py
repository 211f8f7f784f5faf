"""HTML extraction by equivalence-class template deduction (operator 10).

Pages of a host come from one template. Tokens are tags, and texts by their
content, with the path of block elements they stand in. Per host:

1. *Values.* Class, id and role values that fewer than half the host's pages
   hold (post numbers) are a page's own and are left out of the paths.
2. *Occurrence vectors.* A token's counts over the host's pages are
   fingerprinted by a sum of hashes of (page, count), an aggregate that is
   combined map-side, so a host with a third of all pages is no hot task.
   Pages of equal html count once.
3. *Equivalence classes.* Tokens with equal vectors form a class. A class is
   valid if it holds an element's opening tag, occurs once a page and on at
   least half the host's pages: what always comes together comes from the
   template. A text in a valid class is the template's, not a slot's, on a
   host of at least ``EVIDENCE`` different pages.
4. *Extraction.* The slots are the other texts. Each page's slots are joined in
   their order, without boilerplate: menus, headers, footers, sidebars, notices,
   adverts, forms, comments, scripts, styles. These are told by element name, or by a
   class, id or role that is a listed word, or begins or ends with one; on a host
   with evidence, the latter only if the value is one of the host's, so a page's own
   ``ad-hoc-analysis`` stays. Words never hide html, body, main, article or a
   wrapper of most of the page's text. Where ``article`` or ``main`` hold text, all of it
   outside boilerplate stays, the template's headings too, and so do paragraphs and the
   like beside them; other text beside them stays unless they hold most of the slots.
   A page that would be left without text keeps the template's.

Paths longer than ``PATH`` characters start with a digest, so nesting of any depth
costs memory in proportion. Null and empty html give the empty text. Pages without a parsable url share
one nameless host. Nothing is cut off; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections import Counter
from itertools import chain

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelake.llm.scratch import stage

#: Element names by their role in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var".split())
_RAW = "script|style|noscript|template|svg|iframe|object|canvas|textarea|select"
_SKIP = frozenset("nav header footer aside form head menu dialog button".split())
_MAIN = frozenset("article main".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: Words of class, id or role that mark boilerplate.
_MARKS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
                   "contentinfo cookie cookies copyright disclaimer disqus footer gdpr header masthead menu modal "
                   "nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted "
                   "promotion related respond replies reply search share sharing sidebar signup skip social sponsor "
                   "sponsored subscribe subscription toolbar widget".split())
#: Elements the words never hide, and first or last words of values that tell a state, not a role.
_WRAPS = frozenset("html body main article".split())
_STATES = frozenset("has have is no not non with without show hide free open closed enabled disabled active results".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                      "main nav ol p pre section table ul".split())

#: Share of a host's pages on which a class must occur, and the different pages a host needs for its constant texts to count.
SUPPORT = 0.5
EVIDENCE = 3
#: Characters of a path; what is deeper starts with a digest of the path so far.
PATH = 512

_REST = r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+"
# a raw element that closes itself is empty; only an unclosed script or style runs to the end of the page
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<raw>" + _RAW + r")\b" + _REST + r">(?:(?<=/>)|.*?</(?P=raw)\s*>)"
                    r"|<(?P<rest_raw>script|style)\b" + _REST + r">.*\Z"
                    r"|<(?P<close>/?)(?P<name>[a-z][\w:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
                    r"|<[!?/][^>]*>", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def marks_of(rest: str) -> list[str]:
    """The class, id and role values of a tag."""
    return sorted({w.lower() for m in _ATTR.finditer(rest) for w in (m[2] or m[3] or m[4] or "").split()}) if "=" in rest else []


def label_of(name: str, rest: str, known=None, evidence: bool = False) -> tuple[str, bool]:
    """(token label, whether a class, id or role marks boilerplate). Only values in
    ``known`` are in the label (None: all). On a host that gives ``evidence`` a value
    that only contains a listed word marks if it is one of the host's, in ``known``."""
    marks = marks_of(rest)
    marked = name not in _WRAPS and any(is_mark(w) and (w in _MARKS or not evidence or w in known) for w in marks)
    return name + "".join("." + w for w in marks if known is None or w in known), marked


def is_mark(value: str) -> bool:
    """Whether a class, id or role names boilerplate: as a whole, or by its first or last word unless it tells a state."""
    words = [w for w in re.split(r"[-_]+", value) if w]
    if not words or words[0] in _STATES or words[-1] in _STATES:
        return False
    return words[0] in _MARKS or words[-1] in _MARKS


class _Element:
    """An element of a page: its text, and how much of that is in article or main."""

    __slots__ = ("above", "name", "path", "by_name", "main", "prose", "marked", "chars", "held", "skip")

    def __init__(self, above, name: str, label: str, marked: bool):
        self.above, self.name, self.marked = above, name, marked
        way = above.path if above else ""
        if len(way) > PATH:
            way = "/#" + hashlib.blake2b(way.encode("utf-8", "replace"), digest_size=8).hexdigest()
        self.path = f"{way}/{label}"
        self.main = name in _MAIN or above is not None and above.main
        # the header of an article is its title
        self.by_name = name in _SKIP and not (name == "header" and self.main) or above is not None and above.by_name
        self.prose = name in _PROSE or above is not None and above.prose
        self.chars = self.held = 0
        self.skip = False


def walk(page: str, known=None, evidence: bool = False):
    """Tokens of a page in order: ("open", element), ("close", element),
    ("break", element), and ("text", element, text); elements know whether to skip them.

    A marked element that holds most of the page's text is a wrapper, not
    boilerplate, unless article or main beside it hold text."""
    elements: list[_Element] = []
    events = list(_events(page, known, evidence, elements))
    whole = named = 0
    for kind, element, text in events:
        if kind == "text" and not (element and element.by_name):
            n = len(" ".join(text.split()))
            main = n if element and element.main else 0
            whole, named = whole + n, named + main
            if element:
                element.chars += n
                element.held += main
    for e in reversed(elements):  # children come after their parents
        if e.above:
            e.above.chars += e.chars
            e.above.held += e.held
    for e in elements:
        wraps = 2 * e.chars > whole and named == e.held
        e.skip = e.by_name or e.marked and not wraps or e.above is not None and e.above.skip
    return events


def _events(page: str, known, evidence: bool, elements: list):
    """(kind, element, text) of a page's tokens; its elements go to ``elements``."""
    stack: list[_Element] = []
    open_: Counter = Counter()
    at, top = 0, None
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", top, page[at:m.start()]
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"] or m["rest_raw"]:
                yield "break", top, None
            continue
        name = name.lower()
        if name in _INLINE:
            continue
        if name in _VOID:
            yield "break", top, None
            continue
        if m["close"]:
            if not open_[name]:
                yield "break", top, None
                continue
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name)
            yield "close", stack[depth], None
            for e in stack[depth:]:
                open_[e.name] -= 1
            del stack[depth:]
        else:
            if name in _CLOSES_P and stack and stack[-1].name == "p" or name == "li" and stack and stack[-1].name == "li":
                yield "close", stack[-1], None
                open_[stack[-1].name] -= 1
                del stack[-1]
            label, marked = label_of(name, m["rest"], known, evidence)
            stack.append(_Element(stack[-1] if stack else None, name, label, marked))
            open_[name] += 1
            elements.append(stack[-1])
            yield "open", stack[-1], None
        top = stack[-1] if stack else None
    if at < len(page):
        yield "text", top, page[at:]


def slots(page: str, known=None, evidence: bool = False):
    """(kind, element, text) of a page's tokens; the pieces of one text between two block tags are one, unescaped."""
    pieces: list[str] = []
    where = None
    for kind, element, text in chain(walk(page, known, evidence), [("break", None, None)]):
        if kind == "text":
            pieces.append(text)
            where = element
            continue
        if pieces:
            joined = " ".join(_html.unescape("".join(pieces)).split())
            pieces = []
            if joined:
                yield "text", where, joined
        yield kind, element, None


def key_of(path: str, text: str) -> int:
    """A text's token: its content at its path."""
    return int.from_bytes(hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _values(batches):
    """One row per page and class, id or role value of its tags."""
    for batch in batches:
        out = []
        for host, copy, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = {w for m in _TOKEN.finditer(page) if m["name"] and not m["close"] and "=" in m["rest"]
                     and m["name"].lower() not in _INLINE for w in marks_of(m["rest"])}
            out += [(host, copy, w) for w in found]
        cols = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.string(), pa.int64(), pa.string()])],
                                         names=["host", "copy", "value"])


def _tokens(batches):
    """One row per page and token: its count. Texts are tokens by their content and path."""
    for batch in batches:
        out = []
        for host, copy, page, known, evidence in zip(*(batch.column(i).to_pylist() for i in range(5))):
            seen: Counter = Counter()
            chars: Counter = Counter()
            known = frozenset(known or ())
            for kind, element, text in slots(page, known, evidence):
                if element is None or element.skip or kind == "break":
                    continue
                path = element.path
                if kind == "text":
                    chars[path] += len(text)
                    seen[path, kind, key_of(path, text)] += 1
                else:
                    seen[path, kind, 0] += 1
            out += [(host, copy, path, kind, key, n, chars[path] if kind == "open" else 0)
                    for (path, kind, key), n in seen.items()]
        cols = list(zip(*out)) or [()] * 7
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["host", "copy", "path", "kind", "key", "n", "chars"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)


def host_of(url_col):
    return F.coalesce(F.lower(F.nullif(F.regexp_extract(url_col, r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))),
                      F.lit(""))


def _source(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, copy, html) of the pages with html; pages of equal html share ``copy``."""
    return (pages.filter(F.length(html_col) > 0)
            .select(host_of(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("copy"), F.col(html_col).alias("html")))


def host_values(pages: DataFrame, url_col: str = "url", html_col: str = "html", support: float = SUPPORT) -> DataFrame:
    """(host, all_pages, known): the different pages of a host, and the class,
    id and role values that at least ``support`` of them hold; the others are a page's own."""
    src = _source(pages, url_col, html_col)
    total = src.select("host", "copy").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    values = (src.mapInArrow(_values, "host string, copy long, value string").distinct()
              .groupBy("host", "value").agg(F.count(F.lit(1)).alias("pages")))
    often = (values.join(total, "host").filter(F.col("pages") >= F.col("all_pages") * support)
             .groupBy("host").agg(F.collect_list("value").alias("known")))
    return total.join(often, "host", "left")


def _known(values: DataFrame, evidence: int) -> DataFrame:
    return values.select("host", "known", (F.col("all_pages") >= evidence).alias("evidence"))


def classes(pages: DataFrame, values: DataFrame, url_col: str = "url", html_col: str = "html",
            support: float = SUPPORT, evidence: int = EVIDENCE) -> DataFrame:
    """(host, class_id, path, kind, key, pages, all_pages, chars): the tokens of each host's valid equivalence classes."""
    src = _source(pages, url_col, html_col).join(_known(values, evidence), "host", "left")
    schema = "host string, copy long, path string, kind string, key long, n long, chars long"
    tokens = src.select("host", "copy", "html", "known", "evidence").mapInArrow(_tokens, schema)
    # copies of a page are one page of evidence
    once = tokens.groupBy("host", "copy", "path", "kind", "key").agg(F.max("n").alias("n"), F.max("chars").alias("chars"))
    vector = F.xxhash64("copy", "n")
    roles = once.groupBy("host", "path", "kind", "key").agg(
        F.count(F.lit(1)).alias("pages"), F.max("n").alias("most"), F.sum("chars").alias("chars"),
        F.bit_xor(vector).alias("v1"), F.sum(F.pmod(vector, F.lit(1 << 31))).alias("v2"))
    valid = stage(roles.join(values.select("host", "all_pages"), "host")
                  .filter((F.col("pages") >= F.col("all_pages") * support) & (F.col("most") == 1)), "roles")
    opened = (valid.filter("kind = 'open'").select("host", "v1", "v2").distinct()
              .withColumn("class_id", F.xxhash64("v1", "v2")))
    return valid.join(opened, ["host", "v1", "v2"]).select("host", "class_id", "path", "kind", "key", "pages", "all_pages", "chars")


def templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              support: float = SUPPORT) -> DataFrame:
    """(host, class_id, path, pages, chars): the elements of each host's valid
    equivalence classes, with the text that stands directly in each."""
    values = stage(host_values(pages, url_col, html_col, support), "values")
    found = classes(pages, values, url_col, html_col, support)
    return found.filter("kind = 'open'").select("host", "class_id", "path", "pages", "chars")


def text_of(page: str, known=frozenset(), template=frozenset(), evidence: bool = False) -> str:
    """The text of a page's slots: its texts outside boilerplate. Texts of the
    host's template are none, but for those inside article or main, such as
    the headings that all articles of a host have. Beside an article or main with text,
    text that stands in no element of the body is left out, and where these hold
    most of the slots, so is text in no paragraph, heading, quotation or the like."""
    found = [(e, text) for kind, e, text in slots(page, known, evidence) if kind == "text" and not (e and e.skip)]
    own = [(e, text) for e, text in found if e and e.main or not template or key_of(e.path if e else "", text) not in template]
    own = own or found
    held = sum(len(text) for e, text in own if e and e.main)
    if held:
        most = 2 * held > sum(len(text) for _, text in own)
        own = [(e, text) for e, text in own if e and (e.main or e.prose or not most and e.name not in ("html", "body"))]
    return " ".join(text for _, text in own)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              support: float = SUPPORT, evidence: int = EVIDENCE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page. A host's constant texts and
    values count from ``evidence`` different pages on."""
    # a row per host, measured before it meets the pages: Spark broadcasts it if
    # it is small, and splits hot hosts if it is not
    values = stage(host_values(pages, url_col, html_col, support), "values")
    constant = (classes(pages, values, url_col, html_col, support, evidence)
                .filter((F.col("kind") == "text") & (F.col("all_pages") >= evidence))
                .groupBy("host").agg(F.collect_list("key").alias("template")))
    hosts = stage(_known(values, evidence).join(constant, "host", "left"), "hosts")
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_of(F.col(url_col)).alias("host"))

    def extract(batches):
        for batch in batches:
            texts = [text_of(p or "", frozenset(k or ()), frozenset(t or ()), bool(e))
                     for p, k, t, e in zip(*(batch.column(c).to_pylist() for c in ("html", "known", "template", "evidence")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = src.join(hosts, "host", "left").select("page_id", "url", "html", "known", "template", "evidence")
    kind = dict(joined.dtypes)["page_id"]
    return joined.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
