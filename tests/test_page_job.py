"""The page job's fast path: the same trees as html.parser, and taken by plain pages."""

import random

from pricelake.sources import html_job as H

PARTS = ["<div>", "</div>", "<p>", "</p>", "<br>", "<br/>", "<div/>", "text ", " & ", "&amp;", "&euro;", "&copy=", "a&lt",
         "<a href='x?a=1&copy=2'>", "</a>", '<a HREF="/p/1" class="x  y" class=z>', "<a href=x>", "<!-- c -->", "<!---->", "<!-->",
         "<!-- a--b -->", "<!doctype html>", "<script>", "</script>", "<script>{\"a\": \"<b>\"}</script>", "<SCRIPT>x</SCRIPT>",
         "<style>a<!--b--></style>", "<title>t &amp; <b>x</b></title>", "<title>t</title>", "<", "<3", ">", "</", "</ div>",
         "<?php x ?>", "<![CDATA[x]]>", "<li disabled>", "<Img alt=\"a > b <c>\" />", "\r\n", "é€", "<p\ta='1'\n>", "<p a = 'b'>",
         "<p a='b'c='d'>", "<p/ a>", "<script/>", "<svg><path d='M0'/></svg>", "<noscript>", "<iframe>", "<a\x0bb>"]


def tree(n):
    return n.tag, n.attrs, n.idx, n.end, n.cls, [c if isinstance(c, tuple) else tree(c) for c in n.children]


def test_fast_path_builds_the_parsers_tree():
    rnd, plain = random.Random(3), 0
    for _ in range(20_000):
        html = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 7)))
        fast = H._parse_plain(html)
        if fast is not None:
            plain += 1
            root, want = fast.root, H._parse_any(html).root
            assert [c if isinstance(c, tuple) else tree(c) for c in root.children] == \
                [c if isinstance(c, tuple) else tree(c) for c in want.children], html
            assert root.end == want.end
    assert plain > 2000


def test_shop_pages_take_the_fast_path():
    page = ('<!DOCTYPE html><html><head><title>x</title><script type="application/ld+json">{"a": "</b>"[0]}</script></head>'
            '<body><li class="product-item"><a href="/p/1?x&amp;y">A</a><img alt="a > b"><br/></li></body></html>')
    assert H._parse_plain(page.replace("</b>", "<b>")) is not None
    assert H._parse_plain(page) is None  # an end tag inside a script is left to html.parser
