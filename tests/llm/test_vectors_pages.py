"""Operators 9 and 10."""

import numpy as np
import pytest

from pricelake.llm import embedding_lsh, html_template
from tests.llm.corpus import rows_of


def vectors():
    r = np.random.default_rng(11)
    rows = []
    for k in range(300):
        rows.append((k, r.standard_normal(16)))
    for g in range(12):  # groups of near copies
        centre = r.standard_normal(16)
        rows += [(1000 + 10 * g + j, centre + 0.06 * r.standard_normal(16)) for j in range(10)]
    hot = r.standard_normal(16)
    rows += [(3000 + j, hot + 0.01 * r.standard_normal(16)) for j in range(150)]
    rows += [(4000 + j, hot) for j in range(30)] + [(4000, hot), (5000, 1e-30 * hot), (5001, 1e30 * hot)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    odd = [(6000, None), (6001, []), (6002, [0.0] * 16), (6003, [None, *rows[0][1][1:]]), (6004, [float("nan"), *rows[0][1][1:]]),
           (6005, [float("inf"), *rows[0][1][1:]]), (6006, rows[0][1] + [0.5]), (6007, [1.0]), (6008, [2.0]), (None, rows[0][1])]
    return rows + odd


def brute(rows, threshold):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    ok = [(i, v / np.abs(v).max()) for i, v in ok if np.isfinite(v).all() and np.abs(v).max() > 0]
    ok = [(i, v / np.linalg.norm(v)) for i, v in ok]
    links, boss = {}, {i: i for i, _ in rows if i is not None}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i
    pairs = 0
    for a, (i, x) in enumerate(ok):
        for b, (j, y) in enumerate(ok):
            if a != b and len(x) == len(y) and x @ y >= threshold:
                links[a] = links.get(a, 0) + 1
                pairs += 1
                lo, hi = sorted((find(i), find(j)))
                boss[hi] = lo
    number = {}
    for a, (i, _) in enumerate(ok):
        number.setdefault(i, []).append(links.get(a, 0))
    return boss, find, number, pairs


@pytest.mark.parametrize("block", [16, 1024])
def test_near_groups(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, "t") for i, v in rows], "vec_id long, embedding array<double>, label int, code string")
    got = embedding_lsh.near_groups(df, block=block).collect()
    assert len(got) == len(rows)
    boss, find, number, pairs = brute(rows, 0.95)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert by[None][0].n_links == 0 and by[None][0].component_id is None and not by[None][0].kept
    assert sum(r.n_links for r in got) >= 0.97 * pairs  # recall
    for i, many in by.items():
        if i is None:
            continue
        for r in many:
            assert r.n_links <= max(number.get(i, [0]))  # none below the threshold
            assert find(r.component_id) == find(i) and r.kept == (i == r.component_id)
    for i in range(3000, 3150):
        assert by[i][0].n_links == number[i][0] and by[i][0].component_id == find(i)
    assert [by[i][0].n_links for i in (6000, 6001, 6002, 6003, 6004, 6005, 6006)] == [0] * 7
    assert by[6008][0].component_id == 6007


def test_recall_at_the_threshold(spark):
    r = np.random.default_rng(3)
    rows = []
    for k in range(400):
        a = r.standard_normal(64)
        a /= np.linalg.norm(a)
        b = r.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.951
        rows += [(2 * k, a.tolist()), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    got = embedding_lsh.near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("n_links = 1").count() >= 0.9 * len(rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_lsh.near_groups(df).count() == 0
    one = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert rows_of(embedding_lsh.near_groups(one), "vec_id", "n_links", "component_id", "kept") == [(1, 0, 1, True)]


def page(body, extra=""):
    return f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=x>Menu {extra}</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy {extra}</div><article><h1>Head {extra}</h1>{body}<form><button>Send</button></form>
<div id="comments"><p>First!</p></div></article><aside>Side</aside><footer>&copy; {extra}</footer></body></html>"""


def test_articles(spark):
    pages = [(k, f"http://a.example.com/{k}", page(f"<p>Text <b>no</b>{k} &amp; m&aacute;s\n\t  x<p>two<br>three", k)) for k in range(5)]
    pages += [(10, "https://A.example.com:80/z", page("<p>deep " * 3000)), (11, "http://a.example.com/n", None), (12, None, ""),
              (13, "http://a.example.com/broken", "<p>only <b>text"), (13, "http://a.example.com/broken", "<p>only <b>text"),
              (14, "nonsense", "<main>m</main> rest")]
    df = spark.createDataFrame([(*p, "h", "m") for p in pages], "page_id long, url string, html string, host string, main string")
    got = html_template.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r.page_id: r for r in got.collect()}
    assert got.count() == len(pages)
    for k in range(5):
        assert rows[k].text == f"Head {k} Text no{k} & más x two three" and rows[k].n_chars == len(rows[k].text)
    assert rows[10].text == "Head " + "deep " * 2999 + "deep"
    assert rows[11].text == rows[12].text == "" and rows[13].text == "only text" and rows[14].text == "m"


def test_template_without_article(spark):
    html = """<html><body><div class="top-menu"><a>Menu</a></div><div class=wrap><div class="content"><p>{t}</p></div>
<div class="sidebar-left">Side text that is rather long, longer than the content</div><div class=legal>tiny</div></div></body></html>"""
    pages = [(k, f"http://b.example.com/{k}", html.format(t=" ".join(f"word{k}{j}" for j in range(60)))) for k in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = html_template.templates(df)
    content = found.filter("path = '/html/body/div.wrap/div.content'").first()
    assert content.pages == 6 and found.select("class_id").distinct().count() == 1  # one class: all occur alike
    assert {r.page_id: r.text for r in html_template.main_text(df).collect()} == {
        k: " ".join(f"word{k}{j}" for j in range(60)) for k in range(6)}


def test_no_pages(spark):
    assert html_template.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, pages):
    df = spark.createDataFrame([(k, f"http://h.example.com/{k}", h) for k, h in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html_template.main_text(df).orderBy("page_id").collect()]


def test_classes_decide_which_texts_are_the_templates(spark):
    story = [" ".join(f"word{k}x{j}" for j in range(40)) for k in range(6)]
    html = ('<html><body class="postid-{k}"><div id="post-{k}"><p>{t}</p><p>Read on in our shop</p><p>Same on two pages {two}</p></div>'
            '</body></html>')
    assert texts_of(spark, [html.format(k=k, t=t, two=k // 2) for k, t in enumerate(story)]) == [
        f"{t} Same on two pages {k // 2}" for k, t in enumerate(story)]
    df = spark.createDataFrame([(k, "http://h.example.com/", html.format(k=k, t=t, two=0)) for k, t in enumerate(story)],
                               "page_id long, url string, html string")
    assert {r.path for r in html_template.templates(df).collect()} == {"/html", "/html/body", "/html/body/div"}
    # copies are no evidence, and no page is emptied
    assert texts_of(spark, [html.format(k=0, t=story[0], two=0)] * 4) == [f"{story[0]} Read on in our shop Same on two pages 0"] * 4
    assert texts_of(spark, [f"<html><body id=b{k}><p>Not found</p></body></html>" for k in range(5)]) == ["Not found"] * 5


def test_all_slots_of_a_page_are_kept(spark):
    lead, story = ([" ".join(f"{w}{k}x{j}" for j in range(n)) for k in range(5)] for w, n in (("lead", 35), ("story", 65)))
    html = '<html><body><div class=wrap><div class="lead"><p>{a}</p></div><div class="story"><p>{b}</p></div></div></body></html>'
    assert texts_of(spark, [html.format(a=a, b=b) for a, b in zip(lead, story)]) == [f"{a} {b}" for a, b in zip(lead, story)]
    html = "<html><body><article class=teaser>Teaser {k}</article><div class=text><p>{b}</p></div></body></html>"
    assert texts_of(spark, [html.format(k=k, b=b) for k, b in enumerate(story)]) == [f"Teaser {k} {b}" for k, b in enumerate(story)]
    html = "<html><body><div>By author {k}</div><article>{b}</article></body></html>"
    assert texts_of(spark, [html.format(k=k, b=b) for k, b in enumerate(story)]) == story


def test_listed_words_hide_no_wrapper(spark):
    story = " ".join(f"word{j}" for j in range(40))
    body = f'<div class="ad">Buy</div><div class="top-menu">Menu</div><p>{story}</p>'
    for wrapped in (f"<html><body class='has-sidebar'>{body}</body></html>", f"<html class=no-banner><body class='menu'>{body}</body></html>",
                    f"<body class='has-header-image'>{body}", f"<body><div id=page class='no-banner'>{body}</div>",
                    f"<body><main id='search-results'>{body}</main>", f"<body><article class='comments-open'>{body}</article>",
                    f"<body><div class='ad-free'>{body}</div>", f"<body><div class='sidebar-page'>{body}</div>",
                    f"<body><main><div class='widget'>{body}</div></main>"):
        assert html_template.text_of(wrapped) == story, wrapped
    assert html_template.text_of(f"<body><p>Intro</p><div class='not-a-menu-page'>{'x ' * 4}</div><p>{story}") == f"Intro x x x x {story}"
    thread = "<p>reply</p>" * 100  # a long thread is no wrapper where an article stands beside it
    assert html_template.text_of(f"<body><article>{story}<div id=comments>{thread}</div></article>") == story


STORY = " ".join(f"word{j}" for j in range(40))


def test_raw_elements_that_close_themselves_hide_nothing():
    for tag in ('<svg class="icon"/>', "<iframe/>", '<iframe src="a>b" />', "<canvas>", "<select>", '<object data="x"/>'):
        assert html_template.text_of(f"<body><article><p>Lead</p>{tag}<p>{STORY}</p></article>") == f"Lead {STORY}", tag
    assert html_template.text_of(f"<article>{STORY}<svg><text>icon</text></svg><script>var a='<p>'") == STORY
    assert html_template.text_of(f'<article>{STORY}<script data-x="a>b">no</script> end') == f"{STORY} end"


def test_an_articles_own_parts_stay(spark):
    assert html_template.text_of(f"<article><header><h1>Title</h1></header><fieldset>Facts</fieldset><p>{STORY}</p>"
                                 "<footer>Foot</footer></article><header>Site</header>") == f"Title Facts {STORY}"
    # a lead paragraph before the article, on every page
    lead = [f"<body><p>A lead paragraph that sums up story number {k}.</p><article>{STORY * 20} {k}</article>" for k in range(5)]
    assert texts_of(spark, lead) == [f"A lead paragraph that sums up story number {k}. {STORY * 20} {k}" for k in range(5)]
    # headings that all articles of a host have at the same place
    recipe = "<body><article><h2>Ingredients</h2><p>{a}</p><h2>Method</h2><p>{b}</p></article><div>Recipes of the day</div>"
    assert texts_of(spark, [recipe.format(a=f"flour {k}", b=f"mix {k} {STORY}") for k in range(6)]) == [
        f"Ingredients flour {k} Method mix {k} {STORY}" for k in range(6)]


def test_values_with_listed_words_hide_only_what_the_host_repeats(spark):
    html = '<body><div class="promo-box">Buy {k}</div><article><p>{s} {k}</p><div class="{c}"><p>Inside {k}</p></div></article>'
    own = ["ad-hoc-analysis", "notice-period", "related-work", "x", "y", "z"]
    assert texts_of(spark, [html.format(k=k, s=STORY, c=c) for k, c in enumerate(own)]) == [
        f"{STORY} {k} Inside {k}" for k in range(6)]
    assert texts_of(spark, [html.format(k=k, s=STORY, c="related-posts") for k in range(6)]) == [f"{STORY} {k}" for k in range(6)]
    assert texts_of(spark, [html.format(k=k, s=STORY, c="ad") for k in range(6)]) == [f"{STORY} {k}" for k in range(6)]


def test_any_depth_of_nesting():
    import time
    import tracemalloc
    deep = "<div class=ad-free>" * 60_000 + STORY + "</p>" * 60_000 + "<div>x" * 20_000
    tracemalloc.start()
    began = time.time()
    text = html_template.text_of(deep)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.startswith(STORY) and text.endswith(" x x") and peak < 400e6 and time.time() - began < 60


def brute_constant_texts(pages, known_path):
    """Texts that stand once on each page of at least half of the pages, with the counts of some element's tag."""
    from collections import Counter, defaultdict
    vectors, opened = defaultdict(dict), set()
    for k, page in enumerate(pages):
        seen = Counter()
        for kind, e, text in html_template.slots(page, known_path):
            if e is not None and not e.skip and kind != "break":
                seen[e.path, kind, text] += 1
        for token, n in seen.items():
            vectors[token][k] = n
    valid = {t: frozenset(v) for t, v in vectors.items() if 2 * len(v) >= len(pages) and max(v.values()) == 1}
    opened = {v for (_, kind, _), v in valid.items() if kind == "open"}
    return {(path, text) for (path, kind, text), v in valid.items() if kind == "text" and v in opened}


def test_classes_against_brute_force(spark):
    import random
    r = random.Random(5)
    pages = []
    for k in range(14):
        body = "".join(r.choice(["<div class=a><p>Same</p></div>", "<div class=b>Other</div>", f"<p>own {k}</p>", "<ul><li>Same</ul>",
                                 "<section><h2>Head</h2></section>"]) for _ in range(r.randrange(1, 7)))
        pages.append(f"<html><body><div class=top>Shop</div>{body}<div class=legal>Legal {k % 2}</div><p>end {k}</p></body></html>")
    df = spark.createDataFrame([(k, "http://h.example.com/", h) for k, h in enumerate(pages)], "page_id long, url string, html string")
    values = html_template.host_values(df)
    known = frozenset(values.first().known)
    want = brute_constant_texts(pages, known)
    found = html_template.classes(df, values).filter("kind = 'text'").collect()
    assert {(x.path, x.key) for x in found} == {(p, html_template.key_of(p, t)) for p, t in want} and want
