"""Main text of pages: wrappers by themselves, odd pages, and whole tables."""

import html
import re
from difflib import SequenceMatcher

from turnout.llm import wrappers as w

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<{tag}><h1>{title}</h1><!-- <p>hidden</p> --><p>First &amp; <b>bold</b>
 text<br>next<p>Second{extra}<ul><li>one<li>two</ul>
<form><label>Mail</label></form><div class="comments"><p>Reader</p></div></{end}>
<aside>More</aside><footer>&copy; us</footer></body></html>"""
TEXT = "{title}\n\nFirst & bold text next\n\nSecond{extra}\n\none\n\ntwo"


def page(title="A", extra="", tag="article"):
    return PAGE.format(title=title, extra=extra, tag=tag, end=tag.split()[0])


def rows_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, main string, text int")


def test_article_without_furniture(spark):
    rows = [(i, f"https://A.example:80/{i}", page(f"T{i}", "x" * i), "z", "z", 1) for i in range(5)]
    # A host whose pages have a plain container in place of an article.
    rows += [(10 + i, f"http://b.example/{i}", page(f"U{i}", " y" * i, 'div id="box"'), None, None, None)
             for i in range(5)]
    rows += [(20, None, page("V"), None, None, None), (21, "http://[bad", None, None, None, None),
             (22, "http://a.example/x", "", None, None, None), (None, "http://a.example/y", page("N"), None, None, None),
             (0, "https://A.example:80/0", page("T0"), None, None, None),
             (23, "http://c.example", "just text &lt; here", None, None, None),
             (24, "http://a.example/long", page("L", " w" * 200_000), None, None, None)]
    found = {}
    for r in w.main_text(rows_table(spark, rows)).collect():
        found.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    for i in range(5):
        assert {r.text for r in found[i]} == {TEXT.format(title=f"T{i}", extra="x" * i)}
        assert found[10 + i][0].text == TEXT.format(title=f"U{i}", extra=" y" * i)
    assert len(found[0]) == 2
    assert found[20][0].text == TEXT.format(title="V", extra="")
    assert (found[21][0].text, found[22][0].text) == ("", "")
    assert found[None][0].text == TEXT.format(title="N", extra="")
    assert found[23][0].text == "just text < here"
    assert found[24][0].text == TEXT.format(title="L", extra=" w" * 200_000)


def test_empty_table(spark):
    assert w.main_text(rows_table(spark, [])).collect() == []


def test_supplied_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in w.main_text(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        inner = re.sub(r"</?b>", "", inner.replace("<br>", " "))
        parts = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"<[^>]*>", inner)]
        assert r.text == "\n\n".join(x for x in parts if x)


def kinds(nodes):
    return [(n[0], kinds(n[2])) if n[2] else n[0] if n[0] != "text" else n[1] for n in nodes]


def test_runs_become_repeated_groups():
    nodes = w.page_nodes("<ul><li>a<li>b<li>c</ul><p>x")
    assert kinds(nodes) == ["open", ("many", ["open", "#text"]), "close", "open", "x"]


def test_alignment_makes_slots_options_and_repeats():
    one, two = w.page_nodes("<div><h1>a</h1><p>x</div>"), w.page_nodes("<div><h1>b</h1><hr><p>x<p>y</div>")
    joined = w.align(one, two)
    assert kinds(joined) == [
        "open", "open", "#text", "close", ("maybe", ["open", "close"]), ("many", ["open", "#text"]), "close",
    ]
    # Aligning what is already covered changes nothing but the letters seen.
    assert kinds(w.align(joined, one)) == kinds(joined) == kinds(w.align(joined, two))


def test_furniture_by_tag_name_and_role():
    for label in ("nav", "div class=sidebar left", "div id=comments", "section class=post-comments",
                  "div class=site-footer", "div role=navigation", "div class=advert"):
        assert w.is_furniture(label), label
    for label in ("div class=content", "div class=shadow", "article class=comment", "p", "body class=sidebar"):
        assert not w.is_furniture(label), label


def test_literals_of_the_wrapper_are_left_out_in_each_template(spark):
    rows = []
    for i in range(8):
        story = f"<h1>Title {i}</h1><p>Story {i}<p>told {'at length ' * i}"
        rows.append((i, f"http://a.example/{i}", "<body><div class=x1>Buy our things</div>"
                     f"<article>{story}<div>All rights are ours</div></article></body>", None, None, None))
        rows.append((100 + i, f"http://a.example/old/{i}", "<body><div class=x1>Buy our things</div>"
                     f"<div class=old>{story}</div><div class=x2><h4>Know this</h4>{'We tell all. ' * 20}</div></body>",
                     None, None, None))
    found = {r.page_id: r.text for r in w.main_text(rows_table(spark, rows)).collect()}
    for i in range(8):
        text = f"Title {i}\n\nStory {i}\n\ntold {'at length ' * i}".strip()
        # An article's text is whole, whatever other articles say too; elsewhere the wrapper tells.
        assert found[i] == text + "\n\nAll rights are ours"
        assert found[100 + i] == text


def extracted(spark, pages, host="a.example"):
    rows = [(i, f"http://{host}/{i}", h, None, None, None) for i, h in enumerate(pages)]
    return [r.text for r in sorted(w.main_text(rows_table(spark, rows)).collect(), key=lambda r: r.page_id)]


def test_an_article_is_whole_on_hosts_of_any_number_of_pages(spark):
    def recipes(n):
        return [f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><p>{i} eggs</p></article>" for i in range(n)]

    def counters(n):
        story = "<article><h1>One story</h1><p>told in full.</p></article>"
        return [f"<body>{story}<div class=count>seen {i} times</div></body>" for i in range(n)]

    for n in (1, 2, 3, 7):
        assert extracted(spark, recipes(n)) == [f"Dish {i}\n\nIngredients\n\n{i} eggs" for i in range(n)]
        assert extracted(spark, counters(n)) == ["One story\n\ntold in full."] * n


def test_names_inside_an_article(spark):
    def pages(n):
        return [f"<article><h1>Drug {i}</h1><div class='side-effects'>causes {i}</div><section id='discussion'>"
                f"<p>We discuss {i}</p></section><div class='post-comments'>Reader {i}</div><div class='share'>Share</div>"
                f"<div class='notice'>Note</div><div class='promo-box'>Buy now</div></article>" for i in range(n)]

    for n in (2, 3, 5):
        assert extracted(spark, pages(n)) == [f"Drug {i}\n\ncauses {i}\n\nWe discuss {i}" for i in range(n)]


def test_an_article_in_furniture_is_none(spark):
    pages = [f"<aside><article>Other {i}</article></aside><main><p>Mine {i}</p></main>" for i in range(3)]
    assert extracted(spark, pages) == [f"Mine {i}" for i in range(3)]


def plainly_matched(nodes, wrapper):
    one, other = w._gathered(nodes, w._groups(wrapper)), w._gathered(wrapper, w._groups(nodes))
    blocks = SequenceMatcher(None, [w._key(n) for n in one], [w._key(n) for n in other], autojunk=False)
    found = {}
    for at, to, size in blocks.get_matching_blocks():
        for x, y in zip(one[at : at + size], other[to : to + size]):
            if x[2] or y[2]:
                found |= plainly_matched(x[2] or [x], y[2] or [y])
            elif x[0] == "text":
                found |= dict.fromkeys(x[3][2], y)
    return found


def test_prepared_wrappers_match_like_fresh_ones():
    pages = [page(f"T{i}", " z" * (i % 3)) + "<ul>" + "<li>x" * (i % 4) + "</ul>" for i in range(12)]
    wrapper = w.infer([w.page_nodes(p) for p in pages])
    prepared = w.Prepared(wrapper)
    for p in pages * 2:
        nodes = w.page_nodes(p)
        found = w.match(nodes, prepared)
        assert len(found) > 10 and found == plainly_matched(nodes, wrapper)



def test_ids_of_pages_do_not_grow_the_wrapper(spark):
    def rows(n):
        return [(i, f"http://a.example/{i}", f"<body><div class=top id=t{i}>Welcome all</div><div id='post-{i}-about-{i * 7}' "
                 f"class='post-{i} post'><h2>Day {i}</h2><p>Story {i}<p>told {'and told ' * i}</div></body>", None, None, None)
                for i in range(n)]

    found = {r.page_id: r.text for r in w.main_text(rows_table(spark, rows(9))).collect()}
    assert found == {i: f"Day {i}\n\nStory {i}\n\ntold {'and told ' * i}".strip() for i in range(9)}
    sizes = [len(w.infer([w.page_nodes(r[2]) for r in rows(n)])) for n in (3, 60)]
    assert sizes[0] == sizes[1]
