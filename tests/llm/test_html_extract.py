import json
import random

import pytest

from helpers import folder
from postline.llm.html_extract import Level, align, blocks, expression, extract, fold, main_text, op12_html_extract, parse

SCHEMA = "page_id long, url string, html string, host string, plan string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "p") for i, (u, h) in enumerate(rows)], SCHEMA)


def shown(items):
    """An expression in the usual notation."""
    def one(x):
        inside = shown(x[3])
        body = x[0] if x[0] == "#" else f"({inside})" if x[0][0] == "(" else x[0] + (f"[{inside}]" if inside else "")
        return body + ("*" if x[1] and x[2] else "+" if x[2] else "?" if x[1] else "")
    return " ".join(map(one, items))


def of(html):
    return expression(parse(html))


@pytest.mark.parametrize("pages, wrapper", [
    (["<p>a<p>b<p>c"], "p[#]+"),
    (["<h2>a</h2><p>b</p><h2>c</h2><p>d</p>"], "(h2[#] p[#])+"),
    (["<div>a</div><p>b</p>", "<p>c</p>"], "div[#]? p[#]"),
    (["<p>a</p><hr><ul><li>x</ul>", "<p>a</p><ul><li>x<li>y</ul>"], "p[#] hr? ul[li[#]+]"),
    (["<h2>a</h2><p>b</p>", "<h2>a</h2><p>b</p><h2>c</h2><p>d</p>", "<h2>a</h2>"], "(h2[#] p[#]?)+"),
    (["<p>a <b>b</b> c</p>", "<p></p>"], "p[#?]"),
    (["<div class='x1 box'>a</div>", "<div class='x2 box'>b</div>"], "div.box[#]"),
])
def test_alignment(pages, wrapper):
    whole = of(pages[0])
    for page in pages[1:]:
        whole = align(whole, of(page))
    assert shown(whole) == wrapper


def test_random_expressions_align_and_stay_bounded():
    rnd = random.Random(1)
    for _ in range(300):
        page = lambda: fold([[rnd.choice("abcdefgh"), 0, 0, [["#", 0, 0, []]]] for _ in range(rnd.randint(0, 60))])
        whole = page()
        for _ in range(6):
            whole = align(whole, page())
            assert len(whole) <= 32 and json.loads(json.dumps(whole)) == whole


def test_tree_is_mended():
    texts = lambda html: [x[1] for x in blocks(html, Level([]))]
    assert texts("<p><b>a<br>b<p>c</i></p></div>d") == ["a b", "c", "d"]
    assert texts("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("1 < 2 &amp; 3 &gt 2 &eacute;&#233;&nbsp; x<!-- <p>no --><script>if (a < b) '</p>'</script>y") == ["1 < 2 & 3 > 2 éé xy"]
    assert texts('<p title="a > b" x=\'<p>\'>q</p><![CDATA[z]]><br/>') == ["q"]
    assert texts("<script>never closed <p>x") == [] and texts("") == [] and texts("<") == ["<"] and texts("a<p") == ["a<p"]
    assert texts("<div>" * 50_000 + "deep" + "</div>" * 50_000) == ["deep"] and of("<div>" * 3000 + "x")
    assert texts("<p " + "x" * 100_000 + ">a" + '<a "' * 20_000) != [] and texts("<b>" * 30_000 + "x") == ["x"]


def boilerplate(i, body, style):
    nav = "".join(f"<li><a href=/{k}>menu{k}</a>" for k in range(5))
    comments = "".join(f"<div class=comment><p>reader {i} {k}</p></div>" for k in range(i % 3))
    if style == "article":
        return (f"<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style></head><body><header><p>Site {i}</p></header><nav><ul>{nav}</ul></nav>"
                f"<div class='cookie-notice'>We use cookies {i}</div><article class='post has-sidebar'>{body}<form>Your mail {i}<button>ok</button></form>"
                f"<section id=comments>{comments}</section></article><aside>seen {i}</aside><footer>&copy; {i}</footer>")
    return (f"<html><body><div class=top><ul>{nav}</ul></div><div class=wrap><div class=text>{body}</div>"
            f"<div class=box>Read this on our site</div></div><div class=links><a href=/x>more {i}</a> <a href=/y>and more {i}</a></div></body></html>")


@pytest.mark.parametrize("style", ["article", "plain"])
@pytest.mark.parametrize("options", [{}, {"group": 2, "broadcast_bytes": 0}])
def test_whole_pages(spark, style, options):
    rnd, rows, want = random.Random(4), [], []
    for i in range(40):
        parts = [("h1", f"Title {i}")]
        for _ in range(rnd.randint(1, 12)):
            parts.append((rnd.choice(["p", "p", "p", "h2", "blockquote", "pre"]), " ".join(f"w{rnd.randrange(999)}" for _ in range(rnd.randint(4, 30)))))
        if i % 4 == 0:
            parts += [("li", f"point {i} {k} with some words") for k in range(3)]
        body = "".join(f"<{tag}>{text.replace(' ', rnd.choice([' ', chr(10), ' <b>'])) if tag == 'p' else text}</{tag}>" if tag != "li" else f"<ul><li>{text}</ul>"
                       for tag, text in parts)
        rows.append((f"http://Host{i % 2}.example.org/{i}", boilerplate(i, body, style)))
        want.append("\n\n".join(t for _, t in parts))
    got = {r.page_id: r for r in extract(frame(spark, rows), **options).collect()}
    for i, text in enumerate(want):
        assert got[i].text == text, (i, style)
        assert got[i].n_chars == len(text) and got[i].url == rows[i][0]


def test_odd_rows(spark, tmp_path):
    long = "<article>" + "<p>word</p><h2>x</h2>" * 20_000 + "</article>"
    rows = [(None, None), ("no host", ""), ("http://a/", "<article><p>same</article>"), ("http://a/", "<article><p>same</article>"),
            ("http://b/x", long), ("://", "just text"), ("http://B/", "<nav>only a menu</nav>")]
    got = {r.page_id: r.text for r in op12_html_extract(spark, folder(tmp_path, pages=frame(spark, rows))).collect()}
    assert got == {0: "", 1: "", 2: "same", 3: "same", 4: "\n\n".join(["word", "x"] * 20_000), 5: "just text", 6: ""}
    assert op12_html_extract(spark, folder(tmp_path / "e", pages=frame(spark, []))).collect() == []


def test_the_given_pages(spark):
    import re
    from html import unescape
    path = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = op12_html_extract(spark, path).collect()
    assert len(rows) == len(html)
    for r in rows:  # all these pages have one article of h1 and p
        article = re.search("(?s)<article>(.*)</article>", html[r.page_id])[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(filter(None, parts)), r.page_id
