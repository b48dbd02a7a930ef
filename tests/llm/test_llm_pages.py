"""Templates of sites against a plain recount, menus by shape, deep markup."""

from __future__ import annotations

import random
import time
from collections import defaultdict

import pytest

from motorpulse.llm import html_text


def _site(seed: int, hosts: int = 4, pages: int = 30) -> list[tuple]:
    """Pages with menus of changing words, blocks of the site, near copies and lone hosts."""
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    rows = []
    for host in range(hosts):
        for k in range(rng.choice([3, pages])):
            menu = "".join(f"<li><a href='/{words(1)}'>{words(2)}</a>" for _ in range(3 + host))
            body = words(120) if k % 5 else f"{words(1)} " + "same " * 100 + str(host)
            source = (
                f"<body><div><ul class='m{k}'>{menu}</ul></div><article class='a{host % 2}'><p>{body}</p>"
                f"<div><p>Written in house {host}</p></div><ul><li>{words(3)}<li><a href=x>{words(1)}</a></ul></article>"
                f"<p>Rights of host {host}</p></body>"
            )
            rows.append((len(rows), f"http://h{host}.example/{k}", source))
    return rows + [(len(rows), None, rows[0][2]), (len(rows) + 1, "x", rows[1][2])]


def _recount(rows: list[tuple]) -> dict[int, set[int]]:
    """Templates by a plain reading of the rule, page by page."""
    seen, articles = defaultdict(list), defaultdict(set)
    for _, url, source in rows:
        page = html_text.Page(source)
        found, layout = page.unlisted(), html_text._layout(page, url)
        if layout is None or not found:
            continue
        text = "\n".join(b.text for b in found)
        sketch = html_text.sketch(found)
        articles[layout].add(sketch)
        for h in set(page.hashes) | set(page.shapes):
            seen[layout, h].append((sketch, text))
    out = defaultdict(set)
    for (layout, h), pages in seen.items():
        near = defaultdict(list)
        for sketch, text in pages:
            near[sketch].append(text)
        # Equal articles are one; near copies, which share a sketch, are counted as rows.
        copies = [1 if len(set(texts)) == 1 else len(texts) for texts in near.values()]
        enough = len(near) > html_text.LEAST_ARTICLES
        enough &= len(near) >= html_text.LEAST_ARTICLES + html_text.LEAST_SHARE * len(articles[layout])
        if h and enough and sum(copies) - max(copies) >= html_text.LEAST_OTHERS * sum(copies):
            out[layout].add(h)
    return dict(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_equal_a_plain_recount(spark, monkeypatch, seed):
    rows = _site(seed)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = html_text._templates(html_text._seen(pages)).collect()
    wanted = _recount(rows)
    assert wanted and {r["layout"]: set(r["recurring"]) for r in found} == wanted
    plain = {}
    for page_id, url, source in rows:
        page = html_text.Page(source)
        recurring = wanted.get(html_text._layout(page, url), set())
        plain[page_id] = html_text.main_text(page.without(recurring))
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == plain
    monkeypatch.setattr(html_text, "BROADCAST_HASHES", 0)  # joined by a shuffle instead
    shuffled = html_text.extract(pages)
    assert {r["page_id"]: r["text"] for r in shuffled.collect()} == plain
    assert "Join" in shuffled._jdf.queryExecution().executedPlan().toString()


def test_pages_are_read_once_more_and_not_shuffled(spark):
    pages = spark.createDataFrame(_site(1), "page_id long, url string, html string")
    plan = html_text.extract(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_menus_are_known_by_their_shape():
    menu = "<nav><ul class='x1'><li><a>{0}</a><li><a>{1}</a><li><a>{2}</a></ul></nav>"
    page = lambda *w: html_text.Page(menu.format(*w) + "<article><p>T</p></article>")
    one, other = page("a", "b", "c"), page("d e", "f", "g h i")
    assert one.hashes[0] != other.hashes[0] and one.shapes[0] == other.shapes[0] != 0
    longer = html_text.Page(menu.format("a", "b", "c</a><li><a>d") + "<article><p>T</p></article>")
    assert longer.shapes[0] not in (0, one.shapes[0])
    inside = html_text.Page("<article>" + menu.format("a", "b", "c") + "</article>")
    talk = html_text.Page("<div>Much text of its own beside <a>one</a>, <a>two</a> and <a>three</a></div>")
    two = html_text.Page("<ul><li><a>one</a><li><a>two</a></ul>")
    around = html_text.Page("<div><main><p>t</p></main><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></div>")
    assert not any(inside.shapes) and not any(talk.shapes) and not any(two.shapes)
    assert around.shapes[0] == 0 and any(around.shapes)


@pytest.mark.parametrize(
    "source",
    ["<div>x" * 40_000, "<b><div>x" * 20_000, "<div>" * 40_000 + "</span>" * 40_000, "<form><p>x" * 20_000,
     "<article><p>x" * 20_000, "<ul>" * 20_000 + "<li>x" * 20_000, "<b>" * 20_000 + "<td>x" * 20_000],
    ids=lambda s: s[:14],
)
def test_deep_markup_takes_time_by_its_length(source):
    start = time.process_time()
    page = html_text.Page(source)
    page.without(set(page.subtrees()[:5]))
    assert time.process_time() - start < 5


def test_nested_forms():
    source = "<form><p>Outer words of a form</p><form>Inner</form><form><article><p>A</p></article></form></form><p>{}</p>"
    page = html_text.Page(source.format("Much more text than in all of these forms together, and so on and on"))
    assert [b.text for b in page.unlisted()][:1] == ["Outer words of a form"]
    assert "Inner" not in [b.text for b in page.unlisted()] and "A" in [b.text for b in page.unlisted()]
