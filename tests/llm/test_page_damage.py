"""Pages with stray quotes, misleading names, and templates that not every page has."""

import random
import re

import pytest

from daybook.llm import html_extract, html_tree


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<p title=it's>whole article</p><p>b", ["whole article", "b"]),
        ("<p title=\"5\" tall\">x</p><p>y's</p>", ["x", "y's"]),
        ("<p title = \"a>b\">x<p title='c>d'>y", ["x", "y"]),
        ('<p a=b="c>d">e', ['d">e']),
        ('<p a=">x</p><p>y</p>', ["x", "y"]),
        ("<p>cut <a href='", ["cut"]),
    ],
)
def test_quotes_delimit_after_an_equals_sign_only(page, blocks):
    assert html_extract.extract(page) == "\n\n".join(blocks)


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<html class=no-cookie><body class='has-sidebar'><p>a</p>", ["a"]),
        ("<body class=sidebar><div class=sidebar>no</div><p>a</p>", ["a"]),
        ("<article class='post related'><p>a</p></article>", ["a"]),
        ("<div id='content-sidebar-wrap'><article>a</article></div>", ["a"]),
        ("<div class=widget><main>a</main></div>", ["a"]),
        ("<article>a<section class='social-sciences'>b</section><div class='related'>no</div></article>", ["a", "b"]),
        ("<article>a<div class=comments><article class=comment>no</article></div></article>", ["a"]),
        ("<body><form id=aspnetForm><input><article>a<form>no</form></article></form></body>", ["a"]),
        ('<body><div class="social"><p>essay</p></div></body>', ["essay"]),
        ('<body><div class="social"><p>no</p></div><p>essay</p></body>', ["essay"]),
        ('<article>a<section class="menu">soup</section><div class="top-menu">no</div></article>', ["a", "soup"]),
        ("<body><div class='cookie-notice'>no</div><form><label>no</label></form></body>", []),
    ],
)
def test_names_of_parts_that_hold_the_article_do_not_drop_it(page, blocks):
    assert html_extract.extract(page) == "\n\n".join(blocks)


def test_a_few_odd_pages_leave_the_host_its_template(spark):
    page = "<body><ul><li>Motto {1}</ul><div><p>Our motto</p><p>story {0}</p></div><ul><li>Read on</ul></body>"
    rows = [(i, f"https://a.example.org/{i}", page.format(i, "")) for i in range(40)]
    rows += [(40, "https://a.example.org/none", None), (41, "https://a.example.org/odd", "<table><tr><td>odd")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}
    assert found[7] == "story 7" and found[41] == "odd" and found[40] == ""


def test_whole_pages_are_aligned_exactly_at_any_size():
    fold = lambda page: html_tree.fold(html_tree.parse(page))
    assert [c.label for c in fold("<nav>a</nav><p>b").children] == ["nav", "p"]
    many = [f"<div class=c{chr(97 + i % 26)}{chr(97 + i // 26)}>x</div>" for i in range(300)]
    pairs = html_tree.align(fold("".join(many)), fold("<h1>new</h1>" + "".join(many[:150] + ["<p>y"] + many[150:])))
    assert len(pairs) == 301


def shop_pages(count, rng):
    """Pages of a framework that puts all into a form, with names that say the opposite; and their articles."""
    rows, articles = [], {}
    for i in range(count):
        paragraphs = [" ".join(rng.choice(["sun", "moon", "star", "sky"]) + str(rng.randrange(99)) for _ in range(40)) for _ in range(rng.randrange(2, 5))]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        html = (
            f"<body><form id=aspnetForm><div class=head><ul><li>Home<li>Shop {'' if i % 3 else '!'}</ul></div>"
            f"<div class='page'><div class='promo widget'>{body}<p>Share this text</p></div>"
            f"<div class=sidebar><p>Offer {rng.randrange(9)}</p></div></div><div>All rights reserved</div></form></body>"
        )
        rows.append((i, f"https://shop.example.org/{i}", html))
        articles[i] = "\n\n".join(paragraphs)
    return rows, articles


def test_content_is_the_slot_where_most_text_varies(spark):
    rows, articles = shop_pages(12, random.Random(8))
    rows.append((99, "https://shop.example.org/none", "<body><form id=aspnetForm></form></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}
    assert found.pop(99) == "" and found == articles


def brute_template(pages):
    """(path of tags, text) that all pages have, for pages without repeated structure; independent of the trees."""
    seen = []
    for html in pages:
        path, own = [], set()
        for tag, text in re.findall(r"<(/?[a-z0-9]+)[^>]*>([^<]*)", html):
            if tag.startswith("/"):
                path.pop()
            else:
                path.append(tag)
            if text.strip():
                own.add((tuple(path), text.strip()))
        seen.append(own)
    return set.intersection(*seen)


def test_planted_templates_are_found_as_by_intersection(spark):
    rng = random.Random(11)
    tags = ["div", "section", "p", "blockquote", "h2", "center", "pre", "ul"]
    rows, expected = [], {}
    for host in range(6):
        order = rng.sample(tags, 6)
        planted = {tag for tag in order if rng.random() < 0.5}
        pages = []
        for i in range(10):
            inner = "".join(
                f"<{tag}>{'constant of ' + tag if tag in planted else 'varies ' + str(rng.random())}</{tag}>" for tag in order
            )
            pages.append(f"<body>{inner}</body>")
        template = brute_template(pages)
        assert {path[-1] for path, _ in template} == planted
        for i, page in enumerate(pages):
            key = 100 * host + i
            rows.append((key, f"https://h{host}.example.org/{i}", page))
            texts = [(tag, text) for tag, text in re.findall(r"<([a-z0-9]+)>([^<]+)", page)]
            expected[key] = "\n\n".join(text for tag, text in texts if (("body", tag), text) not in template)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extract.extract_pages(df).collect()} == expected
