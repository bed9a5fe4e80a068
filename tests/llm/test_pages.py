"""Operators on web pages, against brute force and by hand on awkward rows."""

import base64
import gzip
import hashlib
import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from daybook.llm import html_extract, html_tree, url_filter, warc
from daybook.llm.common import scratch_path

SCHEMA = "page_id long, url string, html string"
CLASHING = ["key", "host", "path", "rule", "text", "content", "capture", "wrapper", "value", "first"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    for name in CLASHING:
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


# Main text


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<nav>m</nav><article><h1>T &amp; t</h1><p>a\n b<br>c<p>d</article><footer>f</footer>", ["T & t", "a b c", "d"]),
        ("<article><p><b>bold<br><p>next<b> one</b> two</article>", ["bold", "next one two"]),
        ("<article>x<aside>no</aside>y<form><input value=1>no</form><script>a</p></script>z</article>", ["x", "y", "z"]),
        ("<article><header><h1>T</h1><p>by me</p></header><p>a</p><div class='comment-list'><p>no</div></article>", ["T", "a"]),
        ("<article>a</article><div>no</div><article class=comment>no</article>", ["a"]),
        ("<div class=sidebar>no</div><main><ul><li>1<li>2</ul></main>", ["1", "2"]),
        ("<body><div id='top-menu'>no</div><p>a<span class=ad>no</span>b<table><tr><td>1<td>2</table>", ["a", "b", "1", "2"]),
        ("<p>a<!-- <p>no --><!doctype x>b &lt;i&gt; &#233; &nosuch; &amp", ["ab <i> é &nosuch; &"]),
        ("plain text, 1 < 2", ["plain text, 1 < 2"]),
        ("<p>cut <a href='", ["cut"]),
        ("<title>no</title><style>no</style>", []),
        ("", []),
        (None, []),
    ],
)
def test_main_text_by_hand(page, blocks):
    assert html_extract.extract(page) == "\n\n".join(blocks)


def naive(page):
    article = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
    article = re.sub("</?b>", "", article).replace("<br>", " ")
    blocks = (" ".join(unescape(x).split()) for x in re.split("</?(?:p|h1)>", article))
    return "\n\n".join(block for block in blocks if block)


def test_extraction_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = html_extract.extract_pages(pages).collect()
    expected = {r.page_id: naive(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in found} == expected
    assert all(r.n_chars == len(r.text) for r in found)


def host_pages(count, host="news.example.org"):
    page = "<body><div><p>Our motto</p></div><div class=x><p>story {0}</p><p>more of {0}</p><p>Read on</p></div></body>"
    return [(i, f"https://{host}/{i}", page.format(i)) for i in range(count)]


def test_what_all_pages_of_a_host_share_is_template(spark):
    rows = host_pages(12) + host_pages(3, "small.example.org")
    rows = [(i, url, html) for i, (_, url, html) in enumerate(rows)]
    rows += [(90, None, "<p>no url</p>"), (91, "https://news.example.org/none", None), (None, "x", "")]
    found = {r.page_id: r.text for r in html_extract.extract_pages(frame(spark, rows)).collect()}
    # The page without content does not count.
    assert found[3] == "story 3\n\nmore of 3"
    assert (found[90], found[91], found[None]) == ("no url", "", "")
    found = {r.page_id: r.text for r in html_extract.extract_pages(frame(spark, rows[:15])).collect()}
    assert found[3] == "story 3\n\nmore of 3"
    # Too few pages to tell.
    assert found[13] == "Our motto\n\nstory 1\n\nmore of 1\n\nRead on"


def test_copies_of_one_page_are_no_template(spark):
    rows = [(i, "https://a.example.org/x", "<article><p>same</p></article>") for i in range(20)]
    found = html_extract.extract_pages(frame(spark, rows)).collect()
    assert {r.text for r in found} == {"same"} and len(found) == 20


def test_alignment_keeps_order_and_parents():
    fold = lambda page: html_tree.fold(html_tree.parse(page))
    reference = fold("<div><h1>a</h1></div><section><p>b</p></section><ul><li>c</ul>")
    page = fold("<section><p>x</p></section><table></table><ul><li>y<li>z</ul>")
    pairs = [(number, shape.label) for number, shape in html_tree.align(reference, page)]
    assert pairs == [(0, "#root"), (3, "section"), (4, "p"), (5, "ul"), (6, "li")]


@pytest.mark.parametrize("unit", ["<div>", "<a ", '<a "', "<!--", "</", "<p>x", "<", "&amp", "<script>", "<b>", "<li>"])
def test_hostile_pages_end(unit):
    assert isinstance(html_extract.extract(unit * 20_000), str)


# URL rules


URLS = [
    "http://a.example.net/en/x", "https://EXAMPLE.net", "x://net/", "http://mynet/", "https://m.example.com/de/1?x#y",
    "http://example.com/de", "ftp://fr.org/fr/?://net/", "no scheme net/", "", None, "http://a.org:80/fr/", "http://Ä.NET/",
    "http://www.cheap-pills.example.com/en/1", "http://example.com/cheap-pills.net/", "//net/", "://net/", "a://b://net/",
    "http://x.example.net/enx", "http://ok.example.org/a/phishing/b", "http://net?/x", "http://sub.casino-win.example.com",
]


def brute_judge(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.SITE_RULES:
        site, slash, tail = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith(slash + tail):
            best = max(best or ("", ""), (rule, verdict), key=lambda x: len(x[0]))
    if best:
        return host, path, *best
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    rules = url_filter.make_rules((), url_filter.PATTERNS)
    return host, path, None, "block" if any(r.expression.search(lowered) for r in rules) else "allow"


def test_urls_equal_trying_every_rule(spark):
    rows = [(i, url, None) for i, url in enumerate(URLS)] + [(0, URLS[0], None), (None, "x://net/", "")]
    found = url_filter.judge_urls(frame(spark, rows))
    assert ordered(found.collect()) == ordered((i, *brute_judge(url)) for i, url, _ in rows)


def test_only_candidates_run_and_rules_sit_under_their_rarest_token():
    rules = url_filter.make_rules((("block", "example.com/rare/"),), ("*anything*",))
    index = url_filter.RuleIndex(rules, {"example": 90, "com": 100, "rare": 2})
    assert list(index.by_token) == ["rare"]
    assert [r.name for r in index.always] == ["*anything*"]
    assert [r.name for r in index.candidates("http://example.com/")] == ["*anything*"]
    assert len(list(index.candidates("http://example.com/rare/"))) == 2


def test_tokens_that_a_wildcard_may_extend_are_not_used():
    rule = url_filter.Rule("||ads*track.js^", "block", False)
    assert rule.tokens == ["js"]
    assert rule.expression.search("http://ads-xtrack.js?1")


# WARC


PAGES = [
    (1, "http://a.example.org/x?y=1", "<p>same</p>"),
    (2, "http://b.example.org/", "<p>same</p>"),
    (3, None, None),
    (4, "http://c.example.org/\r\nWARC-Type: x", ""),
    (5, "http://d.example.org", "line\r\n\r\nWARC/1.1\r\n\r\n\r\n é 👍" * 50),
    (6, "nonsense", "x" * 100_000),
    (7, "http://a.example.org/x?y=1", "<p>other</p>"),
    (7, "http://a.example.org/x?y=1", "<p>other</p>"),
]


def expected_captures(rows, least=0):
    first, found = {}, []
    for key, _, html in rows:
        first[html or ""] = min(key, first.get(html or "", key))
    for key, _, html in rows:
        payload = (html or "").encode()
        original = first[html or ""]
        again = key != original and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if again else "response"
        found.append((key, len(payload), digest, kind, original if again else None))
    return ordered(found)


@pytest.mark.parametrize("least", [0, 5])
def test_warc_roundtrip(spark, least):
    found = warc.warc_roundtrip(frame(spark, PAGES), scratch_path(spark), min_revisit_bytes=least)
    assert ordered(found.collect()) == expected_captures(PAGES, least)


def test_captures_hold_their_three_records(spark):
    path = scratch_path(spark)
    warc.write_warc(frame(spark, PAGES[:6]), path)
    captures = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(captures) == 6
    payloads = {r.metadata.fields["page-key"]: bytes(r.response.payload) for r in captures}
    assert payloads["5"].decode() == PAGES[4][2] and payloads["2"] == b""
    for row in captures:
        assert row.request.concurrent_to == row.metadata.concurrent_to == row.response.record_id
    one = next(r for r in captures if r.metadata.fields["page-key"] == "1")
    assert one.request.payload.startswith(b"GET /x?y=1 HTTP/1.1\r\nHost: a.example.org\r\n")


def test_archives_of_other_writers(spark):
    """Plain, or a gzip member per record; a response without request; other types."""
    def record(kind, block, **headers):
        lines = ["WARC/1.0", f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in headers.items())]
        return ("\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])).encode() + block + b"\r\n\r\n"

    records = [
        record("warcinfo", b"software: x\r\n", WARC_Record_ID="<i>"),
        record("response", b"HTTP/1.1 200 OK\r\n\r\nbody", WARC_Record_ID="<r>"),
        record("metadata", b"a: b\r\n", WARC_Record_ID="<m>", WARC_Concurrent_To="<r>"),
    ]
    for archive in (b"".join(records), b"".join(map(gzip.compress, records))):
        rows = [warc.describe_record(*parts, True) for parts in warc.parse_records(archive)]
        captures = warc.assemble(spark.createDataFrame(rows, warc.RECORD_SCHEMA)).collect()
        assert [(bytes(c.response.payload), c.request) for c in captures] == [(b"body", None)]
        assert captures[0].metadata.fields == {"a": "b"}
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parse_records(records[1][:-10]))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_records(b"hello"))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert html_extract.extract_pages(none).collect() == []
    assert url_filter.judge_urls(none).collect() == []
    assert warc.warc_roundtrip(none, scratch_path(spark)).collect() == []
