"""RSS and Atom bodies against a whole tree, odd bodies, and memory."""

import random
import tracemalloc
from xml.etree import ElementTree

from newsloom.sources import feeds as B
from newsloom.sources import xmlfeeds as M

A, C, D = "{http://www.w3.org/2005/Atom}", "{http://purl.org/rss/1.0/modules/content/}", "{http://purl.org/dc/elements/1.1/}"


def by_tree(body):
    root = ElementTree.fromstring(body)
    out = []
    for it in root.findall(".//item"):
        t = lambda k: it.findtext(k) or ""
        guid = t("guid").strip()
        out.append(("rss", t("title"), t(f"{C}encoded") or t("description"), t("link").strip() or (guid if guid.startswith("http") else ""), t("pubDate") or t(f"{D}date")))
    for it in [] if out else root.findall(f".//{A}entry"):
        t = lambda k: it.findtext(A + k) or ""
        links = it.findall(f"{A}link")
        own = [x.get("href") for x in links if x.get("rel") in (None, "alternate")]
        url = (own[0] if own else "" or "") or ""
        url = url.strip() or next((x.get("href").strip() for x in links if x.get("href")), "")
        out.append(("atom", t("title"), t("content") or t("summary"), url, t("published") or t("updated")))
    return out


def random_body(rnd):
    p = rnd.choice(["", "a:", "atom:"])
    text = lambda: rnd.choice(["x", " y &amp; z", "", "<![CDATA[<b>q</b>]]>", "t<b>u</b>v", "a<!-- no -->b", "<i/>late", "\n  ", "ü"])
    field = lambda names: "".join(f"<{n}>{text()}</{n}>" for n in rnd.choices(names, k=rnd.randint(0, 6)))
    entries = ""
    for _ in range(rnd.randint(0, 5)):
        links = "".join(f"<{p}link{rnd.choice(['', ' rel=\"alternate\"', ' rel=\"self\"'])}{rnd.choice(['', ' href=\" http://h/1 \"', ' href=\"http://h/2\"', ' href=\"\"'])}/>" for _ in range(rnd.randint(0, 3)))
        one = f"<{p}entry>{links}{field([p + k for k in ('title', 'content', 'summary', 'published', 'updated')])}</{p}entry>"
        entries += rnd.choice([one, f"<div>{one}</div>", one + "text"])
    items = ""
    for _ in range(rnd.choice([0, 0, 1, 4])):
        one = f"<item>{field(['title', 'link', 'guid', 'description', 'pubDate', 'c:encoded', 'd:date', 'other', 'a:title'])}<guid>http://g</guid></item>"
        items += rnd.choice([one, f"<channel>{one}</channel>", one[:-7] + one + "</item>"])
    own = {"": "", "a:": "", "atom:": ' xmlns:atom="http://www.w3.org/2005/Atom"'}[p]
    feed = f'<feed xmlns="http://www.w3.org/2005/Atom">{entries}</feed>' if p == "" else entries
    return f'<?xml version="1.0" encoding="utf-8"?><all xmlns:a="http://www.w3.org/2005/Atom" xmlns:c="http://purl.org/rss/1.0/modules/content/" xmlns:d="http://purl.org/dc/elements/1.1/"{own}>{feed}{items}</all>'


def test_entries_equal_those_of_a_tree():
    rnd = random.Random(1)
    seen = 0
    for _ in range(2000):
        body = random_body(rnd)
        got = [(form, row[0] or "", row[1] or "", row[2], row[3] or "") for form, _, row in M.FeedReader().read(body)]
        assert got == by_tree(body), body
        seen += len(got)
    assert seen > 2000


def test_bodies_that_do_not_parse_say_why(spark):
    odd = [("whole", "<rss><item><title>a</title></item></rss>"), ("cut", "<rss><item><title>a</title></item>"), ("none", None), ("blank", " \n"), ("text", "no feed"), ("entity", "<rss><item><title>&nbsp;</title></item></rss>"), ("empty", "<rss/>"),
           ("bom", "﻿<rss><item><title>b</title></item></rss>")]
    got = {r.k: (r.ord, r.title, r.error) for r in M.entries(spark.createDataFrame(odd, "k string, body string")).collect()}
    assert got["whole"] == (0, "a", None) and got["bom"] == (0, "b", None) and got["empty"] == (None, None, None)
    assert all(got[k][0] is None and got[k][2] for k in ("cut", "none", "blank", "text", "entity"))
    assert "undefined entity" in got["entity"][2]


def test_known_feeds(spark):
    atom = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>t</a:title><a:link href=" http://x/1 "/><a:content>&lt;p&gt;c&lt;/p&gt;</a:content><a:updated>2024-01-31T08:09:10Z</a:updated></a:entry></a:feed>'
    rss = '<rss xmlns:c="http://purl.org/rss/1.0/modules/content/" xmlns:d="http://purl.org/dc/elements/1.1/"><deep><channel><item><title>r</title><c:encoded>long</c:encoded><description>short</description><d:date>31 Jan 24 08:09 EST</d:date></item></channel></deep></rss>'
    bodies = spark.createDataFrame([("a", atom), ("r", rss)], "k string, body string")
    got = {r.k: (r.title, r.desc, r.url, str(r.dt)) for r in B.parse_feed(bodies).collect()}
    assert got == {"a": ("t", "c", "http://x/1", "2024-01-31 08:09:10"), "r": ("r", "long", "", "2024-01-31 13:09:00")}
    assert [r.k for r in B.parse_atom(bodies).collect()] == ["a"] and [r.k for r in B.parse_rss(bodies).collect()] == ["r"]


def test_a_long_body_builds_no_tree():
    body = "<rss>" + "".join(f"<item><title>t{k}</title><media>{'<a><b/></a>' * 300}</media></item>" for k in range(1230)) + "</rss>"
    tracemalloc.start()
    rows = list(M.FeedReader().read(body))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == 1230 and peak < 3_000_000 < len(body)  # the tree of its 740,000 elements would take 100 MB


def test_entries_are_handed_on_in_small_batches(spark, monkeypatch):
    """A worker held up to 10,000 bodies and all of their entries at once."""
    from newsloom.sources import xmlfeeds

    texts = ["<rss>" + "".join(f"<item><title>t{k}</title><link>http://{i}/{k}</link></item>" for k in range(i)) + "</rss>" for i in range(40)] + ["<rss>", None]
    bodies = spark.createDataFrame([(i, f"s{i}", x) for i, x in enumerate(texts)], "i int, s string, body string").coalesce(1)
    monkeypatch.setattr(xmlfeeds, "MOST", 100)
    df = xmlfeeds.entries(bodies)
    assert df.columns[:3] == ["i", "s", "ord"] and "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.i, r.s, r.ord, r.url) for r in df.filter("ord is not null").collect())
    assert got == [(i, f"s{i}", k, f"http://{i}/{k}") for i in range(40) for k in range(i)]
    assert sorted(r.i for r in df.filter("ord is null").collect()) == [0, 40, 41]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 26
