"""Anchors of HTML, and references resolved as the standard library does it."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gridloom.sources import links

PAGES = [
    ('<a href="/a.xlsx">x</a>', [("/a.xlsx", "x")]),
    ("<!-- <a href='/old.xlsx'>old</a> --><a href=/new.xlsx class=b>new</a>", [("/new.xlsx", "new")]),
    ("<script>var t = '<a href=\"/s.xlsx\">s</a>';</script><style>a{content:'<a href=x>'}</style>", []),
    ("<A HREF = '/b.xlsx?x=1&amp;y=&#50;'>caf&eacute; &amp; <b> bar </b>\n<!-- no -->baz </A>", [("/b.xlsx?x=1&y=2", "café &barbaz")]),
    ("<td><a href=/c.xlsx>open</td><td>beside</td>", [("/c.xlsx", "open")]),
    ("<a name=top>no</a><a href>empty</a><a href=''>blank</a>", [("", "empty"), ("", "blank")]),
    ("<a title='a > b' href='/d.xlsx'><img src=x><br>t</a>", [("/d.xlsx", "t")]),
    ("<a href='/e.xlsx'>one <a href='/f.xlsx'>two</a> three</a> four", [("/e.xlsx", "onetwothree"), ("/f.xlsx", "two")]),
    ("<a href='/g.xlsx'><script>no()</script>yes</a>", [("/g.xlsx", "yes")]),
    ("<a href='/h.xlsx'/>after", [("/h.xlsx", "")]),
    ("a < b <a href='/i.xlsx'>1 < 2</a>", [("/i.xlsx", "1 < 2")]),
    ("<![CDATA[x]]><?php ?><!DOCTYPE html><a href='/j.xlsx'>j", [("/j.xlsx", "j")]),
    (None, []),
    ("", []),
    ("<" * 5000 + "<a href='/k.xlsx'>k</a>", [("/k.xlsx", "k")]),
]


def test_anchors(spark):
    pages = spark.createDataFrame([(i, p, "u", "t") for i, (p, _) in enumerate(PAGES)], "id int, html string, url string, text string")
    rows = links.extract_links(pages, F.lit("https://h/"), "", keys=("id",)).orderBy("id", "ordinal").collect()
    for i, (_, want) in enumerate(PAGES):
        assert [(r.href, r.text) for r in rows if r.id == i] == want
        assert [r.ordinal for r in rows if r.id == i] == list(range(len(want)))
    assert links.extract_links(pages, F.lit("https://h/"), "NEW|b\\.xlsx", keys=("id",)).count() == 2


BASES = ["http://a/b/c/d;p?q", "http://a/b/c/d;p?q=1/2", "https://h", "https://h/", "http://a/b/c/", "HTTP://A.b/c", "http://h/x//y/z", "mailto:x@y"]
REFS = "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h http:g https://o/../p?q#r //o//p/../q d//e /a//b/../c ?q=a/../b #a/../b mailto:a@b".split()


@pytest.mark.parametrize("base", BASES)
def test_references(spark, base):
    refs = [*REFS, "", " /a b ", "\tx\ny ", "é/ñ"]
    rows = spark.createDataFrame([(i, base, r) for i, r in enumerate(refs)], "i int, base string, ref string").select("i", links.absolute(F.col("base"), F.col("ref")).alias("url")).collect()
    got = {r.i: r.url for r in rows}
    for i, r in enumerate(refs):
        assert got[i] == urljoin(base, r), (base, r)
