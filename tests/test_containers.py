"""Text of one container of a page, its own nested elements included."""

import pytest

from skillframe.functions.text import hrefs, inner_html

NESTED = """<div class="side"><a href=0>0</a></div><!-- <div class="box"><a href=9></a></div> -->
<DIV id=x class='a box b'>one<div><a href="1">1</a><div class="box"><a href="2">2</a></div></div><a href='3'>3</a></DIV>
<divider class="box"><a href=8></a></divider></div><div data-class="box"><a href=7></a></div>
<script>var s = '<div class="box"><a href=6></a>';</script><div class=box title="a > b">two<a href=4>4</a>"""
CASES = [
    (NESTED, "div", "class", "box", ["1", "2", "3", "4"]),
    (NESTED, "div", "id", "x", ["1", "2", "3"]),
    (NESTED, "div", "id", "X", []),
    (NESTED, "div", None, None, ["0", "1", "2", "3", "7", "4"]),
    (NESTED, "nav", None, None, []),
    ("", "div", None, None, []),
    ("</div><a href=1></a><div/><a href=2></a>", "div", None, None, ["2"]),
]


@pytest.mark.parametrize("page,element,attribute,value,want", CASES)
def test_links_of_a_container(spark, page, element, attribute, value, want):
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(hrefs(inner_html("html", element, attribute, value)).alias("h")).first()["h"] == want


def test_text_as_written_missing_and_many(spark):
    page = '<ul class="x"><li>a</ul>\n<ul><li>b</ul>'
    df = spark.createDataFrame([(page,), (None,), ("<ul>" * 300 + "z" + "</ul>" * 300 + "out",)], "html string")
    got = [r["t"] for r in df.select(inner_html("html", "ul").alias("t")).collect()]
    assert got == ["<li>a\n<li>b", None, "<ul>" * 299 + "z" + "</ul>" * 299]
    with pytest.raises(ValueError):
        inner_html("html", "u.l")
