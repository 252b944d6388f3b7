import html
import json
import random
from html.entities import html5
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import dom as D
from shelfmark.functions import html as H
from shelfmark.sources import pages as P
from shelfmark.sources.pages import all_cards, cards_from_pages
from shelfmark.sources.responses import all_works, works_from_responses

CARD = """<article class="product_pod">
  <div class="image_container"><a href="b.html"><img alt="other title"></a></div>
  <p class="star-rating {rating}"><i class="icon-star"></i></p>
  <h3><a href="b.html?title=no" title="{title}">A short...</a></h3>
  <div class="product_price"><p class="price_color">{price}</p>
  <p class="instock availability"><i class="icon-ok"></i>
      In stock
  </p></div></article>"""


def card(title="A book", price="£51.77", rating="Three"):
    return CARD.format(title=title, price=price, rating=rating)


def pages(spark, *bodies, url="http://shop/catalogue/page-1.html"):
    rows = [(url, f"<html><body>{body}</body></html>") for body in bodies]
    return spark.createDataFrame(rows, "url string, html string")


def read(df):
    return sorted(tuple(row) for row in df.collect())


def test_card_fields(spark):
    found = cards_from_pages(pages(spark, card()))
    assert found.columns == ["title", "price_gbp", "rating", "availability"]
    assert read(found) == [("A book", 51.77, 3, "In stock")]


def test_prices_titles_and_ratings_are_decoded(spark):
    body = (
        card("Tom &amp; Jerry&#39;s &quot;caf&eacute;&quot;", "Â£1.50", "Five")
        + card("b", "&pound;2", "Zero")
        + card("", "&Acirc;&pound;3")
    )
    assert read(cards_from_pages(pages(spark, body)).drop("availability")) == [
        ("", 3.0, 3),
        ('Tom & Jerry\'s "café"', 1.5, 5),
        ("b", 2.0, 0),
    ]


def test_one_broken_card_leaves_the_rest_of_its_page(spark):
    broken = [
        card(price="free"),
        card().replace("instock", "gone"),
        card().replace(' title="A book"', ""),
        card().replace("h3>", "h4>"),
        card(rating=""),
        card().replace("price_color", "price_colors"),
    ]
    found = all_cards(pages(spark, card("first") + "".join(broken) + card("last")))
    assert found.filter("NOT valid").count() == len(broken)
    assert [row[0] for row in read(found.filter("valid"))] == ["first", "last"]


def test_markup_variants(spark):
    other = card("quoted").replace('class="product_pod"', "id=x class='wide product_pod'")
    bare = card("bare").replace('"price_color"', "price_color").replace("article", "ARTICLE")
    single = card("x").replace('title="x"', "TITLE = 'say \"hi\" > all'")
    hidden = "<!-- " + card("commented") + " --><script>var a='" + card("script") + "';</script>"
    elsewhere = card("no pod").replace("product_pod", "product_pods")
    found = cards_from_pages(pages(spark, hidden + other + bare + single + elsewhere))
    assert [row[0] for row in read(found)] == ["bare", "quoted", 'say "hi" > all']


def test_elements_left_open_or_nested(spark):
    body = (
        card("no end of paragraph").replace("\n  </p></div></article>", "\n  </div></article>")
        + card("no end").replace("</article>", "")
        + card("within").replace("<h3>", "<article class='note'><p>new</p></article><h3>")
        + card("last").replace("</article>", "")
    )
    found = cards_from_pages(pages(spark, body)).select("title", "price_gbp", "availability")
    titles = ["last", "no end", "no end of paragraph", "within"]
    assert read(found) == [(title, 51.77, "In stock") for title in titles]


def nested(depth, inner):
    return "<article class=note><p class=price_colors>no</p>" * depth + inner + "</article>" * depth


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 30])
def test_articles_within_cards(spark, depth):
    notes = nested(depth, "<p>new</p><i>x")
    body = card("before").replace("<h3>", notes + "<h3>") + card("after").replace("</article>", notes + "</article>")
    body += nested(depth, card("inside"))
    found = all_cards(pages(spark, body))
    assert read(found.select("title", "price_gbp", "availability", "valid")) == [
        (title, 51.77, "In stock", True) for title in ("after", "before", "inside")
    ]


def test_cards_within_cards(spark):
    inner = card("inner", price="£2")
    outer = card("outer").replace("</article>", inner + "</article>")
    found = cards_from_pages(pages(spark, outer + card("next", price="£3")))
    assert read(found.select("title", "price_gbp")) == [("inner", 2.0), ("next", 3.0), ("outer", 51.77)]
    # The first element that fits counts, wherever it lies in the card.
    first = card("outer").replace("<h3>", inner + "<h3>")
    found = cards_from_pages(pages(spark, first))
    assert read(found.select("title", "price_gbp")) == [("inner", 2.0), ("inner", 2.0)]


MARKUP = ["<p>", "</p>", "<p class=w>", "<div>", "</div>", "<br>", "<b>", "</b>", "<p class='w x'/>", "t", " u<v "]
MARKUP += ["<!-- <p> -->", "<script>'</p>'</script>", "<img class=w>", "</br>", "<P CLASS=w>"]


class Tree(HTMLParser):
    """Elements by the open tags of a parser: (first token, text) of each wanted paragraph."""

    EMPTY = {"br", "img"}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        own = [tag, "w" in dict(attrs).get("class", "").split() and tag == "p", self.getpos(), []]
        self.found += [own] if own[1] else []
        if tag not in self.EMPTY:
            self.open.append(own)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in self.EMPTY:
            self.open.pop()

    def handle_endtag(self, tag):
        if any(own[0] == tag for own in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.open or self.open[-1][0] != "script":
            for own in self.open:
                own[3].append(data)


def test_elements_equal_those_of_a_parser(spark):
    rng = random.Random(5)
    htmls = ["".join(rng.choice(MARKUP) for _ in range(rng.randrange(1, 25))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(htmls)), "n int, html string")
    df = df.withColumn("pieces", D.tokens(F.col("html")))
    df = df.withColumn("found", D.elements("pieces", [("p", "w")]))
    own = F.transform("found", lambda e: F.struct(e["closed"], D.text(D.inner(F.col("pieces"), e)).alias("text")))
    for row in df.withColumn("own", own).collect():
        assert "".join(row.pieces) == row.html
        tree = Tree()
        tree.feed(row.html)
        tree.close()
        want = ["".join(own[3]) for own in tree.found]
        assert len(row.found) == len(want), row.html
        for k, (closed, text) in enumerate(row.own):
            if closed:
                assert text == want[k], row.html
            else:  # ends with its parent, or where the next wanted one opens
                assert want[k].startswith(text), row.html
                assert text == want[k] or row.found[k + 1].first == row.found[k].last + 1


def test_kinds_of_elements(spark):
    html = "<h3 id=a>x</h3><p class='k l'>y<a href=q>z</a></p><h3>w</h3><p>"
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string")
    df = df.select("html", D.tokens(F.col("html")).alias("p"))
    df = df.withColumn("f", D.elements("p", [("h3", None), ("p", "l"), ("p", None)]))
    rows = df.select(
        F.transform("f", lambda e: F.struct(e["kind"], e["closed"])).alias("kinds"),
        D.inner_html("html", "p", "k").alias("inner"),
    ).collect()
    kinds = [(0, True), (1, True), (0, True), (2, False)]
    assert [tuple(kind) for kind in rows[0].kinds] == kinds and rows[0].inner == ["y<a href=q>z</a>"]
    assert [tuple(row) for row in rows[1:]] == [([], None), ([], [])]


def test_coarse_pieces_leave_what_is_within(spark):
    rng = random.Random(6)
    more = ["<h3>", "</h3>", "<img src=a>", "<b/>", "<!-- <p> -->", "<P class='w'>", "</B>", "<i>x</i>", "</br>", "<"]
    htmls = ["".join(rng.choice([*MARKUP, *more]) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    htmls.append("<p class=w><li><h3><a title='<p class=w>'>x</a></h3><i></i>y<br></li></p>")
    df = spark.createDataFrame([(own,) for own in htmls], "html string")
    df = df.withColumn("pieces", D.tokens(F.col("html"))).withColumn("found", D.elements("pieces", [("p", "w")]))
    fine = F.transform("found", lambda e: F.array_join(D.inner(F.col("pieces"), e), ""))
    coarse = F.regexp_extract_all("html", F.lit(D._coarse_token("p")), F.lit(0))
    rows = df.select("html", "pieces", fine.alias("fine"), D.inner_html("html", "p", "w").alias("own"), coarse.alias("coarse")).collect()
    for row in rows:
        assert row.own == row.fine, row.html
        assert "".join(row.coarse) == row.html
    assert len(rows[-1].coarse) == 3 < len(rows[-1].pieces)


def test_fields_found_together_equal_those_found_one_by_one(spark):
    rng = random.Random(7)
    parts = [
        "<h3>", "</h3>", '<a title="t 1">', "<a title='t2'>", '<a href="x" Title = "<p class=instock>">', "<a>", "</a>",
        '<p class="star-rating One">', "<p class='star-rating Two'>", '<p class="star-rating price_color">', "</p>",
        '<p class="price_color">£1.25</p>', '<p class="price_color"><b>2</b></p>', '<p class="x instock">', "In <i></i>",
        '<P CLASS="instock">In\n</P >', '<p class="price_color">', "x", "\x01", '"', "<", "<i/>",
    ]
    whole = ['<h3><a title="q">', '<p class="star-rating One">', '<p class="price_color">£1</p>', '<p class="instock">In</p>']
    cards = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 16))) for _ in range(800)]
    cards += ["".join(rng.sample([*whole, *rng.choices(parts, k=3)], 7)) for _ in range(800)]
    cards += ["".join(rng.sample(whole, 4)) for _ in range(9)]
    df = spark.createDataFrame([(own,) for own in cards], "card string")
    found = F.split(F.regexp_replace("card", H.card_fields(), P._FIELDS), P._MARK, 5)
    together = P._raw_fields(F.col("card"), found)
    alone = P._raw_fields(F.col("card"), F.array().cast("array<string>"))
    rows = df.select("card", F.size(found).alias("n"), F.struct(*together).alias("a"), F.struct(*alone).alias("b")).collect()
    for row in rows:
        assert row.a == row.b, row.card
    assert all(row.n == 5 for row in rows[-9:])  # in any order


def test_references_are_decoded_as_by_the_parser(spark):
    names = sorted(html5)
    texts = [f"&{name}" for name in names] + [f"a&{name.rstrip(';')}z; &{name}" for name in names]
    texts += [f"&{name.rstrip(';')}" for name in names]
    codes = [*range(0, 0x180), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x1F600, 0x10FFFF, 0x110000]
    codes += [0x1FFFE, 10**9, 10**30]
    texts += [f"x&#{n};y&#{n}z&#X{n:x};&#x000{n:X}g" for n in codes]
    texts += [None, "", "&", "&&", "&;", "&#", "&#;", "&#x;", "&#xg", "& amp;", "&amp", "&ampamp;", "&no such;"]
    texts += ["&" + "a" * 40 + ";", "&é;", "a&b<c&lt;d", "&#38;#38;", "&amp;lt;", "&notit;", "&notin;"]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for row in df.select("text", H.unescape("text").alias("got")).collect():
        assert row.got == (None if row.text is None else html.unescape(row.text)), row.text


def test_no_python_in_the_plan_of_cards(spark):
    plan = cards_from_pages(pages(spark, card()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_only_the_first_heading_names_the_book(spark):
    body = card().replace("<h3>", "<h3>no link here</h3><h3>")
    assert all_cards(pages(spark, body)).select("valid").collect()[0][0] is False


def test_page_range_reads_the_number_in_the_url(spark):
    df = pages(spark, card("one")).unionAll(
        pages(spark, card("eleven"), url="http://shop/catalogue/page-11.html")
    )
    df = df.unionAll(pages(spark, card("index"), url="http://shop/index.html"))
    assert [row[0] for row in read(cards_from_pages(df, max_pages=10))] == ["one"]
    assert cards_from_pages(df).count() == 3


def test_pages_without_cards(spark):
    df = spark.createDataFrame([("u", None), ("u", ""), ("u", "<p>")], "url string, html string")
    assert cards_from_pages(df).count() == 0


def test_large_page(spark):
    body = "".join(card(f"book {n} " + "x" * 200) for n in range(3000)) + "<" * 100_000
    assert cards_from_pages(pages(spark, body)).count() == 3000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab <>&\"'=é\n/;", max_size=12), min_size=1, max_size=8))
def test_escaped_titles_come_back(spark, titles):
    body = "".join(card(html.escape(title)) for title in titles)
    found = cards_from_pages(pages(spark, body)).select("title").collect()
    assert sorted(row[0] for row in found) == sorted(titles)


def test_tags_that_only_begin_alike_are_other_tags(spark):
    longer = card("x").replace("<p class", "<p-x class='instock'>no</p-x><pre>no</pre><p class")
    found = cards_from_pages(pages(spark, longer))
    assert read(found) == [("x", 51.77, 3, "In stock")]


def test_elements_attributes_and_text(spark):
    df = spark.createDataFrame([('<p id=a>x <b>y</b></p><p class="k l" data-id="q">z</p>',)], ["h"])
    row = df.select(
        H.elements(F.col("h"), "p").alias("all"),
        H.elements(F.col("h"), "p", "l").alias("of_class"),
        H.text(H.element(F.col("h"), "p")).alias("text"),
        H.attribute(H.opening_tag(F.col("h"), "p"), "id").alias("id"),
        H.attribute(H.opening_tag(F.col("h"), "p", "k"), "id").alias("no_id"),
    ).first()
    assert tuple(row) == (["x <b>y</b>", "z"], ["z"], "x y", "a", None)


PAYLOAD = {
    "works": [
        {
            "title": "Python Book",
            "authors": [{"name": "Author"}],
            "first_publish_year": 2020,
            "edition_count": 5,
            "key": "/works/123",
        }
    ]
}


def responses(spark, *bodies, subject="python"):
    texts = [body if body is None or isinstance(body, str) else json.dumps(body) for body in bodies]
    return spark.createDataFrame([(subject, text) for text in texts], "subject string, body string")


def test_work_fields(spark):
    works = works_from_responses(responses(spark, PAYLOAD))
    assert [tuple(row) for row in works.collect()] == [
        ("Python Book", ["Author"], 2020, "python", 5, "/works/123")
    ]


def test_defaults_stand_in_for_absent_fields_only(spark):
    body = {
        "works": [
            {},
            {"title": None, "edition_count": None, "key": None, "first_publish_year": None},
            {"title": 7, "first_publish_year": "1999", "edition_count": 2.0, "authors": [{}]},
            {"title": "t", "authors": [{"name": "A"}, {"name": None}], "first_publish_year": "x"},
        ]
    }
    works = works_from_responses(responses(spark, body)).drop("subject")
    assert [tuple(row) for row in works.collect()] == [
        ("", [], None, 0, ""),
        (None, [], None, None, None),
        ("7", [""], 1999, 2, ""),
        ("t", ["A", None], None, 0, ""),
    ]


def test_bad_bodies_give_no_rows(spark):
    bodies = ["not json", "{}", "[1, 2]", '{"works": null}', '{"works": 3}', "", None]
    assert all_works(responses(spark, *bodies)).count() == 0


def test_bad_works_are_marked(spark):
    body = {"works": [None, 5, "x", {"title": "t", "authors": "A"}, {"title": "ok"}]}
    works = all_works(responses(spark, body))
    assert works.filter("NOT valid").count() == 4
    assert works.filter("valid").first()["title"] == "ok"


def test_cap_counts_per_response_and_subjects_are_chosen(spark):
    body = {"works": [{"title": str(n)} for n in range(30)]}
    df = responses(spark, body).unionAll(responses(spark, body, subject="other"))
    assert works_from_responses(df).count() == 60
    assert works_from_responses(df, limit=20).count() == 40
    capped = works_from_responses(df, subjects=["other"], limit=2)
    assert read(capped.select("title", "subject")) == [("0", "other"), ("1", "other")]


_PIECES = [
    '<h3><a href="x" title="A &amp; B">t</a></h3>', "<h3 title='<p class=\"instock\">x</p>'><a title=\"B\">t</a></h3>",
    '<h3>t</h3><a title="C">t</a>', '<H3><i></i><A rel="a" TITLE = "D">t</A></H3>', '<h3><a title="a < b">t</a></h3>',
    '<p class="star-rating One"><i></i></p>', '<p class="star-rating Two price_color">£1</p>',
    "<p class='star-rating Three'></p>", '<P CLASS="big star-rating Four">',
    '<p class="price_color">£2.5</p>', '<p class="price_color instock">£3</p>', '<p class="price_color">£<b>4</b></p>',
    '<p class="instock availability">\n<i></i>In stock\n</p>', '<p class="instock">a<p>b</p></p>', '<p class="instock">c',
    "<p>note</p>", '<b title="<p class=instock>">', "text", '<p class="pinstock">d</p>', "<pre>e</pre>",
]


def test_fields_of_a_card_in_usual_order_are_found_in_one_pass(spark):
    usual = _PIECES[0] + _PIECES[5] + _PIECES[9] + _PIECES[12]
    draw = random.Random(3)
    cards = [usual] + [
        "".join(draw.choice(_PIECES[a:b]) + draw.choice(["", "", "", draw.choice(_PIECES)])
                for a, b in ((0, 5), (5, 9), (9, 12), (12, 15)))
        for _ in range(3000)
    ] + ["".join(draw.choices(_PIECES, k=6)) for _ in range(1000)]
    df = spark.createDataFrame([(own,) for own in cards], "card string")
    names = ("title", "rating", "price", "stock")
    anywhere = F.regexp_replace("card", rf"^(?:{H._fields_anywhere()})(?s:.*)\z", "|".join(f"${{{n}}}" for n in names))
    both = F.regexp_replace("card", H.card_fields(), "|".join(f"${{{n}}}${{{n}1}}" for n in names))
    in_order = F.col("card").rlike("^" + H._fields_in_order())
    rows = df.select("card", anywhere.alias("anywhere"), both.alias("both"), in_order.alias("in_order")).collect()
    assert rows[0]["in_order"] and rows[0]["both"] == 'A &amp; B|star-rating One|£2.5|' + _PIECES[12]
    assert [row for row in rows if row["both"] != row["anywhere"]] == []
    assert len({row["in_order"] for row in rows}) == 2
