"""Product cards of fetched catalogue pages."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dom as D
from ..functions import html as H
from ..functions.columns import clean_price, pinned, rating_from_word, strip_ws, token
from ..schemas import RAW_PAGES

# Fixed value: the `source` of these records.
WEB_SOURCE = "books.toscrape.com"

_PAGE_NUMBER = r"page-([0-9]+)\.html"


# Pages whose numbers have equally many binary digits lie together: 31 folders at most.
_NUMBER, _GROUP = "page", "page_group"
_NUMBERED_PAGES = T.StructType(
    [*RAW_PAGES, T.StructField(_NUMBER, T.IntegerType()), T.StructField(_GROUP, T.IntegerType())]
)


def read_raw_pages(spark, path, fmt="parquet", partitions=None, by_number=False, max_pages=None):
    """Fetched pages: (url, html), Parquet or JSON Lines.

    `partitions` deals the raw rows out anew, a shuffle that helps only where the files hold fewer
    splits than the cluster has cores. Without it they stay where they are read. `by_number` reads what
    store_raw_pages wrote; of that, `max_pages` leaves the folders of higher pages unread.
    """
    schema = _NUMBERED_PAGES if by_number else RAW_PAGES
    raw = spark.read.schema(schema).format(fmt).load(path)
    if by_number and max_pages is not None:
        raw = page_range(raw, max_pages)
    return raw.repartition(partitions) if partitions else raw


def store_raw_pages(pages, path, url="url"):
    """Write fetched pages with their page numbers, in folders by size of the number.

    A page without a number in its URL has a folder too. Returns the path.
    """
    number = _page_number(url)
    group = F.when(number > 0, F.length(F.bin(number))).otherwise(number)
    numbered = pages.withColumns({_NUMBER: number, _GROUP: group.cast("int")})
    numbered.write.mode("overwrite").partitionBy(_GROUP).parquet(path)
    return path


def _page_number(url):
    number = F.try_element_at(F.regexp_extract_all(F.col(url), F.lit(_PAGE_NUMBER)), F.lit(1))
    return number.try_cast("int")


def page_range(pages, max_pages, url="url"):
    """Pages whose URL names a page number of at most max_pages; stored numbers reach the scan."""
    if {_NUMBER, _GROUP} <= set(pages.columns):
        largest = max_pages.bit_length() if max_pages > 0 else max_pages
        return pages.filter((F.col(_GROUP) <= largest) & (F.col(_NUMBER) <= max_pages))
    return pages.filter(_page_number(url) <= max_pages)


_CARD = ("article", "product_pod")
# An article that opens before another is closed. Of a page without one, patterns tell the cards.
_ARTICLE = r"(?i:article)(?![\w:-])"
_NESTED = rf"<{_ARTICLE}[^<]*+(?:<(?!/?{_ARTICLE})[^<]*+)*+<{_ARTICLE}"


def all_cards(pages, html="html", max_pages=None):
    """Every product card with a `valid` flag, one row per card.

    A card is valid when title, price, rating word and availability are all there and the price
    is a number. An unknown rating word gives 0.
    """
    if max_pages is not None:
        pages = page_range(pages, max_pages)
    cards = pages.select(H.drop_noise(F.col(html)).alias("page")).select(
        F.when(F.col("page").rlike(_NESTED), D.inner_html("page", *_CARD))
        .otherwise(H.elements(F.col("page"), *_CARD))
        .alias("cards")
    )
    # Without `outer` Spark would add a filter to the scan that finds all cards for itself.
    cards = cards.select(F.explode_outer("cards").alias("card"))
    found = F.split(F.regexp_replace("card", H.card_fields(), _FIELDS), _MARK, 5)
    marked = cards.filter(F.col("card").isNotNull()).select("card", found.alias("found"))
    raw = marked.select(*_raw_fields(F.col("card"), F.col("found")))
    stock = F.when(F.col("stock_element") != "", H.text(F.col("stock_element")))
    raw = raw.withColumn("raw_stock", stock)
    decoded = raw.select(
        pinned(H.unescape("raw_title")).alias("title"),
        H.unescape("raw_price").alias("price_text"),
        H.unescape("raw_stock").alias("availability_text"),
        "rating_classes",
    )
    word = token(F.col("rating_classes"), 2)
    price = clean_price("price_text")
    return decoded.select(
        "title",
        price.alias("price_gbp"),
        rating_from_word(word).alias("rating"),
        strip_ws("availability_text").alias("availability"),
        (
            F.col("title").isNotNull()
            & price.isNotNull()
            & word.isNotNull()
            & F.col("availability_text").isNotNull()
        ).alias("valid"),
    )


def cards_from_pages(pages, html="html", max_pages=None):
    """The valid product cards: (title, price_gbp, rating, availability)."""
    return all_cards(pages, html, max_pages).filter("valid").drop("valid")


# The fields of a card that one pattern finds.
_MARK = "\x01"
_FIELDS = "".join(f"{_MARK}${{{name}}}${{{name}1}}" for name in ("rating", "price", "stock", "title"))


def _raw_fields(card, found):
    """From `found` where one pattern fits the card, else by a pattern for each field."""
    fits = (F.size(found) == 5) & ~card.contains(_MARK)
    link, stars = H.opening_tag(card, "a", within="h3"), H.opening_tag(card, "p", "star-rating")
    fields = {
        "raw_title": (4, H.attribute(link, "title")),
        "raw_price": (2, H.text(H.element(card, "p", "price_color"))),
        "stock_element": (3, H.element(card, "p", "instock")),
        "rating_classes": (1, H.attribute(stars, "class")),
    }
    return [
        F.when(fits, F.get(found, F.lit(at))).otherwise(by_pattern).alias(name)
        for name, (at, by_pattern) in fields.items()
    ]
