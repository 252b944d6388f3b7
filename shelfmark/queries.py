"""The operators and jobs run over the test tables, each with the same result as plain SQL.

`QUERIES` maps a name to a function of (spark, folder of Parquet tables); `ORACLE` maps the same
names to SQL over those tables. The book jobs get their input from these tables: lines of
`documents` become product cards and listed works, `orders` become rows of a book dump.
"""

from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from .functions import html as H
from .functions.columns import (
    RATING_WORDS,
    array_text,
    batch_stamp,
    clean_price,
    lookup,
    safe_double,
    safe_int,
    strip_ws,
    token,
)
from .functions.fields import field
from .operators.groups import count_by, number_stats, size_ranking, top_k
from .operators.quality import (
    at_most,
    is_between,
    is_positive,
    is_unique,
    not_empty,
    quality_report,
)
from .operators.rows import (
    add_lineage,
    dedup_latest,
    in_range,
    moment,
    positive,
    require,
)
from .operators.sketches import estimates, relative_error, sketch_by, union_sketches
from .plans.gold import gold_by_year, gold_price_stats, gold_top_rated, gold_top_subjects
from .plans.jobs import Inputs, run_all, run_bronze, run_silver
from .plans.silver import silver_api, silver_csv, silver_web
from .schemas import LANDING_CSV_COLUMNS
from .session import Layers, shared_folder
from .sinks.tables import TableRejected, overwrite_table, publish_table, write_batch
from .sources.landing import read_landing_csv
from .sources.layers import open_table, read_bronze, read_silver
from .sources.pages import WEB_SOURCE, cards_from_pages, read_raw_pages, store_raw_pages
from .sources.responses import API_SOURCE, works_from_responses

QUERIES = {}
ORACLE = {}

BATCH_TS = datetime(2025, 1, 31, 12, 30, 45, tzinfo=timezone.utc)
_WORDS = [*RATING_WORDS, "Zero"]


def query(sql):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLE[run.__name__] = sql
        return run

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(text):
    return F.lit(text).cast("timestamp_ntz")


# --- Grouping, ranking, filtering -------------------------------------------------------------


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
           count(DISTINCT o_custkey) AS n_customers,
           count(DISTINCT o_orderpriority) AS n_priorities
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31'
    GROUP BY 1 ORDER BY 1
""")
def by_year(spark, folder):
    orders = table(spark, folder, "orders")
    orders = in_range(orders, "o_orderdate", day("1996-01-01"), day("2000-12-31"))
    return count_by(
        orders.withColumn("year", F.year("o_orderdate")),
        "year",
        rows="n_orders",
        distinct={"n_customers": "o_custkey", "n_priorities": "o_orderpriority"},
    )


@query("""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n_lines,
           count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
    FROM lineitem GROUP BY 1 ORDER BY 1
""")
def shipments_by_year(spark, folder):
    return count_by(
        table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate")),
        "year",
        rows="n_lines",
        distinct={"n_parts": "l_partkey", "n_suppliers": "l_suppkey"},
    )


@query("""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n_lines,
           count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders,
           TRUE AS parts_fit, TRUE AS orders_fit
    FROM lineitem GROUP BY 1
""")
def shipments_from_sketches(spark, folder):
    """Distinct counts, and whether estimates from sketches of each return flag are within 4 errors."""
    lines = table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate"))
    distinct = {"parts": "l_partkey", "orders": "l_orderkey"}
    parts = sketch_by(lines, ["l_returnflag", "year"], "n_lines", distinct)
    kept = f"{shared_folder(spark, 'sketches')}/years"
    overwrite_table(parts, kept)
    whole = union_sketches(open_table(spark, kept), ["year"], "n_lines", distinct)
    exact = count_by(lines, "year", "n", {"n_parts": "l_partkey", "n_orders": "l_orderkey"}).drop("n")
    both = estimates(whole, distinct).join(exact, "year")

    def fits(name):
        return F.abs(F.col(name) - F.col(f"n_{name}")) <= 4 * relative_error() * F.col(f"n_{name}")

    return both.select(
        "year", "n_lines", "n_parts", "n_orders",
        fits("parts").alias("parts_fit"), fits("orders").alias("orders_fit"),
    )


@query("""
    SELECT p_size, count(*) AS n_parts,
           round(min(CAST(p_retailprice AS FLOAT)), 2) AS min_price,
           round(max(CAST(p_retailprice AS FLOAT)), 2) AS max_price,
           round(avg(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE)), 2) AS mean_price
    FROM part GROUP BY p_size ORDER BY p_size DESC
""")
def price_stats(spark, folder):
    part = table(spark, folder, "part").withColumn("price", F.col("p_retailprice").cast("float"))
    return number_stats(
        part,
        "p_size",
        "price",
        rows="n_parts",
        low="min_price",
        high="max_price",
        mean="mean_price",
    )


@query("""
    SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size IS NOT NULL
    ORDER BY p_size DESC, p_retailprice ASC, p_partkey ASC LIMIT 20
""")
def top_rated(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    order = [F.col("p_size").desc(), F.col("p_retailprice").asc(), F.col("p_partkey").asc()]
    return top_k(require(part, ["p_size"]), order, 20)


@query("""
    SELECT source, count(*) AS n_docs, round(avg(n_chars), 2) AS mean_chars,
           min(n_chars) AS shortest, max(n_chars) AS longest
    FROM documents GROUP BY source ORDER BY n_docs DESC, source
""")
def top_subjects(spark, folder):
    return size_ranking(
        table(spark, folder, "documents"),
        "source",
        rows="n_docs",
        mean_of="n_chars",
        mean="mean_chars",
        span_of="n_chars",
        first="shortest",
        last="longest",
    )


@query("""
    SELECT event_id, nullif(event_type, 'error') AS kind, value - 245 AS balance
    FROM events WHERE event_type <> 'error' AND value - 245 > 0
""")
def filter_valid(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        (F.col("value") - 245).alias("balance"),
    )
    return positive(require(events, ["kind"]), "balance")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 300000
""")
def filter_range(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return in_range(orders, "o_totalprice", 50000, 300000)


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
    FROM orders GROUP BY 1 HAVING year(ANY_VALUE(o_orderdate)) = 1998
""")
def filter_after_agg(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return count_by(orders, "year", rows="n_orders", distinct={}).filter("year = 1998")


@query("""
    SELECT c_custkey AS customer, c_name AS name, c_acctbal AS balance, 'silver' AS layer
    FROM customer
""")
def rename_drop_lit(spark, folder):
    names = {"c_custkey": "customer", "c_name": "name", "c_acctbal": "balance", "absent": "x"}
    customer = table(spark, folder, "customer").withColumnsRenamed(names)
    return customer.drop("c_nationkey", "c_mktsegment", "absent").withColumn(
        "layer", F.lit("silver")
    )


# --- Deduplication ----------------------------------------------------------------------------


@query("""
    SELECT doc_id, text, lang, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1
""")
def dedup_documents(spark, folder):
    return dedup_latest(table(spark, folder, "documents"), ["text"], ["doc_id"])


@query("""
    SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS ts, user_id, event_type, value, props
    FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type
        ORDER BY ts DESC, event_id DESC, value DESC, props DESC) = 1
""")
def dedup_events(spark, folder):
    latest = dedup_latest(table(spark, folder, "events"), ["user_id", "event_type"], ["ts"])
    return latest.withColumn("ts", batch_stamp("ts"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
                 l_quantity DESC) = 1
""")
def dedup_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    return dedup_latest(lines, ["l_partkey"], ["l_shipdate"]).drop("l_shipdate")


# --- Column functions -------------------------------------------------------------------------


@query("""
    WITH forms AS (
        SELECT l_orderkey, l_linenumber,
               CASE l_returnflag
                   WHEN 'A' THEN ' ' || l_linenumber || ' '
                   WHEN 'N' THEN l_linenumber || '.' || l_linenumber
                   WHEN 'R' THEN l_linenumber || 'e3' END AS form
        FROM lineitem)
    SELECT l_orderkey, l_linenumber, form,
           CASE WHEN regexp_full_match(trim(form), '[0-9]+(\\.[0-9]*)?')
                THEN CAST(trunc(CAST(trim(form) AS DOUBLE)) AS INTEGER) ELSE -1 END AS as_int,
           CAST(trim(form) AS DOUBLE) AS as_double
    FROM forms
""")
def cast_safe(spark, folder):
    number = F.col("l_linenumber").cast("string")
    form = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), number, F.lit(" ")))
        .when(F.col("l_returnflag") == "N", F.concat(number, F.lit("."), number))
        .when(F.col("l_returnflag") == "R", F.concat(number, F.lit("e3")))
    )
    lines = table(spark, folder, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", form.alias("form"))
    return lines.withColumns(
        {
            "as_int": F.coalesce(safe_int("form"), F.lit(-1)),
            "as_double": safe_double("form"),
        }
    )


@query("""
    WITH padded AS (
        SELECT doc_id, '  ' || chr(9) || text || chr(160) || chr(10) || ' ' AS text FROM documents)
    SELECT doc_id, trim(text) AS trimmed,
           trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))
               AS stripped
    FROM padded
""")
def trim_strip(spark, folder):
    padded = F.concat(F.lit("  \t"), F.col("text"), F.lit(" \n "))
    return table(spark, folder, "documents").select(
        "doc_id", F.trim(padded).alias("trimmed"), strip_ws(padded).alias("stripped")
    )


@query("SELECT p_partkey, p_retailprice AS price FROM part")
def price_text(spark, folder):
    part = table(spark, folder, "part")
    text = F.concat(F.lit(" Â£"), F.col("p_retailprice").cast("string"), F.lit("\n"))
    return part.select("p_partkey", clean_price(text).alias("price"))


@query("""
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
                                WHEN '3-MEDIUM' THEN 3 ELSE 0 END AS priority
    FROM orders
""")
def map_lookup(spark, folder):
    known = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return table(spark, folder, "orders").select(
        "o_orderkey", lookup("o_orderpriority", known, 0).alias("priority")
    )


@query("""
    SELECT p_partkey,
           '[' || upper(replace(p_name, ' ', ', ')) || ']' AS words,
           nullif(split_part(p_name, ' ', 2), '') AS second_word
    FROM part
""")
def array_to_string(spark, folder):
    words = F.transform(F.split("p_name", " "), F.upper)
    return table(spark, folder, "part").select(
        "p_partkey", array_text(words).alias("words"), token("p_name", 2).alias("second_word")
    )


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, 'none' AS absent,
           CAST(NULL AS VARCHAR) AS nulled
    FROM events
""")
def json_fields(spark, folder):
    props = F.try_parse_json(F.replace("props", F.lit("{"), F.lit('{"nulled": null, ')))
    return table(spark, folder, "events").select(
        "event_id",
        field(props, "$.k", "int", 0).alias("k"),
        field(props, "$.absent", "string", "none").alias("absent"),
        field(props, "$.nulled", "string", "none").alias("nulled"),
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def format_batch_ts(spark, folder):
    return table(spark, folder, "events").select("event_id", batch_stamp("ts").alias("stamp"))


# --- Extraction from raw pages and responses --------------------------------------------------

# One row per line of a document, numbered from 1.
_LINES_SQL = """
    SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS n
    FROM documents
"""
_CARDS_SQL = f"""
    SELECT doc_id, line AS title,
           CAST((length(line) - 3) || '.25' AS DOUBLE) AS price_gbp,
           CAST(CASE (length(line) % 6) WHEN 5 THEN 0 ELSE length(line) % 6 + 1 END AS INTEGER)
               AS rating,
           CASE WHEN length(line) % 2 = 0 THEN 'In stock' ELSE 'Out of stock' END AS availability
    FROM ({_LINES_SQL})
"""
_WORKS_SQL = f"""
    SELECT lang AS subject, line AS title, list_slice(string_split(line, ' '), 1, 2) AS authors,
           CAST(1700 + length(line) % 400 AS INTEGER) AS first_publish_year,
           CAST(length(line) % 5 AS INTEGER) AS edition_count,
           '/works/' || split_part(line, ' ', 1) AS key, n
    FROM ({_LINES_SQL})
"""


# How many tasks share the parsing of raw pages and responses. The tables lie in few files, which alone
# would leave most cores idle.
RAW_PARTITIONS_SETTING = "spark.shelfmark.rawPartitions"


def raw_partitions(spark):
    return int(spark.conf.get(RAW_PARTITIONS_SETTING, str(spark.sparkContext.defaultParallelism)))


def documents_of(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return documents.repartition(raw_partitions(spark))


def pages_of_documents(documents, card=None):
    """A catalogue page per document, with a product card per line; page numbers repeat."""
    return documents.select(*_page_columns(card))


def _page_columns(card=None):
    number = (F.col("doc_id") % 20).cast("string")
    return [
        F.concat(
            F.lit("http://shop.example.com/page-"), number, F.lit(".html?id="), "doc_id"
        ).alias("url"),
        F.concat(
            F.lit("<html><body><!-- <article class='product_pod'> --><ol>"),
            F.array_join(F.transform(F.split("text", "\n"), card or _card_html), "\n"),
            F.lit("</ol></body></html>"),
        ).alias("html"),
    ]


def pages_of_cards_in_cards(documents):
    """As pages_of_documents, but of each four cards the later lie in the earlier."""
    end = "</article></li>"
    cards = F.transform(F.split("text", "\n"), _card_html)
    opened = F.transform(cards, lambda card: F.substr(card, F.lit(1), F.length(card) - len(end)))
    fours = F.transform(
        F.sequence(F.lit(0), F.size(cards) - 1, F.lit(4)),
        lambda at: F.concat(
            F.array_join(F.slice(opened, at + 1, F.lit(4)), ""),
            F.repeat(F.lit(end), F.least(F.lit(4), F.size(cards) - at)),
        ),
    )
    return documents.select(
        F.lit("http://shop.example.com/page-1.html").alias("url"), F.array_join(fours, "\n").alias("html")
    )


def _broken_card(line):
    """A card with a paragraph or itself left open, or with an article within."""
    whole, kind = _card_html(line), F.length(line) % 4
    return (
        F.when(kind == 1, F.replace(whole, F.lit("\n</p></article>"), F.lit("</article>")))
        .when(kind == 2, F.replace(whole, F.lit("</article>"), F.lit("")))
        .when(kind == 3, F.replace(whole, F.lit("<h3>"), F.lit("<article><p>new</p></article><h3>")))
        .otherwise(whole)
    )


def _nested_card(line):
    """A card that holds articles one to four deep, some of them left open, before and after its fields."""
    whole, depth = _card_html(line), F.length(line) % 4 + 1
    note = F.lit('<article class="note"><p class="price">new</p><p class="stock">')
    end = F.when(F.length(line) % 3 == 0, F.lit("</article>")).otherwise(F.lit("</p></article>"))
    notes = F.concat(F.repeat(note, depth.cast("int")), F.repeat(end, depth.cast("int")))
    return F.replace(
        F.replace(whole, F.lit("<h3>"), F.concat(notes, F.lit("<h3>"))),
        F.lit("</article></li>"),
        F.concat(notes, F.lit("</article></li>")),
    )


def _card_html(line):
    size = F.length(line)
    escaped = line
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    title = F.when(line.rlike('[&<>"]'), escaped).otherwise(line)
    word = F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (size % 6 + 1).cast("int"))
    stock = F.when(size % 2 == 0, "In stock").otherwise("Out of stock")
    return F.concat(
        F.lit('<li><article class="wide product_pod"><h3><a href="x.html" title="'),
        title,
        F.lit('">a book</a></h3><p class="star-rating '),
        word,
        F.lit('"><i></i></p><p class="price_color">Â£'),
        (size - 3).cast("string"),
        F.lit('.25</p><p class="instock availability">\n  <i></i>'),
        stock,
        F.lit("\n</p></article></li>"),
    )


def responses_of_documents(documents):
    """A response per document that lists a work per line; zero editions are left out."""
    return documents.select(*_response_columns())


def _response_columns():
    works = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("title"),
            F.transform(
                F.slice(F.split(line, " "), 1, 2), lambda name: F.struct(name.alias("name"))
            ).alias("authors"),
            (F.length(line) % 400 + 1700).alias("first_publish_year"),
            F.nullif(F.length(line) % 5, F.lit(0)).alias("edition_count"),
            F.concat(F.lit("/works/"), F.split_part(line, F.lit(" "), F.lit(1))).alias("key"),
        ),
    )
    return [F.col("lang").alias("subject"), F.to_json(F.struct(works.alias("works"))).alias("body")]


@query(f"SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL})")
def product_cards(spark, folder):
    return cards_from_pages(pages_of_documents(documents_of(spark, folder)))


@query(f"SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL})")
def broken_cards(spark, folder):
    """Cards whose tags are left open or nested."""
    return cards_from_pages(pages_of_documents(documents_of(spark, folder), _broken_card))


@query(f"SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL})")
def nested_cards(spark, folder):
    """Cards with other articles in them, up to four deep."""
    return cards_from_pages(pages_of_documents(documents_of(spark, folder), _nested_card))


@query(f"SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL})")
def cards_in_cards(spark, folder):
    """Cards each of which lies in the one before it on its page, four deep."""
    return cards_from_pages(pages_of_cards_in_cards(documents_of(spark, folder)))


@query(f"""
    SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL}) WHERE doc_id % 20 <= 10
""")
def product_cards_capped(spark, folder):
    """The feature that takes pages up to a number."""
    return cards_from_pages(pages_of_documents(documents_of(spark, folder)), max_pages=10)


@query(f"""
    SELECT title, price_gbp, rating, availability FROM ({_CARDS_SQL}) WHERE doc_id % 20 <= 10
""")
def product_cards_pruned(spark, folder):
    """As product_cards_capped, from pages stored by number, of which the scan leaves out most."""
    path = f"{shared_folder(spark, 'pages')}/pages"
    store_raw_pages(pages_of_documents(documents_of(spark, folder)), path)
    return cards_from_pages(read_raw_pages(spark, path, by_number=True, max_pages=10))


@query(f"""
    SELECT title, array_to_string(authors, '|') AS authors, first_publish_year, subject,
           edition_count, key
    FROM ({_WORKS_SQL})
""")
def listed_works(spark, folder):
    works = works_from_responses(responses_of_documents(documents_of(spark, folder)))
    return works.withColumn("authors", F.array_join("authors", "|"))


@query(f"SELECT title, subject, key FROM ({_WORKS_SQL}) WHERE n <= 3 AND subject IN ('fr', 'de')")
def listed_works_capped(spark, folder):
    """The feature that takes the first three works of each response, of two subjects."""
    responses = responses_of_documents(documents_of(spark, folder))
    works = works_from_responses(responses, subjects=["fr", "de"], limit=3)
    return works.select("title", "subject", "key")


@query("""
    WITH bodies AS (
        SELECT page_id, unnest(regexp_extract_all(
            html, '(?s)<article(?:\\s[^>]*)?>(.*?)</article>', 1)) AS body
        FROM pages)
    SELECT page_id,
           regexp_replace(regexp_replace(regexp_replace(
               regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
               '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS heading,
           CAST(length(body) AS INTEGER) AS size
    FROM bodies
""")
def page_articles(spark, folder):
    body = H.elements(F.regexp_replace("html", "(?s)<!--.*?-->", ""), "article")
    articles = table(spark, folder, "pages").select("page_id", F.explode(body).alias("body"))
    return articles.select(
        H.text(H.element(F.col("body"), "h1")).alias("heading"), F.length("body").alias("size"), "page_id"
    ).select("page_id", H.unescape("heading").alias("heading"), "size")


@query("""
    SELECT page_id, nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') AS first_link,
           nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang
    FROM pages
""")
def page_attributes(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id",
        H.attribute(H.opening_tag(html, "a"), "href").alias("first_link"),
        H.attribute(H.opening_tag(html, "html"), "lang").alias("lang"),
    )


# An order as a row of a book dump: the customer is the book, so that books repeat.
_DUMP_SQL = """
    SELECT CAST(o_custkey AS VARCHAR) AS isbn,
           '  ' || o_orderpriority || ', "' || o_orderstatus || '"' || chr(10) || o_orderkey || ' '
               AS title,
           ' ' || o_orderstatus || (o_orderkey % 50) || ' ' AS author,
           CASE o_orderstatus WHEN 'F' THEN year(o_orderdate) || '.0' WHEN 'P' THEN 'unknown'
                              ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year_text,
           o_orderpriority AS publisher, o_orderdate,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year
    FROM orders
"""


def book_dump(orders):
    year, status = F.year("o_orderdate").cast("string"), F.col("o_orderstatus")
    text = {
        "ISBN": F.col("o_custkey").cast("string"),
        "Book-Title": F.concat(
            F.lit("  "),
            "o_orderpriority",
            F.lit(', "'),
            status,
            F.lit('"\n'),
            "o_orderkey",
            F.lit(" "),
        ),
        "Book-Author": F.concat(F.lit(" "), status, F.col("o_orderkey") % 50, F.lit(" ")),
        "Year-Of-Publication": F.when(status == "F", F.concat(year, F.lit(".0")))
        .when(status == "P", "unknown")
        .otherwise(year),
        "Publisher": F.col("o_orderpriority"),
    }
    empty = F.lit(None).cast("string")
    columns = [text.get(name, empty).alias(name) for name in LANDING_CSV_COLUMNS]
    return orders.select(*columns, "o_orderdate")


def bronze_csv(orders):
    """The dump as Bronze records, each extracted on the day of its order."""
    day = F.col("o_orderdate").cast("timestamp")
    return add_lineage(book_dump(orders), "csv", day).drop("o_orderdate")


# --- Files ------------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents")
def landing_csv(spark, folder):
    """Files in UTF-8 and Latin-1 whose texts hold commas, quotes and line breaks."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    path = shared_folder(spark, "landing")
    latin = F.col("text").rlike("^[\\x00-\\xff]*$") & (F.col("lang") != "en")
    for name, rows, encoding in (("latin", latin, "ISO-8859-1"), ("utf", ~latin, "UTF-8")):
        _write_csv(documents.filter(rows), f"{path}/{name}", encoding)
    return read_landing_csv(spark, path, columns=documents.columns, na_tokens=[""])


def _csv_row(*fields):
    """Fields as one CSV line, each quoted."""
    quoted = [F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"')) for f in fields]
    return F.concat_ws(",", *quoted)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
           replace(text, chr(10), chr(13) || chr(10)) || chr(13) || chr(10) || lang AS text
    FROM documents
""")
def landing_csv_splits(spark, folder):
    """Files read in splits, whose quoted texts hold CR LF."""
    text = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    text = F.concat(text, F.lit("\r\n"), F.col("lang"))
    lines = _csv_row(F.col("doc_id").cast("string"), text)
    path = _write_lines(spark, table(spark, folder, "documents").select(lines), "doc_id,text")
    return read_landing_csv(spark, path, ["doc_id", "text"], na_tokens=[], large_file_bytes=0)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
           CASE WHEN doc_id % 7 = 1 THEN NULL WHEN doc_id % 7 = 2 THEN '5" ' || lang
                WHEN doc_id % 7 = 3 THEN NULL ELSE lang END AS lang,
           CASE WHEN doc_id % 7 = 1 THEN NULL ELSE source END AS source
    FROM documents WHERE doc_id % 7 NOT IN (4, 5)
""")
def landing_overlong(spark, folder):
    """Short rows, stray quotes, missing values, and rows with too many fields, which are skipped."""
    own, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 7
    line = (
        F.when(kind == 1, own)
        .when(kind == 2, F.concat_ws(",", own, F.concat(F.lit('5" '), "lang"), "source"))
        .when(kind == 3, F.concat_ws(",", own, F.lit("NA"), "source"))
        .when(kind == 4, F.concat_ws(",", own, F.lit('5" disk,7" tape'), "lang"))
        .when(kind == 5, F.concat_ws(",", own, "lang", "source", F.lit('"x, y"')))
        .otherwise(F.concat_ws(",", own, "lang", "source"))
    )
    path = _write_lines(spark, table(spark, folder, "documents").select(line), "doc_id,lang,source")
    return read_landing_csv(spark, path, ["doc_id", "lang", "source"])


def _write_lines(spark, lines, header):
    """Text files with a header line each."""
    path = shared_folder(spark, "lines")
    lines = lines.toDF("value").withColumn("part", F.spark_partition_id())
    head = lines.select("part").distinct().select(F.lit(header).alias("value"), "part")
    both = head.withColumn("at", F.lit(0)).unionByName(lines.withColumn("at", F.lit(1)))
    both = both.repartition("part").sortWithinPartitions("part", "at")
    both.select("value", "part").write.partitionBy("part").text(path)
    return path


def _write_csv(df, path, encoding="UTF-8"):
    df.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        encoding=encoding,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@query(f"""
    SELECT isbn, title, author, year_text, publisher, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS day
    FROM ({_DUMP_SQL})
""")
def csv_roundtrip(spark, folder):
    layers = Layers.under(shared_folder(spark, "csv"))
    write_batch(bronze_csv(table(spark, folder, "orders")), layers, "csv", BATCH_TS)
    return read_bronze(spark, layers, "csv").select(
        F.col("ISBN").alias("isbn"),
        F.col("Book-Title").alias("title"),
        F.col("Book-Author").alias("author"),
        F.col("Year-Of-Publication").alias("year_text"),
        F.col("Publisher").alias("publisher"),
        batch_stamp("extracted_at").alias("day"),
    )


@query("""
    SELECT 'books_20250131_123045.json' AS batch, event_type AS title, value AS price_gbp,
           '20250131_123045' AS extracted_at FROM events
    UNION ALL
    SELECT 'books_20250201_123045.json', event_type, value, '20250201_123045' FROM events
""")
def json_roundtrip(spark, folder):
    """Two batches of one source, read back together."""
    layers = Layers.under(shared_folder(spark, "json"))
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("title"),
        F.col("value").alias("price_gbp"),
        F.lit(1).alias("rating"),
        "props",
    )
    events = events.withColumnRenamed("props", "availability")
    for batch_ts in (BATCH_TS, BATCH_TS.replace(month=2, day=1)):
        batch = add_lineage(events, WEB_SOURCE, moment(batch_ts))
        write_batch(batch, layers, "web", batch_ts)
    return read_bronze(spark, layers, "web", file_column="file").select(
        F.regexp_extract("file", "books_[0-9_]+\\.json", 0).alias("batch"),
        "title",
        "price_gbp",
        batch_stamp("extracted_at").alias("extracted_at"),
    )


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def parquet_roundtrip(spark, folder):
    """Of two writes of a table the second stands alone."""
    path = f"{shared_folder(spark, 'parquet')}/lines"
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    overwrite_table(lines.withColumn("l_extendedprice", F.lit(0.0)), path)
    overwrite_table(lines, path)
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def replace_after_failure(spark, folder):
    """A table that two writes fail to replace: one breaks off at its last rows, one breaks a check."""
    path = f"{shared_folder(spark, 'replaced')}/lines"
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    publish_table(lines.withColumn("l_extendedprice", F.lit(1.0)), path, [not_empty()])
    publish_table(lines, path, [is_positive("l_extendedprice"), not_empty()])
    last = lines.agg(F.max("l_orderkey")).first()[0]
    failing = F.when(F.col("l_orderkey") == last, F.raise_error(F.lit("broken off")).cast("double"))
    price = F.coalesce(failing, F.lit(0.0))
    for attempt, checks in ((lines.withColumn("l_extendedprice", price), []), (lines.limit(0), [not_empty()])):
        try:
            publish_table(attempt, path, checks)
        except (PySparkException, TableRejected):
            continue
        raise AssertionError("a broken table was published")
    return open_table(spark, path)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
           CASE WHEN doc_id % 5 = 3 THEN NULL
                ELSE lang || ' 5" disk, ' || text END AS text,
           CASE WHEN doc_id % 5 = 3 THEN NULL ELSE '7"' || source END AS source
    FROM documents
""")
def landing_irregular_splits(spark, folder):
    """Files read in splits, with line breaks in quotes beside single quotes in unquoted fields."""
    own, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 5
    quoted = _csv_row(own, F.concat("lang", F.lit(' 5" disk, '), "text"))
    tail = F.concat(F.lit('7"'), "source")
    line = F.when(kind == 3, F.concat(F.lit('"'), own, F.lit('"'))).otherwise(F.concat_ws(",", quoted, tail))
    documents = table(spark, folder, "documents")
    path = _write_lines(spark, documents.select(line), "doc_id,text,source")
    columns = ["doc_id", "text", "source"]
    return read_landing_csv(spark, path, columns, na_tokens=[], large_file_bytes=0)


# --- Silver and Gold jobs ---------------------------------------------------------------------


def bronze_web(documents):
    cards = cards_from_pages(pages_of_documents(documents))
    return add_lineage(cards, WEB_SOURCE, moment(BATCH_TS))


def bronze_api(documents):
    works = works_from_responses(responses_of_documents(documents))
    return add_lineage(works, API_SOURCE, moment(BATCH_TS))


_SILVER_WEB_SQL = f"""
    SELECT trim(title) AS title, CAST(price_gbp AS FLOAT) AS price_gbp, rating,
           trim(availability) AS availability, 'books.toscrape.com' AS source,
           '20250131_123045' AS extracted_at, 'silver' AS layer, '20250131_123045' AS transformed_at
    FROM ({_CARDS_SQL}) WHERE price_gbp > 0
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY price_gbp DESC) = 1
"""
_SILVER_CSV_SQL = f"""
    SELECT isbn, trim(title) AS title, trim(author) AS author, year, publisher, 'csv' AS source,
           strftime(o_orderdate, '%Y%m%d_%H%M%S') AS extracted_at, 'silver' AS layer,
           '20250131_123045' AS transformed_at
    FROM ({_DUMP_SQL}) WHERE year BETWEEN 1996 AND 2000
    QUALIFY row_number() OVER (
        PARTITION BY isbn
        ORDER BY o_orderdate DESC, title DESC, author DESC, year DESC, publisher DESC) = 1
"""
_WORK_TEXT_SQL = f"""
    SELECT * REPLACE ('[' || array_to_string(authors, ', ') || ']' AS authors) FROM ({_WORKS_SQL})
"""
_SILVER_API_SQL = f"""
    SELECT key, trim(title) AS title, authors, first_publish_year, edition_count, subject,
           'openlibrary_api' AS source, '20250131_123045' AS extracted_at, 'silver' AS layer,
           '20250131_123045' AS transformed_at
    FROM ({_WORK_TEXT_SQL}) WHERE first_publish_year >= 1800
    QUALIFY row_number() OVER (
        PARTITION BY key
        ORDER BY title DESC, authors DESC, first_publish_year DESC, subject DESC,
                 edition_count DESC) = 1
"""


def _stamped(silver):
    return silver.withColumns(
        {name: batch_stamp(name) for name in ("extracted_at", "transformed_at")}
    )


def _silver_web(spark, folder):
    return silver_web(bronze_web(documents_of(spark, folder)), BATCH_TS)


def _silver_csv(spark, folder):
    orders = table(spark, folder, "orders")
    return silver_csv(bronze_csv(orders), BATCH_TS, min_year=1996, max_year=2000)


def _silver_api(spark, folder):
    return silver_api(bronze_api(documents_of(spark, folder)), BATCH_TS)


@query(_SILVER_WEB_SQL)
def silver_web_table(spark, folder):
    return _stamped(_silver_web(spark, folder))


@query(_SILVER_CSV_SQL)
def silver_csv_table(spark, folder):
    return _stamped(_silver_csv(spark, folder))


@query(_SILVER_API_SQL)
def silver_api_table(spark, folder):
    return _stamped(_silver_api(spark, folder))


@query(f"""
    SELECT trim(title) AS title, CAST(price_gbp AS FLOAT) AS price_gbp, rating
    FROM ({_CARDS_SQL}) WHERE price_gbp > 0
    QUALIFY row_number() OVER (PARTITION BY trim(title) ORDER BY price_gbp DESC, rating DESC) = 1
""")
def silver_trimmed_keys(spark, folder):
    """Titles that differ in outer spaces only are one book when keys are trimmed first."""
    bronze = bronze_web(documents_of(spark, folder))
    return silver_web(bronze, BATCH_TS, normalize_key=True).select("title", "price_gbp", "rating")


@query(f"""
    SELECT title, price_gbp, rating, availability FROM ({_SILVER_WEB_SQL})
    ORDER BY rating DESC, price_gbp, title, availability LIMIT 20
""")
def gold_top_rated_books(spark, folder):
    return gold_top_rated(_silver_web(spark, folder))


@query(f"""
    SELECT year, count(*) AS nombre_livres, count(DISTINCT author) AS nombre_auteurs,
           count(DISTINCT publisher) AS nombre_editeurs
    FROM ({_SILVER_CSV_SQL}) GROUP BY year ORDER BY year
""")
def gold_books_by_year(spark, folder):
    return gold_by_year(_silver_csv(spark, folder))


@query(f"""
    SELECT rating, count(*) AS nombre_livres, round(min(price_gbp), 2) AS prix_min,
           round(max(price_gbp), 2) AS prix_max,
           round(avg(CAST(price_gbp AS DOUBLE)), 2) AS prix_moyen
    FROM ({_SILVER_WEB_SQL}) GROUP BY rating ORDER BY rating DESC
""")
def gold_price_stats_by_rating(spark, folder):
    return gold_price_stats(_silver_web(spark, folder))


@query(f"""
    SELECT subject, count(*) AS nombre_livres, round(avg(edition_count), 2) AS editions_moyennes,
           min(first_publish_year) AS plus_ancien, max(first_publish_year) AS plus_recent
    FROM ({_SILVER_API_SQL}) GROUP BY subject ORDER BY nombre_livres DESC, subject
""")
def gold_top_subjects_table(spark, folder):
    return gold_top_subjects(_silver_api(spark, folder))


# --- Quality and run status -------------------------------------------------------------------


@query("""
    WITH t AS (SELECT count(*) AS n, count(DISTINCT p_partkey) AS keys,
                      count(DISTINCT p_name) AS names,
                      count(*) FILTER (WHERE NOT p_retailprice - 950 > 0) AS cheap,
                      count(*) FILTER (WHERE NOT p_size BETWEEN 1 AND 5) AS sizes FROM part)
    SELECT 'column_present' AS "check", 'p_name' AS "column", CAST(0 AS BIGINT) AS failed_rows,
           n AS total_rows FROM t
    UNION ALL SELECT 'column_present', 'isbn', n, n FROM t
    UNION ALL SELECT 'not_empty', '*', 0, n FROM t
    UNION ALL SELECT 'positive', 'margin', cheap, n FROM t
    UNION ALL SELECT 'between', 'p_size', sizes, n FROM t
    UNION ALL SELECT 'unique', 'p_partkey', n - keys, n FROM t
    UNION ALL SELECT 'unique', 'p_name', n - names, n FROM t
    UNION ALL SELECT 'at_most', '*', greatest(n - 20, 0), n FROM t
""")
def table_quality(spark, folder):
    part = table(spark, folder, "part").withColumn("margin", F.col("p_retailprice") - 950)
    checks = [
        not_empty(),
        is_positive("margin"),
        is_between("p_size", 1, 5),
        is_unique("p_partkey"),
        is_unique("p_name"),
        at_most(20),
    ]
    return quality_report(part, checks, required=["p_name", "isbn"])


def _status_sql(bronze):
    return f"""
    WITH lines AS (SELECT count(*) AS n FROM ({_LINES_SQL})),
         dump AS (SELECT count(*) AS n FROM orders),
         web AS (SELECT title, ANY_VALUE(rating) AS rating FROM ({_CARDS_SQL})
                 WHERE price_gbp > 0 GROUP BY title),
         latest AS (SELECT year FROM ({_DUMP_SQL}) WHERE year IS NOT NULL
                    QUALIFY row_number() OVER (
                        PARTITION BY isbn
                        ORDER BY title DESC, author DESC, year DESC, publisher DESC) = 1),
         api AS (SELECT subject FROM ({_SILVER_API_SQL}))
    SELECT 'bronze/web' AS step, '{bronze}' AS status, n AS rows_in, n AS rows_out FROM lines
    UNION ALL SELECT 'bronze/csv', '{bronze}', n, n FROM dump
    UNION ALL SELECT 'bronze/api', '{bronze}', n, n FROM lines
    UNION ALL SELECT 'silver/web', 'OK', n, (SELECT count(*) FROM web) FROM lines
    UNION ALL SELECT 'silver/csv', 'OK', n, (SELECT count(*) FROM latest) FROM dump
    UNION ALL SELECT 'silver/api', 'OK', n, (SELECT count(*) FROM api) FROM lines
    UNION ALL SELECT 'gold/top_rated_books', 'OK', count(*), least(count(*), 20) FROM web
    UNION ALL SELECT 'gold/books_by_year', 'OK', count(*), count(DISTINCT year) FROM latest
    UNION ALL SELECT 'gold/price_stats_by_rating', 'OK', count(*), count(DISTINCT rating) FROM web
    UNION ALL SELECT 'gold/top_subjects', 'OK', count(*), count(DISTINCT subject) FROM api
"""


def _raw_files(spark, folder, label):
    """Raw pages, dump and responses made of the test tables, and the folder they are in.

    A document's page and response lie in one row, so that the texts are dealt out and read once.
    """
    root = shared_folder(spark, label)
    documents, orders = documents_of(spark, folder), table(spark, folder, "orders")
    # A CSV file is one task to whoever reads it, so that a table in one file would be one task throughout.
    orders = orders.repartition(raw_partitions(spark))
    fetched = f"{root}/raw/fetched"
    inputs = Inputs(fetched, f"{root}/raw/csv", fetched)
    columns = [*_page_columns(), *_response_columns()]
    overwrite_table(documents.select(*columns), fetched)
    _write_csv(book_dump(orders).drop("o_orderdate"), inputs.landing_csv)
    return inputs, root


@query(_status_sql("OK"))
def medallion_status(spark, folder):
    """Everything at once: raw files to Bronze, Silver and Gold tables, with row counts."""
    inputs, root = _raw_files(spark, folder, "medallion")
    status = run_all(spark, inputs, Layers.under(root), BATCH_TS, parallel=True)
    return status.select("step", "status", "rows_in", "rows_out")


@query(_status_sql("KEPT"))
def resumed_status(spark, folder):
    """A run that ended after Bronze, and goes on."""
    inputs, root = _raw_files(spark, folder, "resumed")
    run_bronze(spark, inputs, Layers.under(root), BATCH_TS, parallel=True)
    status = run_all(spark, inputs, Layers.under(root), BATCH_TS, parallel=True, resume=True)
    return status.select("step", "status", "rows_in", "rows_out")


def _run_over(spark, folder, bronze_csv_format=None):
    """Layers that a whole run over the test tables has written."""
    inputs, root = _raw_files(spark, folder, "written")
    run_all(spark, inputs, Layers.under(root), BATCH_TS, formats={"csv": bronze_csv_format})
    return Layers.under(root)


_WRITTEN_CSV_SQL = f"""
    SELECT * FROM ({_DUMP_SQL}) WHERE year IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY isbn ORDER BY title DESC, author DESC, year DESC, publisher DESC) = 1
"""


@query(f"""
    SELECT title, price_gbp, rating, availability FROM ({_SILVER_WEB_SQL})
    ORDER BY rating DESC, price_gbp, title, availability LIMIT 20
""")
def written_top_rated(spark, folder):
    """The Gold table of best books, as a run leaves it."""
    layers = _run_over(spark, folder)
    return spark.read.parquet(layers.gold_path("top_rated_books"))


@query(f"""
    SELECT year, count(*) AS nombre_livres, count(DISTINCT author) AS nombre_auteurs,
           count(DISTINCT publisher) AS nombre_editeurs
    FROM ({_WRITTEN_CSV_SQL}) GROUP BY year
""")
def written_books_by_year(spark, folder):
    """The Gold table of years, from Parquet Bronze."""
    layers = _run_over(spark, folder, bronze_csv_format="parquet")
    return spark.read.parquet(layers.gold_path("books_by_year"))


@query(f"""
    SELECT rating, count(*) AS nombre_livres, round(min(price_gbp), 2) AS prix_min,
           round(max(price_gbp), 2) AS prix_max,
           round(avg(CAST(price_gbp AS DOUBLE)), 2) AS prix_moyen
    FROM ({_SILVER_WEB_SQL}) GROUP BY rating
""")
def written_price_stats(spark, folder):
    """The Gold table of prices, as a run leaves it."""
    return spark.read.parquet(_run_over(spark, folder).gold_path("price_stats_by_rating"))


@query(f"""
    SELECT subject, count(*) AS nombre_livres, round(avg(edition_count), 2) AS editions_moyennes,
           min(first_publish_year) AS plus_ancien, max(first_publish_year) AS plus_recent
    FROM ({_SILVER_API_SQL}) GROUP BY subject
""")
def written_top_subjects(spark, folder):
    """The Gold table of subjects, as a run leaves it."""
    return spark.read.parquet(_run_over(spark, folder).gold_path("top_subjects"))


@query(_SILVER_API_SQL)
def written_silver_works(spark, folder):
    """The Silver table of works, authors included, as a run leaves it."""
    return _stamped(read_silver(spark, _run_over(spark, folder), "api"))


@query(f"""
    SELECT isbn, trim(title) AS title, trim(author) AS author, year, publisher,
           strftime(o_orderdate, '%Y%m%d_%H%M%S') AS extracted_at
    FROM ({_DUMP_SQL}) WHERE year BETWEEN 1800 AND 2024
    QUALIFY row_number() OVER (
        PARTITION BY isbn
        ORDER BY o_orderdate DESC, title DESC, author DESC, year DESC, publisher DESC) = 1
""")
def silver_merged(spark, folder):
    """Silver after three batches, each merged into the buckets of the one before."""
    layers = Layers.under(shared_folder(spark, "merged"))
    dump = bronze_csv(table(spark, folder, "orders"))
    for number in range(3):
        rows = dump.filter(F.pmod(F.xxhash64("Book-Title"), F.lit(3)) == number)
        batch_ts = BATCH_TS.replace(day=number + 1)
        write_batch(rows, layers, "csv", batch_ts, "parquet")
        run_silver(spark, layers, ["csv"], batch_ts, buckets=8, formats={"csv": "parquet"})
    silver = read_silver(spark, layers, "csv")
    return silver.select(
        "isbn", "title", "author", "year", "publisher", batch_stamp("extracted_at").alias("extracted_at")
    )


@query("""
    SELECT p_partkey, p_name, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 1
""")
def first_part(spark, folder):
    """The first row of an order."""
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return top_k(part, [F.col("p_size").desc(), F.col("p_partkey").asc()], 1)
