"""Silver -> Gold: small summary tables. Output names are the tables' public contract."""

from pyspark.sql import functions as F

from ..operators.groups import count_by, number_stats, size_ranking, top_k
from ..operators.quality import at_most, is_unique
from ..operators.rows import require
from ..operators.sketches import estimates, sketch_by, union_sketches


TOP_RATED = 20


def gold_top_rated(silver, k=TOP_RATED):
    """Best-rated books, cheapest first; remaining ties by title and availability."""
    df = require(silver.select("title", "price_gbp", "rating", "availability"), ["rating"])
    order = [F.col("rating").desc(), F.col("price_gbp").asc(), "title", "availability"]
    return top_k(df, order, k)


_PER_YEAR = {"nombre_auteurs": "author", "nombre_editeurs": "publisher"}


def gold_by_year(silver, exact=True):
    """Books per year; `exact=False` estimates authors and publishers by sketches."""
    return count_by(require(silver, ["year"]), "year", "nombre_livres", _PER_YEAR, exact)


def year_sketches(silver, part):
    """What the table of years is made of, for each value of `part`."""
    return sketch_by(require(silver, ["year"]), [part, "year"], "nombre_livres", _PER_YEAR)


def gold_by_year_of(sketches):
    """The table of years, authors and publishers estimated, from the sketches of all parts."""
    whole = union_sketches(sketches, ["year"], "nombre_livres", _PER_YEAR)
    return estimates(whole, _PER_YEAR).orderBy(F.col("year").asc())


def gold_price_stats(silver):
    return number_stats(
        silver,
        "rating",
        "price_gbp",
        rows="nombre_livres",
        low="prix_min",
        high="prix_max",
        mean="prix_moyen",
    )


def gold_top_subjects(silver):
    """Works per subject. A work counts for the one subject it is kept under."""
    return size_ranking(
        silver,
        "subject",
        rows="nombre_livres",
        mean_of="edition_count",
        mean="editions_moyennes",
        span_of="first_publish_year",
        first="plus_ancien",
        last="plus_recent",
    )


# Gold table -> (Silver source, job).
GOLD_JOBS = {
    "top_rated_books": ("web", gold_top_rated),
    "books_by_year": ("csv", gold_by_year),
    "price_stats_by_rating": ("web", gold_price_stats),
    "top_subjects": ("api", gold_top_subjects),
}

GOLD_CHECKS = {
    "top_rated_books": [at_most(TOP_RATED)],
    "books_by_year": [is_unique("year")],
    "price_stats_by_rating": [is_unique("rating")],
    "top_subjects": [is_unique("subject")],
}
