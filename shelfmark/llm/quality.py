"""Quality rules: a table of thresholds compiled into one Spark projection.

A rule bounds the ratio of two counts of a text. All counts and rules are built-in expressions; no
user function runs. Ratios are compared in whole numbers, so that no rounding decides.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from .words import BLANKS, bound, with_results, words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for with be this are on as at by "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le la les de et un une du que qui dans est pour par sur "
    "el los y en una del las por con no se su para es"
).split()


@dataclass(frozen=True)
class Rule:
    """`at_least` <= 100 * top / bottom <= `at_most`; a ratio of nothing passes."""

    name: str
    top: str
    bottom: str
    at_least: int | None = None
    at_most: int | None = None

    def broken(self):
        top, bottom = 100 * F.col(self.top), F.col(self.bottom)
        wrong = F.lit(False)
        if self.at_least is not None:
            wrong = wrong | (top < self.at_least * bottom)
        if self.at_most is not None:
            wrong = wrong | (top > self.at_most * bottom)
        return wrong


COUNTS = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words"
).split()
BASE = (
    Rule("few_words", "n_words", "one", at_least=5000),
    Rule("repeated_words", "n_repeat_words", "n_words", at_most=50),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", at_least=300, at_most=1000),
    Rule("symbols", "n_symbols", "n_words", at_most=10),
    Rule("stop_words", "n_stop_words", "n_words", at_least=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=50),
)


def _without(text, characters):
    return F.translate(text, characters, "")


def _windows(make):
    """`make(i)` for each window of three words; none in shorter texts."""
    size = F.size("_words")
    return F.when(
        size >= 3, F.transform(F.sequence(F.lit(0), size - 3), lambda i: make(i))
    )


def _word(i):
    return F.col("_words")[i]


def _repeated_positions(ordered):
    """Starts, in order, of windows that have an equal neighbour in sorted order."""
    twice = F.filter(
        ordered,
        lambda x, k: F.coalesce(x["gram"] == F.get(ordered, k - 1)["gram"], F.lit(False))
        | F.coalesce(x["gram"] == F.get(ordered, k + 1)["gram"], F.lit(False)),
    )
    return F.sort_array(F.transform(twice, lambda x: x["at"]))


def _covered(starts):
    """Words under at least one of the windows of three that begin at `starts`."""
    own = F.transform(
        starts, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - x, F.lit(3)))
    )
    return F.aggregate(own, F.lit(0), lambda total, x: total + x)


def measure(docs, text="text"):
    """`docs` with the counts that rules use, as long columns.

    `n_words`, `word_chars` (code points in words), `n_symbols`, `n_lines` (lines with a word),
    `n_dup_lines` (those equal to an earlier line), `n_repeat_words` (words in windows of three
    words found twice or more, the first included), `n_stop_words`, and `one`. A null text counts
    as empty: all counts are 0. Every row is kept, equal ones too, and texts are counted whole. Columns
    with these names are replaced.
    """
    return with_results(docs, {"text": F.col(text)}, [*COUNTS, "one"], _counted)


def _counted(docs):
    """Rows (row, text) with the counts of each text."""
    text = "text"
    plain = F.coalesce(F.col(text), F.lit(""))
    spelled = {form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())}
    docs = docs.withColumns({"_words": words_of(text), "_solid": _without(plain, BLANKS)})
    docs = docs.withColumns(
        {
            "_lines": F.filter(
                F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""
            ),
            "_grams": _windows(lambda i: F.xxhash64(_word(i), _word(i + 1), _word(i + 2))),
        }
    )
    # Equal windows have equal hashes; only texts with equal hashes are sorted by their windows.
    may_repeat = F.size("_grams") > F.size(F.array_distinct("_grams"))
    pairs = _windows(
        lambda i: F.struct(
            F.concat_ws(" ", _word(i), _word(i + 1), _word(i + 2)).alias("gram"), i.alias("at")
        )
    )
    repeats = bound(
        F.sort_array(pairs), lambda ordered: bound(_repeated_positions(ordered), _covered)
    )
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length("_solid"),
        "n_symbols": F.length("_solid") - F.length(_without(F.col("_solid"), SYMBOLS)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(may_repeat, repeats).otherwise(0),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(*sorted(spelled)))),
        "one": F.lit(1),
    }
    return docs.withColumns({name: n.cast("bigint") for name, n in counts.items()})


def judge(docs, text="text", base=BASE, rules=RULES):
    """`measure(docs)` with `base_failed`, `broken` (names of broken rules) and `kept`.

    A document is kept if it breaks no rule. A null or empty text breaks the base rules. Equal rows
    are judged alike and none is dropped. To filter by the verdict use `keep_good`, which counts once.
    """
    docs = measure(docs, text)
    failed = F.lit(False)
    for rule in base:
        failed = failed | rule.broken()
    broken = F.array_compact(
        F.array(*[F.when(rule.broken(), F.lit(rule.name)) for rule in (*base, *rules)])
    )
    docs = docs.withColumns({"base_failed": failed, "broken": broken})
    return docs.withColumn("kept", F.size("broken") == 0)


def keep_good(docs, text="text", base=BASE, rules=RULES):
    """The rows of `docs` that break no rule, with their own columns."""
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    judged = judge(held, "text", base, rules).select("row", "kept", _apart().alias("_apart"))
    return judged.filter(F.col("kept") & (F.col("_apart") >= 0)).select("row.*")


def _apart():
    """A column that a filter cannot be pushed below.

    Spark would move the filter to the scan by writing out what `kept` is made of, and split the
    text anew for every word.
    """
    return F.monotonically_increasing_id()
