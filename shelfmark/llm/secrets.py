"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a long run with a digit, or the value of 6 characters or more given to a word like
`password`, with or without blanks between; it ends at a blank, quote, comma or semicolon. Its features
are length, transitions between kinds of characters, how much of it common words cover, whether it
stands in a path, and the words around it. The forest is trained with Spark ML on labelled findings
and then compiled to one expression, so that texts are scanned by built-in functions alone.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from .words import bound, with_results, words_of

MARK = "[SECRET]"
TREES = 20
DEPTH = 6
SEED = 7
#: At most so many labelled findings are fitted, those with the smallest hash of their text.
MAX_FINDINGS = 100_000

# Looked for where a run begins only, so that a very long one without a digit is read once.
_RUN = r"(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*+[0-9])[A-Za-z0-9_+/\-]{12,}+={0,2}"
_NAMED = r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api_?key)[\"']?[:=][\"']?([^\s\"',;]{6,})"
# A value in the word after its name: the ends of the words before it, and the value.
_NAME_ENDS = r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api_?key)[\"'`]?"
_SIGN = r"[:=]=?>?"
_VALUE = rf"^(?:{_SIGN})?[\"'`(\[]*([^\s\"'`,;]{{6,}})"
_LEAST_NAMED = 10  # characters of the shortest word that holds a name, a sign and a value
# Words that name a secret, and words that name a harmless number or digest.
_SECRET_WORDS = "password passwd pwd secret token apikey api_key key auth bearer credential access"
_HARMLESS_WORDS = "commit sha1 sha256 md5 checksum digest hash rev id isbn order card phone version uuid"
_COMMON_WORDS = (
    "about after also back been data date demo down each example file find first from good have "
    "here home image info into item just kind know last like line list long make more most name "
    "need next note only open over page part path read release report sample section size some "
    "start status style table test than that them then there they this time type user value "
    "version very view want week well were what when will with word work year your"
)


def _either(words):
    return "(?i)(?:" + "|".join(words.split()) + ")"


def _without(value, pattern):
    return F.regexp_replace(value, pattern, "")


def _share(part, whole):
    return part / F.greatest(whole, F.lit(1))


def _transitions(value):
    """Places where the kind of character changes: lower, upper, digit or other."""
    kinds = F.regexp_replace(value, "[a-z]+", "a")
    kinds = F.regexp_replace(F.regexp_replace(kinds, "[A-Z]+", "B"), "[0-9]+", "1")
    return F.length(F.regexp_replace(kinds, "[^aB1]+", "-")) - 1


def features(value, before, after):
    """Named features of a candidate, of the text before it and of the word after it."""
    size = F.length(value)
    letters, digits = F.length(_without(value, "[^A-Za-z]+")), F.length(_without(value, "[^0-9]+"))
    common = size - F.length(_without(value, _either(_COMMON_WORDS)))
    return {
        "size": size,
        "transitions": _transitions(value),
        "transition_rate": _share(_transitions(value), size),
        "letters": _share(letters, size),
        "digits": _share(digits, size),
        "upper": _share(F.length(_without(value, "[^A-Z]+")), size),
        "hexadecimal": value.rlike("^[0-9a-fA-F]+$").cast("int"),
        "number": value.rlike(r"^[0-9\-]+$").cast("int"),
        "uuid": value.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-").cast("int"),
        "known_start": value.rlike("^(?:AKIA|ASIA|gh[pousr]_|xox[abp]-|eyJ|sk[-_]|AIza)").cast("int"),
        "dictionary": _share(common, size),
        "consonants": F.length(F.regexp_extract(value, "([b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{4,})", 1)),
        "path": F.concat(before, value).rlike(r"(?:[:./\\][^\s/\\]*/|/[^\s/]+/|\.[a-z]{2,4}$)").cast("int"),
        "secret_word": before.rlike(_either(_SECRET_WORDS)).cast("int"),
        "harmless_word": before.rlike(_either(_HARMLESS_WORDS)).cast("int"),
        "assigned": before.rlike(r"[:=]\s*[\"'`]?$").cast("int"),
        "quoted": (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("int"),
    }


_NAMES = (
    "size transitions transition_rate letters digits upper hexadecimal number uuid known_start "
    "dictionary consonants path secret_word harmless_word assigned quoted"
).split()


def example_findings(spark, rows=8000):
    """Labelled findings (value, before, after, label) made by rule, for lack of a labelled table.

    Half are secrets in the forms that tools give them, half are harmless runs of the same shapes:
    digests, identifiers, card and order numbers, paths, UUIDs, encoded data, and words, placeholders and
    calls after a name like `password`.
    """
    n = F.col("id")
    hex_ = F.sha2(F.concat(F.lit("finding"), n.cast("string")), 256)
    mixed = F.translate(F.base64(F.unhex(hex_)), "+/=", "xyz")
    upper = F.upper(F.translate(mixed, "abcdefghijklmnopqrstuvwxyz", "QWERTYUIOPASDFGHJKLZXCVBNM"))
    number = F.lpad(F.abs(F.xxhash64(n)).cast("string"), 19, "4")
    word = F.element_at(F.split(F.lit(_COMMON_WORDS), " "), (F.abs(F.hash(n)) % 80 + 1).cast("int"))
    other = F.element_at(F.split(F.lit(_COMMON_WORDS), " "), (F.abs(F.hash(n, n)) % 80 + 1).cast("int"))
    plain = F.concat(other, F.lit(" "), word, F.lit(" "))
    text = F.concat
    lit = F.lit
    size = (n % 5 * 6 + 16).cast("int")
    secrets = [
        (F.substring(hex_, 1, 40), text(plain, lit('token = "')), lit('" ')),
        (hex_.substr(lit(1), size), text(plain, lit("password=")), lit(" ")),
        (text(lit("AKIA"), F.substring(upper, 1, 16)), plain, word),
        (F.substring(mixed, 1, 40), text(plain, lit("aws_secret_access_key: ")), word),
        (text(lit("ghp_"), F.substring(mixed, 1, 36)), plain, word),
        (mixed.substr(lit(1), size), text(plain, lit("api_key='")), lit("' ")),
        (text(lit("eyJ"), mixed), text(plain, lit("Bearer ")), word),
        (text(lit("sk-"), F.substring(mixed, 1, 32)), text(plain, lit('secret: "')), lit('"')),
        (text(word, lit("-"), other, lit("!")), text(plain, lit("password = ")), word),
        (text(word, (n % 89).cast("string"), lit("!")), text(plain, lit('"password": "')), lit('" ')),
        (F.substring(mixed, 1, 8), text(plain, lit("pwd:")), word),
        (text(F.substring(word, 1, 3), (n % 899 + 100).cast("string")), text(plain, lit("pwd=")), word),
    ]
    harmless = [
        (F.substring(hex_, 1, 40), text(plain, lit("commit ")), word),
        (F.substring(number, 1, 16), plain, word),
        (F.substring(number, 1, 13), text(plain, lit("order id ")), word),
        (text(word, lit("_"), other, lit("_"), (n % 9999).cast("string"), lit("_test")), plain, word),
        (hex_, text(plain, lit("sha256: ")), word),
        (
            F.regexp_replace(hex_, "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5"),
            plain,
            word,
        ),
        (text(lit("/"), word, lit("/"), other, lit("/file"), (n % 999).cast("string")), text(plain, lit("https:/")), word),
        (text(F.initcap(word), F.initcap(other), lit("Number"), (n % 99).cast("string")), plain, word),
        (text(word, other), text(plain, lit("password: ")), word),
        (text(lit("<"), word, lit(">")), text(plain, lit("token = ")), word),
        (text(lit("get_"), word, lit("()")), text(plain, lit("secret = ")), word),
        (text(lit("config."), word), text(plain, lit("api_key: ")), word),
    ]
    kinds = F.array(
        *[
            F.struct(v.alias("value"), b.alias("before"), a.alias("after"), F.lit(label).alias("label"))
            for label, group in ((1, secrets), (0, harmless))
            for v, b, a in group
        ]
    )
    made = spark.range(rows).select(F.element_at(kinds, (n % 24 + 1).cast("int")).alias("f"), "id")
    return made.select("f.*")


def train(findings, max_findings=MAX_FINDINGS):
    """The forest as an expression of a struct of features, from labelled findings.

    Fitted on at most `max_findings` rows, a bound on the sample that is documented, not on the
    texts that are scanned. Rows with a null value or label are left out.
    """
    rows = findings.filter(F.col("value").isNotNull() & F.col("label").isNotNull())
    blank = F.lit("")
    rows = rows.select(
        F.col("label").cast("double").alias("label"),
        F.xxhash64("value", "before", "after").alias("order"),
        *[
            f.cast("double").alias(name)
            for name, f in features(
                F.col("value"), F.coalesce("before", blank), F.coalesce("after", blank)
            ).items()
        ],
    )
    rows = rows.orderBy("order", *_NAMES, "label").limit(max_findings)
    vectors = VectorAssembler(inputCols=_NAMES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    ).fit(vectors)
    trees = [_as_tuples(tree._call_java("rootNode")) for tree in forest.trees]

    def score(own):
        return sum((_as_column(tree, own) for tree in trees), F.lit(0.0)) / len(trees)

    return score


def _as_tuples(node):
    """A tree of (feature, threshold, left, right), or the share of label 1 in a leaf."""
    if node.subtreeDepth() == 0:
        counts = list(node.impurityStats().stats())
        return counts[1] / sum(counts)
    split = node.split()
    return (
        _NAMES[split.featureIndex()],
        split.threshold(),
        _as_tuples(node.leftChild()),
        _as_tuples(node.rightChild()),
    )


def _as_column(tree, own):
    if isinstance(tree, float):
        return F.lit(tree)
    name, threshold, left, right = tree
    return F.when(own[name] <= threshold, _as_column(left, own)).otherwise(_as_column(right, own))


def _candidates(text):
    """Distinct (value, before, after) of the candidates in the words of a text, in order."""

    none = F.array().cast("array<string>")

    def given(words, i):
        """Whether the words before, or the sign it begins with, make a word a value."""
        name, sign = F.lit(_NAME_ENDS + "$"), F.lit(f"^{_SIGN}$")
        one, two = F.get(words, i - 1), F.get(words, i - 2)
        return F.coalesce(F.rlike(one, F.lit(_NAME_ENDS + _SIGN + "$")), F.lit(False)) | F.coalesce(
            F.rlike(one, name) & F.rlike(F.get(words, i), F.lit("^[:=]"))
            | F.rlike(one, sign) & F.rlike(two, name),
            F.lit(False),
        )

    def values(words, i):
        word = F.get(words, i)
        own = F.when(
            F.length(word) >= _LEAST_NAMED,
            F.array_union(
                F.regexp_extract_all(word, F.lit(_RUN), 0), F.regexp_extract_all(word, F.lit(_NAMED), 1)
            ),
        ).otherwise(none)
        next_ = F.when(given(words, i), F.regexp_extract_all(word, F.lit(_VALUE), 1)).otherwise(none)
        return F.array_union(own, next_)

    def of_words(words):
        places = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))),
            lambda i: (F.length(F.get(words, i)) >= 6) & (F.size(values(words, i)) > 0),
        )

        def near(i):
            word = words[i]
            blank = F.lit("")
            lead = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), blank)
            return F.transform(
                values(words, i),
                lambda value: F.struct(
                    value.alias("value"),
                    F.concat(lead, F.call_function("substring_index", word, value, F.lit(1))).alias("before"),
                    F.concat(
                        F.substring(word, F.instr(word, value) + F.length(value), F.length(word)),
                        F.lit(" "),
                        F.coalesce(F.get(words, i + 1), blank),
                    ).alias("after"),
                ),
            )

        return F.flatten(F.transform(places, near))

    return F.array_distinct(bound(words_of(text), of_words))


def scan(docs, score, text="text", threshold=0.5):
    """`docs` with `findings` (value, score), `secrets` (distinct values) and `redacted`.

    `findings` are all distinct candidates, `secrets` those whose score reaches `threshold`, and
    `redacted` is the text in which each secret, wherever it stands, is replaced by `[SECRET]`. A
    null or empty text has no findings and is returned as it is. Every row is kept, equal ones too, and
    an empty table stays empty; columns with the three names are replaced. Texts are scanned whole. Of
    secrets of one length the larger is replaced first. One projection: nothing is shuffled, whatever is frequent.
    """
    return with_results(
        docs,
        {"text": F.col(text)},
        ["findings", "secrets", "redacted"],
        lambda held: _scanned(held, score, threshold),
    )


def _scanned(docs, score, threshold):
    """Rows (row, text) with what was found in them."""
    blank = F.lit("")
    docs = docs.withColumn("_candidates", _candidates("text"))
    found = F.transform(
        "_candidates",
        lambda c: F.struct(
            c["value"].alias("value"),
            F.struct(
                *[
                    f.cast("double").alias(name)
                    for name, f in features(
                        c["value"], F.coalesce(c["before"], blank), F.coalesce(c["after"], blank)
                    ).items()
                ]
            ).alias("own"),
        ),
    )
    docs = docs.withColumn("_found", found)
    judged = F.transform(
        "_found",
        lambda c: F.struct(c["value"].alias("value"), F.round(score(c["own"]), 6).alias("score")),
    )
    docs = docs.withColumn("findings", judged)
    bad = F.filter("findings", lambda c: c["score"] >= threshold)
    docs = docs.withColumn("secrets", F.array_distinct(F.transform(bad, lambda c: c["value"])))
    # Longer values first, so that a value within another one does not spoil it.
    longest = F.reverse(
        F.sort_array(F.transform("secrets", lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))))
    )
    clean = F.aggregate(
        longest, F.col("text"), lambda left, c: F.replace(left, c["v"], F.lit(MARK))
    )
    return docs.withColumn("redacted", clean)


def redact(docs, score, text="text", threshold=0.5):
    """`docs` with the secrets of `text` replaced; the other columns and all rows as given."""
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    clean = scan(held, score, "text", threshold)
    return clean.select(F.col("row").withField(text, F.col("redacted")).alias("row")).select("row.*")
