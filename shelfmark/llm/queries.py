"""The operators over the whole test tables, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from . import line_quality, toxicity
from .bpe import encode_summary
from .decontaminate import mark
from .html_text import extract_text
from .near_dup import near_duplicates
from .periodic import find_runs, greatest_run, plant_runs
from .quality import STOP_WORDS, judge
from .resample import ranked, weigh
from .secrets import example_findings, scan, train
from .sharding import assign_shards
from .token_count import count_tokens
from .url_rules import judge_urls

QUERIES = {}
ORACLE = {}

SHARD_BYTES = 1 << 20
URL_RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
TOKENIZER = "byte_bpe_50k.json"


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_bpe(spark, folder):
    """Ids of every document, and the text decoded from them, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_summary(docs, public_tokenizers.path(TOKENIZER)).drop("text")


@query
def op7_token_count(spark, folder):
    """Bytes and tokens of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(TOKENIZER)).drop("text")


_SPELLED = ", ".join(
    f"'{form}'" for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())
)
ORACLE["op6_quality"] = f"""
    WITH base AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents),
    windows AS (
        SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
    twice AS (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
        FROM windows
        JOIN (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1)
            USING (doc_id, gram)),
    repeats AS (SELECT doc_id, count(DISTINCT place) AS n FROM twice GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    counts AS (
        SELECT doc_id, len(w) AS n_words,
               length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_lines - n_distinct, 0) AS n_dup_lines,
               coalesce(n_lines, 0) AS n_lines,
               coalesce(repeats.n, 0) AS n_repeat_words,
               len(list_filter(w, lambda x: x IN ({_SPELLED}))) AS n_stop_words
        FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 100 * word_chars BETWEEN 300 * n_words AND 1000 * n_words
               AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop_words >= 2 * n_words
               AND 100 * n_dup_lines <= 50 * n_lines AS kept
    FROM judged
"""


@query
def op6_quality(spark, folder):
    """Counts and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
ORACLE["op2_url_filter"] = f"""
    WITH rests AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0
               THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    urls AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    rules AS (
        SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host,
               substr(rule, instr(rule, '/')) AS rule_path
        FROM (VALUES {_RULE_ROWS}) AS t(rule, verdict)),
    fitting AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule,
               arg_max(verdict, length(rule)) AS verdict
        FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
            AND starts_with(path, rule_path)
        GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM urls LEFT JOIN fitting USING (page_id)
"""


@query
def op2_url_filter(spark, folder):
    """Host, path, deciding rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


@query
def op5_sharding(spark, folder):
    """Shard of every document, for shards of at most 1 MiB of text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return assign_shards(docs, ["doc_id"], SHARD_BYTES).drop("text")


@query
def op3_near_duplicates(spark, folder):
    """Group of every document by near-equal texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).drop("text")


@query
def op9_decontamination(spark, folder):
    """Benchmark items in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return mark(docs, table(spark, folder, "benchmark")).drop("text")


@query
def op10_secret_scan(spark, folder):
    """Candidates, secrets and the redacted text of every document, the text as a digest."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs, train(example_findings(spark))).select(
        "doc_id",
        F.size("findings").cast("bigint").alias("n_candidates"),
        F.size("secrets").cast("bigint").alias("n_secrets"),
        "secrets",
        F.sha2("redacted", 256).alias("redacted_sha256"),
    )


@query
def op4_toxicity(spark, folder):
    """Score of every document, from labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trained = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, trained).drop("text")
    return scored.withColumn("held_out", toxicity.held_out())


@query
def op8_html_text(spark, folder):
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_text(pages).drop("html")


# CRC-32 of a word by its bytes; the table of its 256 remainders is built by rule.
_CRC_SQL = """
    remainders AS (
        SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i:
            CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS t
        FROM (SELECT unnest(range(256)) AS b)),
    crcs AS (
        SELECT word, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(1, strlen(word) + 1), lambda i:
                CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT))),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM words), remainders)
"""
_WORDS_11 = """
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
"""
ORACLE["op11_resampling"] = f"""
    WITH docs AS (SELECT *, row_number() OVER () AS row FROM documents),
    words AS (
        SELECT row, {_WORDS_11} FROM docs
        UNION ALL SELECT NULL, {_WORDS_11} FROM benchmark),
    {_CRC_SQL},
    counts AS (SELECT row, bucket, count(*) AS n FROM words JOIN crcs USING (word) GROUP BY ALL),
    totals AS (
        SELECT bucket, CAST(coalesce(sum(n) FILTER (WHERE row IS NOT NULL), 0) AS DOUBLE) AS s,
               CAST(coalesce(sum(n) FILTER (WHERE row IS NULL), 0) AS DOUBLE) AS t
        FROM counts GROUP BY bucket),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)
                   / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
        FROM totals),
    weights AS (
        SELECT row, CAST(sum(n) AS BIGINT) AS n_features,
               CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
        FROM counts JOIN gains USING (bucket) WHERE row IS NOT NULL GROUP BY row),
    scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(
                   sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT)
                   AS score
        FROM docs LEFT JOIN weights USING (row)),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id) AS place,
               count(*) FILTER (WHERE n_features >= 20) OVER () AS fit
        FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank
    FROM placed
"""


@query
def op11_resampling(spark, folder):
    """Weight, score and place of every document among those drawn towards the benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weighed = weigh(docs, table(spark, folder, "benchmark")).drop("text")
    return ranked(weighed).drop("n_words")


@query
def op12_line_quality(spark, folder):
    """Score of every document by its lines, from labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = line_quality.train(docs, table(spark, folder, "labels"))
    scored = line_quality.score(docs, field).drop("text")
    return scored.withColumn("held_out", line_quality.held_out())


@query
def op13_periodic_runs(spark, folder):
    """Runs of every document, some of which end in a planted one, and the text without them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_runs(plant_runs(docs)).withColumn("best", greatest_run("runs"))
    row = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(row, lambda text: F.concat(text, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
