"""URL rules found by expressions: host suffixes times path prefixes, looked up by short hashes.

A rule names a host and the beginning of a path. A URL is expanded into every expression that a rule
for it could have, and these are joined with the rules on the first bytes of a digest. A match is
confirmed on the whole digest; of several rules the longest decides.
"""

from pyspark.sql import functions as F

from .words import lower_ascii, with_results

_SHORT = 8  # hexadecimal digits of the joined prefix: four bytes


def split_url(url):
    """Host and path columns of a URL; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (
        lower_ascii(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def _digests(host, path, lengths):
    """Digest and text of each expression of a host and a path."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n)
    )
    return F.flatten(
        F.transform(
            suffixes, lambda s: F.transform(prefixes, lambda p: F.sha2(F.concat(s, p), 256))
        )
    )


def compile_rules(rules, rule="rule", verdict="verdict"):
    """Digests of the rules. Rules that are null, or whose verdict is neither, are left out.

    The host, up to the first slash, is lower-cased in A-Z. Equal rules count once; if they differ
    in verdict, block wins.
    """
    text = F.col(rule)
    host = lower_ascii(F.regexp_extract(text, "^([^/]*)", 1))
    path = F.regexp_extract(text, "^[^/]*(.*)$", 1)
    return (
        rules.filter(text.isNotNull() & F.col(verdict).isin("allow", "block"))
        .select(text.alias("rule"), F.col(verdict).alias("rule_verdict"), host.alias("h"), path.alias("p"))
        .groupBy(F.concat("h", "p").alias("own"), F.length("h").alias("host_length"), F.length("p").alias("path_length"))
        .agg(F.min("rule").alias("rule"), F.max("rule_verdict").alias("rule_verdict"))
        .select(
            "rule",
            "rule_verdict",
            "host_length",
            "path_length",
            F.length("own").alias("rule_length"),
            F.sha2("own", 256).alias("rule_digest"),
        )
        .withColumn("rule_short", F.substring("rule_digest", 1, _SHORT))
    )


def judge_urls(pages, rules, url="url", rule="rule", verdict="verdict", default="allow"):
    """`pages` with `host`, `path`, `rule` and `verdict` of each URL.

    A rule fits its host and all subdomains if the path begins with the rule's. The longest rule, in
    characters of host and path, wins; of equal ones that with the longer host. Without a rule,
    `rule` is null and `verdict` is `default`; so it is for all pages if there are no rules. A null or empty URL has an empty host and path, so
    that no rule fits. Every row is kept, equal ones too; columns with the four names are replaced.

    Only distinct host and path pairs are expanded, and only the lengths of paths that occur in
    rules are tried. These lengths, a set no larger than the longest path of a rule, pass through
    the driver. Rules are joined; Spark broadcasts them if they are small.
    """
    compiled = compile_rules(rules, rule, verdict)
    found = compiled.agg(F.sort_array(F.collect_set("path_length"))).first()[0]
    lengths = F.array(*map(F.lit, found)).cast("array<int>")
    host, path = split_url(F.col(url))
    return with_results(
        pages,
        {"host": host, "path": path},
        ["host", "path", "rule", "verdict"],
        lambda held: _judged(held, compiled, lengths, default),
    )


def _judged(parsed, compiled, lengths, default):
    """Rows (row, host, path) with the rule and verdict of each."""
    keys = parsed.select(F.col("host").alias("_host"), F.col("path").alias("_path")).distinct()
    expressions = keys.withColumn(
        "_digest", F.explode(_digests(F.col("_host"), F.col("_path"), lengths))
    )
    order = F.struct("rule_length", "host_length", F.col("rule_verdict") == "block")
    verdicts = (
        expressions.withColumn("_short", F.substring("_digest", 1, _SHORT))
        .join(compiled, F.col("_short") == F.col("rule_short"))
        .filter(F.col("_digest") == F.col("rule_digest"))
        .groupBy("_host", "_path")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), order).alias("_best"))
    )
    same = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return (
        parsed.join(verdicts, same, "left")
        .withColumns(
            {
                "rule": F.col("_best")["rule"],
                "verdict": F.coalesce(F.col("_best")["rule_verdict"], F.lit(default)),
            }
        )
        .drop("_host", "_path", "_best")
    )
