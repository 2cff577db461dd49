"""URL filter by host-suffix and path-prefix expressions, in DataFrame operations only.

Every URL is expanded into the expressions a rule could be written as: each
suffix of its host at a dot, and each prefix of its path that ends in a slash.
Rules are keyed by host and by their path up to its last slash. Both sides are
hashed; the equi-join is on a short prefix of that hash, and a candidate is
confirmed by the full digest and by the rest of the rule's path.

Expressions with more host labels or slashes than any rule has cannot match,
so they are not made; this bounds the expansion of very long URLs exactly.
Work is done once per distinct (host, path), and only those are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_HEX = 8  # a 32-bit prefix of the digest is the join key
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty if there is none."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def _host_suffixes(host: Column, most: Column) -> Column:
    """All suffixes of the host that start at a label, of at most `most` labels."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    least = F.greatest(n - most, F.lit(0))
    return F.transform(F.sequence(least, n - 1), lambda i: F.array_join(F.slice(labels, i + 1, n), "."))


def _path_prefixes(path: Column, most: Column) -> Column:
    """The empty prefix and all prefixes that end in a slash, of at most `most` slashes."""
    parts = F.split(path, "/", -1)
    last = F.least(F.size(parts) - 1, most)
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT_VERDICT
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    `rules` has host, path and verdict (allow or block); host and path as they
    are in a URL, e.g. `example.net` and `/en/`. A rule fits its host and all
    subdomains if the path starts with the rule's; the longest (host + path)
    wins, and of equal rules the blocking one. Null and malformed URLs have
    empty host and path and get `default`, as do URLs no rule fits (`rule`
    null). Repeated rows and null ids stay as they are; rules with a null part
    count as empty there; no rules or no pages give defaults or no rows.
    """
    judged = pages.select(
        F.col(id_col).alias(id_col), F.coalesce(url_host(F.col(url_col)), F.lit("")).alias("host"),
        F.coalesce(url_path(F.col(url_col)), F.lit("")).alias("path"),
    )
    book = rules.select(
        F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).withColumn("rule_base", F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0)).withColumn(
        "digest", _digest(F.col("rule_host"), F.col("rule_base"))
    ).withColumn("key", F.substring("digest", 1, PREFIX_HEX))
    labels = book.agg(F.coalesce(F.max(F.size(F.split("rule_host", r"\.", -1))), F.lit(0))).scalar()
    slashes = book.agg(F.coalesce(F.max(F.size(F.split("rule_base", "/", -1)) - 1), F.lit(0))).scalar()
    places = judged.where("host <> ''").select("host", "path").distinct()
    places = places.withColumns({"labels": labels, "slashes": slashes})
    suffixes = _host_suffixes(F.col("host"), F.col("labels"))
    expanded = (
        places.select("host", "path", "slashes", F.explode(suffixes).alias("suffix"))
        .withColumn("prefix", F.explode(_path_prefixes(F.col("path"), F.col("slashes"))))
        .withColumn("url_digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("key", F.substring("url_digest", 1, PREFIX_HEX))
    )
    fits = expanded.join(book, "key").where(
        (F.col("url_digest") == F.col("digest")) & F.expr("startswith(path, rule_path)")
    )
    order = F.struct(
        F.char_length("rule_host") + F.char_length("rule_path"),  # longest
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"),
    )
    # Written first, so that the join back can split the rows of a very common URL.
    best = staged(fits.groupBy("host", "path").agg(F.max(order).alias("best")), "url-verdicts").hint("merge")
    return judged.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
