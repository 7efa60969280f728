"""Verdicts on URLs from a table of (host, path prefix) rules.

Every URL is expanded into host-suffix and path-prefix expressions. Expressions meet
rules by an equi-join on the first bytes of their digests; the full digest confirms, and
the most specific rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import is_small

PREFIX_HEX = 8  # 4 bytes of the digest
BROADCAST_RULES = 20_000


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty where there is no ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per input row.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the path
    starts with the rule's path; the longest rule (host, then path) wins, and of rules that
    are the same in both, block wins. A URL no rule fits gets `default` and a null rule; so
    does a null URL or one without ://, whose host and path are empty. Rules with a null host
    or verdict are ignored, a null path counts as empty. Rows that repeat are judged one by
    one, other columns are ignored, an empty table gives no rows.
    """
    rules = rules.filter(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        F.col("host").alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    # the distinct lengths of rule paths: a few dozen numbers, however many rules there are
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    rows = pages.select(
        F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    where = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths] or [F.lit(0)]), lambda n: n <= F.length("path")),
        lambda n: F.struct(n.alias("n"), F.substring(F.col("path"), F.lit(1), n).alias("start")),
    )
    expressions = (
        where.select("host", "path", F.explode(suffixes).alias("suffix"))
        .filter("suffix <> ''")
        .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
        .withColumn("digest", _digest(F.concat("suffix", F.lit("\n"), "prefix.start")))
        .select("host", "path", "digest", F.substring("digest", 1, PREFIX_HEX).alias("short"))
    )
    table = rules.withColumn("rule_digest", _digest(F.concat("rule_host", F.lit("\n"), "rule_path")))
    table = table.withColumn("short", F.substring("rule_digest", 1, PREFIX_HEX))
    if is_small(table, BROADCAST_RULES):
        table = F.broadcast(table)
    best = (
        expressions.join(table, "short")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule_host"),
                    F.length("rule_path"),
                    (F.col("rule_verdict") == "block").alias("blocks"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    "rule_verdict",
                )
            ).alias("best")
        )
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
