"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import written

#: Hexadecimal digits of a digest on which expressions and rules meet first.
PREFIX_DIGITS = 8
PARTS = r"://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty for null and for urls without ``://``."""
    host = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def rule_table(spark: SparkSession, rules: dict[str, str]) -> DataFrame:
    """``(rule, verdict)`` from ``{"example.com/de/": "block"}``: a host, then the start of a path."""
    return spark.createDataFrame(list(rules.items()), "rule string, verdict string")


def _keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules under the digest of their host and their path up to its last slash."""
    host = F.translate(F.substring_index("rule", "/", 1), ascii_uppercase, ascii_lowercase)
    path = F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)")
    key = F.regexp_extract(path, r"^(?s)(.*/)?", 1)
    return (
        rules.where("rule IS NOT NULL AND verdict IS NOT NULL")
        .select("rule", "verdict", host.alias("rule_host"), path.alias("rule_path"), key.alias("key"))
        .withColumn("rule_digest", F.sha2(F.concat("rule_host", "key"), 256))
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )


def _expressions(labels: int, slashes: int) -> Column:
    """Every suffix of up to ``labels`` labels of the host with every prefix of the path.

    Prefixes are the empty one and those up to a slash, the first ``slashes`` of them: no rule has
    more, so long hosts and paths give no more expressions than short ones.
    """
    suffixes = F.expr(
        f"transform(sequence(1, least(size(split(host, '[.]')), {labels})), "
        "n -> substring_index(host, '.', -n))"
    )
    prefixes = F.expr(
        f"transform(sequence(0, least(length(path) - length(replace(path, '/', '')), {slashes})), "
        "n -> if(n = 0, '', substring_index(path, '/', n) || '/'))"
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url"
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row.

    A rule fits its host and every subdomain if the path starts with the rule's path. The longest
    rule wins, and of one rule with both verdicts ``block``. Without a rule, ``rule`` is null and the
    verdict is ``default``. Null urls have no host and so no rule; null rules and verdicts fit
    nothing. Rows that share an id are judged by themselves; other columns are left out.

    What a url is judged by is its host and path alone, so each such pair is expanded once, however
    many rows have it. Pairs meet rules on the first digits of a digest; the whole digest and the
    start of the path are confirmed in the same join.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = _keyed_rules(rules)
    most = keyed.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.size(F.split("key", "/")) - 1), F.lit(0)).alias("slashes"),
    ).first()
    expanded = rows.select("host", "path").distinct().select(
        "host", "path", F.explode(_expressions(most["labels"], most["slashes"])).alias("expression")
    )
    expanded = expanded.withColumn("digest", F.sha2("expression", 256)).drop("expression")
    expanded = expanded.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    rank = F.struct(F.length("rule"), F.col("verdict") == "block", F.col("rule"), F.col("verdict"))
    found = (
        expanded.join(keyed, "prefix").where(fits).groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found"))
    )
    found = written(found, "url-rules")
    return rows.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict")
    )
