"""URL rules matched by hashed host-suffix and path-prefix expressions.

A rule names a host and the beginning of a path. It fits a URL whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path; of the fitting rules the longest decides.

Every distinct (host, path) is expanded into all its host suffixes combined with all its path prefixes
that end in ``/`` (and the empty one). Rules are keyed alike, by their host and their path up to its last
``/``. Both sides are joined on the first 32 bits of the key's SHA-256, then the full digest, the rest of the
rule's path and precedence are checked. Everything is built-in functions.

Defined results: a null URL, or one without ``://``, has an empty host and path; an empty path fits only
rules without a path. Equal URLs are judged once, so a URL or host with a third of all rows is reduced before it
is shuffled; the join that returns the verdicts may be split by adaptive execution. Rules with a null host are
ignored, a null path is empty, repeated rules count once, and of two equally long rules the one with the longer
host decides, then ``block``. Without a fitting rule the verdict is ``default``. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trailperks.llm.common import ascii_lower

PREFIX_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    scheme_end = F.instr(url, "://")
    rest = F.when(scheme_end > 0, F.substr(url, scheme_end + F.lit(3))).otherwise(F.lit(""))
    return (
        ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def up_to_last_slash(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def rule_keys(rules: DataFrame) -> DataFrame:
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    anchor = F.concat(host, F.lit("\n"), up_to_last_slash(path))
    return (
        rules.where(F.col("host").isNotNull())
        .select(
            F.sha2(anchor, 256).alias("rule_digest"),
            host.alias("rule_host"),
            path.alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .distinct()
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )


def expressions(sites: DataFrame, labels: int, depth: int) -> DataFrame:
    """(host, path, digest, prefix) of every suffix and prefix that a rule can have.

    ``labels`` and ``depth`` are the most labels and slashes in any rule, so longer expressions cannot match.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n),
    )
    slashes = F.length("path") - F.length(F.translate("path", "/", ""))
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(slashes, F.lit(depth))),
        lambda n: F.when(n == 0, F.lit("")).otherwise(
            F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), n), F.lit("/"))
        ),
    )
    return (
        sites.withColumn("suffix", F.explode(suffixes))
        .withColumn("beginning", F.explode(prefixes))
        .withColumn("digest", F.sha2(F.concat("suffix", F.lit("\n"), "beginning"), 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .select("host", "path", "digest", "prefix")
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` (all its columns in a struct ``row``) with host, path, rule and verdict."""
    host, path = host_and_path(F.col(url))
    located = urls.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    keys = rule_keys(rules)
    most = keys.agg(
        F.max(F.size(F.split("rule_host", r"\."))),
        F.max(F.length("rule_path") - F.length(F.translate("rule_path", "/", ""))),
    ).first()
    candidates = expressions(located.select("host", "path").distinct(), most[0] or 1, most[1] or 0)
    best = F.max(
        F.struct(
            F.length(F.concat("rule_host", "rule_path")).alias("length"),
            F.length("rule_host").alias("host_length"),
            (F.col("rule_verdict") == "block").alias("blocks"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("rule_verdict").alias("verdict"),
        )
    )
    verdicts = (
        candidates.join(keys, "prefix")
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path"))
        .groupBy("host", "path")
        .agg(best.alias("best"))
    )
    return located.join(verdicts, ["host", "path"], "left").select(
        "row",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
