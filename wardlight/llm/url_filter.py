"""URL rules by a sorted sweep over reversed-host keys.

A rule is a host and a path prefix and fits the host and all its subdomains. With
the labels of a host reversed, "this host and below" is a prefix, and so is a
path; a prefix is an interval of the sorted keys, and such intervals are nested
or apart. The sweep sorts rule starts and URL keys together and gives each URL
the stack of rules open at the last start before it; those that are prefixes of
the key are the ones that fit. One sweep runs over hosts, a second over the paths
of each fitting host. All steps are built-in functions.

Keys are dealt into ranges by key and a row hash, so a host or URL that holds a
third of the rows is spread over many ranges; each range gets the stack that is
open at its beginning.

Defined cases: a NULL url, or one without "://", has empty host and path; of the
fitting rules the longest host plus path wins, then the longer host; a rule given
both ways blocks; repeated rows stay; an empty rule table leaves the default.
Only page_id and url are read, so other columns cannot clash; a url of any length is one
row's work; an empty ``pages`` gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of (verdict, host, path)."""
    if not rules:
        return spark.range(0).selectExpr("'' AS verdict", "'' AS host", "'' AS path")
    entries = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), r)])
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def stacks(keys: DataFrame, prefixes: Column) -> DataFrame:
    """For each key, the keys of the table that are its prefixes, shortest first."""
    each = keys.select("key", F.explode(prefixes).alias("prefix"))
    return (
        each.join(keys.select(F.col("key").alias("prefix")), "prefix")
        .groupBy("key").agg(F.sort_array(F.collect_set("prefix")).alias("stack"))
    )


def sweep(points: DataFrame, starts: DataFrame, ranges: int) -> DataFrame:
    """Add ``open`` to points (key, salt, row): the start keys that are prefixes of key."""
    events = points.select(
        "key", F.lit(1).alias("kind"), "salt", "row", F.lit(None).cast("array<string>").alias("stack")
    ).unionByName(starts.select(
        "key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"),
        F.lit(None).cast(points.schema["row"].dataType).alias("row"), "stack",
    ))
    dealt = stored(
        events.repartitionByRange(ranges, "key", "kind", "salt")
        .withColumn("range", F.spark_partition_id()),
        "url-ranges",
    )
    # The stack open at the end of each range; one row per range.
    ends = dealt.where("kind = 0").groupBy("range").agg(F.max_by("stack", "key").alias("stack"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        dealt.select("range").distinct().join(ends, "range", "left")
        .select("range", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    )
    inside = W.partitionBy("range").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    return (
        dealt.withColumn("last", F.last("stack", ignorenulls=True).over(inside))
        .where("kind = 1").join(carried, "range", "left")
        .withColumn("open", F.coalesce("last", "carried", F.array().cast("array<string>")))
        .withColumn("open", F.filter("open", lambda s: F.startswith(F.col("key"), s)))
        .select("row", "open")
    )


def match_rules(
    pages: DataFrame, rules: DataFrame, ranges: int | None = None, default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``."""
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = stored(
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
        .select("block", "host", "path", host_key(F.col("host")).alias("host_key")),
        "url-rules",
    )
    hosts = rules.select(F.col("host_key").alias("key")).distinct()
    labels = F.split("key", r"\.", -1)
    host_stacks = stacks(hosts, F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
    ))
    host, path = host_and_path(F.col("url"))
    # Equal rows are judged once and counted.
    rows = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("n"))
    urls = rows.select("page_id", "url", "n", host.alias("host"), path.alias("path"))
    salt = F.xxhash64("page_id", "url")
    by_host = sweep(
        urls.select(host_key(F.col("host")).alias("key"), salt.alias("salt"),
                    F.struct("*").alias("row")),
        host_stacks, ranges,
    )
    # A path key begins with its rule host's key; U+0000 ends it.
    zero = F.lit("\0")
    rule_key = F.concat("host_key", zero, "path")
    path_keys = rules.select(rule_key.alias("key"))
    first = F.locate("\0", F.col("key"))
    path_stacks = stacks(path_keys, F.transform(
        F.sequence(first, F.char_length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n)
    ))
    by_path = sweep(
        by_host.select("row", F.explode_outer("open").alias("rule_host")).select(
            F.concat(F.coalesce("rule_host", F.lit("")), zero, "row.path").alias("key"),
            F.xxhash64("row.page_id", "row.url").alias("salt"), "row",
        ),
        path_stacks, ranges,
    )
    # The longest prefix of each fitting host, then the longest rule of the row.
    fitting = by_path.withColumn("key", F.try_element_at("open", F.lit(-1)))
    known = rules.select(rule_key.alias("key"), "block", F.concat("host", "path").alias("rule"),
                         F.char_length("host").alias("host_length"))
    order = F.struct(F.char_length("rule").alias("length"), "host_length", "rule", "block")
    best = (
        fitting.join(known, "key", "left").groupBy("row")
        .agg(F.max(F.when(F.col("rule").isNotNull(), order)).alias("best"))
    )
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best.block"), "block")
    return best.select(
        "row.page_id", "row.host", "row.path", F.col("best.rule").alias("rule"),
        verdict.otherwise("allow").alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("row.n"))).alias("copy"),
    ).drop("copy")
