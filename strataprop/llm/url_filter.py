"""Rules for hosts and paths, matched to urls by a sorted sweep over reversed-host keys.

A host is written backwards, label by label (``www.example.net`` as ``net.example.www.``), so a host
and all its subdomains are one interval of keys, and so are all paths with one beginning. Such
intervals are nested or apart. Sorting rules and urls together and walking along, the rules that hold
at a url are the last rule opened or rules around it: so each rule carries the stack of rules around it,
and a url takes the stack of the last rule before it and drops what has ended.

The walk is one window function per cell of a range-partitioned table. A cell begins with the last
rule of the cells before it, so cells are swept side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import shuffle_partitions, stage
from strataprop.operators.joins import equi_join

#: Accepted verdicts, the stronger first: it wins when one host and path has both.
BLOCK, ALLOW = "block", "allow"


def url_host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    capitals = "".join(map(chr, range(65, 91)))
    return F.coalesce(F.translate(host, capitals, capitals.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _host_rules(rules: DataFrame) -> DataFrame:
    """One row per host with rules: its key, and the keys of hosts with rules around it, outer first."""
    hosts = rules.select("host_key").distinct()
    label = F.split("host_key", r"\.", -1)
    outer = F.transform(F.sequence(F.lit(1), F.size(label) - 1),
                        lambda k: F.concat(F.array_join(F.slice(label, 1, k), "."), F.lit(".")))
    around = hosts.select("host_key", F.explode(outer).alias("outer")).join(
        hosts.select(F.col("host_key").alias("outer")), "outer")
    return around.groupBy(F.col("host_key").alias("key")).agg(
        F.sort_array(F.collect_set("outer")).alias("stack"))


def _path_key(host_key: str, path: str) -> Column:
    """No host has a slash, so the keys of one host stand together, apart from its subdomains'."""
    return F.concat(host_key, F.lit("/"), path)


def _path_rules(rules: DataFrame) -> DataFrame:
    """One row per rule: its key, and the rules of the same host whose path it begins with, itself too."""
    size = F.length("path")
    lengths = rules.groupBy("host_key").agg(F.collect_set(size).alias("lengths"))
    shorter = rules.join(lengths, "host_key").select(
        "host_key", "path", F.explode(F.filter("lengths", lambda n: n <= size)).alias("n"))
    around = shorter.select("host_key", "path", F.substring("path", F.lit(1), F.col("n")).alias("outer")).join(
        rules.select("host_key", F.col("path").alias("outer"), "rule", "verdict"), ["host_key", "outer"])
    key = _path_key("host_key", "path").alias("key")
    one = F.struct(_path_key("host_key", "outer").alias("prefix"), "rule", "verdict")
    return around.groupBy(key).agg(F.sort_array(F.collect_set(one)).alias("stack"))


def sweep(rules: DataFrame, points: DataFrame) -> DataFrame:
    """``key`` of every point with the ``stack`` of the last rule at or before it.

    ``rules`` has distinct ``key`` and ``stack``; ``points`` has distinct ``key``. Points before the
    first rule get a null stack.
    """
    kind = rules.schema["stack"].dataType
    events = rules.select("key", F.lit(0).alias("turn"), "stack").unionByName(
        points.select("key", F.lit(1).alias("turn"), F.lit(None).cast(kind).alias("stack")))
    cells = stage(events.repartitionByRange(shuffle_partitions(events.sparkSession), "key", "turn")
                  .withColumn("cell", F.spark_partition_id()))
    # one row per cell: cells are as many as shuffle partitions, whatever the input
    last = cells.groupBy("cell").agg(F.max_by("stack", F.when(F.col("turn") == 0, F.col("key"))).alias("last"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("cell", F.last("last", ignorenulls=True).over(before).alias("carried"))
    along = Window.partitionBy("cell").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = cells.join(carried, "cell").withColumn(
        "stack", F.coalesce(F.last("stack", ignorenulls=True).over(along), "carried"))
    return swept.filter("turn = 1").select("key", "stack")


def filter_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW,
) -> DataFrame:
    """Host, path, deciding rule and verdict of every url.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``block`` or ``allow``). A rule fits its host and all
    subdomains if the url's path starts with the rule's; the longest rule wins, host and path together, of
    equally long ones that with the longest host. Of two rules for one host and path, block wins. Rules with
    a host that is null, empty or has one of ``/?#``, or another verdict, fit nothing; a null path is empty. A url that is null
    or has no ``://`` has an empty host and path, and no rule. Without a rule the verdict is
    ``default`` and ``rule`` is null. Every row is returned once, repeated ones too; an empty table
    gives no rows; other columns are not carried.
    """
    path = F.coalesce("path", F.lit(""))
    rules = stage(
        rules.filter(F.col("verdict").isin(BLOCK, ALLOW) & F.col("host").rlike("^[^/?#]+$")).groupBy(
            F.lower("host").alias("host"), path.alias("path")).agg(F.max("verdict").alias("verdict"))
        .select(reversed_host(F.col("host")).alias("host_key"), "path",
                F.concat("host", "path").alias("rule"), "verdict"))
    parts = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    split = stage(parts.withColumn("host_key", reversed_host(F.col("host"))))

    hosts = split.filter("host <> ''").select(F.col("host_key").alias("key")).distinct()
    of_host = sweep(_host_rules(rules), hosts).select(
        F.col("key").alias("host_key"),
        F.explode(F.filter("stack", lambda outer: F.col("key").startswith(outer))).alias("outer"))
    seen = stage(split.select("host_key", "path").distinct())
    ruled = stage(equi_join(seen, of_host, "host_key", "inner").withColumn("key", _path_key("outer", "path")))
    of_path = sweep(_path_rules(rules), ruled.select("key").distinct())
    held = of_path.select("key", F.filter(
        "stack", lambda rule: F.col("key").startswith(rule["prefix"])).alias("active")).filter("size(active) > 0")
    # the longest path of a host ends its stack
    last = F.element_at("active", -1)
    won = equi_join(ruled, held, "key", "inner").groupBy("host_key", "path").agg(
        F.max_by(last, F.struct(F.length(last["rule"]), F.length("outer"))).alias("won"))
    joined = equi_join(split, won, ["host_key", "path"], "left", spread_by=[key])
    return joined.select(
        key, "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
