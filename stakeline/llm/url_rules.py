"""URL filters by a sort-merge range join, in DataFrame functions only.

A rule (host, path) fits its host and all subdomains, if the url's path starts with the rule's.
With its labels reversed a host is a key whose subdomains are the keys it is a prefix of, so a
rule's host is an interval of keys, and intervals either nest or lie apart. Urls and the ends of
intervals are sorted together; going along, the rules whose interval is open form a stack. Two
such sweeps are made: one over hosts, which finds the hosts with rules that hold for a url, and
one over those hosts and paths, which finds the rules themselves.

The sort is cut into slices of about equal size, also inside a hot host; a slice starts from the
stack that the slices before it leave, of which there is one per slice.

Of the rules that fit, the longest (host and path) wins, of equally long ones that with the longer
host, and of equal rules a blocking one. Null urls and such without ``://`` have empty host and
path and no rule; what no rule fits gets the default verdict. Repeated rows are judged like any
others. Rules with a null host or path are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeline.llm.common import CHUNK, slices
from stakeline.sources.sinks import stage_table

ALLOW, BLOCK = "allow", "block"

# The rules of the registered query as (verdict, host, path).
RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]

_PARTS = r"://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The greatest character: a key and this one stand behind all keys with that prefix.
_END = "\U0010ffff"
_STACK = "array<struct<key:string,rule:string,verdict:string>>"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def host_key(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``."""
    return F.concat(F.array_join(F.reverse(F.split(_plain(host), r"\.")), "."), F.lit("."))


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit(_END), F.lit("�"))


def _host_prefixes(key: Column) -> Column:
    """The keys of a host and all hosts above it."""
    labels = F.split(key, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
    )


def _path_prefixes(key: Column) -> Column:
    """All beginnings of a host and path that have the whole host."""
    slash = F.instr(key, "/")
    return F.transform(
        F.sequence(slash, F.length(key)), lambda n: F.substring(key, F.lit(1), n)
    )


def _sweep(
    points: DataFrame, prefixes: DataFrame, beginnings: Callable[[Column], Column], name: str
) -> DataFrame:
    """Adds ``stack`` to points with a ``key``: the prefixes (key, rule, verdict) it begins with.

    ``beginnings`` gives the beginnings of a prefix that may be prefixes too.
    """
    above = prefixes.select(F.struct("key", "rule", "verdict").alias("entry"))
    chains = (
        prefixes.select(
            F.col("key").alias("own"), F.explode(beginnings(F.col("key"))).alias("up")
        )
        .join(above, F.col("up") == F.col("entry.key"))
        .groupBy("own")
        .agg(F.collect_set("entry").alias("stack"))
    )
    rest = [c for c in points.columns if c != "key"]
    nothing = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest]
    opened = chains.select(F.col("own").alias("key"), F.lit(0).alias("is_url"), "stack", *nothing)
    closed = chains.select(
        F.concat("own", F.lit(_END)).alias("key"),
        F.lit(0).alias("is_url"),
        F.filter("stack", lambda e: e["key"] != F.col("own")).alias("stack"),
        *nothing,
    )
    unknown = F.lit(None).cast(_STACK).alias("stack")
    urls = points.select("key", F.lit(1).alias("is_url"), unknown, *rest)
    events = opened.unionByName(closed).unionByName(urls)
    order = ["key", "is_url", "url_row"]
    sliced = events.repartitionByRange(slices(points.sparkSession), *order)
    stored = stage_table(sliced.withColumn(CHUNK, F.spark_partition_id()), name)

    boundary = F.when(F.col("is_url") == 0, F.col("key"))
    ends = stored.groupBy(CHUNK).agg(F.max_by("stack", boundary).alias("stack"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    left = ends.select(CHUNK, F.last("stack", ignorenulls=True).over(before).alias("left"))
    along = Window.partitionBy(CHUNK).orderBy(*order)
    along = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        stored.withColumn("open", F.last("stack", ignorenulls=True).over(along))
        .where("is_url = 1")
        .join(F.broadcast(left), CHUNK)
        .withColumn("stack", F.coalesce("open", "left", F.array().cast(_STACK)))
        .select("key", *rest, "stack")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per page: id, host, path, rule (host and path, or null), verdict.

    ``rules`` has the columns verdict, host and path. Other columns of ``pages`` are not read.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        host_key(F.translate("host", _UPPER, _LOWER)).alias("host_key"),
        _plain(F.col("path")).alias("path"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    # Of equal rules the greater verdict, which is the blocking one.
    rules = rules.groupBy("host_key", "path").agg(
        F.max("rule").alias("rule"), F.max("verdict").alias("verdict")
    )
    none = F.lit(None).cast("string")
    hosts = rules.select(F.col("host_key").alias("key")).distinct()
    hosts = hosts.withColumns({"rule": none, "verdict": none})
    # Hosts have no slash, so the first one parts host and path.
    paths = rules.select(F.concat_ws("/", "host_key", "path").alias("key"), "rule", "verdict")

    urls = pages.select(
        F.monotonically_increasing_id().alias("url_row"),
        F.col(page_id).alias("id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    held = _sweep(
        urls.withColumn("key", host_key(F.col("host"))), hosts, _host_prefixes, "url_hosts"
    )
    # A row per host with rules that the url lies under; urls without any keep one.
    per_host = held.withColumn("under", F.explode_outer("stack.key")).withColumn(
        "key", F.concat(F.coalesce("under", F.lit("")), F.lit("/"), _plain(F.col("path")))
    )
    fits = _sweep(per_host.drop("stack"), paths, _path_prefixes, "url_paths")
    longest = F.array_max(
        F.transform(
            "stack",
            lambda e: F.struct(
                F.length(e["rule"]).alias("length"),
                F.length(F.col("under")).alias("host_length"),
                e["rule"].alias("rule"),
                e["verdict"].alias("verdict"),
            ),
        )
    )
    return (
        fits.withColumn("best", longest)
        .groupBy("url_row", "id", "host", "path")
        .agg(F.max("best").alias("best"))
        .select(
            F.col("id").alias(page_id),
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
