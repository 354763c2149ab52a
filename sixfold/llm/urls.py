"""Dated URL lists: was a page's address listed when it was fetched?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
#: Path and query, where there is a query.
QUERY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*\?[^#]*)"
#: Seconds of one bucket of time; an interval is one row for each bucket that it touches.
BUCKET = 30 * 86400


def list_intervals(entries: DataFrame) -> DataFrame:
    """``key, action, since, until``: each entry holds from its date until the key's next entry (null: still).

    ``entries`` has ``key, since, action``. Rows with a null key or date are no entries; of several on one date the greatest action
    counts; an action ``remove`` ends the entry before it and is no interval itself.
    """
    one = entries.where("key IS NOT NULL AND since IS NOT NULL").groupBy("key", "since").agg(F.max("action").alias("action"))
    following = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    return one.withColumn("until", following).where("action <> 'remove'").select("key", "action", "since", "until")


def url_keys(url):
    """Keys under which an address can be listed, the most specific first: host with path and query, with the path, with each path above
    it down to its first part, then the host and its parent domains."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    path, query = F.regexp_extract(url, PATH, 1), F.regexp_extract(url, QUERY, 1)
    parts = F.split(path, "/", -1)  # the first one is empty
    prefixes = F.transform(F.sequence(F.size(parts), F.lit(2), F.lit(-1)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    paths = F.concat(F.when(query != "", F.array(query)).otherwise(F.array().cast("array<string>")), F.when(F.length(path) > 1, prefixes).otherwise(F.array().cast("array<string>")))
    return F.when(F.length(host) > 0, F.concat(F.transform(F.filter(paths, lambda p: F.length(p) > 1), lambda p: F.concat(host, p)), parents))


def listed_at_fetch(captures: DataFrame, entries: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """As-of join of every capture with the entries active when it was fetched.

    ``captures`` has ``url`` and ``fetched`` (timestamp) and the columns ``extra``. The most specific active key decides. Returns these
    columns (but for those named as the results), ``listed_key``, ``listed_since``, ``action`` (all null if none is active) and ``blocked``.

    Intervals and captures meet on (key, bucket of time), so one busy host is spread over time and its few intervals are the small
    side of a join that Spark can split. A null or malformed url and a null time match nothing; repeated rows stay repeated; without
    entries nothing is blocked.
    """
    results = ("listed_key", "listed_since", "action", "blocked")
    own = ["url", "fetched", *(c for c in extra or [] if c not in results)]
    seconds = F.unix_timestamp("fetched")
    spans = list_intervals(entries)
    newest = captures.agg(F.max(seconds)).first()[0] or 0
    since, until = F.unix_timestamp("since"), F.coalesce(F.unix_timestamp("until") - 1, F.lit(newest))
    spans = (
        spans.where((since <= newest) & (until >= since))
        .withColumn("bucket", F.explode(F.sequence(F.floor(since / BUCKET), F.floor(F.least(until, F.lit(newest)) / BUCKET))))
        .select("key", "bucket", "action", "since", "until")
    )
    # The capture's columns stand in one struct, so that none of them meets a name used here.
    whole = F.struct(*[F.col(f"`{c}`") for c in own]).alias("own")
    asked = captures.select(whole, "fetched", F.floor(seconds / BUCKET).alias("at"), F.posexplode_outer(url_keys(F.col("url"))).alias("rank", "key"))
    joined = asked.join(
        spans.withColumnRenamed("key", "k"),
        (F.col("key") == F.col("k")) & (F.col("at") == F.col("bucket")) & (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))),
        "left",
    )
    hit = F.when(F.col("action").isNotNull(), F.struct((-F.col("rank")).alias("order"), "key", "since", "action"))
    # A key has at most one interval at a time, so the first key's rows count the captures.
    best = joined.groupBy("own").agg(F.max(hit).alias("hit"), F.sum((F.coalesce("rank", F.lit(0)) == 0).cast("int")).alias("copies"))
    each = best.select("own", "hit", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(
        *[F.col(f"own.`{c}`") for c in own],
        F.col("hit.key").alias("listed_key"),
        F.col("hit.since").alias("listed_since"),
        F.col("hit.action").alias("action"),
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
    )


def _number(text, size: int):
    """A whole number below ``size`` made from the text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % size


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a time of fetching in 2024, made from the address."""
    day = _number(F.coalesce("url", F.lit("")), 366 * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + day).alias("fetched"))


def entries_of(captures: DataFrame) -> DataFrame:
    """A dated list made from the addresses: a third of all keys are listed, withdrawn and listed again, one in eight of them as allowed."""
    keys = captures.select(F.explode(url_keys(F.col("url"))).alias("key")).distinct().where(_number(F.col("key"), 3) == 0)
    start = _number(F.concat(F.lit("since "), "key"), 200 * 86400)
    listed = F.when(_number(F.concat(F.lit("kind "), "key"), 8) == 0, "allow").otherwise("block")
    steps = F.array(
        F.struct(start.alias("s"), listed.alias("action")),
        F.struct((start + 60 * 86400).alias("s"), F.lit("remove").alias("action")),
        F.struct((start + 120 * 86400).alias("s"), listed.alias("action")),
    )
    return keys.select("key", F.explode(steps).alias("step")).select("key", F.timestamp_seconds(F.lit(1704067200) + F.col("step.s")).alias("since"), "step.action")


def op10(spark, sf):
    captures = captures_of(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url"))
    found = listed_at_fetch(captures, entries_of(captures), ["page_id"])
    plain = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return found.select("page_id", "url", plain("fetched").alias("fetched"), "listed_key", plain("listed_since").alias("listed_since"), "action", "blocked")


OP10_SQL = r"""WITH c AS (
  SELECT row_number() OVER () AS rid, page_id, url, TIMESTAMP '2024-01-01' + to_seconds(('0x' || md5(coalesce(url, ''))[1:8])::BIGINT % 31622400) AS fetched,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*\?[^#]*)', 1) AS query FROM pages),
n AS (SELECT *, string_split(host, '.') AS labels, string_split(path, '/') AS parts FROM c WHERE host <> ''),
k AS (SELECT rid, fetched, unnest(list_concat(CASE WHEN query <> '' THEN [host || query] ELSE [] END,
        list_transform(list_filter(list_transform(range(2, len(parts) + 1), lambda i: array_to_string(parts[:i], '/')), lambda p: length(p) > 1), lambda p: host || p),
        list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.')))) AS key FROM n),
names AS (SELECT key, 'x' AS x FROM k GROUP BY key HAVING ('0x' || md5(key)[1:8])::BIGINT % 3 = 0),
e AS (SELECT key, unnest([0, 60, 120]) AS add, ('0x' || md5('since ' || key)[1:8])::BIGINT % 17280000 AS start,
        CASE WHEN ('0x' || md5('kind ' || key)[1:8])::BIGINT % 8 = 0 THEN 'allow' ELSE 'block' END AS kind FROM names),
dated AS (SELECT key, TIMESTAMP '2024-01-01' + to_seconds(start + add * 86400) AS since, CASE WHEN add = 60 THEN 'remove' ELSE kind END AS action FROM e),
spans AS (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM dated),
hit AS (SELECT rid, k.key, since, action, row_number() OVER (PARTITION BY rid ORDER BY length(k.key) DESC) AS r
        FROM k JOIN spans ON k.key = spans.key AND since <= fetched AND (until IS NULL OR fetched < until) AND action <> 'remove')
SELECT page_id, url, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS fetched, hit.key AS listed_key, strftime(since, '%Y-%m-%d %H:%M:%S') AS listed_since,
       action, coalesce(action = 'block', false) AS blocked
FROM c LEFT JOIN hit ON c.rid = hit.rid AND r = 1"""

QUERIES = {"op10_url_lists": (op10, OP10_SQL)}
