"""URL filters: captures judged by the list entries in force when they were fetched.

Dated list entries become validity intervals; every capture meets, by equality of host
suffix and time bucket, the intervals that hold its fetch time. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import table

#: Days in a time bucket: intervals are repeated for each bucket they touch.
BUCKET_DAYS = 32


def url_host(url):
    """Lower-case host of a URL column without user, port and final dot; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def host_suffixes(host):
    """A host and its parent domains, longest first: a.b.c -> [a.b.c, b.c, c]."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + F.lit(1)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, action, valid_from, valid_to) of (list_name, pattern, action, listed_on).

    An entry holds from its date until its list's next entry of the same pattern (to:
    exclusive, null: open). Action ``remove`` only ends what came before. Of entries of one
    list, pattern and date the greatest action in text order counts; equal successors merge.
    Entries with a null column are left out.
    """
    keys = Window.partitionBy("list_name", "pattern").orderBy("listed_on")
    one = entries.select("list_name", F.lower("pattern").alias("pattern"), "action", F.col("listed_on").cast("date").alias("listed_on")).dropna()
    one = one.groupBy("list_name", "pattern", "listed_on").agg(F.max("action").alias("action"))
    changed = one.withColumn("before", F.lag("action").over(keys)).where(F.col("before").isNull() | (F.col("before") != F.col("action")))
    return (
        changed.withColumn("valid_to", F.lead("listed_on").over(keys))
        .where("action <> 'remove'")
        .select("list_name", "pattern", "action", F.col("listed_on").alias("valid_from"), "valid_to")
    )


def temporal_list_join(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """(id, host, fetched_on, verdict, list_name, pattern, valid_from): one row a capture.

    The most specific pattern in force decides (the host itself before its parent domains);
    of several lists' entries for that pattern ``allow`` wins, then the list's name, then the
    earlier start. No entry in force, no host, or no fetch time: verdict ``none``. Null ids
    and repeated rows pass through as rows of their own.
    """
    c = captures.select(F.col(id_col).alias("capture"), url_host(F.col(url_col)).alias("host"), F.col(time_col).cast("date").alias("fetched_on"))
    span = c.agg(F.min("fetched_on").alias("first"), F.max("fetched_on").alias("last"))
    bucket = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / BUCKET_DAYS)
    held = (
        validity_intervals(entries)
        .join(F.broadcast(span), (F.col("valid_from") <= F.col("last")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("first"))))
        .select(
            "list_name", "pattern", "action", "valid_from", "valid_to",
            F.explode(F.sequence(bucket(F.greatest("valid_from", "first")), bucket(F.least(F.coalesce("valid_to", "last"), "last")))).alias("bucket"),
        )
    )
    # A host's captures of one day share their verdict: each such pair is judged once. Of a host's
    # suffixes only listed ones meet the intervals, so no top-level domain gathers all its hosts.
    days = c.select("host", "fetched_on").dropna().distinct()
    listed = entries.select(F.lower("pattern").alias("pattern")).distinct()
    suffixes = days.select("host").distinct().select("host", F.posexplode(host_suffixes(F.col("host"))).alias("steps", "pattern"))
    asked = days.join(suffixes.join(listed, "pattern", "left_semi"), "host").select(
        "host", "fetched_on", bucket(F.col("fetched_on")).alias("bucket"), "steps", "pattern"
    )
    hits = asked.join(held, ["pattern", "bucket"]).where("valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)")
    best = hits.groupBy("host", "fetched_on").agg(
        F.min(F.struct("steps", (F.col("action") != "allow").alias("not_allow"), "list_name", "valid_from", "pattern", "action")).alias("b")
    )
    # Captures without a host or time meet none: they are spread by their id.
    best = best.withColumnRenamed("host", "key")
    key = F.when(F.col("fetched_on").isNotNull(), F.col("host"))
    c = c.withColumn("key", F.coalesce(key, F.concat(F.lit(" "), F.xxhash64("capture"))))
    return c.join(best, ["key", "fetched_on"], "left").select(
        F.col("capture").alias(id_col),
        "host",
        "fetched_on",
        F.coalesce("b.action", F.lit("none")).alias("verdict"),
        "b.list_name",
        "b.pattern",
        "b.valid_from",
    )


def dated_captures(pages: DataFrame) -> DataFrame:
    """``pages`` with a fetch date by a rule on page_id: a day of 2024."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int")).alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries by a rule on the pages' hosts, so that the lists grow with the pages.

    Of the digest-like number k = (length of host * 31 + smallest page_id) each host gets:
    blocked from day k % 300, removed 40 days later if k % 3 = 0, listed again 90 days later if
    k % 6 = 0; allowed by a second list from day k % 200 if k % 5 = 0. Three domains hold all year.
    """
    host = pages.select(url_host(F.col("url")).alias("pattern"), "page_id").where("pattern IS NOT NULL AND page_id IS NOT NULL")
    host = host.groupBy("pattern").agg((F.length("pattern") * 31 + F.min("page_id")).alias("k"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    k = F.col("k")
    entry = lambda name, action, on, when: F.when(when, F.struct(F.lit(name).alias("list_name"), F.lit(action).alias("action"), day(on).alias("listed_on")))
    made = F.array(
        entry("spam", "block", k % 300, F.lit(True)),
        entry("spam", "remove", k % 300 + 40, k % 3 == 0),
        entry("spam", "block", k % 300 + 90, k % 6 == 0),
        entry("trusted", "allow", k % 200, k % 5 == 0),
    )
    own = host.select("pattern", F.explode(F.filter(made, lambda e: e.isNotNull())).alias("e")).select("e.list_name", "pattern", "e.action", "e.listed_on")
    spark = pages.sparkSession
    wide = spark.createDataFrame(
        [("adult", "example.net", "block", "2024-03-01"), ("adult", "example.net", "remove", "2024-09-01"), ("trusted", "example.org", "allow", "2024-02-01")],
        "list_name string, pattern string, action string, listed_on string",
    ).withColumn("listed_on", F.to_date("listed_on"))
    return own.unionByName(wide)


def op4_temporal_url_lists(spark, sf_dir: str) -> DataFrame:
    """Every page's verdict under the list entries in force on its fetch day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return temporal_list_join(dated_captures(pages), dated_entries(pages), "page_id", "url", "fetched_on")


OP4_SQL = r"""
WITH hosted AS (
  SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '') AS host,
         CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS DATE) AS fetched_on
  FROM pages
), k AS (
  SELECT host AS pattern, length(host) * 31 + min(page_id) AS k FROM hosted WHERE host IS NOT NULL AND page_id IS NOT NULL GROUP BY host
), entries AS (
  SELECT 'spam' AS list_name, pattern, 'block' AS action, CAST(DATE '2024-01-01' + CAST(k % 300 AS INTEGER) AS DATE) AS listed_on FROM k
  UNION ALL SELECT 'spam', pattern, 'remove', CAST(DATE '2024-01-01' + CAST(k % 300 + 40 AS INTEGER) AS DATE) FROM k WHERE k % 3 = 0
  UNION ALL SELECT 'spam', pattern, 'block', CAST(DATE '2024-01-01' + CAST(k % 300 + 90 AS INTEGER) AS DATE) FROM k WHERE k % 6 = 0
  UNION ALL SELECT 'trusted', pattern, 'allow', CAST(DATE '2024-01-01' + CAST(k % 200 AS INTEGER) AS DATE) FROM k WHERE k % 5 = 0
  UNION ALL VALUES ('adult', 'example.net', 'block', DATE '2024-03-01'), ('adult', 'example.net', 'remove', DATE '2024-09-01'), ('trusted', 'example.org', 'allow', DATE '2024-02-01')
), held AS (
  SELECT list_name, pattern, action, listed_on AS valid_from, lead(listed_on) OVER (PARTITION BY list_name, pattern ORDER BY listed_on) AS valid_to
  FROM entries
), hits AS (
  SELECT h.page_id, h.host, h.fetched_on, e.action, e.list_name, e.pattern, e.valid_from,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(e.pattern) DESC, e.action <> 'allow', e.list_name, e.valid_from) AS r
  FROM hosted h JOIN held e ON (h.host = e.pattern OR ends_with(h.host, '.' || e.pattern)) AND e.action <> 'remove'
    AND e.valid_from <= h.fetched_on AND (e.valid_to IS NULL OR h.fetched_on < e.valid_to)
)
SELECT h.page_id, h.host, h.fetched_on, coalesce(b.action, 'none') AS verdict, b.list_name, b.pattern, b.valid_from
FROM hosted h LEFT JOIN hits b ON b.page_id = h.page_id AND b.r = 1
"""
