"""URL filters by a temporal join with dated lists.

List changes (an entry goes on or comes off on a day) become validity intervals; every capture is judged by the entries that
were on the list the day it was fetched. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoplake.llm.common import cut

#: How a URL is read.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def keys(url: Column) -> Column:
    """What list entries can match a URL, from most to least specific: host and path, from all segments to the first one, the host, and its parent domains.

    A parent domain has two labels at least. Paths keep their case. A URL that has no host matches nothing.
    """
    name = host(url)
    labels = F.split(name, r"\.")
    none = F.array().cast("array<string>")
    parents = F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = _segments(F.regexp_extract(url, PATH, 1))
    paths = F.transform(F.sequence(F.size(segments), F.lit(1)), lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    every = F.concat(
        F.when(F.size(segments) > 0, paths).otherwise(none),
        F.array(name),
        F.when(F.size(labels) > 2, parents).otherwise(none),
    )
    return F.when(name != "", every)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def named(entry: Column) -> Column:
    """An entry as keys are written: host in lower case, path segments as they are. A whole URL loses scheme, user, port, query and fragment."""
    url = F.when(entry.rlike(SCHEME), entry).otherwise(F.concat(F.lit("http://"), entry))
    name = host(url)
    segments = _segments(F.regexp_extract(url, PATH, 1))
    return F.when(name != "", F.array_join(F.concat(F.array(name), segments), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """entry, valid_from, valid_to (exclusive; NULL while it is still on): when each entry was on the list.

    ``entries``: entry, listed (TRUE: goes on, FALSE: comes off), changed_on. Changes of one entry on one day count as one, and
    going on wins; that leaves an entry at most a row per day to be put in order, however many changes were sent in.
    Going on twice keeps the first day. Rows with a NULL, and entries without a host, are not used.
    """
    rows = entries.select(named(F.col("entry")).alias("entry"), "listed", F.col("changed_on").cast("date").alias("changed_on")).dropna()
    daily = rows.groupBy("entry", "changed_on").agg(F.max("listed").alias("listed"))
    order = W.partitionBy("entry").orderBy("changed_on")
    changes = daily.withColumn("was", F.lag("listed").over(order)).filter("listed <> coalesce(was, FALSE)")
    return changes.withColumn("valid_to", F.lead("changed_on").over(order)).filter("listed").select("entry", F.col("changed_on").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched_on, blocked, and the most specific active entry with the day it went on, for every capture.

    ``captures``: page_id, url, fetched_on (date); other columns are not read. A NULL or unreadable url or a NULL date is not
    blocked. Repeated rows each come back. Empty captures give no rows; an empty list blocks nothing.

    Intervals are dealt into the months that captures have and matched on entry and month, so a capture meets only intervals near its
    day, and a stray date far off costs one month. The interval side is stored first: both sides of the join are plain shuffles, which
    adaptive execution splits at a host that holds very many captures. Two jobs run while the frame is built.
    """
    listed = intervals(entries)
    # Distinct months, of which the calendar has some 120,000 in all.
    fetched = captures.select(F.trunc(F.col("fetched_on").cast("date"), "month").cast("string").alias("m")).dropna().distinct()
    held = F.lit(sorted(r["m"] for r in fetched.collect())).cast("array<date>")
    inside = F.filter(held, lambda m: (m >= F.trunc("valid_from", "month")) & (F.col("valid_to").isNull() | (m < F.col("valid_to"))))
    active = cut(listed.select("entry", F.explode(inside).alias("month"), "valid_from", "valid_to"), "url-intervals")

    rows = captures.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("fetched_on").cast("date").alias("fetched_on"))
    probes = rows.distinct().select("page_id", "url", "fetched_on", F.trunc("fetched_on", "month").alias("month"), F.posexplode(keys(F.col("url"))).alias("rank", "entry"))
    met = probes.join(active, ["entry", "month"]).filter("fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)")
    hits = met.groupBy("page_id", "url", "fetched_on").agg(F.min(F.struct("rank", "entry", "valid_from")).alias("hit"))
    hits = hits.select(*(F.col(c).alias(f"_{c}") for c in ("page_id", "url", "fetched_on")), F.col("hit.entry").alias("entry"), F.col("hit.valid_from").alias("listed_on"))
    same = F.col("page_id").eqNullSafe(F.col("_page_id")) & F.col("url").eqNullSafe(F.col("_url")) & F.col("fetched_on").eqNullSafe(F.col("_fetched_on"))
    # Copies are rows of the capture side, which is split where they are very many.
    return rows.join(hits, same, "left").select("page_id", "url", "fetched_on", F.col("entry").isNotNull().alias("blocked"), "entry", "listed_on")


# --- the sample list ----------------------------------------------------------------------------------------------------
#: Pages carry no fetch day and no list, so both are derived from the whole table, in syntax that other SQL engines share.
FETCHED = "DATE '2024-01-01' + CAST(page_id * 7919 % 365 AS INT)"
CHANGED = "DATE '2023-11-01' + CAST(page_id * 4001 % 400 AS INT)"


def sample_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.expr(FETCHED).alias("fetched_on"))


def sample_entries(pages: DataFrame) -> DataFrame:
    """Changes of hosts, of hosts with a first path segment, and of parent domains, from every page of some numbers."""
    url = F.col("url")
    entry = (
        F.when(F.col("page_id") % 97 == 0, F.element_at(keys(url), -1))
        .when(F.col("page_id") % 5 == 0, F.when(host(url) != "", F.concat(host(url), F.regexp_extract(url, SEGMENT, 1))))
        .when(F.col("page_id") % 3 == 0, host(url))
    )
    return pages.select(entry.alias("entry"), (F.col("page_id") % 7 < 4).alias("listed"), F.expr(CHANGED).alias("changed_on")).filter("entry IS NOT NULL")


OP8_SQL = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url, {FETCHED} AS fetched_on, {CHANGED} AS changed_on,
           rtrim(lower(regexp_extract(url, '{HOST}', 1)), '.') AS host, regexp_extract(url, '{SEGMENT}', 1) AS seg FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
k AS (SELECT *, CASE WHEN host <> '' THEN list_concat(CASE WHEN seg <> '' THEN [host || seg] ELSE [] END, [host],
      CASE WHEN len(labels) > 2 THEN list_transform(range(2, len(labels)), lambda i: array_to_string(labels[i:], '.')) ELSE [] END) END AS keys FROM l),
e AS (SELECT lower(CASE WHEN page_id % 97 = 0 THEN keys[len(keys)] WHEN page_id % 5 = 0 THEN keys[1] WHEN page_id % 3 = 0 THEN host END) AS entry,
      page_id % 7 < 4 AS listed, changed_on FROM k),
daily AS (SELECT entry, changed_on, bool_or(listed) AS listed FROM e WHERE entry IS NOT NULL AND changed_on IS NOT NULL AND listed IS NOT NULL GROUP BY 1, 2),
ch AS (SELECT * FROM (SELECT *, lag(listed) OVER (PARTITION BY entry ORDER BY changed_on) AS was FROM daily) WHERE listed <> coalesce(was, FALSE)),
iv AS (SELECT * FROM (SELECT *, lead(changed_on) OVER (PARTITION BY entry ORDER BY changed_on) AS valid_to FROM ch) WHERE listed),
probe AS (SELECT r, fetched_on, keys[i] AS entry, i FROM (SELECT r, fetched_on, keys, unnest(range(1, len(keys) + 1)) AS i FROM k)),
hit AS (SELECT r, iv.entry, iv.changed_on AS listed_on, row_number() OVER (PARTITION BY r ORDER BY i) AS n FROM probe JOIN iv ON probe.entry = iv.entry
        AND fetched_on >= iv.changed_on AND (valid_to IS NULL OR fetched_on < valid_to))
SELECT page_id, url, fetched_on, entry IS NOT NULL AS blocked, entry, listed_on FROM p LEFT JOIN (SELECT * FROM hit WHERE n = 1) USING (r)
"""
