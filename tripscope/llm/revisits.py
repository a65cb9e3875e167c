"""Not-modified revisit resolution of web-archive records.

A revisit record (the server answered "not modified") holds no body.  It is
resolved to the latest earlier full response of the same canonical URL, if the
validators agree; the stored headers are then updated by those the revisit may
change.  The as-of join is native: time is cut into ranges at the quantiles of
all records; inside (URL, range) a running last response, and for what came
before the range one row per (URL, range).  So a URL with a third of all
records is spread over the ranges, and no window sees more of it than one
range, or one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import table, written

RANGES = 64
# Header fields of a not-modified answer that do not replace the
# stored ones (they describe the message or the connection, not the resource).
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-connection", "set-cookie", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that do not change the page.
TRACKING = r"^(ref|utm_[a-z]+|sessionid)="

RECORD = "record_id bigint, url string, ts bigint, kind string, headers array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """host/path?query: scheme, fragment, ``www``/``m`` label, default port and
    trailing slash dropped, host in lower case, tracking parameters dropped and
    the rest sorted.  NULL stays NULL; a text without a scheme is all path."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www[0-9]*|m)\.", "")
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), r"/+$", "")
    params = F.array_sort(
        F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def header(headers: str, name: str) -> Column:
    """First value of a field, by lower-case name; NULL if there is none."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), 0)["value"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def merged_headers(stored: str, fresh: str) -> Column:
    """Stored fields, those named by a permitted field of ``fresh`` replaced."""
    permitted = F.filter(fresh, lambda h: ~F.lower(h["name"]).isin(*NOT_MERGED))
    names = F.transform(permitted, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), permitted)


def resolve_revisits(records: DataFrame, *, ranges: int = RANGES) -> DataFrame:
    """``records`` as in ``RECORD`` (kind ``response`` or ``revisit``; others
    are ignored).  One row per revisit: record_id, url_key, response_id,
    outcome, headers (merged; NULL unless resolved).

    Earlier means a smaller ts; of responses at one ts the largest record_id
    wins.  Validators: the entity tags, compared weakly, if the revisit has
    one; else Last-Modified; with neither the revisit is ``unvalidated``.  A
    revisit with NULL url or ts has no earlier response; a response with either
    NULL resolves nothing; NULL headers count as none.  Repeated revisit rows
    stay repeated.  Extra columns are ignored.
    """
    spark = records.sparkSession
    rows = written(
        records.where(F.col("kind").isin("response", "revisit")).select(
            "record_id", canonical_url(F.col("url")).alias("url_key"), "ts", (F.col("kind") == "response").alias("full"),
            F.coalesce("headers", F.array().cast("array<struct<name:string,value:string>>")).alias("headers"),
        ),
        "revisit-records",
    )
    at = [i / ranges for i in range(1, ranges)]
    bounds = sorted({int(x) for x in rows.agg(F.percentile_approx("ts", at, 10_000)).first()[0] or []})
    place = F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b <= F.col("ts"))) if bounds else F.lit(0)
    keyed = rows.where("url_key is not null and ts is not null").select(
        "record_id", "url_key", "ts", "full", place.alias("range")
    )
    response = F.when(F.col("full"), F.struct("ts", "record_id"))
    # Revisits come before the responses of their ts; so the last response
    # above a revisit is an earlier one.
    inside = (
        Window.partitionBy("url_key", "range").orderBy("ts", F.col("full"), "record_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = keyed.withColumn("near", F.last(response, ignorenulls=True).over(inside)).where(~F.col("full"))
    per_range = keyed.groupBy("url_key", "range").agg(F.max(response).alias("top"))
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.select("url_key", "range", F.max("top").over(earlier).alias("far")).where("far is not null")
    found = (
        near.join(carried, ["url_key", "range"], "left")
        .select("record_id", "url_key", "ts", F.coalesce("near.record_id", "far.record_id").alias("response_id"))
    )
    # One response per revisit id and time: repeated revisit rows agree.
    found = found.groupBy("record_id", "url_key", "ts").agg(F.max("response_id").alias("response_id"))
    revisits = rows.where(~F.col("full")).select("record_id", "url_key", "ts", F.col("headers").alias("fresh"))
    matched = revisits.join(
        found, revisits["record_id"].eqNullSafe(found["record_id"]) & (revisits["url_key"] == found["url_key"])
        & (revisits["ts"] == found["ts"]), "left",
    ).select(revisits["record_id"], revisits["url_key"], "fresh", "response_id")
    # Written, so that a response with very many revisits can be split in the join.
    stored = written(
        rows.where("full and record_id is not null").groupBy(F.col("record_id").alias("response_id"))
        .agg(F.min("headers").alias("stored")),
        "revisit-stored",
    )
    tag, modified = header("fresh", "etag"), header("fresh", "last-modified")
    agrees = F.when(tag.isNotNull(), F.coalesce(_weak(tag) == _weak(header("stored", "etag")), F.lit(False))).otherwise(
        F.coalesce(modified == header("stored", "last-modified"), F.lit(False))
    )
    outcome = (
        F.when(F.col("response_id").isNull(), "no earlier response")
        .when(tag.isNull() & modified.isNull(), "unvalidated")
        .when(agrees, "resolved")
        .otherwise("validators differ")
    )
    return (
        matched.join(stored, "response_id", "left").withColumn("outcome", outcome)
        .select(
            "record_id", "url_key", "response_id", "outcome",
            F.when(F.col("outcome") == "resolved", merged_headers("stored", "fresh")).alias("headers"),
        )
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records laid over ``pages``: each page is a full response, and
    is revisited once.  Time is 10 seconds a page; by page_id, every 7th page
    (remainder 3) is revisited before its response, the others after; every
    5th revisit (remainder 0) has another entity tag; every 4th (remainder 1)
    has only a modification date.  Revisits ask for another spelling of the URL.
    """
    p = F.col("page_id")
    body = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(body), 1, 16), F.lit('"'))
    field = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    day = F.concat(F.lit("day "), (p % 1000).cast("string"))
    full = F.array(
        field("Content-Type", F.lit("text/html")), field("Content-Length", F.octet_length(body)),
        field("ETag", tag), field("Last-Modified", day), field("Cache-Control", F.lit("max-age=60")),
    )
    validator = F.when(p % 4 == 1, field("Last-Modified", day)).otherwise(
        field("ETag", F.when(p % 5 == 0, F.lit('"gone"')).otherwise(F.concat(F.lit("W/"), tag)))
    )
    light = F.array(
        validator, field("Cache-Control", F.concat(F.lit("max-age="), (p % 100).cast("string"))),
        field("Content-Length", F.lit(0)), field("Set-Cookie", F.lit("id=1")),
        field("Date", F.concat(F.lit("at "), p.cast("string"))),
    )
    at = p * 10
    return pages.select(
        F.inline(
            F.array(
                F.struct((p * 2).alias("record_id"), F.col("url").alias("url"), at.alias("ts"),
                         F.lit("response").alias("kind"), full.alias("headers")),
                F.struct((p * 2 + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"),
                         F.when(p % 7 == 3, at - 5).otherwise(at + 5).alias("ts"),
                         F.lit("revisit").alias("kind"), light.alias("headers")),
            )
        )
    )


def op4_revisits(spark, sf_dir):
    found = resolve_revisits(page_records(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    lines = F.array_sort(F.transform("headers", lambda h: F.concat_ws(": ", F.lower(h["name"]), h["value"])))
    return found.select("record_id", "url_key", "response_id", "outcome", F.array_join(lines, "\n").alias("headers"))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id AS p, coalesce(html, '') AS body, regexp_replace(url, '#.*$', '') AS u FROM pages),
c AS (
  SELECT p, '"' || substr(md5(body), 1, 16) || '"' AS tag, 'day ' || (p % 1000) AS day, strlen(body) AS size,
         regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)),
                        ':(80|443)$', ''), '^(www[0-9]*|m)\.', '') AS host,
         regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '') AS rest
  FROM p),
k AS (
  SELECT p, tag, day, size, host || regexp_replace(regexp_replace(rest, '\?.*$', ''), '/+$', '') ||
         CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|utm_[a-z]+|sessionid)='))) AS params FROM c)),
v AS (
  SELECT *, CASE WHEN p % 7 = 3 THEN p * 10 - 5 ELSE p * 10 + 5 END AS ts,
         CASE WHEN p % 4 = 1 THEN NULL WHEN p % 5 = 0 THEN '"gone"' ELSE tag END AS ask_tag FROM k),
j AS (
  SELECT v.p, v.url_key, v.ask_tag, v.day AS ask_day, r.p AS rp, r.tag, r.day, r.size
  FROM v ASOF LEFT JOIN (SELECT p, url_key, tag, day, size, p * 10 AS ts FROM k) r
    ON v.url_key = r.url_key AND v.ts > r.ts),
o AS (
  SELECT *, CASE WHEN rp IS NULL THEN 'no earlier response'
                 WHEN CASE WHEN ask_tag IS NOT NULL THEN ask_tag = tag ELSE ask_day = day END THEN 'resolved'
                 ELSE 'validators differ' END AS outcome FROM j)
SELECT p * 2 + 1 AS record_id, url_key, rp * 2 AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN
         'cache-control: max-age=' || (p % 100) || chr(10) || 'content-length: ' || size || chr(10) ||
         'content-type: text/html' || chr(10) || 'date: at ' || p || chr(10) ||
         'etag: ' || CASE WHEN ask_tag IS NOT NULL THEN 'W/' || ask_tag ELSE tag END || chr(10) ||
         'last-modified: ' || day END AS headers
FROM o
"""
