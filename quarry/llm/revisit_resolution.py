"""WARC not-modified revisit resolution: an as-of join by canonical URL.

A revisit record says "not modified since an earlier capture" and has no
payload. ``resolve`` finds, for every revisit, the latest full response of
the same canonical URL with an earlier time, checks that its validators
agree, and answers with that response's payload under merged headers.

The as-of join sorts captures by (URL, time) into ranges, so a URL with a
third of all captures is spread over many ranges. Inside a range a window
finds the last response before each revisit; what a range ends with is carried
to the URL's later ranges by a second window over one row per URL and range.
Only (time, id) travel through the sort; headers and payload are joined to the
responses found.

Validators: if both records have an ETag they must agree by weak comparison
(a leading ``W/`` does not count); else if both have Last-Modified the texts
must be equal; else the payload digests must agree if both are known. Without
any of them the revisit is unverifiable and stays unresolved.

Headers: a revisit's fields replace or add to the stored ones, except those
that describe the payload or the connection (``KEPT``), which stay as stored.
Field names are compared in lower case.

Defined results
* null url or time: never joined; status ``no_response``.
* null headers: as empty. Null payload of a response: resolved with null payload.
* ties: of responses with equal time the greatest record id is the latest; a
  response at the revisit's very time is not earlier.
* repeated records: every revisit row is answered by itself, at its own time.
  Responses with one id at different times are different captures. Of responses
  that share id, URL and time, the one with the greatest digest (then payload
  hash, then headers) stands for all.
* very long payloads are joined once, at the end, to the revisits they answer.
* extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import stage

# Fixed values (HTTP caching): stored fields that a not-modified answer never changes.
KEPT = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
        "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer",
        "transfer-encoding", "upgrade"]
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """Key of a URL: host without user, ``www.``, default port and case; path
    without a last slash; query parameters sorted; scheme and fragment dropped.
    Null for a text that is not an absolute URL."""
    part = [F.regexp_extract(url, URL, i) for i in range(5)]
    host = F.lower(F.regexp_replace(part[2], r"^[^@]*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.", "")
    query = F.array_join(F.array_sort(F.split(F.substring(part[4], 2, 1 << 30), "&")), "&")
    key = F.concat(host, F.regexp_replace(part[3], r"/+$", ""), F.when(F.length(part[4]) > 1, F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(part[0] != "", key)


def lower_keys(headers: Column) -> Column:
    """Headers with lower-case names; of names equal but for case the last wins."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(
        F.filter(entries, lambda e: F.lower(e["key"]) == k), -1)["value"]))


def as_of(records: DataFrame) -> DataFrame:
    """(id, key, time, found_id, found_time) for revisit rows with an earlier
    response: the latest. ``records``: key, time, id, is_response."""
    placed = stage(records.where("key is not null and time is not null")
                   .repartitionByRange("key", "time").withColumn("part", F.spark_partition_id()), "revisit-ranges")
    mark = F.when(F.col("is_response"), F.struct("time", "id"))
    inside = Window.partitionBy("part", "key").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    here = placed.withColumn("inside", F.max(mark).over(inside)).where("not is_response")
    ends = placed.groupBy("key", "part").agg(F.max(mark).alias("last"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.max("last").over(before)).where("carried is not null").select("key", "part", "carried")
    return (here.join(carried, ["key", "part"], "left").withColumn("found", F.coalesce("inside", "carried")).where("found is not null")
            .select("id", "key", "time", F.col("found.id").alias("found_id"), F.col("found.time").alias("found_time")).distinct())


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], r"^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records`` (record_id, url, time, type, headers,
    digest, payload): revisit_id, url_key, time, response_id, status
    (``resolved``, ``mismatch``, ``unverifiable``, ``no_response``), headers, digest, payload."""
    rows = records.select("record_id", "time", (F.col("type") == "response").alias("is_response"), "type",
                          canonical_url(F.col("url")).alias("key"), lower_keys(F.col("headers")).alias("headers"), "digest", "payload")
    found = stage(as_of(rows.where(F.col("type").isin("response", "revisit")).select("key", "time", F.col("record_id").alias("id"), "is_response")),
                  "revisit-found")
    revisit = rows.where("type = 'revisit'").drop("payload", "is_response", "type")
    place = ["found_id", "key", "found_time"]
    first = F.struct(F.coalesce("digest", F.lit("")), F.sha2(F.coalesce("payload", F.lit("")), 256), F.to_json(F.array_sort(F.map_entries("headers"))))
    response = (rows.where("is_response").withColumnsRenamed({"record_id": "found_id", "time": "found_time"})
                .join(found.select(*place).distinct(), place, "left_semi")
                .groupBy(*place).agg(F.max_by(F.struct("headers", "digest", "payload"), first).alias("r"))
                .select(*place, F.col("r.headers").alias("stored"), F.col("r.digest").alias("stored_digest"), F.col("r.payload").alias("payload")))
    joined = (revisit.join(found.withColumnRenamed("id", "record_id"), ["record_id", "key", "time"], "left").join(response, place, "left"))
    new, old = F.col("headers"), F.col("stored")
    agree = (F.when(new["etag"].isNotNull() & old["etag"].isNotNull(), _tag(new) == _tag(old))
             .when(new["last-modified"].isNotNull() & old["last-modified"].isNotNull(), new["last-modified"] == old["last-modified"])
             .otherwise(F.col("digest") == F.col("stored_digest")))
    status = (F.when(F.col("found_id").isNull(), "no_response").when(agree, "resolved")
              .when(~agree, "mismatch").otherwise("unverifiable"))
    kept = F.array(*[F.lit(k) for k in KEPT])
    updates = F.map_filter(new, lambda k, _: ~F.array_contains(kept, k))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(updates), k)), updates)
    ok = F.col("status") == "resolved"
    return joined.withColumn("status", status).select(
        F.col("record_id").alias("revisit_id"), F.col("key").alias("url_key"), "time", F.col("found_id").alias("response_id"), "status",
        F.when(ok, merged).alias("headers"), F.when(ok, F.col("stored_digest")).alias("digest"), F.when(ok, F.col("payload")).alias("payload"))


def capture_records(pages: DataFrame) -> DataFrame:
    """Capture records derived from the ``pages`` table.

    Every page p is a full response at time 10 p and is asked for again at
    10 p + 25, pages divisible by 7 also at 10 p - 5. A third of the pages lie
    under one URL, a third share a URL by eights, a third have their own; what
    pages of a shared URL hold changes every six pages. Responses carry an ETag,
    Last-Modified, both or neither, revisits an ETag (stale at times),
    Last-Modified, a digest (wrong at times) or nothing.
    """
    p, third = F.col("page_id"), F.col("page_id") % 3
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    version = F.when(third == 1, text("e", p)).otherwise(text("e", F.floor(p / 6)))
    url = (F.when(third == 0, F.lit("http://hot.example.org/"))
           .when(third == 2, text("https://site", F.floor(p / 8), ".example.org/a?y=2&x=1")).otherwise(F.col("url")))
    base = pages.select("page_id", "html", url.alias("url"), version.alias("version"))

    def headers(**fields):
        each = [x for k, v in fields.items() for x in (F.lit(k.replace("_", "-")), v)]
        return F.map_filter(F.create_map(*each), lambda _, v: v.isNotNull())

    full = base.select(
        text("r", p).alias("record_id"), "url", (p * 10).alias("time"), F.lit("response").alias("type"),
        headers(ETag=F.when((p % 5).isin(0, 1, 4), F.col("version")), Last_Modified=F.when((p % 5).isin(1, 2), text("m", F.col("version"))),
                Content_Type=F.lit("text/html"), Content_Length=F.length("html").cast("string"), Cache_Control=F.lit("max-age=60")).alias("headers"),
        F.when(p % 5 != 2, F.md5("version")).alias("digest"), F.col("html").alias("payload"))
    other_spelling = F.when(third == 0, F.lit("https://www.HOT.example.org:443")).otherwise(F.concat("url", F.lit("#again")))
    tag = F.when(p % 11 == 0, F.lit("stale")).otherwise(text("W/", F.col("version")))
    again = base.select("page_id", "version", other_spelling.alias("url"), F.explode(
        F.when(p % 7 == 0, F.array(F.lit("v"), F.lit("w"))).otherwise(F.array(F.lit("v")))).alias("kind"))
    again = again.select(
        F.concat("kind", p.cast("string")).alias("record_id"), "url", (p * 10 + F.when(F.col("kind") == "v", 25).otherwise(-5)).alias("time"),
        F.lit("revisit").alias("type"),
        headers(etag=F.when((p % 6).isin(0, 1), tag), last_modified=F.when((p % 6).isin(1, 2), text("m", F.col("version"))),
                content_length=F.lit("0"), cache_control=F.lit("max-age=90"), Date=p.cast("string")).alias("headers"),
        F.when((p % 6).isin(0, 3), F.md5("version")).when(p % 6 == 5, F.lit("other")).alias("digest"),
        F.lit(None).cast("string").alias("payload"))
    return full.union(again)


ORACLE_SQL = r"""
WITH base AS (
  SELECT page_id AS p, html,
         CASE WHEN page_id % 3 = 1 THEN 'e' || page_id ELSE 'e' || (page_id // 6) END AS version,
         CASE WHEN page_id % 3 = 0 THEN 'hot.example.org' WHEN page_id % 3 = 2 THEN 'site' || (page_id // 8) || '.example.org/a?x=1&y=2' ELSE
           regexp_replace(regexp_replace(lower(regexp_replace(
             regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2), '^[^@]*@', '')), ':(80|443)?$', ''), '^www\.', '')
           || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')
           || CASE WHEN length(regexp_extract(url, '^[^?#]*(\?[^#]*)?', 1)) > 1
              THEN '?' || array_to_string(list_sort(string_split(substring(regexp_extract(url, '^[^?#]*(\?[^#]*)?', 1), 2), '&')), '&') ELSE '' END END AS key
  FROM pages),
r AS (
  SELECT p, key, p * 10 AS time, html, CASE WHEN p % 5 IN (0, 1, 4) THEN version END AS etag,
         CASE WHEN p % 5 IN (1, 2) THEN 'm' || version END AS modified, CASE WHEN p % 5 <> 2 THEN md5(version) END AS digest FROM base),
v AS (
  SELECT kind || p AS id, p, key, p * 10 + CASE kind WHEN 'v' THEN 25 ELSE -5 END AS time,
         CASE WHEN p % 6 IN (0, 1) THEN CASE WHEN p % 11 = 0 THEN 'stale' ELSE 'W/' || version END END AS etag,
         CASE WHEN p % 6 IN (1, 2) THEN 'm' || version END AS modified,
         CASE WHEN p % 6 IN (0, 3) THEN md5(version) WHEN p % 6 = 5 THEN 'other' END AS digest
  FROM base, (VALUES ('v'), ('w')) AS k(kind) WHERE kind = 'v' OR p % 7 = 0),
j AS (
  SELECT v.*, r.p AS rp, r.html, r.etag AS retag, r.modified AS rmodified, r.digest AS rdigest
  FROM v ASOF LEFT JOIN r ON v.key = r.key AND v.time > r.time),
s AS (
  SELECT *, CASE WHEN rp IS NULL THEN 'no_response'
                 WHEN etag IS NOT NULL AND retag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = retag THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL AND rmodified IS NOT NULL THEN CASE WHEN modified = rmodified THEN 'resolved' ELSE 'mismatch' END
                 WHEN digest = rdigest THEN 'resolved' WHEN digest <> rdigest THEN 'mismatch' ELSE 'unverifiable' END AS status FROM j)
SELECT id AS revisit_id, key AS url_key, time, 'r' || rp AS response_id, status,
       CASE WHEN status = 'resolved' THEN concat_ws('|', 'cache-control: max-age=90', 'content-length: ' || length(html), 'content-type: text/html',
         'date: ' || p, 'etag: ' || coalesce(etag, retag), 'last-modified: ' || coalesce(modified, rmodified)) END AS headers,
       CASE WHEN status = 'resolved' THEN rdigest END AS digest
FROM s
"""
