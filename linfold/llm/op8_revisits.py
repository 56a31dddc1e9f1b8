"""Not-modified revisits in a crawl log, resolved to the responses they stand for.

A revisit (304) has no body. It stands for the latest earlier full response of the same canonical
URL: an as-of join. Its validators are checked against that response's (entity tags by weak
comparison; where one side has none, the last-modified date), and its headers update the stored
ones, but for those that describe the stored body or one connection.

The as-of join is made of windows that are split by time: records are dealt to blocks by quantiles
of their time, the last response of every URL in each block is found by an aggregate, and a window
within a URL and a block is preceded by the last response of the URL's earlier blocks. So a URL with
very many records is spread over all blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linfold.llm import common

# Headers of a 304 response that do not update the stored response.
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type",
                "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te",
                "trailer", "transfer-encoding", "upgrade")
RECORD = ("record_id", "url", "ts", "revisit", "etag", "last_modified", "headers", "digest")


def canonical_url(url: Column) -> Column:
    """Host without case, www and default port, and path without a closing slash or index file,
    without scheme and fragment; query parameters sorted, those for tracking left out."""
    head = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www[0-9]*\.", ""), r":(80|443)?$", "")
    rest = F.regexp_replace(F.regexp_replace(url, head, ""), r"#.*$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/(index\.html?)?$", "")
    params = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
                      lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]*|ref)="))
    tail = F.array_join(F.array_sort(params), "&")
    return F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Headers as entries with lower-case names; of a repeated name the last value."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.coalesce(F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)),
                      F.array().cast("array<struct<key:string,value:string>>"))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers with the permitted ones of ``update`` in their place; names in lower case,
    sorted."""
    allowed = F.filter(_lower_names(update), lambda e: ~e["key"].isin(*KEPT_HEADERS))
    names = F.transform(allowed, lambda e: e["key"])
    rest = F.filter(_lower_names(stored), lambda e: ~F.array_contains(names, e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(rest, allowed)))


def resolved(records: DataFrame, blocks: int | None = None) -> DataFrame:
    """record_id, canonical_url, status, base_id, base_digest, headers for every revisit.

    ``records``: record_id, url, ts (any ordered type that casts to double), revisit (boolean),
    etag, last_modified, headers (map), digest. status: ``resolved``; ``mismatch``: validators
    differ; ``unverified``: no validator on both sides; ``orphan``: no earlier response. Headers are
    the merged ones if resolved, else the revisit's own.

    Earlier means a smaller (ts, record_id). Nulls: records without url or ts match nothing (their
    revisits are orphans); null headers are none; a null ``revisit`` is a full response. Repeated
    revisits are resolved one by one; of responses with equal (ts, record_id) any is taken, a larger
    digest first. Empty table: no rows. Other columns are ignored.
    """
    spark = records.sparkSession
    blocks = blocks or max(64, common.shuffle_partitions(spark))
    base = records.select(*RECORD).withColumns({
        "revisit": F.coalesce("revisit", F.lit(False)), "canonical_url": canonical_url(F.col("url")),
        "at": F.col("ts").cast("double")})
    usable = F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    bounds = base.where(usable).agg(F.percentile_approx("at", [i / blocks for i in range(1, blocks)])).first()[0]
    steps = F.array(*[F.lit(b) for b in sorted(set(bounds or []))]).cast("array<double>")
    own = F.struct("record_id", "etag", "last_modified", "headers", "digest")
    timed = base.where(usable).withColumns({
        "block": F.size(F.filter(steps, lambda b: b <= F.col("at"))), "full": F.when(~F.col("revisit"), own)})
    order = F.struct("at", "record_id", "digest")
    last = timed.groupBy("canonical_url", "block").agg(
        F.max_by("full", F.when(~F.col("revisit"), order)).alias("last"))
    past = W.partitionBy("canonical_url").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = last.select("canonical_url", "block", F.last("last", ignorenulls=True).over(past).alias("carried"))
    # A revisit comes before a response of the same (ts, record_id), which is not earlier.
    inside = (W.partitionBy("canonical_url", "block").orderBy("at", "record_id", F.col("revisit").desc(), "digest")
              .rowsBetween(W.unboundedPreceding, -1))
    found = (timed.withColumn("near", F.last("full", ignorenulls=True).over(inside)).where("revisit")
             .join(before, ["canonical_url", "block"], "left")
             .withColumn("base", F.coalesce("near", "carried")))
    found = found.select("record_id", "canonical_url", "etag", "last_modified", "headers", "base")
    orphans = base.where(~usable & F.col("revisit")).select(
        "record_id", "canonical_url", "etag", "last_modified", "headers",
        F.lit(None).cast(found.schema["base"].dataType).alias("base"))

    def opaque(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    verdict = (F.when(F.col("base").isNull(), "orphan")
               .when(F.col("etag").isNotNull() & F.col("base.etag").isNotNull(),
                     F.when(opaque(F.col("etag")) == opaque(F.col("base.etag")), "resolved").otherwise("mismatch"))
               .when(F.col("last_modified").isNotNull() & F.col("base.last_modified").isNotNull(),
                     F.when(F.col("last_modified") == F.col("base.last_modified"), "resolved").otherwise("mismatch"))
               .otherwise("unverified"))
    good = F.col("status") == "resolved"
    return (found.union(orphans).withColumn("status", verdict)
            .select("record_id", "canonical_url", "status", F.when(good, F.col("base.record_id")).alias("base_id"),
                    F.when(good, F.col("base.digest")).alias("base_digest"),
                    F.when(good, merged_headers(F.col("base.headers"), F.col("headers")))
                    .otherwise(F.map_from_entries(F.array_sort(_lower_names(F.col("headers"))))).alias("headers")))


HOUR, DAY = 3_600, 86_400


def crawl_log(pages: DataFrame) -> DataFrame:
    """A crawl log derived from ``pages``: each page is fetched at its page_id's hour; every fourth
    again, changed, three days later; and each is asked for twice more, with entity tags (the old
    one, weak for odd pages, a foreign one for every seventh) or dates alone (every fifth)."""
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    new_tag = F.concat(F.lit('"'), F.substring(F.md5(F.concat("html", F.lit("2"))), 1, 16), F.lit('"'))
    page = pages.select(
        F.col("page_id").cast("long").alias("id"), "url", tag.alias("tag"), new_tag.alias("new_tag"),
        F.sha2("html", 256).alias("digest"), F.sha2(F.concat("html", F.lit("2")), 256).alias("new_digest"),
        F.length("html").cast("string").alias("size"))
    date = F.concat(F.lit("day "), (F.col("id") % 365).cast("string"))
    at = F.col("id") * HOUR

    def record(n: int, ts: Column, revisit: bool, etag: Column, modified: Column, headers: Column, digest: Column,
               when: Column, url: Column) -> Column:
        return F.when(when, F.struct(
            (F.col("id") * 4 + n).alias("record_id"), url.alias("url"), ts.alias("ts"),
            F.lit(revisit).alias("revisit"), etag.alias("etag"), modified.alias("last_modified"),
            headers.alias("headers"), digest.alias("digest")))

    def full(tag_: Column, date_: Column, date_now: str) -> Column:
        return F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size"),
                            F.lit("ETag"), tag_, F.lit("Last-Modified"), date_, F.lit("Date"), F.lit(date_now),
                            F.lit("Cache-Control"), F.lit("max-age=60"))

    none = F.lit(None).cast("string")
    asked = F.create_map(F.lit("Date"), F.lit("later"), F.lit("cache-control"), F.lit("max-age=600"),
                         F.lit("Content-Length"), F.lit("0"), F.lit("X-Cache"), F.lit("hit"))
    weak = F.when(F.col("id") % 2 == 1, F.concat(F.lit("W/"), F.col("tag"))).otherwise(F.col("tag"))
    sent = (F.when(F.col("id") % 5 == 0, none).when(F.col("id") % 7 == 0, F.lit('"other"')).otherwise(weak))
    yes = F.lit(True)
    fourth = F.col("id") % 4 == 0
    later_date = F.concat(date, F.lit(" changed"))
    rows = F.array(
        record(0, at, False, F.col("tag"), date, full(F.col("tag"), date, "first"), F.col("digest"), yes, F.col("url")),
        record(1, at + DAY, True, sent, date, asked, none, yes, F.concat("url", F.lit("#again"))),
        record(2, at + 3 * DAY, False, F.col("new_tag"), later_date, full(F.col("new_tag"), later_date, "second"),
               F.col("new_digest"), fourth, F.col("url")),
        record(3, at + 4 * DAY, True, F.when(fourth & (F.col("id") % 3 == 0), F.col("new_tag")).otherwise(sent),
               F.when(fourth, later_date).otherwise(date), asked, none, yes, F.col("url")))
    return page.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolved(crawl_log(common.table(spark, sf_dir, "pages")))
    text = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select("record_id", "canonical_url", "status", "base_id", "base_digest", text.alias("headers"))


ORACLE_SQL = r"""
WITH page AS (
  SELECT page_id AS id, url, '"' || substr(md5(html), 1, 16) || '"' AS tag,
         '"' || substr(md5(html || '2'), 1, 16) || '"' AS new_tag, sha256(html) AS digest,
         sha256(html || '2') AS new_digest, CAST(length(html) AS VARCHAR) AS size,
         'day ' || CAST(page_id % 365 AS VARCHAR) AS modified,
         CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"other"'
              ELSE CASE WHEN page_id % 2 = 1 THEN 'W/' ELSE '' END || '"' || substr(md5(html), 1, 16) || '"' END AS sent
  FROM pages),
log AS (
  SELECT id * 4 AS record_id, url, id * 3600 AS ts, false AS revisit, tag AS etag, modified AS last_modified, digest, size, 'first' AS seen FROM page
  UNION ALL SELECT id * 4 + 1, url || '#again', id * 3600 + 86400, true, sent, modified, NULL, NULL, NULL FROM page
  UNION ALL SELECT id * 4 + 2, url, id * 3600 + 259200, false, new_tag, modified || ' changed', new_digest, size, 'second' FROM page WHERE id % 4 = 0
  UNION ALL SELECT id * 4 + 3, url, id * 3600 + 345600, true,
         CASE WHEN id % 4 = 0 AND id % 3 = 0 THEN new_tag ELSE sent END,
         CASE WHEN id % 4 = 0 THEN modified || ' changed' ELSE modified END, NULL, NULL, NULL FROM page),
cut AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www[0-9]*\.', ''), ':(80|443)?$', '') AS host,
         regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#.*$', '') AS rest FROM log),
named AS (
  SELECT *, host || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/(index\.html?)?$', '') || CASE WHEN tail <> '' THEN '?' || tail ELSE '' END AS canonical_url
  FROM (SELECT *, coalesce(array_to_string(list_sort([p FOR p IN string_split(regexp_extract(rest, '\?(.*)$', 1), '&')
               IF p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]*|ref)=')]), '&'), '') AS tail FROM cut)),
joined AS (
  SELECT record_id, canonical_url, etag, last_modified, revisit,
         last_value(CASE WHEN NOT revisit THEN {'id': record_id, 'etag': etag, 'lm': last_modified, 'digest': digest, 'size': size} END IGNORE NULLS)
           OVER (PARTITION BY canonical_url ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
  FROM named),
judged AS (
  SELECT *, CASE WHEN b IS NULL THEN 'orphan'
                 WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(b.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN last_modified = b.lm THEN 'resolved' ELSE 'mismatch' END AS status
  FROM joined WHERE revisit)
SELECT record_id, canonical_url, status, CASE WHEN status = 'resolved' THEN b.id END AS base_id,
       CASE WHEN status = 'resolved' THEN b.digest END AS base_digest,
       CASE WHEN status = 'resolved'
            THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || b.size || chr(10) || 'content-type: text/html' || chr(10)
                 || 'date: later' || chr(10) || 'etag: ' || b.etag || chr(10) || 'last-modified: ' || b.lm || chr(10) || 'x-cache: hit'
            ELSE 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || chr(10) || 'date: later' || chr(10) || 'x-cache: hit' END AS headers
FROM judged
"""
