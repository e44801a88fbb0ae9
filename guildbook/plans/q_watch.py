"""Queries of watched sources and of lists of members, each with SQL written by hand."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from guildbook.operators import baselines as b
from guildbook.operators import joins as j
from guildbook.operators import schema as sc
from guildbook.operators.store import new_folder, written
from guildbook.plans.frames import frame, table, with_frames
from guildbook.streaming import streams

c = F.col

SELECTORS = {"name": ".member-item a", "tier": "p.tier"}
MEMBERS = {
    "company_name": {"selectors": ["//b[@class='nm']", "b"]}, "website": {"selectors": ["//li/a[contains(@class, 'w')]/@href", "a.w"], "extract": "href"},
    "city": {"selectors": ["//li/i/text()"]}, "country": {"selectors": ["//em"], "default": "United States"},
}


def _watched(spark, sf):
    """Baselines as they were, without every ninth page, and the pages as they are; both written, so that a page is parsed once."""
    pages = frame(spark, sf, "snapshots")
    old = b.create_baselines(pages.filter("page_id % 9 <> 7"), SELECTORS, html="old_html")
    old = old.withColumns({"change_count": F.lit(0).cast("long"), "last_checked_at": F.lit("2025-05-01").cast("timestamp"), "last_changed_at": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp")})
    return written(old, "old"), written(b.create_baselines(pages, SELECTORS, html="new_html", status="status", error="error"), "new")


def source_alerts(spark, sf):
    old, new = _watched(spark, sf)
    return b.check_baselines(new, old)


def watched_sources(spark, sf):
    old, new = _watched(spark, sf)
    after = b.update_baselines(old, b.check_baselines(new, old), new, F.lit("2025-06-01").cast("timestamp"))
    return after.select("url", "domain", "content_hash", "items", "change_count", c("last_checked_at").cast("date").cast("string").alias("checked"), c("last_changed_at").cast("date").cast("string").alias("changed"))


def watch_report(spark, sf):
    old, new = _watched(spark, sf)
    alerts = b.check_baselines(new, old)
    return b.monitor_report(b.update_baselines(old, alerts, new, F.lit("2025-06-01").cast("timestamp")), alerts)


def directory_records(spark, sf):
    return sc.directory_records(frame(spark, sf, "directories"), "page_id", "url", MEMBERS, "li", container="//div[@id='members']").drop("turn")


def snapshot_changes(spark, sf):
    """What each user did last, as snapshots by time; the last day of the table waits for what may still come."""
    out, before = new_folder(spark, "snapshots"), spark.conf.get(streams.ROCKS[0], None)
    stream = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    stream = stream.select(c("user_id").cast("string").alias("url"), c("event_type").alias("content_hash"), c("ts").cast("timestamp").alias("ts"))
    spark.conf.set(*streams.ROCKS)
    try:
        streams.run_now(streams.snapshot_changes(stream), new_folder(spark, "checkpoint"), lambda batch, _: batch.write.mode("append").parquet(out))
    finally:
        spark.conf.unset(streams.ROCKS[0]) if before is None else spark.conf.set(streams.ROCKS[0], before)
    return spark.read.parquet(out).select("url", F.unix_millis("at").alias("at_ms"), "content_hash", "change_count", "changed")


def streamed_companies(spark, sf):
    """Companies in three batches over a table in buckets: the last phone and city of each."""
    folder = new_folder(spark, "bucketed")
    rows = frame(spark, sf, "companies").select("company_id", "phone", "city")
    streams.upsert_batch(rows.withColumn("turn", F.lit(0)), 0, folder, "company_id", "turn", ["phone", "city"])
    later = rows.filter("company_id % 50 = 7").select("company_id", F.lit("555").alias("phone"), F.lit(None).cast("string").alias("city"), F.lit(1).alias("turn"))
    streams.upsert_batch(later, 1, folder, "company_id", "turn", ["phone", "city"])
    streams.upsert_batch(later.select((c("company_id") + 10_000_000).alias("company_id"), "phone", F.lit("New").alias("city"), "turn"), 2, folder, "company_id", "turn", ["phone", "city"])
    return streams.read_table(spark, folder).select("company_id", "phone", "city")


def companies_upserted(spark, sf):
    """Rows that meet a company by domain (against their id), by id alone, twice, or none."""
    old = frame(spark, sf, "companies").select(c("company_id").alias("id"), F.when(c("company_id") % 4 != 3, F.concat(F.lit("f"), c("company_id").cast("string"), F.lit(".com"))).alias("domain"), "phone", "city")
    of = lambda m, id_, domain, phone, city, turn: old.filter(c("id") % 10 == m).select(id_.cast("long").alias("id"), domain.cast("string").alias("domain"), phone.cast("string").alias("phone"), city.cast("string").alias("city"), F.lit(turn).alias("turn"))
    none, own = F.lit(None), F.concat(F.lit("f"), c("id").cast("string"), F.lit(".com"))
    parts = [
        of(0, c("id") + 1, own, F.lit("by domain"), none, 1), of(1, c("id"), F.lit(""), F.lit("by id"), F.lit("Elsewhere"), 1), of(2, c("id"), none, F.lit("first"), F.lit("One"), 1), of(2, c("id"), none, F.lit("second"), none, 2),
        of(4, c("id") + 10_000_000, F.concat(F.lit("new"), own), F.lit("new"), F.lit("N"), 1), of(4, none, F.concat(F.lit("new"), own), F.lit("newer"), none, 2), of(5, c("id") + 20_000_000, none, F.lit("id only"), none, 1), of(6, none, none, F.lit("nobody"), none, 1), of(6, none, none, F.lit("nobody"), none, 1),
    ]
    return j.upsert_companies(old, reduce(lambda a, b: a.unionByName(b), parts), ["phone", "city"])


_ALERTS = """alerts(m, alert, level, action, detail) AS (VALUES (1, 'SELECTOR_CHANGED', 'WARNING', 'verify_extraction', 'name'), (2, 'DOM_DRIFT', 'WARNING', 'monitor', '3.2%'), (2, 'SELECTOR_BROKEN', 'CRITICAL', 'fix_selector', 'tier'),
  (3, 'DOM_DRIFT', 'CRITICAL', 'update_selectors', '33.3%'), (3, 'SELECTOR_BROKEN', 'CRITICAL', 'fix_selector', 'name'), (3, 'ITEMS_MISSING', 'CRITICAL', 'investigate', '4 -> 0'),
  (4, 'DOM_DRIFT', 'CRITICAL', 'update_selectors', '23.1%'), (4, 'SELECTOR_CHANGED', 'WARNING', 'verify_extraction', 'name'), (4, 'ITEM_COUNT_CHANGED', 'WARNING', 'verify', '4 -> 1'), (5, 'HTTP_ERROR', 'CRITICAL', 'investigate', '503'),
  (6, 'DOM_DRIFT', 'CRITICAL', 'update_selectors', '60.0%'), (6, 'SELECTOR_BROKEN', 'CRITICAL', 'fix_selector', 'name'), (6, 'SELECTOR_BROKEN', 'CRITICAL', 'fix_selector', 'tier'), (6, 'ITEMS_MISSING', 'CRITICAL', 'investigate', '4 -> 0'),
  (6, 'ACCESS_BLOCKED', 'CRITICAL', 'review_access', 'access_denied,captcha,verification'), (7, 'NO_BASELINE', 'INFO', 'create_baseline', ''), (8, 'FETCH_FAILED', 'CRITICAL', 'investigate', 'timeout'))"""
_ROWS = "SELECT page_id AS k, url, old_html, new_html, page_id % 9 AS m, (list_value(0, 1, 2, 3, 3, 0, 5, 0, 0))[page_id % 9 + 1] AS n FROM snapshots"

QUERIES = {
    "source_alerts": (source_alerts, with_frames(f"WITH {_ALERTS} SELECT url, sha256(url) AS url_hash, alert, level, action, detail FROM snapshots JOIN alerts ON m = page_id % 9", "snapshots")),
    "watched_sources": (watched_sources, with_frames(f"""WITH r AS ({_ROWS}) SELECT url, 'watch' || k || '.org' AS domain, sha256(CASE WHEN n > 0 OR m = 7 THEN new_html ELSE old_html END) AS content_hash, 4 AS items, n::BIGINT AS change_count,
  CASE WHEN n > 0 OR m = 7 THEN '2025-06-01' ELSE '2025-05-01' END AS checked, CASE WHEN n > 0 THEN '2025-06-01' END AS changed FROM r""", "snapshots")),
    "watch_report": (watch_report, with_frames(f"""WITH {_ALERTS}, r AS ({_ROWS}) SELECT (SELECT count(*) FROM r) AS total_sources, (SELECT count(*) FROM r WHERE n > 0) AS sources_with_changes, count(*) AS alert_count,
  count(*) FILTER (level = 'CRITICAL') AS critical_count, count(*) FILTER (level = 'WARNING') AS warning_count, count(*) FILTER (level = 'INFO') AS info_count FROM r JOIN alerts USING (m)""", "snapshots")),
    "directory_records": (directory_records, """WITH s AS (SELECT c_custkey AS k, c_custkey % 3 AS m FROM customer)
SELECT k AS page_id, 'schema' AS how, 'Firm ' || k AS company_name, '/go/1' AS website, 'Akron' AS city, 'United States' AS country FROM s WHERE m < 2
UNION ALL SELECT k, 'schema', 'Second', NULL, NULL, 'United States' FROM s WHERE m < 2
UNION ALL SELECT k, 'links', 'One', 'https://one' || k || '.com/x', NULL, NULL FROM s WHERE m = 2 UNION ALL SELECT k, 'links', 'Two', 'https://two' || k || '.com', NULL, NULL FROM s WHERE m = 2"""),
    "snapshot_changes": (snapshot_changes, """WITH e AS (SELECT user_id::VARCHAR AS url, (epoch_us(ts::TIMESTAMP) // 1000)::BIGINT AS at_ms, coalesce(event_type, '') AS h FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
l AS (SELECT *, lag(h) OVER w AS was, row_number() OVER w AS i FROM e WINDOW w AS (PARTITION BY url ORDER BY at_ms, h)),
n AS (SELECT url, at_ms, h AS content_hash, sum(CASE WHEN was <> h THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY i)::INT AS change_count, coalesce(was <> h, false) AS changed FROM l)
SELECT * FROM n WHERE at_ms < (SELECT max(at_ms) FROM e) - 86400000"""),
    "streamed_companies": (streamed_companies, with_frames("SELECT company_id, CASE WHEN company_id % 50 = 7 THEN '555' ELSE phone END AS phone, city FROM companies UNION ALL SELECT company_id + 10000000, '555', 'New' FROM companies WHERE company_id % 50 = 7", "companies")),
    "companies_upserted": (companies_upserted, with_frames("""WITH o AS (SELECT company_id AS id, CASE WHEN company_id % 4 <> 3 THEN 'f' || company_id || '.com' END AS domain, phone, city, company_id % 10 AS m FROM companies),
x AS (SELECT o.*, m = 0 AND domain IS NOT NULL AS d, m = 1 AS i, m = 2 AS t, EXISTS (SELECT 1 FROM o p WHERE p.id = o.id - 1 AND p.m = 0 AND p.domain IS NULL) AS e FROM o)
SELECT id, CASE WHEN e THEN 'f' || (id - 1) || '.com' ELSE domain END AS domain, CASE WHEN d THEN 'by domain' WHEN i AND e THEN 'by id' WHEN i THEN 'by id' WHEN t THEN 'second' ELSE phone END AS phone, CASE WHEN i THEN 'Elsewhere' WHEN t THEN 'One' ELSE city END AS city, CASE WHEN d OR i OR t OR e THEN 'updated' ELSE 'kept' END AS how FROM x
UNION ALL SELECT id + 10000000, 'newf' || id || '.com', 'newer', 'N', 'added' FROM o WHERE m = 4 UNION ALL SELECT id + 20000000, NULL, 'id only', NULL, 'added' FROM o WHERE m = 5 UNION ALL SELECT NULL, NULL, 'nobody', NULL, 'added' FROM o, range(2) WHERE m = 6""", "companies")),
}
