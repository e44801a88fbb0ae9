"""Queries of duplicates, joins, graph and incremental state, with independent SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import text as t
from guildbook.operators import graph as g
from guildbook.operators import joins as j
from guildbook.operators import match as m
from guildbook.plans.frames import frame, table, with_frames
from guildbook.plans.q_rows import DOMAIN_SQL

c = F.col


def _keyed(spark, sf):
    df = frame(spark, sf, "companies").withColumn("name", t.normalize_name(c("company_name"))).withColumn("site", t.extract_domain(c("website")))
    return df.withColumn("word", F.substring_index("name", " ", 1))


def duplicate_pairs(spark, sf):
    pairs = m.candidate_pairs(_keyed(spark, sf), "company_id", ["site", "word"], {"site": 0.3, "city": 0.1, "state": 0.1}, ("name", 0.5))
    return pairs.select("u", "v", F.round("score", 6).alias("score"))


def _clusters(spark, sf):
    df = _keyed(spark, sf)
    return df, m.leader_clusters(m.candidate_pairs(df, "company_id", ["site", "word"], {"site": 0.3, "city": 0.1, "state": 0.1}, ("name", 0.5)))


def merged_companies(spark, sf):
    df, clusters = _clusters(spark, sf)
    out = m.merge_clusters(df, clusters, "company_id", {"company_name": c("company_name") != "", "website": c("website") != "", "phone": c("phone") != ""}, ["employee_count_max", "quality_score"], {"associations": t.text_list(c("associations"))})
    return out.withColumn("associations", F.array_join("associations", ","))


def resolved_entities(spark, sf):
    df, clusters = _clusters(spark, sf)
    return m.resolve_entities(clusters, df, "company_id", "quality_score").withColumn("aliases", F.array_join("aliases", "|"))


def exact_names(spark, sf):
    """One row per name without suffix: the first value that is one."""
    df = frame(spark, sf, "companies").withColumn("key", t.strip_one_suffix(c("company_name")))
    return df.groupBy("key").agg(m.first_truthy("website", c("website") != "", "company_id").alias("website"), m.first_truthy("phone", c("phone") != "", "company_id").alias("phone"), F.count("*").alias("n"))


def best_per_name(spark, sf):
    df = frame(spark, sf, "companies").withColumn("key", t.merge_key(c("company_name")))
    return m.first_per_key(df, ["key"], [F.desc("quality_score"), c("company_id")]).select("key", "company_id", "quality_score")


def provider_waterfall(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", t.extract_domain(c("website")).alias("domain"), "employee_count_min").withColumn("domain", F.nullif("domain", F.lit("")))
    one = df.groupBy("domain").agg(F.min("company_id").alias("k")).filter("domain is not null")
    a = one.filter("k % 3 = 0").select("domain", (c("k") * 10).cast("int").alias("employee_count_min"))
    b = one.filter("k % 2 = 0").select("domain", (c("k") * 20).cast("int").alias("employee_count_min"))
    return j.waterfall(df, "domain", [("clearbit", a), ("apollo", b)], ["employee_count_min"], c("employee_count_min").isNotNull())


def crossref(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", t.extract_domain(c("website")).alias("domain"))
    dns = df.filter("domain <> ''").groupBy("domain").agg((F.min("company_id") % 3 != 0).alias("mx"))
    places = df.filter("company_id % 4 <> 1").select("company_id", (c("company_id") % 5 != 0).alias("place"))
    return j.crossref(df, dns, places).select("company_id", "domain", "score", "issues")


def enriched_merge(spark, sf):
    df = frame(spark, sf, "companies").withColumn("key", t.merge_key(c("company_name"))).withColumn("phone", F.coalesce("phone", F.lit("")))
    base = m.first_per_key(df.filter("company_id % 2 = 0"), ["key"], [c("company_id")])
    return j.merge_enriched(df.filter("company_id % 3 = 0"), base, "key", "company_id", ["phone", "email"])


def profile_overlay(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", "phone", "city")
    return j.overlay(df, df.filter("company_id % 3 = 0").select("company_id", F.lit("").alias("phone"), F.concat(c("city"), F.lit("*")).alias("city")), "company_id", ["phone", "city"])


def both_sources(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", F.coalesce("phone", F.lit("")).alias("phone"), "email")
    return j.full_fill(df.filter("company_id % 3 <> 0"), df.filter("company_id % 2 = 0").withColumn("phone", F.lit("b")), "company_id", ["phone", "email"])


def market_coverage(spark, sf):
    expected = spark.createDataFrame([("PMA", 1000), ("NEMA", 300), ("AGMA", 5000), ("XYZ", 10)], "association string, expected int")
    return j.tam(expected, frame(spark, sf, "memberships"))


def new_companies(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", t.merge_key(c("company_name")).alias("key"))
    return j.mark_new(df, df.filter("company_id % 7 = 0"), "key").select("company_id", "is_new")


def upserted(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", "phone", "city")
    batch = df.filter("company_id % 5 = 0").select((c("company_id") + 100000 * (c("company_id") % 2)).alias("company_id"), F.lit("first").alias("phone"), "city", F.lit(1).alias("turn"))
    later = batch.select("company_id", F.when(c("company_id") % 3 == 0, "second").alias("phone"), F.lit("Later").alias("city"), F.lit(2).alias("turn"))
    return j.upsert(df, batch.unionByName(later), "company_id", "turn", ["phone", "city"])


def audit(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", "phone", "city", "quality_score")
    new = df.filter("company_id % 10 <> 3").withColumn("city", F.when(c("company_id") % 4 == 0, "Moved").otherwise(c("city"))).withColumn("quality_score", c("quality_score") + (c("company_id") % 2).cast("int"))
    return j.audit_diff(df, new, "company_id", ["phone", "city", "quality_score"])


def url_queue(spark, sf):
    e = table(spark, sf, "events").select(F.concat(c("event_type"), F.lit("/"), c("user_id").cast("string")).alias("url"), "event_id", "value")
    return j.enqueue(e, [e.filter("value > 200").select("url"), e.filter("event_id % 50 = 0").select("url")], "url", "event_id").select("url", "event_id")


def _graph(spark, sf):
    f = lambda n: frame(spark, sf, n)
    return g.build_nodes(f("companies"), f("memberships"), f("trade_events"), f("signals")), g.build_edges(f("memberships"), f("trade_events"), f("participants"), f("signals"))


def graph_metrics(spark, sf):
    return g.metrics(*_graph(spark, sf))


def graph_kinds(spark, sf):
    _, edges = _graph(spark, sf)
    return edges.groupBy("kind").agg(F.count("*").alias("n"))


def graph_neighbors(spark, sf):
    _, edges = _graph(spark, sf)
    return g.neighbors(edges, "event:7", 2, ["SPONSOR", "EXHIBITOR", "ATTENDEE"])


def related(spark, sf):
    return g.related_companies(_graph(spark, sf)[1], "company:11")


_GRAPH = """WITH nodes AS (SELECT 'company:' || company_id AS id FROM companies UNION SELECT DISTINCT 'association:' || association FROM memberships UNION SELECT 'event:' || event_id FROM trade_events UNION SELECT DISTINCT 'competitor:' || competitor FROM signals),
edges AS (SELECT 'association:' || association AS source, 'company:' || company_id AS target, 'HAS_MEMBER' AS kind FROM memberships UNION SELECT 'association:' || organizer, 'event:' || event_id, 'HOSTS_EVENT' FROM trade_events
  UNION SELECT 'company:' || company_id, 'event:' || event_id, kind FROM participants UNION SELECT 'company:' || company_id, 'competitor:' || competitor, 'MENTIONED_COMPETITOR' FROM signals) """
_G = ("companies", "memberships", "trade_events", "participants", "signals")
_KEY = "regexp_replace(lower(company_name), '[^a-z0-9]', '', 'g')"
QUERIES = {
    "duplicate_pairs": (duplicate_pairs, None),
    "merged_companies": (merged_companies, None),
    "resolved_entities": (resolved_entities, None),
    "exact_names": (exact_names, with_frames("WITH k AS (SELECT *, lower(trim(CASE " + " ".join(f"WHEN ends_with(company_name, '{x}') THEN left(company_name, length(company_name) - {len(x)})" for x in t.WRITTEN_SUFFIXES) + " ELSE company_name END)) AS key FROM companies) SELECT key, arg_min(website, company_id) FILTER (website <> '') AS website, arg_min(phone, company_id) FILTER (phone <> '') AS phone, count(*) AS n FROM k GROUP BY key", "companies")),
    "best_per_name": (best_per_name, with_frames(f"SELECT key, company_id, quality_score FROM (SELECT *, {_KEY} AS key, row_number() OVER (PARTITION BY {_KEY} ORDER BY quality_score DESC, company_id) AS i FROM companies) WHERE i = 1", "companies")),
    "provider_waterfall": (provider_waterfall, with_frames(f"WITH d AS (SELECT company_id, nullif({DOMAIN_SQL}, '') AS domain, employee_count_min FROM companies), o AS (SELECT domain, min(company_id) AS k FROM d WHERE domain IS NOT NULL GROUP BY 1) SELECT company_id, d.domain, CASE WHEN employee_count_min IS NOT NULL THEN employee_count_min WHEN k % 3 = 0 THEN (k * 10)::INT WHEN k % 2 = 0 THEN (k * 20)::INT END AS employee_count_min, CASE WHEN employee_count_min IS NOT NULL THEN NULL WHEN k % 3 = 0 THEN 'clearbit' WHEN k % 2 = 0 THEN 'apollo' END AS source FROM d LEFT JOIN o ON d.domain = o.domain", "companies")),
    "crossref": (crossref, with_frames(f"WITH d AS (SELECT company_id, {DOMAIN_SQL} AS domain FROM companies), n AS (SELECT domain, min(company_id) % 3 <> 0 AS mx FROM d WHERE domain <> '' GROUP BY 1), x AS (SELECT d.*, n.mx, CASE WHEN company_id % 4 <> 1 THEN company_id % 5 <> 0 END AS place FROM d LEFT JOIN n ON n.domain = d.domain) SELECT company_id, domain, 50 + CASE WHEN mx THEN 20 WHEN NOT mx THEN -20 ELSE 0 END + CASE WHEN place THEN 15 WHEN NOT place THEN -10 ELSE 0 END AS score, concat_ws('; ', CASE WHEN NOT mx THEN 'no mail server' END, CASE WHEN NOT place THEN 'no place found' END, CASE WHEN mx IS NULL THEN 'domain not checked' END) AS issues FROM x", "companies")),
    "enriched_merge": (enriched_merge, with_frames(f"WITH k AS (SELECT company_id, {_KEY} AS key, coalesce(phone, '') AS phone, email FROM companies), b AS (SELECT key, arg_min(phone, company_id) AS phone, arg_min(email, company_id) AS email FROM k WHERE company_id % 2 = 0 GROUP BY 1), e AS (SELECT key, arg_max(phone, company_id) AS phone, arg_max(email, company_id) AS email, arg_min(phone, company_id) AS p1, arg_min(email, company_id) AS e1 FROM k WHERE company_id % 3 = 0 GROUP BY 1) SELECT b.key, coalesce(nullif(b.phone, ''), e.phone) AS phone, coalesce(nullif(b.email, ''), e.email) AS email, 'base' AS origin FROM b LEFT JOIN e USING (key) UNION ALL SELECT key, p1, e1, 'enriched' FROM e ANTI JOIN b USING (key)", "companies")),
    "profile_overlay": (profile_overlay, with_frames("SELECT company_id, phone, CASE WHEN company_id % 3 = 0 THEN city || '*' ELSE city END AS city FROM companies", "companies")),
    "both_sources": (both_sources, with_frames("SELECT company_id, CASE WHEN company_id % 3 <> 0 AND coalesce(phone, '') <> '' THEN phone WHEN company_id % 2 = 0 THEN 'b' END AS phone, CASE WHEN company_id % 3 <> 0 AND email <> '' THEN email WHEN company_id % 2 = 0 THEN email END AS email FROM companies WHERE company_id % 3 <> 0 OR company_id % 2 = 0", "companies")),
    "market_coverage": (market_coverage, with_frames("SELECT association, expected, coalesce(known, 0) AS known, round(100.0 * coalesce(known, 0) / expected, 6) AS percent, greatest(0, expected - coalesce(known, 0)) AS gap, CASE WHEN 100.0 * coalesce(known, 0) / expected >= 80 THEN 'covered' WHEN 100.0 * coalesce(known, 0) / expected >= 30 THEN 'partial' ELSE 'open' END AS status FROM (VALUES ('PMA', 1000), ('NEMA', 300), ('AGMA', 5000), ('XYZ', 10)) e(association, expected) LEFT JOIN (SELECT association, count(DISTINCT company_id) AS known FROM memberships GROUP BY 1) USING (association)", "memberships")),
    "new_companies": (new_companies, with_frames(f"WITH k AS (SELECT company_id, {_KEY} AS key FROM companies) SELECT company_id, key NOT IN (SELECT key FROM k WHERE company_id % 7 = 0) AS is_new FROM k", "companies")),
    "upserted": (upserted, with_frames("WITH b AS (SELECT company_id + 100000 * (company_id % 2) AS company_id FROM companies WHERE company_id % 5 = 0) SELECT coalesce(c.company_id, b.company_id) AS company_id, CASE WHEN b.company_id IS NULL THEN phone WHEN b.company_id % 3 = 0 THEN 'second' ELSE 'first' END AS phone, CASE WHEN b.company_id IS NULL THEN city ELSE 'Later' END AS city FROM companies c FULL JOIN b ON c.company_id = b.company_id", "companies")),
    "audit_diff": (audit, with_frames("WITH n AS (SELECT company_id, phone, CASE WHEN company_id % 4 = 0 THEN 'Moved' ELSE city END AS city, quality_score + company_id % 2 AS quality_score FROM companies WHERE company_id % 10 <> 3), x AS (" + " UNION ALL ".join(f"SELECT c.company_id, '{f}' AS field, c.{f}::VARCHAR AS old_value, n.{f}::VARCHAR AS new_value FROM companies c LEFT JOIN n USING (company_id)" for f in ("phone", "city", "quality_score")) + ") SELECT * FROM x WHERE old_value IS DISTINCT FROM new_value", "companies")),
    "url_queue": (url_queue, "WITH e AS (SELECT event_type || '/' || user_id AS url, event_id, value FROM events) SELECT url, min(event_id) AS event_id FROM e WHERE url NOT IN (SELECT url FROM e WHERE value > 200) AND url NOT IN (SELECT url FROM e WHERE event_id % 50 = 0) GROUP BY 1"),
    "graph_metrics": (graph_metrics, with_frames(_GRAPH + ", d AS (SELECT nodes.id, count(x.id) AS degree FROM nodes LEFT JOIN (SELECT source AS id FROM edges UNION ALL SELECT target FROM edges) x ON x.id = nodes.id GROUP BY 1), e AS (SELECT count(*) AS edges FROM edges) SELECT count(*) AS nodes, any_value(e.edges) AS edges, round(avg(degree), 6) AS avg_degree, max(degree) AS max_degree, min(degree) AS min_degree, round(2.0 * any_value(e.edges) / (count(*) * (count(*) - 1)), 9) AS density FROM d, e", *_G)),
    "graph_kinds": (graph_kinds, with_frames(_GRAPH + "SELECT kind, count(*) AS n FROM edges GROUP BY 1", *_G)),
    "graph_neighbors": (graph_neighbors, with_frames(_GRAPH + ", u AS (SELECT source AS a, target AS b FROM edges WHERE kind IN ('SPONSOR', 'EXHIBITOR', 'ATTENDEE') UNION SELECT target, source FROM edges WHERE kind IN ('SPONSOR', 'EXHIBITOR', 'ATTENDEE')), one AS (SELECT b AS id FROM u WHERE a = 'event:7'), two AS (SELECT DISTINCT u.b AS id FROM one JOIN u ON u.a = one.id) SELECT id, 1 AS depth FROM one UNION ALL SELECT id, 2 FROM two WHERE id <> 'event:7' AND id NOT IN (SELECT id FROM one)", *_G)),
    "related_companies": (related, with_frames(_GRAPH + ", p AS (SELECT DISTINCT source, target FROM edges WHERE kind IN ('SPONSOR', 'EXHIBITOR', 'ATTENDEE')) SELECT p.source AS id, count(*) AS shared FROM p JOIN p q ON q.target = p.target AND q.source = 'company:11' WHERE p.source <> 'company:11' GROUP BY 1", *_G)),
}
