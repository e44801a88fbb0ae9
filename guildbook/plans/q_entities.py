"""Queries of entities over two runs, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import text as t
from guildbook.operators import accounts as ac
from guildbook.operators import entities as en
from guildbook.operators import graph as g
from guildbook.operators import intel as it
from guildbook.operators import match as m
from guildbook.plans.frames import frame, with_frames

c = F.col
FIELDS = ["domain", "phone", "city", "employee_count_min"]


def _find(rows):
    keys = rows.select("ord", "domain", t.deep_normalize_name(c("company_name")).alias("name"), F.coalesce(t.last_ten(c("phone")), F.lit("")).alias("phone"), F.lit("").alias("address"))
    return m.score_entity_pairs(keys, "ord", ["domain", "phone"])


def _runs(spark, sf, strategy):
    rows = frame(spark, sf, "records")
    first = en.resolve(rows.filter("run = 1").drop("run"), None, _find, "row_id", FIELDS, strategy)
    return first, en.resolve(rows.filter("run = 2").drop("run"), first["entities"], _find, "row_id", FIELDS, strategy)


def _plain(entities):
    return entities.select("entity_id", "at", "company_name", "quality_score", *FIELDS, F.array_join("associations", ",").alias("associations"), F.array_join("provenance", ",").alias("provenance"), "records")


def best_entities(spark, sf):
    return _plain(_runs(spark, sf, "keep_best")[1]["entities"])


def merged_entities(spark, sf):
    return _plain(_runs(spark, sf, "merge_all")[1]["entities"])


def entity_members(spark, sf):
    return _runs(spark, sf, "keep_best")[1]["members"]


def entity_aliases(spark, sf):
    first, second = _runs(spark, sf, "keep_best")
    return en.alias_table([first["aliases"], second["aliases"]], second["entities"])


def all_related(spark, sf):
    """Companies by shared events, one of which a third of all attend."""
    edges = frame(spark, sf, "participants").select(F.concat(F.lit("company:"), "company_id").alias("source"), F.concat(F.lit("event:"), "event_id").alias("target"), "kind")
    large = frame(spark, sf, "companies").filter("company_id % 3 = 0").select(F.concat(F.lit("company:"), "company_id").alias("source"), F.lit("event:0").alias("target"), F.lit("ATTENDEE").alias("kind"))
    return g.all_related(edges.unionByName(large), few=5)


def _shows(spark, sf):
    return frame(spark, sf, "trade_events").select("event_id", F.concat(F.element_at(F.split(F.lit("Steel Expo|FABTECH/Weld Days|IMTS Show|Tube Fair"), r"\|"), (c("event_id") % 4 + 1).cast("int")), F.lit(" "), (c("event_id") % 12).cast("string")).alias("event_name"), F.when(c("event_id") % 3 == 0, "High").otherwise("LOW").alias("priority"))


def _present(spark):
    rows = [("Epicor", "Seen at fabtech and steelworks meetings", "high"), ("Infor", "IMTSX booth; Expositions", "Emerging"), ("Plex", "none", "HIGH"), ("Sage", "Tube and weld, STEEL", "LOW"), ("Odoo", None, "HIGH"), ("Infor", "the shows", "low")]
    return spark.createDataFrame(rows, "competitor string, presence string, threat_level string")


def competitor_events(spark, sf):
    return ac.events_for_competitor(_present(spark), _shows(spark, sf))


def threatened_events(spark, sf):
    return it.threatened_events(_shows(spark, sf), _present(spark))


def account_events(spark, sf):
    """Tracked competitors with the companies that run their systems and the events that they are present at."""
    found = frame(spark, sf, "companies").select("company_id", F.when(c("company_id") % 4 == 0, "Epicor Kinetic").when(c("company_id") % 4 == 1, "Sage").otherwise("").alias("competitor"), F.lit("PMA;NEMA").alias("associations"))
    return it.competitor_accounts(_present(spark).select(c("competitor").alias("name"), "presence").filter("presence is not null and presence <> 'the shows'"), found, _shows(spark, sf))


#: Of each customer: whether it has the second, third and fourth record; base: the best of the first three.
_S = "s AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS two, c_custkey % 2 = 0 AS three, c_custkey % 5 = 0 AS four, CASE WHEN c_custkey % 3 = 0 THEN 2 WHEN c_custkey % 2 = 0 THEN 3 ELSE 1 END AS best FROM customer)"
_ID = "'e' || substr(sha256({0}::VARCHAR || chr(0) || {1}), 1, 16)"
_OLD, _NEW = _ID.format("(k * 10 + 1)", "'Firm' || k || ' Works'"), _ID.format("(k * 10 + 4)", "'Other' || k || ' Group'")
_NAME = "CASE best WHEN 1 THEN 'Firm' || k || ' Works' WHEN 2 THEN 'Firm' || k || ' Works LLC' ELSE 'FIRM' || k || ' WORKS, Inc.' END"
_REST = f"""CASE WHEN two THEN 'NEMA,PMA' ELSE 'PMA' END AS associations,
  CASE WHEN two AND three THEN 'run1-2,run1-1,run2-3' WHEN two THEN 'run1-2,run1-1' WHEN three THEN 'run2-3,run1-1' ELSE 'run1-1' END AS provenance, (1 + two::INT + three::INT)::BIGINT AS records FROM s
UNION ALL SELECT {_NEW}, k * 10 + 4, 'Other' || k || ' Group', 20, 'o' || k || '.com', '', 'Gary', NULL, 'AGMA', 'run2-4', 1 FROM s WHERE four"""

_SHOWS = "WITH v AS (SELECT event_id, event_id % 4 AS i, (list_value('Steel Expo', 'FABTECH/Weld Days', 'IMTS Show', 'Tube Fair'))[event_id % 4 + 1] || ' ' || (event_id % 12) AS event_name FROM trade_events)"

QUERIES = {
    "best_entities": (best_entities, f"WITH {_S} SELECT {_OLD} AS entity_id, k * 10 + 1 AS at, {_NAME} AS company_name, CASE best WHEN 1 THEN 50 WHEN 2 THEN 70 ELSE 60 END AS quality_score, 'f' || k || '.com' AS domain, CASE WHEN best = 3 THEN '(555) 123-4567' ELSE '' END AS phone, CASE WHEN best = 2 THEN 'Akron' END AS city, CASE best WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 30 END AS employee_count_min, {_REST}"),
    "merged_entities": (merged_entities, f"WITH {_S} SELECT {_OLD} AS entity_id, k * 10 + 1 AS at, {_NAME} AS company_name, CASE best WHEN 1 THEN 50 WHEN 2 THEN 70 ELSE 60 END AS quality_score, 'f' || k || '.com' AS domain, CASE WHEN three THEN '(555) 123-4567' END AS phone, CASE WHEN two THEN 'Akron' END AS city, CASE WHEN three THEN 30 ELSE 10 END AS employee_count_min, {_REST}".replace("'o' || k || '.com', ''", "'o' || k || '.com', NULL")),
    "entity_members": (entity_members, f"WITH {_S} SELECT k * 10 + 3 AS row_id, {_OLD} AS entity_id FROM s WHERE three UNION ALL SELECT k * 10 + 4, {_NEW} FROM s WHERE four"),
    "entity_aliases": (entity_aliases, f"""WITH {_S}, n AS (SELECT k, {_NAME} AS name, {_OLD} AS entity_id, unnest(list_value('Firm' || k || ' Works', CASE WHEN two THEN 'Firm' || k || ' Works LLC' END, CASE WHEN three THEN 'FIRM' || k || ' WORKS, Inc.' END)) AS alias FROM s)
SELECT entity_id, alias FROM n WHERE alias IS NOT NULL AND alias <> name"""),
    "all_related": (all_related, with_frames("""WITH e AS (SELECT DISTINCT 'company:' || company_id AS id, 'event:' || event_id AS ev FROM participants UNION SELECT 'company:' || company_id, 'event:0' FROM companies WHERE company_id % 3 = 0),
p AS (SELECT a.id, b.id AS other, count(*) AS shared FROM e a JOIN e b ON a.ev = b.ev AND a.id <> b.id GROUP BY 1, 2), r AS (SELECT *, count(*) OVER (PARTITION BY id) AS related, row_number() OVER (PARTITION BY id ORDER BY shared DESC, other)::INT AS rank FROM p)
SELECT id, related, rank, other, shared FROM r WHERE rank <= 5""", "companies", "participants")),
    "competitor_events": (competitor_events, with_frames(f"{_SHOWS}, m(competitor, i) AS (VALUES ('Epicor', 0), ('Epicor', 1), ('Infor', 0), ('Infor', 2), ('Infor', 5), ('Sage', 0), ('Sage', 1), ('Sage', 3)), h AS (SELECT DISTINCT competitor, event_name FROM m JOIN v ON v.i = m.i OR m.i = 5 AND v.i = 2) SELECT competitor, string_agg(event_name, '; ' ORDER BY event_name) AS events FROM h GROUP BY 1", "trade_events")),
    "threatened_events": (threatened_events, with_frames(f"{_SHOWS}, m(competitor, i) AS (VALUES ('Epicor', 0), ('Infor', 0), ('Infor', 2)) SELECT DISTINCT event_name, competitor FROM v JOIN m USING (i) WHERE event_id % 3 = 0", "trade_events")),
    "account_events": (account_events, with_frames(f"""{_SHOWS}, m(name, i) AS (VALUES ('Epicor', 0), ('Epicor', 1), ('Infor', 0), ('Infor', 2), ('Sage', 0), ('Sage', 1), ('Sage', 3), ('Plex', -1)), h AS (SELECT DISTINCT name, event_name FROM m LEFT JOIN v USING (i)),
n AS (SELECT name, coalesce(string_agg(event_name, '; ' ORDER BY event_name), '') AS events FROM h GROUP BY 1) SELECT name, (SELECT count(*) FROM companies WHERE company_id % 4 = CASE name WHEN 'Epicor' THEN 0 WHEN 'Sage' THEN 1 ELSE 9 END) AS companies, CASE WHEN name IN ('Epicor', 'Sage') THEN 'NEMA; PMA' ELSE '' END AS associations, events FROM n""", "trade_events", "companies")),
}
