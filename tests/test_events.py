import datetime as d

from pyspark.sql import functions as F

from guildbook.functions import events as e

c = F.col


def test_dates_and_places(spark):
    texts = ["Join us January 15-17, 2024 in Akron", "Jan 30 - February 2, 2024", "On March 3, 2025 and April 4, 2025", "2024-05-06 only", "no date", "Feb 31, 2024"]
    got = [tuple(r[0]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(e.event_dates(c("t"))).collect()]
    assert got == [(d.date(2024, 1, 15), d.date(2024, 1, 17)), (d.date(2024, 1, 30), d.date(2024, 2, 2)), (d.date(2025, 3, 3), d.date(2025, 4, 4)), (d.date(2024, 5, 6), None), (None, None), (None, None)]
    places = ["New Orleans, LA", "somewhere in Ohio", "Main hall", "Online"]
    got = [tuple(r[0]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(places)], "i int, t string").orderBy("i").select(e.location(c("t"))).collect()]
    assert got == [(None, "New Orleans", "LA", False), (None, None, "OH", False), ("Main hall", None, None, False), ("Online", None, None, True)]


def test_addresses_and_headers(spark):
    df = spark.createDataFrame([("1 Main St\nSuite 2\nAKRON, OH 44301", ["Member", "St", "x"], [" Acme ", "OH", "1"])], "t string, h array<string>, v array<string>")
    row = df.select(e.address_block(c("t")).alias("a"), e.map_headers(c("h"), c("v")).alias("m")).first()
    assert tuple(row["a"]) == ("1 Main St, Suite 2", "Akron", "OH", "44301") and row["m"] == {"company_name": "Acme", "state": "OH"}


def test_told_dates(spark):
    texts = {"2025-03-04T09:00Z": (2025, 3, 4), "2025/3/4": (2025, 3, 4), "20250304": (2025, 3, 4), "202503045": None, "Sept. 4th, 2025": (2025, 9, 4), " Tuesday, 4 March 2025 8pm": (2025, 3, 4), "4/13/2025": (2025, 4, 13), "13.4.2025": (2025, 4, 13), "2025": None, "April 31, 2025": None, "": None, None: None}
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(e.told_date(c("t"))).collect()] == [x and d.date(*x) for x in texts.values()]
