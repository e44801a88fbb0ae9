import hashlib
import re

from pyspark.sql import functions as F

from guildbook.llm import op1_pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = {
        "email": lambda s: True,
        "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)),
        "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    out = {k: [(m.start(), m.end()) for m in re.finditer(p, text) if good[k](m[0])] for k, p in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))}
    said = ",".join(f"{k}:{a}:{b}" for k in out for a, b in out[k])
    return [len(v) for v in out.values()] + [hashlib.sha256(said.encode()).hexdigest()], said


TEXTS = [
    None, "", "no data here", "a.b@c.d mail me at x_y@mail.example.com.", "a@b.c_x@d.e @@ a@b", "é😀 jo@exämple.com jo@mail.example.org",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.002.3.4 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111",
    "+1 (152) 555-8590 +123 +12 +1234567890123456 + 1 +49 30 123456-", "9" * 5000, "1 " * 4000 + "x", "a" * 3000 + "@" + "b." * 50 + "c",
    "Contact James Miller, phone 555-123-4567 or (555) 222-3333; ssn 123-45-6789; jim [at] mail [dot] com",
] + ["call me: +1 (202) 555-0143, mail a.b@mail.example.com"] * 3


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, rank int")


def test_base_spans_match_brute_force(spark):
    got = {r["doc_id"]: r for r in with_digest(op1_pii.find_pii(rows(spark, TEXTS))).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        want, said = brute(text)
        assert [got[i][c] for c in ("email", "ip", "card", "phone", "sha")] == want, text
        spans = set(got[i]["all"].split(",")) - {""}
        assert set(said.split(",")) - {""} <= spans


def with_digest(found):
    found = found.withColumn("sure", F.filter("spans", lambda s: s["base"]))
    counts = [op1_pii.count(r.kind).alias(r.kind) for r in op1_pii.BASE]
    return found.select("doc_id", *counts, F.sha2(op1_pii.joined(F.col("sure"), op1_pii.KINDS), 256).alias("sha"), op1_pii.joined(F.col("spans"), op1_pii.KINDS).alias("all"))


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op1_pii.op1_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == brute(d["text"])[0]


def test_empty_table(spark):
    assert op1_pii.find_pii(rows(spark, [])).count() == 0


def test_em_trusts_agreeing_labelers(spark):
    """Two labelers that agree on what is true and one that votes at random: the first two are trusted more."""
    votes = [((2, 2, 0, 2), 60), ((2, 2, 0, 0), 30), ((1, 1, 0, 2), 50), ((1, 1, 0, 1), 40), ((1, 0, 0, 1), 20)]
    df = spark.createDataFrame([([3 * i + v for i, v in enumerate(vs)], float(n)) for vs, n in votes], "v array<int>, n double")
    m = df.agg(F.collect_list(F.struct("v", "n")).alias("p")).select(op1_pii._em(F.col("p")).alias("m")).first()["m"]
    assert m["pos"][2] > 0.8 and m["neg"][1] > 0.7 and 0.3 < m["prior"] < 0.6


def test_a_long_log_of_addresses(spark):
    """Time grows with the number of matches, not with its square; every base span is found, and no other lies over one."""
    line, n = "10.0.0.1 a.b@c.org call (555) 222-3333\n", 20_000
    row = op1_pii.find_pii(rows(spark, [line * n])).first()
    by_kind = {}
    for s in row["spans"]:
        by_kind.setdefault(op1_pii.KINDS[s["rank"]], []).append((s["at"], s["to"]))
    assert by_kind["ip"] == [(len(line) * i, len(line) * i + 8) for i in range(n)]
    assert by_kind["email"] == [(len(line) * i + 9, len(line) * i + 18) for i in range(n)]
