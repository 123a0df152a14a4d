import hashlib
import re

from pyspark.sql import functions as F

from corpuslens.llm import pii
from corpuslens.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for place, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), place, m.end(), kind))
    return sorted(out)


ODD = [
    None, "", "a@b.c", "a@b.c%x@d.e-f.g", "a@b @c.d x@y..z a@b.", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255 1.2.3.0000000000999",
    "😀é x@y.zz 4111 1111 1111 1111, 4111-1111-1111-1112 +1 (524) 555-7373.", "+1 (524) 555-7373 4040549990366437",
    "953013749 4550997810720808", "+12345678901234567 +1+2345678901 +1 2 3", "9" * 100_000, "1 " * 50_000, "a" * 200_000 + "@",
    "a." * 40_000 + "b@c.d", "x@y" + ".z" * 30_000, "+" * 1000 + "1" + " " * 50_000 + "2", "\n1.2.3.4\n5.6.7.8",
    "mail joe [at] site [dot] org or 524-555-7373", "12.12.12.12 " * 3_000,
]


def test_base_spans_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "n", "x") for i, t in enumerate(ODD)] * 2, "doc_id LONG, text STRING, kind STRING, base STRING")
    out = pii.report(df).collect()
    assert len(out) == 2 * len(ODD)
    for r in out:
        assert [tuple(s) for s in r.base] == [(a, p + 1, b, k) for a, p, b, k in brute(ODD[r.doc_id])], ODD[r.doc_id][:60]
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op1_weak_supervision_pii"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        base = brute(texts[r.doc_id])
        spans = [f"{k}:{a}:{b}" for a, _, b, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in base) for k in pii.KINDS]


def corpus(spark):
    rows = [(i, f"word{i} call +1 (5{i % 90 + 10}) 555-{1000 + i} or 10.{i % 200}.3.4 now", "en", "s", 7) for i in range(200)]
    rows += [(1000, "see +1 (524) 555-7373 4040549990366437 end", "en", "s", 7), (1001, "clean text 555-1234 of 2024", "en", "s", 7),
             (1002, None, "en", "s", None), (1003, "é😀 12.1.2.3", "en", "s", 3), (1003, "other 12.1.2.3 text", "en", "s", 3)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")


def test_spans_beyond_the_base_and_redaction(spark):
    df = corpus(spark)
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.report(df).collect()}
    assert found[1000] == ["phone", "card"] and found[1001] == []
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    rows = {(r.doc_id, r.text): r.n_chars for r in out.collect()}
    assert (1000, "see [PHONE] [CARD] end") in rows and (1001, "clean text 555-1234 of 2024") in rows
    assert rows[1003, "é😀 [IP]"] == 7 and rows[1002, None] is None and rows[1001, "clean text 555-1234 of 2024"] == 7
    assert (1003, "other [IP] text") in rows
    assert not out.filter(F.col("text").rlike(r"555-[0-9]{4} or|[0-9]+\.[0-9]+\.[0-9]+")).count()


def test_reliabilities_tell_good_labelers(spark):
    rows = []
    for i in range(400):
        true = i % 4 != 0
        rows.append(("card", *[int(true) for _ in range(4)], i % 2, int(true or i % 8 == 0)))
    voted = spark.createDataFrame(rows, ["kind", *pii.VOTES])
    (model,) = pii.reliabilities(voted).collect()
    assert abs(model.prior - 0.75) < 0.02
    assert model.yes[0] > 0.95 and model.no[0] < 0.05 and abs(model.yes[4] - model.no[4]) < 0.7


def test_native_plan(spark, sf):
    plan = QUERIES["op1_weak_supervision_pii"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    df = corpus(spark).filter("doc_id < 0")
    assert pii.report(df).collect() == [] and pii.redact(df).collect() == []
