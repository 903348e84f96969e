import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from starmart.llm import pii as P
from starmart.llm.arrays import least, largest, scan, total

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_ok(kind, s):
    digits = [int(c) for c in s if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    text = text or ""
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items())
             for m in re.finditer(p, text) if plain_ok(kind, m[0])]
    spans.sort()
    line = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    return [sum(s[3] == k for s in spans) for k in PLAIN], hashlib.sha256(line.encode()).hexdigest(), line


TEXTS = [None, "", "plain", "mail a.b+c@x-y.example.com, or 1.2.3.4!", "a@b.c_d@e.f a@b a@b. @x.y x@y.z@w.v.u",
         "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 0.0.0.0.", "4111 1111-1111 1111 4111111111111112 4--1",
         "+1 (203) 555-8282. +12 3 +1234567890123456 +1) 5 ++49 30 1234567 (", "ñ🙂 🙂é ü@x.de 漢a@b.cd 🙂+1 (203) 555-8282",
         "5 " * 3000 + "end 4111111111111111", "9" * 20000, "a" * 20000 + "@b.c" + ".d" * 5000, "a.b@" * 2000,
         "1." * 5000, "+1" + "(" * 5000, "x@y.zz " * 400, "+1 (203) 555-8282 " * 300]


def check(rows, got):
    got = sorted((r.asDict() for r in got.collect()), key=str)
    want = []
    for i, t in rows:
        counts, sha, line = plain(t)
        want.append((i, *counts, sha, line))
    assert sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got),
                  key=str) == sorted((w[:-1] for w in want), key=str)
    return {r["doc_id"]: r["spans"] for r in got}


def test_base_spans_against_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a@b.cd"), (3, TEXTS[3]), (3, TEXTS[3])]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, base string, kind int")
    spans = check(rows, P.find_pii(df, P.Model([], {})))
    assert spans[8] == plain(TEXTS[8])[2]


def test_random_texts(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice("01256 .-+()@aZ_%\né🙂") for _ in range(rng.randint(0, 80)))) for i in range(600)]
    check(rows, P.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), P.Model([], {})))


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17, 300, 5000])
def test_scans(spark, n):
    rng = random.Random(n)
    values = [rng.choice([None, *range(50)]) for _ in range(n)]
    plain_values = [v or 0 for v in values]
    df = spark.createDataFrame([(plain_values, values)], "v array<int>, w array<int>")
    r = df.select(scan(F.col("v"), total).alias("t"), scan(F.col("w"), largest).alias("m"),
                  scan(F.col("w"), least, -1).alias("l")).first()
    assert r.t == [sum(plain_values[:i + 1]) for i in range(n)]
    assert r.m == [max([x for x in values[:i + 1] if x is not None], default=None) for i in range(n)]
    assert r.l == [min([x for x in values[i:] if x is not None], default=None) for i in range(n)]


def corpus():
    rng = random.Random(5)

    def luhn_number():
        head = [4] + [rng.randint(0, 9) for _ in range(14)]
        return next("".join(map(str, [*head, d])) for d in range(10) if plain_ok("card", "".join(map(str, [*head, d]))))

    rows = []
    for i in range(1000):
        kind = i % 5
        value = [f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", luhn_number(), str(rng.randint(10, 99999)),
                 f"us{i}@host{i % 7}.example.com", f"{i % 250}.7.{i % 9}.{i % 200}"][kind]
        rows.append((i, f"some words then {value} and more words"))
    return rows


def test_trees_add_what_looks_alike(spark):
    rows = corpus() + [(1004, "some words then 4111111111111112 and more words"), (1005, "call us(at)host7.example.com now"),
                       (1006, "clean text in year 1999"), (1007, None)]
    got = check(rows, P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")))
    assert "card:16:32" in got[1004]
    assert got[1006] == "" and got[1007] == ""
    for i, t in rows:
        assert set(filter(None, plain(t)[2].split(","))) <= set(got[i].split(","))


def test_tree_expression_scores_like_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = random.Random(2)
    rows = [[rng.randint(0, 9) for _ in P.FEATURES] for _ in range(300)]
    df = spark.createDataFrame([(*r, int(r[4] + r[6] > 9)) for r in rows], [*P.FEATURES, "label"])
    data = VectorAssembler(inputCols=list(P.FEATURES), outputCol="vector").transform(df)
    fitted = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=5, maxDepth=3, seed=1).fit(data)
    model = P.Model([(w, t.toDebugString) for w, t in zip(fitted.treeWeights, fitted.trees)], {})
    out = fitted.transform(data).select(vector_to_array("probability")[1].alias("p"),
                                        model.score({f: F.col(f) for f in P.FEATURES}).alias("q")).collect()
    assert all(abs(r.p - r.q) < 1e-9 for r in out)


def test_overlaps_and_redaction(spark):
    schema = "text string, base array<struct<start:int,kind:int,end:int>>, extra array<struct<start:int,kind:int,end:int>>"
    text = "0123456789é" * 1500
    rows = [(text, [(2, 0, 5), (4, 1, 9), (5000, 2, 9000)], [(3, 3, 4), (9, 3, 12), (11, 3, 13), (14, 1, 16), (4999, 1, 5001)]),
            (text, [], [(0, 0, 1), (len(text) - 1, 1, len(text))]), (text, [], []), ("", [], [])]
    df = spark.createDataFrame(rows, schema)
    df = df.withColumn("all", P.without_overlaps(F.col("base"), F.col("extra")))
    out = df.withColumn("red", P.redacted(F.col("text"), F.col("all"))).collect()
    assert [tuple(s) for s in out[0]["all"]] == [(2, 0, 5), (4, 1, 9), (9, 3, 12), (14, 1, 16), (5000, 2, 9000)]
    assert out[0].red == (text[:2] + "[EMAIL]" + "[PHONE]" + text[12:14] + "[IP]" + text[16:5000] + "[CARD]" + text[9000:])
    assert out[1].red == "[EMAIL]" + text[1:-1] + "[IP]" and out[2].red == text and out[3].red == ""


def test_plan_is_native_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    df = P.find_pii(empty)
    assert df.count() == 0 and "Python" not in df._jdf.queryExecution().toString()


def test_thresholds_come_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(P, "SAMPLE_DOCS", 200)  # its held-out quarter has about 10 documents of a kind
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    assert {P.KINDS.index("card"), P.KINDS.index("email")} <= set(P.fit(df).thresholds)


def loose_corpus(each):
    """Texts with announced numbers and addresses in base form, and per loose form ``each`` texts with its span."""
    rng = random.Random(8)
    rows, want = [], {}

    def luhn(head):
        return next(head + str(d) for d in range(10) if plain_ok("card", head + str(d)))

    def card(gap):
        digits = luhn("4" + "".join(str(rng.randint(0, 9)) for _ in range(14)))
        return gap.join(digits[i:i + 4] for i in range(0, 16, 4))

    def phone(form):
        return form.format(rng.randint(200, 999), rng.randint(1000, 9999))

    def add(lead, kind, value, tail, loose):
        if loose:
            want[len(rows)] = f"{kind}:{len(lead)}:{len(lead) + len(value)}"
        rows.append((len(rows), lead + value + tail))

    for i in range(1500):
        add("please call ", "phone", phone("+1 ({}) 555-{}"), " today", False)
        add("write mail to ", "email", f"us{i}@host{i % 7}.example.com", " soon", False)
        add("the server ", "ip", f"{i % 250}.7.{i % 9}.{i % 200}", " is down", False)
        add("pay with card ", "card", card(" "), " now", False)
        add("it has order ", "none", f"{rng.randint(10 ** 9, 10 ** 10 - 1)}", " in stock", False)
    for i in range(each):
        add("please call ", "phone", phone("({}) 555-{}"), " today", True)
        add("please call ", "phone", phone("1 ({}) 555-{}"), " today", True)
        add("write mail to ", "email", f"joe{i} (at) host{i % 7} (dot) com", " soon", True)
        add("write mail to ", "email", f"joe{i}[at]host{i % 7}[dot]org", " soon", True)
        add("write mail to ", "email", f"joe{i} @ host{i % 7}.example.com", " soon", True)
        add("write mail to ", "email", f"j\u00f6rg.m\u00fcller{i}@firma.de", " soon", True)
        add("the server ", "ip", f"{i % 250} . 7 . {i % 9} . {i % 200}", " is down", True)
        add("pay with card ", "card", card("."), " now", True)
        add("pay with card ", "card", card("\u00a0"), " now", True)
    return rows, want


def test_loose_forms_are_found_and_orders_left_alone(spark):
    rows, want = loose_corpus(40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    model = P.fit(df)
    got = check(rows, P.find_pii(df, model))
    for i, span in want.items():
        assert span in got[i].split(","), (rows[i], got[i])
    orders = [i for i, t in rows if t.startswith("it has order")]
    assert all(got[i] == "" for i in orders)
    clean = {r.doc_id: r.text for r in P.without_pii(df, model).collect()}
    assert all(clean[i] == "write mail to [EMAIL] soon" for i in want if rows[i][1].startswith("write mail to j\u00f6rg"))


def test_overlaps_against_brute_force(spark):
    rng = random.Random(4)

    def spans(n):
        out = []
        for kind in range(4):  # spans of a kind do not overlap
            at = 0
            for _ in range(n):
                start = at + rng.randint(0, 9)
                at = start + rng.randint(1, 6)
                out.append((start, kind, at))
        return sorted(out)

    def brute(base, extra):
        kept = list(base)
        for e in extra:
            earlier = [x for x in extra if (x[0], x[1]) < (e[0], e[1])]
            if e in base or any(x[2] > e[0] for x in earlier):
                continue
            over = [b for b in base if b[0] < e[2] and e[0] < b[2]]
            if all(e[1] == b[1] == 0 and e[0] <= b[0] and b[2] <= e[2] for b in over):
                kept.append(e)
        return sorted(kept)

    rows = [(i, spans(rng.randint(0, 5)), spans(rng.randint(0, 5))) for i in range(400)]
    span = "array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(rows, f"i int, base {span}, extra {span}").repartition(4)
    got = {r.i: [tuple(s) for s in r.spans] for r in df.select(
        "i", P.without_overlaps(F.col("base"), F.col("extra")).alias("spans")).collect()}
    assert got == {i: brute(b, e) for i, b, e in rows}
