"""The battery against the tests' plain formulas, and added spans on planted strings."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from signmine.llm import secrets

SIGNS = {name: alphabet for name, _, alphabet in secrets.ALPHABETS}
SIGNS["hex"] = SIGNS["hex"].upper()  # small ones of 24 and more are base spans


def plain_p(s):
    name, _, alphabet = next(x for x in secrets.ALPHABETS if re.match(x[1], s))
    s = {"hex": s.lower(), "base36": s.lower()}.get(name, s.replace("_", "/").replace("-", "+"))
    c, k, n = [alphabet.index(x) for x in s], len(alphabet), len(s)
    tail = lambda z: 1 / (1 + math.exp(min(300, 1.5976 * z + 0.07056 * z**3)))
    chi = sum((c.count(x) - n / k) ** 2 / (n / k) for x in range(k))
    z1 = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    up = [x >= k / 2 for x in c]
    a, b = sum(up), n - sum(up)
    spread = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    z2 = abs(1 + sum(x != y for x, y in zip(up, up[1:], strict=False)) - (1 + 2 * a * b / n)) / math.sqrt(spread) if spread > 0 else 9
    m = sum(c) / n
    var = sum((x - m) ** 2 for x in c)
    z3 = abs(sum((x - m) * (y - m) for x, y in zip(c, c[1:], strict=False)) / var + 1 / n) * math.sqrt(n) if var > 0 else 9
    return name, max(1e-16, min(1, 3 * min(tail(z1), 2 * tail(z2), 2 * tail(z3))))


def test_battery_is_that_of_the_plain_formulas(spark):
    rng = random.Random(1)
    made = ["".join(rng.choice(a) for _ in range(rng.randint(20, 90))) for a in (*SIGNS.values(), "ABCdef0123-_/+xyz", "a1") for _ in range(25)] + ["a" * 30 + "1"]
    for r in spark.createDataFrame([(s,) for s in made], "s string").select("s", secrets.battery(F.col("s")).alias("t")).collect():
        name, p = plain_p(r["s"])
        assert (r["t"]["encoding"], r["t"]["n"]) == (name, len(r["s"])) and r["t"]["p"] == pytest.approx(p, rel=1e-6, abs=1e-12)


def test_planted_random_strings_are_added_and_written_ones_are_not(spark, medium):
    rng = random.Random(5)
    rows = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    words = [w for r in rows for w in (r["text"] or "").split() if w.isascii() and w.isalpha()]
    docs, planted = [], {}
    for i, r in enumerate(rows):
        t = r["text"] or ""
        if i % 4 == 0:
            n, name = rng.choice((28, 32, 40, 64, 128)), rng.choice(list(SIGNS))
            s = "".join(rng.choice(SIGNS[name]) for _ in range(n - 1)) + rng.choice("23456")
        elif i % 4 == 1:
            n, name = rng.choice((24, 32, 40, 64, 128)), None
            s = rng.choice(["_", "-", "/", ""]).join(rng.choice([str.lower, str.title])(rng.choice(words)) for _ in range(60))[: n - 2] + str(rng.randint(10, 99))
        else:
            docs.append((i, t))
            continue
        docs.append((i, f"{t} see {s} there"))
        planted[i] = (name, n, len(t) + 5)
    found = {r["doc_id"]: {(s["start"], s["end"]) for s in r["added"]} for r in secrets.find_secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hits = {i: (at, at + n) in found[i] for i, (name, n, at) in planted.items() if name}
    added = sum(map(len, found.values()))
    assert sum(hits.values()) > 0.9 * len(hits) and sum(hits.values()) > 0.85 * added


def test_written_strings_are_made_of_the_whole_text(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12)))
    texts = ["", "a b c", "\u0436 12", *[" ".join(word() for _ in range(n)) for n in (*range(10, 300, 7), 2000)], *["a " * n + "b" for n in range(190, 260)], "x" * 5000, "one-\u0436 TWO\n" * 400]
    for t, made in spark.createDataFrame([(t,) for t in texts], "t string").select("t", secrets.written(F.col("t"), F.xxhash64("t"))).collect():
        letters = [c for c in t.lower() if "a" <= c <= "z"]
        want = letters if len(letters) >= 20 else []
        assert [c for s in made for c in s.lower() if c.isalpha()] == want
        assert all(len(s) >= 20 and re.search("[0-9]", s) for s in made)


def test_thresholds_count_what_stands_far_inside_a_text(spark):
    words = ["lorem", "ipsum", "dolor", "amet"]
    docs = spark.createDataFrame([(1, " ".join(words * 5000))], "doc_id long, text string")
    (n,) = secrets.scanned(docs).select(F.sum(F.size("written"))).first()
    assert n > 100  # 95,000 letters, five strings of 20 to 200 and some in each passage


def test_spans_that_share_a_place_with_base_spans_are_left_out(spark):
    rng = random.Random(3)
    kind = "array<struct<start:int,end:int,body:string>>"
    draw = lambda: sorted((a, a + rng.randint(1, 6), "") for a in rng.sample(range(80), rng.randint(0, 12)))
    rows = [(i, draw(), draw()) for i in range(60)]
    for r in spark.createDataFrame(rows, f"i int, found {kind}, base {kind}").withColumn("rest", secrets.apart(F.col("found"), F.col("base"))).collect():
        want = [tuple(s) for s in r["found"] if not any(b["start"] < s["end"] and s["start"] < b["end"] for b in r["base"])]
        assert [tuple(s) for s in r["rest"]] == want


def test_many_matches_in_one_text(spark):
    took = []
    for n in (8000, 32_000):
        docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.repeat(F.lit("0123456789abcdef0123456789abcdef x "), n).alias("text"))
        began = time.perf_counter()
        row = secrets.digest(secrets.find_secrets(docs)).first()
        assert row["n_hex"] == n and row["spans"].count(",") == n - 1
        took.append(time.perf_counter() - began)
    assert took[1] < 6 * took[0] + 4


def test_battery_of_long_even_and_uneven_strings(spark):
    rng = random.Random(2)
    made = ["".join(rng.choice(a) for _ in range(n)) for a in SIGNS.values() for n in (2, 20, secrets.SHORT - 1, secrets.SHORT, secrets.SHORT + 1, 3000)]
    made += [tail * n + head for n in (secrets.SHORT - 1, secrets.SHORT, 40) for tail, head in (("_", "-"), ("_", "/"), ("-", "+"), ("/", "A"), ("a", "9"), ("zA", "z"))]
    made += ["_/-+" * 30, "ab12" * 10, "A2" * 20, "9f" * 12 + "0", "theQuickBrownFox" * 8 + "7"]
    got = {r["s"]: r["t"] for r in spark.createDataFrame([(s,) for s in made], "s string").select("s", secrets.battery(F.col("s")).alias("t")).collect()}
    for s in made:
        name, p = plain_p(s)
        assert (got[s]["encoding"], got[s]["n"]) == (name, len(s)) and got[s]["p"] == pytest.approx(p, rel=1e-6, abs=1e-15)


def test_strings_that_one_test_settles_are_spared_the_others(spark, medium, monkeypatch):
    tail, seen = secrets._normal_tail, []

    def first_only(z):
        seen.append(z)
        return tail(z) if len(seen) == 1 else F.raise_error(F.lit("another test")).cast("double")

    monkeypatch.setattr(secrets, "_normal_tail", first_only)
    text = F.coalesce("text", F.lit(""))
    made = spark.read.parquet(f"{medium}/documents.parquet").select(F.explode(secrets.written(text, F.xxhash64(text))).alias("s")).where(F.length("s") >= 120)
    rows = made.select(secrets.battery(F.col("s"))["p"].alias("p")).collect()
    assert len(rows) > 1000 and {r["p"] for r in rows} == {1e-16}
    seen.clear()
    with pytest.raises(Exception, match="another test"):  # of a random string all are asked
        spark.createDataFrame([("k7Gx2mQ9vR4tZ1bN8cW5",)], "s string").select(secrets.battery(F.col("s"))).collect()
