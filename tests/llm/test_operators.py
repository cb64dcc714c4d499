"""Operators against brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
from collections import defaultdict
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from signmine.llm import decontaminate, html, langid, line_dedup, mixing, quality, queries, secrets, simhash, substring_dedup, topk
from signmine.llm.common import components


def text(rng, n, words=200):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


class Sets(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


# --- components ---------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)] + [(300, 300 + i) for i in range(1, 90)] + [(None, 5), (7, 7)]
    sets = Sets()
    for a, b in edges:
        if a is not None and a != b:
            sets.join(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: sets.root(x) for x in list(sets)}


# --- 10: SimHash --------------------------------------------------------------------------------


def slow_fingerprint(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    rng = random.Random(1)
    for t in ["", " ", "One", "one TWO", "Éa B c d e", "a b c", "x " * 50, *(text(rng, rng.randint(1, 60)) for _ in range(40))]:
        assert simhash.fingerprint(t) == slow_fingerprint(t), t
    assert simhash.fingerprint(None) == 0


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 4])
def test_links_have_the_components_of_all_pairs(spark, hot):
    rng = random.Random(6)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for center in [*list(fps)[:12], 0]:
        for _ in range(40):
            x = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    # A dense bucket: many that agree in low bits.
    fps |= {0xABCD000000000000 | rng.getrandbits(9) for _ in range(300)}
    fps = sorted(fps)
    want = Sets()
    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            want.join(a, b)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    links = [(a % 2**64, b % 2**64) for a, b in simhash.near_links(df, hot=hot).collect()]
    have = Sets()
    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        have.join(a, b)
    assert {x: have.root(x) for x in fps} == {x: want.root(x) for x in fps}


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_allocation_is_the_best_and_keeps_the_pigeonhole(parts):
    rng = np.random.default_rng(parts)
    costs = np.sort(rng.random((parts, 5)), axis=1)
    cost, chosen = simhash.allocate(costs, 3 - parts + 1)
    every = [t for t in product(range(-1, 4), repeat=parts) if sum(t) == 3 - parts + 1]
    assert sum(chosen) == 3 - parts + 1 and cost == pytest.approx(min(sum(costs[i, t + 1] for i, t in enumerate(ts)) for ts in every))
    groups = simhash.group_bits(rng.random((64, 64)) + np.eye(64), 2, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))


@pytest.mark.parametrize("thresholds", [(1, 1), (2, 0), (1, 0, 0), (0, 0, 0, 0), (3, -1)])
def test_any_thresholds_that_sum_up_find_all_pairs(spark, monkeypatch, thresholds):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({*base, *(x ^ sum(1 << b for b in rng.sample(range(64), 3)) for x in base for _ in range(10))})
    m = len(thresholds)
    groups = [list(range(12)), list(range(12, 64))] if max(thresholds) > 2 else [list(range(i, 64, m)) for i in range(m)]  # three bits of half of them would be 5,489 probes each
    monkeypatch.setattr(simhash, "plan", lambda *_: [(bits, t) for bits, t in zip(groups, thresholds, strict=True) if t >= 0])
    have, want = Sets(), Sets()
    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            want.join(a, b)
    for a, b in simhash.near_links(spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")).collect():
        have.join(a % 2**64, b % 2**64)
    assert {x: have.root(x) for x in fps} == {x: want.root(x) for x in fps}


def test_query_of_simhash(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    sets, first = Sets(), {}
    for d, t in rows:
        first[slow_fingerprint(t)] = min(d, first.get(slow_fingerprint(t), d))
    for a, b in combinations(first, 2):
        if (a ^ b).bit_count() <= 3:
            sets.join(a, b)
    least = {}
    for fp, d in first.items():
        least[sets.root(fp)] = min(d, least.get(sets.root(fp), d))
    want = {(d, f"{slow_fingerprint(t):016x}", least[sets.root(slow_fingerprint(t))]) for d, t in rows}
    assert {tuple(r) for r in queries.op10_simhash(spark, small).collect()} == want


# --- 3: top-k -----------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [topk.QUERY_CHUNK, 3])
def test_topk_is_exact(spark, chunk):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(400)]
    df = topk.quantized(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(5))
    found = defaultdict(list)
    for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 10, chunk).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 400, 50):
        all_of = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(vectors[q][1], v, strict=True)), i) for i, v in vectors if i != q)[:10]
        assert sorted(found[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(all_of)]


def test_threshold_stops_early():
    ids, vectors = np.arange(5000), np.zeros((5000, 3), np.int64)
    vectors[:, 0] = np.arange(5000)[::-1] ** 2
    looked = []

    class Counted(topk.Lists):
        pass

    lists = Counted(ids, vectors)
    lists.vectors = type("V", (), {"__getitem__": lambda s, at: looked.append(len(at)) or vectors[at]})()
    assert [i for _, i in lists.search(np.array([1, 0, 0]), -1, 5, [])] == [0, 1, 2, 3, 4] and sum(looked) < 100


# --- 2: line dedup ------------------------------------------------------------------------------


def slow_chunks(t):
    lines = t.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if (h[i] + (h[i - 1] if i else 0) * line_dedup.BASE) % line_dedup.MODULUS % line_dedup.DIVISOR == 0 or i == len(lines) - 1:
            out.append(now)
            now = []
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    blocks = ["\n".join(text(rng, 3) for _ in range(rng.randint(3, 9))) for _ in range(4)]
    docs = [(i, "\n".join(rng.choice([*blocks, text(rng, 4), text(rng, 4), ""]) for _ in range(rng.randint(1, 8)))) for i in range(60)]
    seen, want = set(), {}
    for i, t in docs:
        stays = []
        for c in slow_chunks(t):
            body = "\n".join(c)
            if len(c) < 2 or body not in seen:
                stays.append(body)
            if len(c) >= 2:
                seen.add(body)
        want[i] = "\n".join(stays)
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == want and sum(map(len, want.values())) < sum(len(t) for _, t in docs)


def test_boundaries_do_not_shift():
    rng = random.Random(5)
    lines = [text(rng, 4) for _ in range(60)]
    a = {"\n".join(c) for c in slow_chunks("\n".join(lines))}
    b = {"\n".join(c) for c in slow_chunks("\n".join(["new", *lines]))}
    assert len(a - b) <= 2


# --- 4: decontamination -------------------------------------------------------------------------


def slow_tiles(p, t, least):
    p, t, out = list(p), list(t), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] is not None and p[i + n] == t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out += n
        p[i : i + n] = [None] * n
        t[j : j + n] = [object()] * n


@pytest.mark.parametrize("seed", range(8))
def test_tiling_covers_what_greedy_search_covers(seed):
    rng = random.Random(seed)
    p = text(rng, rng.randint(3, 30), 8).split()
    t = text(rng, 30, 8).split() + p[len(p) // 2 :] + ["z"] + p[: len(p) // 2] + text(rng, 10, 8).split()
    tiles = decontaminate.tile(p, t, 3)
    assert all(n >= 3 and p[i : i + n] == t[j : j + n] for i, j, n in tiles)
    covered = [x for i, _, n in tiles for x in range(i, i + n)]
    assert len(covered) == len(set(covered))
    # Ties of length may be taken in another order, with a few words' difference.
    assert abs(len(covered) - slow_tiles(p, t, 3)) <= 6


def test_large_and_small_benchmarks_find_the_same(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 6, 9])))) for i in range(25)]
    items += [items[3], (3, "another text of one id"), (40, ""), (41, None)]
    docs = [(rng.choice([None, *range(30)]), " ".join(rng.choices(vocabulary, k=rng.randrange(25)))) for _ in range(60)]
    docs += [(1, items[5][1]), (1, "so: Another text of one ID"), docs[0], (2, None), (3, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    expected, clean = [], []
    for doc_id, text in docs:
        mine = []
        for item_id, item in set(items):
            p, t = decontaminate.words(item), decontaminate.words(text)
            n = min(decontaminate.SEED, len(p))
            if n and set(decontaminate.seeds_of(p)) & {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}:
                covered = sum(x[2] for x in decontaminate.tile(p, t, min(decontaminate.LEAST_TILE, len(p))))
                if covered / len(p) >= decontaminate.COVERAGE:
                    mine.append((str(doc_id), item_id, len(p), covered))
        expected += mine
        clean += [] if mine else [(str(doc_id), str(text))]
    assert len(expected) > 20 and len(clean) > 5 and any(x[0] == "None" for x in expected)
    for most in (decontaminate.MOST_WORDS, 0):
        found = decontaminate.contamination(table, bench, most_words=most).collect()
        assert sorted((str(r["doc_id"]), r["item_id"], r["n_words"], r["covered"]) for r in found) == sorted(expected)
        assert sorted((str(r["doc_id"]), str(r["text"])) for r in decontaminate.decontaminate(table, bench, most_words=most).collect()) == sorted(clean)


def test_reordered_passages_are_caught_and_parts_are_not(spark):
    words = [f"b{i}" for i in range(30)]
    parts = [words[20:], words[:10], words[10:20]]
    docs = [(1, "x y " + " q ".join(" ".join(p) for p in parts)), (2, "x y " + " ".join(words[:20])), (3, " ".join(reversed(words))), (4, "Q " + " ".join(words).upper().replace(" ", ", "))]
    found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(words))], "item_id long, text string"))
    assert sorted((r["doc_id"], r["covered"], r["tiles"]) for r in found.collect()) == [(1, 30, 3), (4, 30, 1)]


# --- 5: secrets ---------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_line(t):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6] + [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]))


def test_secrets(spark, small):
    rng = random.Random(9)
    hexed, b64 = "".join(rng.choice("0123456789abcdef") for _ in range(40)), "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
    odd = [
        'é\U0001f600 password = "abcdef1" x', "secret=token:abcdefgh", "Token='ab'", f"api_key: {hexed}", f"APIKEY={b64}", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "ſecret=abcdefg toKen=abcdefg", f"see {b64}, and {hexed.upper()}",
        "a path /usr/lib/python3/packages/and/more", "word1 counting-one-two-three-four-five-six-7", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "password:: abcdefgh", "12345678901234567890123456789012345",
    ]
    docs = [(i, t) for i, t in enumerate(odd)] + [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = {r["doc_id"]: r for r in secrets.digest(secrets.find_secrets(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    for i, t in docs:
        line = base_line(t)
        assert found[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), t
        assert set(filter(None, line.split(","))) <= set(found[i]["spans"].split(","))
    assert found[8]["spans"] == "random_base64:4:48,random_hex:54:94" and all(found[i]["spans"] == base_line(odd[i]) for i in (9, 10, 11))


def test_battery_tells_random_from_written(spark):
    rng = random.Random(4)
    sign = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    made = [("r", "".join(rng.choice(sign) for _ in range(rng.randint(24, 64)))) for _ in range(200)]
    made += [("w", "-".join(rng.choice(["the", "release", "notes", "of", "version", "2024", "and", "more", "text"]) for _ in range(8))) for _ in range(200)]
    rows = spark.createDataFrame(made, "kind string, s string").select("kind", secrets.battery(F.col("s")).alias("t")).collect()
    p = {k: np.array([r["t"]["p"] for r in rows if r["kind"] == k]) for k in "rw"}
    assert (p["r"] < 0.05).mean() < 0.12 and (p["w"] < 0.01).mean() > 0.95


# --- 6: mixing ----------------------------------------------------------------------------------


def test_mixing_fills_targets(spark):
    rng = random.Random(7)
    docs = [(i, text(rng, rng.randint(0, 40)), rng.choice(["a"] * 20 + ["b", "c", "d", None, "é", "Z"])) for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len(t.split())
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    stopped, total = set(), sum(size.values())
    while True:
        rest = total - sum(3 * size[s] for s in stopped)
        level = rest / sum(weight[s] for s in names if s not in stopped)
        more = {s for s in names if s not in stopped and weight[s] * level > 3 * size[s]}
        if not more:
            break
        stopped |= more
    want = {s: 3.0 * size[s] if s in stopped else weight[s] * level for s in names}
    assert stopped and len(rows) == 500
    taken = defaultdict(int)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-9) for s in names)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    early, late = (np.mean([r["position"] for r in rows if r["source"] == s and r["position"] is not None]) for s in ("Z", "b"))
    assert early < late  # a falling schedule against a rising one


@pytest.mark.parametrize("ramp", [0.5, 1.0, 2.0])
def test_schedule_is_inverted(spark, ramp):
    shares = [i / 20 for i in range(21)]
    found = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.when_taken(F.col("s"), F.lit(ramp))).collect()]
    assert [(2 * t + (ramp - 1) * t * t) / (1 + ramp) for t in found] == pytest.approx(shares)


# --- 7: substring dedup -------------------------------------------------------------------------


def test_every_shared_run_of_fifty_words_is_found(spark):
    rng = random.Random(12)
    passage = text(rng, 50, 5000)
    docs = [(i, text(rng, rng.randint(0, 80), 5000) + " " + passage + "\n" + text(rng, rng.randint(0, 80), 5000)) for i in range(40)] + [(100 + i, text(rng, 200, 5000)) for i in range(20)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    inside = [r for r in found if r["kind"] == "passage"]
    assert {r["doc_id"] for r in inside} == {r["doc_id"] for r in found} == set(range(40)) and {r["class_id"] for r in inside} == {0} and {r["doc_id"] for r in inside if r["keep"]} == {0}


def test_near_paragraphs_against_brute_force(spark):
    rng = random.Random(13)
    docs, sets = [], Sets()
    for family in range(25):
        words = text(rng, 70, 5000).split()
        for k in range(5):
            mine = list(words)
            for at in rng.sample(range(70), rng.randint(0, 3)):
                mine[at] = f"x{rng.randrange(10**6)}"
            docs.append((family * 5 + k, " ".join(mine)))
    shingles = {i: {tuple(t.split()[j : j + 5]) for j in range(66)} for i, t in docs}
    for a, b in combinations(shingles, 2):
        if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
            sets.join(a, b)
    want = {(i, sets.root(i)) for i in list(sets)}
    found = {(r["doc_id"], r["class_id"]) for r in substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r["kind"] == "paragraph"}
    assert len(found ^ want) <= 0.02 * len(want) and not {x for x, _ in found} - {x for x, _ in want}
    bands, rows = substring_dedup.tune()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995


def test_short_paragraphs_are_found(spark):
    rng = random.Random(14)
    lines = {n: text(rng, n, 5000) for n in range(5, 31)}
    near = {n: " ".join([*lines[n].split()[:-1], "other"]) for n in range(15, 31)}  # one shingle of n - 4 differs
    docs = [(n, f"{text(rng, 8, 5000)}\n{lines[n].upper()}") for n in lines] + [(100 + n, f"{lines[n]}\n{text(rng, 8, 5000)}") for n in lines] + [(200 + n, near[n]) for n in near] + [(300, "a b c d"), (301, "a b c d")]
    found = {(r["doc_id"], r["n_words"], r["class_id"]) for r in substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    exact = {(at + n, n, n) for n in lines for at in (0, 100)}
    assert exact <= found and len({(200 + n, n, n) for n in near} - found) <= 1 and found <= exact | {(200 + n, n, n) for n in near}


# --- 8: HTML ------------------------------------------------------------------------------------


def test_messages_give_the_marginals_of_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    model = html.Model(rng.normal(size=html.N_FEATURES), rng.normal(size=(html.EDGE_KINDS, 2, 2)))
    page = html.parse("<body><nav>a</nav><article class=ad><p>b<p>c</article><div><ul><li>d</ul></div>")
    forest, n = html.Forest.of([page]), len(page.tags)
    weights, total, score = np.zeros((n, 2)), 0.0, forest.x @ model.unary
    for labels in product((0, 1), repeat=n):
        w = np.exp(sum(score[i] * y for i, y in enumerate(labels)) + sum(model.pair[forest.kinds[i], labels[page.parents[i]], labels[i]] for i in range(1, n)))
        total += w
        weights[range(n), labels] += w
    node, _, log_z = model.infer(forest)
    assert node == pytest.approx(weights / total) and log_z == pytest.approx(np.log(total))


def test_held_out_pages_and_layouts():
    model, test = html.fit(html.labelled_pages()), html.labelled_pages(80, seed=77)
    node, _, _ = model.infer(html.Forest.of(p for p, _ in test))
    assert ((node[:, 1] >= 0.5) == np.concatenate([y for _, y in test])).mean() > 0.98
    page = """<html><head><title>no</title><script>if (a<b && "</p>") x("</div>")</script></head><body><header><a href=/>Site</a></header><div class="cookie-notice">We use cookies</div><nav><ul><li><a href=/a>A</a></ul></nav>
    <article><h1>A &lt;title&gt;</h1><p>First  para &eacute;<br>more.<!-- no --><p>Second &amp; last, <a href=x>linked</a>.<div class="ad">Buy now</div><form><input name=q><button>Go</button></form><ul><li>one</li><li>two</ul></article>
    <aside class=sidebar><p>Also read</aside><section id="comments"><h2>Comments</h2><div class="comment"><p>I liked it a lot, thank you</div></section><footer>&copy; x</footer></body></html>"""
    assert html.extract([page], model) == ["A <title>\nFirst para é more.\nSecond & last, linked.\none\ntwo"]


def test_pages_of_the_table(spark, small):
    from html import unescape

    for page, row in zip(spark.read.parquet(f"{small}/pages.parquet").orderBy("page_id").collect(), queries.op8_html_extraction(spark, small).orderBy("page_id").collect(), strict=True):
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(filter(None, blocks)) and row["n_chars"] == len(row["text"])


# --- 9 and 1: classifiers -----------------------------------------------------------------------


def test_language_of_held_out_documents(spark, medium):
    found = queries.op9_language_id(spark, medium).join(spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_model_is_sparse_and_calibrated(spark, small):
    model = langid.train(spark.read.parquet(f"{small}/documents.parquet"))
    assert (model.weights != 0).mean() < 0.3 and 0.05 < model.temperature < 20


def test_quality_orders_held_out_documents(spark, medium):
    docs, ratings = spark.read.parquet(f"{medium}/documents.parquet"), quality.grade(spark.read.parquet(f"{medium}/labels.parquet"))
    found = quality.classify(docs, ratings.where("doc_id % 5 <> 0")).join(ratings.where("doc_id % 5 = 0"), "doc_id").groupBy("grade").agg(F.avg("expected_grade").alias("m"), F.avg(F.col("selected").cast("int")).alias("s")).collect()
    of = {r["grade"]: r for r in found}
    assert of[2]["s"] > 0.9 and of[2]["m"] > of[1]["m"] and of[2]["m"] > of[0]["m"]


def test_thresholds_stay_in_order():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)) for _ in range(200)]
    model = quality.fit(rows, np.array([int(r.min() < 5) + int(r.max() > 45) for r in rows]))
    assert model.thresholds[0] < model.thresholds[1]


@pytest.mark.parametrize("attribute", ['title="the hidden door"', 'class="overflow hidden x"', "data-x='display:none'", 'alt="aria-hidden=true"'])
def test_values_hide_nothing(attribute):
    assert [t for _, t in html.parse(f"<div><p {attribute}>one<p>two <a {attribute}>three</a></div><p>four").text] == ["one", "two three", "four"]


@pytest.mark.parametrize("attribute", ["hidden", 'hidden=""', "HIDDEN", 'aria-hidden="true"', "aria-hidden=true", "style='color:red; display : none'"])
def test_hidden_elements_end_where_others_do(attribute):
    parsed = lambda x: [t for _, t in html.parse(x).text]
    assert parsed(f"<div><p {attribute}>no<br>no<p>two</div>three") == ["two", "three"]
    assert parsed(f"<ul><li>one<li {attribute}>no<li>two</ul>three") == ["one", "two", "three"]
    assert parsed(f"<div><div {attribute}>no<div>no</div>no</div>two</div>three") == ["two", "three"]
    assert parsed(f"<p>a<span {attribute}>no<b>no</b></span> b</p>") == ["a b"]


# --- the pipeline's near-dedup ------------------------------------------------------------------


def test_near_dedup_stage_against_brute_force(spark):
    rng = random.Random(12)
    docs = []
    for i in range(120):
        words = text(rng, rng.randint(5, 300), 5000).split()
        docs.append(" ".join(words))
        for _ in range(rng.randint(0, 2)):  # copies with a word in 15 to 150 changed
            changed = list(words)
            for at in rng.sample(range(len(words)), len(words) // rng.randint(15, 150)):
                changed[at] = f"new{rng.randrange(5000)}"
            docs.append(" ".join(changed).upper())
    docs += ["a b", "b a", "A  b", "", " \n", None]
    rng.shuffle(docs)
    words = [(t or "").lower().split() for t in docs]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    want, far = Sets(), 0
    for a, b in combinations(range(len(docs)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            want.join(a, b)
            far += (slow_fingerprint(docs[a]) ^ slow_fingerprint(docs[b])).bit_count() > simhash.DISTANCE
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), "").collect()}
    assert kept == {want.root(i) for i in range(len(docs))} and far > 10


@pytest.mark.parametrize("total", [500, 60_000, 20_000_000])
def test_groups_of_signatures_reach_the_recall(total):
    rng = np.random.default_rng(2)
    distance, groups = simhash.wide_plan(total, 0.8)
    at, shared, near = np.array(groups), 0, 0
    for _ in range(20_000):  # cosine 8/9
        differs = rng.random(simhash.WIDE) < math.acos(8 / 9) / math.pi
        shared += not differs[at].any(axis=1).all()
        near += differs.sum() <= distance
    assert shared > 0.998 * 20_000 and near > 0.999 * 20_000 and total / 2 ** at.shape[1] <= simhash.WIDE_BUCKET


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 7])
def test_links_of_signatures_against_brute_force(spark, hot):
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(5, 200), dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            own = base[rng.random(len(base)) < 0.95]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 1 << 63, max(1, len(base) // 30), dtype=np.uint64)])))
    sets += [sets[0]] * 30
    bits = [simhash.signature(x) for x in sets]
    rows = [(i, *map(int, x.view(np.int64))) for i, x in enumerate(bits)]
    distance, groups = simhash.wide_plan(len(sets), 0.8)
    flat = np.array([np.unpackbits(x.view(np.uint8), bitorder="little") for x in bits])
    have, want, similar = Sets(), Sets(), []
    for i, j in combinations(range(len(sets)), 2):
        same = flat[i] == flat[j]
        if (~same).sum() <= distance and any(same[g].all() for g in groups):
            want.join(i, j)
        both = len(np.intersect1d(sets[i], sets[j]))
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
            similar.append((i, j))
    columns = "node long, " + ", ".join(f"f{i} long" for i in range(simhash.WIDE // 64))
    for a, b in simhash.wide_links(spark.createDataFrame(rows, columns), 0.8, hot).collect():
        have.join(a, b)
    assert [have.root(i) for i in range(len(sets))] == [want.root(i) for i in range(len(sets))]
    assert len(similar) > 100 and all(have.root(i) == have.root(j) for i, j in similar)


def test_near_dedup_stage_goes_through_simhash(spark, monkeypatch):
    rng = random.Random(3)
    words = text(rng, 200, 5000).split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, text(rng, 200, 5000))], "doc_id long, text string")
    kept = lambda: {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept() == {1, 3}
    monkeypatch.setattr("signmine.llm.near_documents.wide_links", lambda signatures, similarity: spark.createDataFrame([], "a long, b long"))
    assert kept() == {1, 2, 3}


# --- the pipeline's line dedup ------------------------------------------------------------------


@pytest.mark.parametrize("size", range(2, 11))
def test_line_stage_removes_planted_blocks(spark, size):
    rng = random.Random(size)
    blocks = [[text(rng, 8, 10_000) for _ in range(size)] for _ in range(20)]
    own = lambda: [text(rng, 8, 10_000) for _ in range(rng.randint(1, 5))]
    docs = [(i, [own(), blocks[i % 20], own()]) for i in range(60)]
    rows = [(i, "\n".join(sum(parts, []))) for i, parts in docs]
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert found == {i: "\n".join(sum(parts if i < 20 else [parts[0], parts[2]], [])) for i, parts in docs}


def test_line_stage_against_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, "\n".join(rng.choice("abcdefgh") + rng.choice(["", "x", "y"]) for _ in range(rng.randint(1, 12)))) for i in range(40)] + [(None, "a\nb\nc"), (50, None), (51, ""), (52, "z\nz\nz\nz")]
    first, want = {}, {}
    for i, t in docs[:40] + docs[41:] + docs[40:41]:
        lines = (t or "").split("\n")
        gone = set()
        for at in range(len(lines) - 1):
            if first.setdefault((lines[at], lines[at + 1]), (i, at)) != (i, at):
                gone |= {at, at + 1}
        want[i] = None if t is None else "\n".join(x for at, x in enumerate(lines) if at not in gone)
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string"), "").collect()}
    assert found == want and want[52] == "z"
