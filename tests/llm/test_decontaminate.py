"""Tiling against the plain greedy search, and both ways of joining against all pairs."""

import random
import time

import pytest
from test_operators import slow_tiles, text

from signmine.llm import decontaminate


@pytest.mark.parametrize("seed", range(60))
def test_tiles_are_those_of_the_plain_greedy_search(seed):
    rng = random.Random(seed)
    vocabulary = rng.choice((1, 2, 3, 8, 40))
    p = text(rng, rng.randint(1, 40), vocabulary).split()
    t = text(rng, rng.randint(0, 60), vocabulary + 1).split() + p[len(p) // 2 :] + ["z"] + p[: len(p) // 2]
    tiles = decontaminate.tile(p, t, 3)
    assert all(n >= 3 and p[i : i + n] == t[j : j + n] for i, j, n in tiles)
    assert len({x for i, _, n in tiles for x in range(i, i + n)}) == len({x for _, j, n in tiles for x in range(j, j + n)}) == sum(n for _, _, n in tiles) == slow_tiles(p, t, 3)


def test_repeated_words_take_no_longer():
    began = time.perf_counter()
    assert sum(n for _, _, n in decontaminate.tile(["a"] * 100, ["a"] * 200_000)) == 100
    assert sum(n for _, _, n in decontaminate.tile(["a", "b"] * 500 + ["c"], (["a", "b"] * 9 + ["x"]) * 5000)) >= 990
    assert time.perf_counter() - began < 3


def brute(docs, items, coverage=decontaminate.COVERAGE):
    out = []
    for doc_id, body in docs:
        for item_id, item in set(items):
            p, t = decontaminate.words(item), decontaminate.words(body)
            if p and (covered := slow_tiles(p, t, min(3, len(p)))) / len(p) >= coverage:
                out.append((str(doc_id), item_id, len(p), covered))
    return sorted(out)


@pytest.mark.parametrize("most", [decontaminate.MOST_WORDS, 0])
def test_contamination_is_that_of_all_pairs(spark, most):
    rng = random.Random(2)
    items = [(i, text(rng, rng.choice([1, 2, 3, 4, 5, 6, 9, 15, 30]), 30)) for i in range(40)] + [(50, "common words stand here"), (51, "")]
    docs = []
    for i in range(120):
        words = (items[rng.randrange(40)][1] + " " + items[rng.randrange(40)][1]).split()
        cut = sorted(rng.sample(range(len(words) + 1), min(3, len(words))))
        parts = [words[a:b] for a, b in zip([0, *cut], [*cut, len(words)], strict=True)]  # reordered passages of any length
        rng.shuffle(parts)
        docs.append((rng.choice([None, i]), "common words stand here " + f" y{i} ".join(" ".join(x) for x in parts)))
    want = brute(docs, items)
    # Every fifth word changed: tiles of four, which five-word seeds don't see.
    words = [f"b{i}" for i in range(40)]
    items.append((60, " ".join(words)))
    docs.append((500, " ".join("other" if i % 5 == 4 else w for i, w in enumerate(words))))
    want = sorted([*want, ("500", 60, 40, 32)])
    assert len(want) > 200
    bench, table = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = decontaminate.contamination(table, bench, most_words=most).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["n_words"], r["covered"]) for r in found) == want


def test_a_benchmark_is_small_by_its_words_in_any_script_and_by_its_bytes(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "слово " * 1000)], "item_id long, text string")
    assert not decontaminate._small(bench, 999) and decontaminate._small(bench, 1000)
    monkeypatch.setattr(decontaminate, "MOST_BYTES", 10_999)
    assert not decontaminate._small(bench, 1000)
