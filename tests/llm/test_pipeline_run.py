"""run() against the stages in plain Python over a whole small table."""

import hashlib
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
import pytest
from test_operators import Sets

from signmine.llm import decontaminate, langid, mixing


def test_run_is_the_stages_in_plain_python(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    docs = {r["doc_id"]: r for r in table.collect()}
    model = langid.train(table.where(~langid.held_out()))
    said = {i: model.predict(r["text"]) for i, r in docs.items()}
    texts = {i: r["text"] for i, r in sorted(docs.items()) if said[i][0] != langid.UNKNOWN and said[i][1] >= 0.4}
    # Lines: each pair of neighbours stays where it stands first.
    first = {}
    for i, t in texts.items():
        lines, gone = t.split("\n"), set()
        for at in range(len(lines) - 1):
            if first.setdefault((lines[at], lines[at + 1]), (i, at)) != (i, at):
                gone |= {at, at + 1}
        texts[i] = "\n".join(x for at, x in enumerate(lines) if at not in gone)
    # Near-duplicates: all pairs.
    words = {i: t.lower().split() for i, t in texts.items()}
    sets, groups = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}, Sets()
    for a, b in combinations(sets, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            groups.join(a, b)
    texts = {i: t for i, t in texts.items() if groups.root(i) == i}
    # Benchmark: all pairs.
    items = [decontaminate.words(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    leaks = lambda t: any(p and sum(x[2] for x in decontaminate.tile(p, t, min(3, len(p)))) >= 0.8 * len(p) for p in items)
    texts = {i: t for i, t in texts.items() if not leaks(decontaminate.words(t))}
    # Mixing: sources' targets, and words in order of md5.
    size = defaultdict(int)
    for i, t in texts.items():
        size[docs[i]["source"]] += len(t.split())
    names = sorted(s for s in size if s is not None) + [s for s in size if s is None]
    weight, stopped = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}, set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in stopped)) / max(1e-9, sum(weight[s] for s in names if s not in stopped))
        more = {s for s in names if s not in stopped and weight[s] * level >= 3 * size[s]}
        if not more:
            break
        stopped |= more
    taken = {}
    for s in names:
        left = int((3.0 * size[s] if s in stopped else weight[s] * level) + 1e-9)
        mine = sorted((hashlib.md5(f"{i}:{t}".encode()).hexdigest(), i) for i, t in texts.items() if docs[i]["source"] == s)
        for _ in range(3):
            for _, i in mine:
                part = min(left, len(texts[i].split()))
                taken[i] = taken.get(i, 0) + part
                left -= part
    found = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"]: (r["text"], r["taken"]) for r in found} == {i: (texts[i], n) for i, n in taken.items() if n} and 50 < len(found) < len(docs)
    for r in found:
        assert r["target"] == pytest.approx(3.0 * size[r["source"]] if r["source"] in stopped else weight[r["source"]] * level)
    places = [r["position"] for r in found]
    assert places == sorted(places)
