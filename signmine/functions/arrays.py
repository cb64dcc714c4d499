"""Folds over arrays, as Column expressions, in time about linear in the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are gathered before they are added to what there is: growing an array copies it.
BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once and not wherever it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def scan(values: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What step(state, value) gives for each value, in order, as an array of `kind` (a DDL type); step returns the new state and what it gives. Null and empty arrays give an empty one."""
    none, nothing = F.expr(f"cast(array() as array<{kind}>)"), F.expr(f"cast(array() as array<array<{kind}>>)")

    def one(acc: Column, x: Column) -> Column:
        new, out = step(acc["state"], x)
        return F.struct(new.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    def many(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return bound(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    def whole(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        blocks = F.transform(starts, lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        folded = F.aggregate(blocks, F.struct(state.alias("state"), nothing.alias("out")), many, lambda acc: F.flatten(acc["out"]))
        return F.when(F.size(v) > 0, folded).otherwise(none)

    return bound(F.coalesce(values, F.slice(values, 1, 0)), whole)


def spans(text: Column, pattern: str) -> Column:
    """All hits of a pattern in text, as an array of structs (start, end, body): code points, end exclusive. Null text: empty.

    What split() leaves and what regexp_extract_all() takes alternate, so running lengths give places.
    """
    kind = "struct<start:int,end:int,body:string>"

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        return end, F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("body"))

    def walk(x: Column) -> Column:
        gaps, hits = x["gaps"], x["hits"]
        pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
        return scan(pairs, F.lit(0), step, kind)

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(pattern), bound(both, walk)).otherwise(F.expr(f"cast(array() as array<{kind}>)"))
