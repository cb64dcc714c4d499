"""How much work a target takes."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

# A shard's expected matches, and the least yield, decode rate and safety that are reckoned with.
MATCHES_A_SHARD = 71_000
LEAST_YIELD, LEAST_DECODE, LEAST_SAFETY = 0.1, 0.05, 1.0
CHUNK_FROM, LEAST_CHUNK, MOST_CHUNK, CHUNKS = 100_000, 50_000, 1_000_000, 30


def expected_yield(max_keep: int) -> float:
    """Crops an image gives, where none is stated."""
    return min(12.0, 0.5 * max_keep) if max_keep > 0 else 12.0


def _floor(x: Column | float, least: float) -> Column:
    return F.greatest(x if isinstance(x, Column) else F.lit(float(x)), F.lit(least))


def _up(x: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(x).cast("long"))


def shown_fetch_cap(target: Column, yields=12.0, decodes=0.5, safety=2.5) -> Column:
    """URLs for a target of crops, rounded up at each step: images, then tries, then the safety."""
    images = _up(target / _floor(yields, LEAST_YIELD))
    return _up(_up(images / _floor(decodes, LEAST_DECODE)) * _floor(safety, LEAST_SAFETY))


def fetch_cap(target: Column, yields=12.0, decodes=0.5, safety=2.5) -> Column:
    """As above, rounded up once."""
    return _up(target / _floor(yields, LEAST_YIELD) / _floor(decodes, LEAST_DECODE) * _floor(safety, LEAST_SAFETY))


def fetch_cap_of(target: int, yields: float = 12.0, decodes: float = 0.5, safety: float = 2.5) -> int:
    """fetch_cap() of a number."""
    return max(1, ceil(target / max(yields, LEAST_YIELD) / max(decodes, LEAST_DECODE) * max(safety, LEAST_SAFETY)))


def shards_needed(target: Column, yields=12.0, decodes=0.5, safety=2.5) -> Column:
    """Shards that hold twice the URLs that a target takes."""
    return _up(fetch_cap(target, yields, decodes, safety) * 2 / F.lit(float(MATCHES_A_SHARD)))


def chunk_size(target: Column) -> Column:
    """Crops of one chunk of a long run; 0: no chunks."""
    share = F.floor(target / CHUNKS).cast("long")
    return F.when(target <= CHUNK_FROM, F.lit(0).cast("long")).otherwise(F.least(F.greatest(share, F.lit(LEAST_CHUNK).cast("long")), F.lit(MOST_CHUNK).cast("long")))


def chunk_target(chunk: int, remaining: int | None) -> int | None:
    """Crops for the next chunk; remaining is None where there is no target, and a chunk of 0 takes all that remains."""
    if remaining is None:
        return chunk or None
    return min(chunk, remaining) if chunk else remaining


def preview_workers(threads: int, wanted: int, candidates: int) -> int:
    return max(1, min(threads, wanted, max(candidates, 1)))
