"""Previews: seeded candidates, and HTML of a few of them."""

from __future__ import annotations

import html
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signmine.functions.captions import highlight


def seeded_order(seed: int) -> list[Column]:
    """Shards, and rows in them, in an order that the seed alone decides."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col("shard"))), F.md5(F.concat(F.lit(f"{seed}:"), F.col("shard"), F.lit(":"), F.col("row").cast("string"))), F.col("shard"), F.col("row")]


def candidates(rows: DataFrame, seed: int = 0, most: int = 200) -> DataFrame:
    """(shard, row, url, re_caption, org_caption): the first `most` rows with a URL in the seeded order; null captions become empty."""
    found = rows.where("url is not null and url <> ''").orderBy(*seeded_order(seed)).limit(most)
    return found.select("shard", "row", "url", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("re_caption", "org_caption")])


def first_good(tried: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Of tried candidates (with ok) the first n good ones in the seeded order, whichever was fetched first."""
    return tried.where("ok").orderBy(*seeded_order(seed)).limit(n)


def highlighted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("caption_html", highlight(F.col("re_caption")))


def first_by_name(rows: DataFrame, n: int, name: str = "name") -> DataFrame:
    return rows.orderBy(name).limit(n)


def page(title: str, items: Iterable[Mapping[str, str]]) -> str:
    """A page of items with image (a path), heading, and body, which is HTML already."""
    shown = lambda x: f'<img src="{html.escape(x["image"])}" loading="lazy">' if x["image"] else ""
    blocks = [f'<figure>{shown(x)}<figcaption><b>{html.escape(x["heading"])}</b><div>{x["body"]}</div></figcaption></figure>' for x in items]
    style = "figure{display:inline-block;width:22em;vertical-align:top}img{max-width:100%}.hl-q{background:#fd8}.hl-v{background:#8df}"
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>{style}</style><h1>{html.escape(title)}</h1>{''.join(blocks)}"
