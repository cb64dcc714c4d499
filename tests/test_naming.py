from decimal import ROUND_HALF_UP, Decimal

from signmine.plans import catalogue


def rounded(x, places):
    """Of the shortest decimal that reads as x, half up."""
    return str(Decimal(repr(x)).quantize(Decimal(places), ROUND_HALF_UP))


def test_all_events_are_formatted(spark, small):
    ids = [r[0] for r in spark.read.parquet(f"{small}/events.parquet").select("event_id").collect()]
    want = []
    for i in ids:
        x = float(7 * i + 3)
        whole = f" ({x:.0f}s)"
        want.append((i, f"{x:.1f}s" if x < 60 else rounded(x / 60, "0.1") + "min" + whole if x < 3600 else rounded(x / 3600, "0.01") + "h" + whole))
    found = [tuple(r) for r in catalogue.QUERIES["fmt_secs"](spark, small).collect()]
    assert sorted(found) == sorted(want) and any("h (" in t for _, t in found) and len(found) == len(ids)
