"""Prices, margins, bands and schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlane.config import MoneyParams

# Upper bounds (exclusive) and names of the price bands.
PRICE_BANDS = ((10000, "<10k"), (20000, "10-20k"), (30000, "20-30k"), (50000, "30-50k"), (80000, "50-80k"), (120000, "80-120k"))
M = MoneyParams()


def price_band(price: Column) -> Column:
    p = F.coalesce(price.cast("double"), F.lit(0.0))
    out = F.when(p < PRICE_BANDS[0][0], PRICE_BANDS[0][1])
    for bound, name in PRICE_BANDS[1:]:
        out = out.when(p < bound, name)
    return out.otherwise("120k+")


def band_factor(value: Column, bands: Sequence[tuple[float, float]]) -> Column:
    """The factor of the first band whose upper bound the value does not exceed; the last band is open."""
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    out = F.when(v <= bands[0][0], bands[0][1])
    for bound, factor in bands[1:-1]:
        out = out.when(v <= bound, factor)
    return out.otherwise(bands[-1][1])


def clipped(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def truncate(x: Column) -> Column:
    """Towards zero."""
    return x.cast("long")


def shipping_of(shipping: Column, p: MoneyParams = M) -> Column:
    return F.coalesce(F.nullif(shipping, F.lit(0)), F.lit(p.shipping)).cast("double")


def margin_raw(price: Column, purchase: Column, shipping: Column, p: MoneyParams = M) -> Column:
    """Sales less fee and costs, with the purchase tax back; null without a positive price and purchase."""
    sales, cost = truncate(price) * p.rate, purchase.cast("double")
    return F.when((price > 0) & (purchase > 0), sales - sales * p.fee - (cost + shipping_of(shipping, p)) + cost / 11)


def margin_amount(price: Column, purchase: Column, shipping: Column, p: MoneyParams = M) -> Column:
    return F.bround(margin_raw(price, purchase, shipping, p), 0)


def margin_percent(price: Column, purchase: Column, shipping: Column, p: MoneyParams = M) -> Column:
    return F.bround(F.try_divide(margin_raw(price, purchase, shipping, p) * 100, truncate(price) * p.rate), 2)


def target_price(purchase: Column, shipping: Column, p: MoneyParams = M) -> Column:
    """The price that leaves the wanted margin rate; null without a positive purchase price."""
    cost = purchase.cast("double")
    return F.when(purchase > 0, truncate((cost + shipping_of(shipping, p) - cost / 11) / (1 - p.fee - p.margin_rate) / p.rate))


def break_even(purchase: Column, shipping: Column, p: MoneyParams = M) -> Column:
    cost = purchase.cast("double")
    return F.when(purchase > 0, F.ceil((cost + shipping_of(shipping, p) - cost / 11) / (p.rate * (1 - p.fee))))


def expected_margin(base: Column, available: Column, p: MoneyParams = M) -> Column:
    return F.bround((base - available) * p.rate * (1 - p.fee), 0)


def reference_price(list_price: Column, p: MoneyParams = M) -> Column:
    """Converted, truncated, then to the nearest hundred; 0 if not positive."""
    x = truncate(list_price * p.krw_to_reference)
    return F.when(x > 0, F.floor((x + 50) / 100) * 100).otherwise(0).cast("long")


def undercut(current: Column, competitor: Column, draw: Column) -> Column:
    """The current price if it is 1 to 9 below the competitor's, else that less ``draw`` (1 to 9)."""
    return F.when(current.between(competitor - 9, competitor - 1), current).otherwise(competitor - draw)


def seeded_draw(key: Column, seed: int) -> Column:
    """1 to 9, the same for a key and seed at every run."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 9 + 1).cast("int")


def next_interval(current: Column, kept: Column) -> Column:
    """Doubled if nothing changed, else halved; 2 to 360 minutes."""
    return F.least(F.lit(360), F.greatest(F.lit(2), F.when(kept, current * 2).otherwise(F.floor(current / 2)))).cast("int")


def time_decay(days: Column) -> Column:
    """1 up to day 30, 0.7 at day 60, 0 from day 90 on, linear between."""
    d = days.cast("double")
    return F.when(d <= 30, 1.0).when(d <= 60, 1 - (d - 30) * 0.01).when(d < 90, 0.7 * (90 - d) / 30).otherwise(0.0)
