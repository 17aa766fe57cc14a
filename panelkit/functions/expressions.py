"""Scalar expressions: null-aware arithmetic, ratios, categories and text pieces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

INF = float("inf")


NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)$"


def try_number(c: Column) -> Column:
    """Text to double; padding is dropped and anything unreadable becomes NULL.

    Missing markers (``NaN``, ``NA``, ``N/A``) are NULL too, and so are numbers with a type suffix such
    as ``1d``, which a plain cast takes.
    """
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def finite(c: Column) -> Column:
    """NULL in place of NaN and both infinities."""
    return F.when(F.isnan(c) | (F.abs(c) == INF), None).otherwise(c)


def finite_or(c: Column, default: float) -> Column:
    return F.coalesce(finite(c), F.lit(default))


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` where ``den`` is positive, else NULL."""
    return F.when(den > 0, num / den)


def share_of(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100)


def sum_if_any(*cols: Column) -> Column:
    """Sum of the values present; NULL only when every one is missing."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp into [lo, hi]; NULL stays NULL."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def min_max_score(c: Column, lo: Column, hi: Column, invert: bool = False) -> Column:
    """Scale to 0-100 by given bounds. A constant column scores 50; missing stays missing."""
    scaled = F.when(c.isNotNull() & (hi == lo), 50.0).when(hi != lo, (c - lo) / (hi - lo) * 100)
    return 100 - scaled if invert else scaled


def residual_share(*shares: Column) -> Column:
    """What the given shares leave of 100, kept within [0, 100]."""
    return clip(100 - sum_if_any(*shares), 0, 100)


def decade(period: Column) -> Column:
    return (F.floor(period / 10) * 10).cast("int")


def period_label(period: Column) -> Column:
    first = decade(period)
    return F.concat(first.cast("string"), F.lit("–"), (first + 9).cast("string"))


def first_day(period: Column) -> Column:
    return F.make_date(period, F.lit(1), F.lit(1))


def risk_category(score: Column) -> Column:
    return (F.when(score.isNull(), "Unknown").when(score > 70, "High")
            .when(score > 40, "Medium").otherwise("Low"))


def risk_word(score: Column) -> Column:
    return (F.when(score.isNull(), "unknown").when(score > 70, "high")
            .when(score > 40, "moderate").otherwise("low"))


def trend_word(growth: Column) -> Column:
    return (F.when(growth.isNull(), "stable").when(growth > 5, "rapidly increasing")
            .when(growth > 1, "increasing").when(growth > -1, "stable")
            .when(growth > -5, "decreasing").otherwise("rapidly declining"))


def spike_direction(change: Column) -> Column:
    return F.when(change > 0, "SPIKE_UP").otherwise("SPIKE_DOWN")


def lookup(key: Column, values: dict[str, str], default: str) -> Column:
    """Fixed dictionary lookup with a default, as a literal map (no join)."""
    entries = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))


def sentence(condition: Column, template: str, *args: Column) -> Column:
    """The formatted text where the condition holds, else NULL (so ``concat_ws`` skips it)."""
    text = F.format_string(template, *args) if args else F.lit(template)
    return F.when(condition, text)


def normalise_code(value: str) -> str:
    return value.strip().upper()
