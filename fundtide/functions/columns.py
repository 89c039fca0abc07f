"""Column expressions shared by the operators.  All of them are Spark built-ins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundtide import settings


def pct_change(new: Column, old: Column) -> Column:
    """Percent change; NULL where the base is zero or missing."""
    return F.try_divide(new - old, old) * F.lit(100.0)


def rounded(value: Column, digits: int = 6) -> Column:
    """Half-up rounding done in plain double arithmetic, so other engines can repeat it exactly."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def minor_units(value: Column, digits: int = 2) -> Column:
    """Money as whole minor units: integer sums are exact and stay in hash aggregation."""
    return F.floor(value * F.lit(float(10**digits)) + F.lit(0.5))


def is_trending(ret: Column, benchmark: Column) -> Column:
    return (ret > benchmark) & (ret > 0)


def is_real_instrument(
    ticker: Column,
    name: Column | None = None,
    pattern: str = settings.PLACEHOLDER_TICKER,
    prefixes: Iterable[str] = settings.PLACEHOLDER_NAME_PREFIXES,
) -> Column:
    """True for tickers and names that are not placeholders.  A NULL name is not accepted."""
    keep = ~ticker.rlike(pattern)
    if name is not None:
        for prefix in prefixes:
            keep = keep & ~F.upper(name).startswith(prefix.strip("\t\n").upper())
    return keep


def has_known_sector(sector: Column) -> Column:
    return sector.isNotNull() & (sector != settings.UNKNOWN_SECTOR)


def normalized_ticker(raw: Column) -> Column:
    """Trimmed upper-case ticker, or NULL when it does not look like one."""
    clean = F.upper(F.trim(raw))
    return F.when(clean.rlike(settings.TICKER_PATTERN), clean)


def ticker_from_name(name: Column) -> Column:
    """First all-upper-case word of at most five characters, else NULL."""
    def upper_word(w: Column) -> Column:
        return (w == F.upper(w)) & w.rlike("[A-Z]") & (F.length(w) <= 5)

    return F.get(F.filter(F.split(name, r"\s+"), upper_word), 0)


def ticker_or_name_head(ticker: Column, name: Column) -> Column:
    """Missing ticker: the first ten characters of the name."""
    given = F.when(ticker != "", ticker)
    return F.coalesce(given, F.substring(F.coalesce(name, F.lit("UNKNOWN")), 1, 10))


def lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a literal map; NULL for an unknown key."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def is_weekday(day: Column) -> Column:
    return ~F.dayofweek(day).isin(1, 7)


def is_last_sunday(day: Column) -> Column:
    return (F.dayofweek(day) == 1) & (F.month(F.date_add(day, 7)) != F.month(day))


def is_last_weekend(day: Column) -> Column:
    """Saturday or Sunday among the last seven days of the month."""
    return F.dayofweek(day).isin(1, 7) & (F.dayofmonth(day) > F.dayofmonth(F.last_day(day)) - 7)


def benchmark_order(fund: Column, priority: Iterable[str]) -> Column:
    """Position of a fund in the priority list; unlisted funds last."""
    listed = F.array(*[F.lit(p) for p in priority])
    place = F.array_position(listed, fund)
    return F.when(place > 0, place).otherwise(F.lit(999).cast("bigint"))
