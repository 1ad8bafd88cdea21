"""Waveform clean-up on array columns, inside the JVM. Null waveforms stay null; empty ones stay empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """As SQL engines round doubles: x times 10^digits to the nearest whole number, ties away from zero, the sign of zero kept; NaN and what overflows stay.

    F.round() takes the shortest decimal of x instead and knows no -0.0.
    """
    factor = F.lit(float(10**digits))
    y = x * factor
    whole = F.rint(y)
    out = F.when(F.abs(y - whole) == 0.5, y + F.signum(y) / 2).otherwise(whole) / factor
    return F.when(F.abs(out) < float("inf"), out).otherwise(x)


def mono(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def mixed(channels: Column) -> Column:
    """The mean over any number of channels of equal length; null without channels."""
    total = F.aggregate(F.slice(channels, 2, F.greatest(F.size(channels) - 1, F.lit(0))), F.get(channels, F.lit(0)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.size(channels))


def checked_tokens(tokens: Column, codebooks: int = 8) -> Column:
    """The token matrix; a row of another number of codebooks, or of codebooks of different lengths, raises."""
    good = (F.size(tokens) == codebooks) & (F.size(F.array_distinct(F.transform(tokens, lambda t: F.size(t)))) <= 1)
    return F.when(tokens.isNull() | good, tokens).otherwise(F.raise_error(F.concat(F.lit("not a matrix of so many codebooks: "), F.size(tokens).cast("string"))))


def peak(wave: Column) -> Column:
    return F.array_max(F.transform(wave, lambda x: F.abs(x)))


def peak_normalise(wave: Column) -> Column:
    """Divided by the peak if that is above 1; quiet waveforms are left alone."""
    p = peak(wave)
    return F.when(p > 1, F.transform(wave, lambda x: x / p)).otherwise(wave)


def trim_silence(wave: Column) -> Column:
    """Without exact zeros at either end; zeros inside stay. All zeros leave nothing."""
    at = F.filter(F.transform(wave, lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    return F.when(F.size(at) == 0, F.slice(wave, 1, 0)).otherwise(F.slice(wave, at[0] + 1, F.element_at(at, -1) - at[0] + 1))
