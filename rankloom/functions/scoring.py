"""Scoring and metric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1 = 1.5
B = 0.7
B_CLASSIC = 0.75


def idf(n: Column, df: Column) -> Column:
    """BM25 inverse document frequency."""
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25_term_score(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    """What one occurrence group of a query term adds, before the idf factor."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def nine_places(x: Column | str) -> Column:
    """Sort key of a score: its first 9 places as a whole double."""
    return F.rint((F.col(x) if isinstance(x, str) else x) * 1e9)


def round3(x: Column) -> Column:
    """Round a non-negative double to 3 places, half to even on its exact binary value.

    Spark's own rounding works on the decimal text of a double, so it sees ties where there are
    none (0.0125 is a little more than 1/80). ``high + low`` is x * 1000 without error: splitting
    x at 27 bits makes both partial products exact.
    """
    shifted = x * F.lit(134217729.0)
    head = shifted - (shifted - x)
    tail = x - head
    high = x * F.lit(1000.0)
    low = (head * F.lit(1000.0) - high) + tail * F.lit(1000.0)
    whole = F.floor(high)
    over = high - whole - F.lit(0.5)
    odd = whole % 2 == 1
    up = (over > 0) | ((over == 0) & ((low > 0) | ((low == 0) & odd)))
    return (whole + up.cast("long")) / F.lit(1000.0)


def harmonic_mean(a: Column, b: Column) -> Column:
    """Harmonic mean rounded to 3 places; 0.0 when either side is 0."""
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(round3(2.0 / (1.0 / a + 1.0 / b)))
