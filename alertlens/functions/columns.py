"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
MICROS_PER_HOUR = 3_600_000_000.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """pandas skips NaN like a missing value; Spark orders NaN above +inf."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_div(num: Column, den: Column) -> Column:
    """Division whose zero/NULL denominator yields NULL (pandas: inf -> NaN)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def micros_between(earlier: str | Column, later: str | Column) -> Column:
    """Exact microseconds from ``earlier`` to ``later`` (TIMESTAMP_NTZ).

    NTZ - NTZ is a day-time interval computed without any time zone; going
    through ``timestamp_diff`` would cast to the session time zone and shift
    differences that cross a daylight-saving change."""
    iv = col(later) - col(earlier)
    return (F.extract(F.lit("DAY"), iv).cast("long") * 86_400_000_000
            + F.extract(F.lit("HOUR"), iv).cast("long") * 3_600_000_000
            + F.extract(F.lit("MINUTE"), iv).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), iv) * 1_000_000).cast("long"))


def days_between(earlier: str | Column, later: str | Column) -> Column:
    """Fractional days from ``earlier`` to ``later`` with microsecond precision."""
    return micros_between(earlier, later).cast("double") / F.lit(1_000_000.0) / F.lit(86_400.0)


def epoch_micros(ts: str | Column) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def flag(cond: Column) -> Column:
    """1/0 flag, NULL condition -> 0 (pandas comparison with NaN is False)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def bias_corrected_skew(values: Column) -> Column:
    """Adjusted Fisher-Pearson G1 (pandas ``skew``): NULL for n<3, 0 for constants.

    The constant test reuses ``stddev_samp`` (shared with base_std) rather than
    a separate variance buffer."""
    n = F.count(values).cast("double")
    g1 = F.skewness(values)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_samp(values) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def bias_corrected_kurt(values: Column) -> Column:
    """Unbiased excess kurtosis G2 (pandas ``kurt``): NULL for n<4, 0 for constants."""
    n = F.count(values).cast("double")
    g2 = F.kurtosis(values)
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.stddev_samp(values) == 0, F.lit(0.0))
            .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)))
