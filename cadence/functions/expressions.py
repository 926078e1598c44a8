"""Column expressions: the scalar building blocks (all JVM-side, no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut points used by the categorical features.
TEMPO_CATEGORY_LABELS = ("slow", "medium", "fast")
TEMPO_CUTS_FEATURE = (100.0, 140.0)   # feature step: < 100 slow, [100, 140] medium, else fast
TEMPO_CUTS_MODEL = (90.0, 130.0)      # model-step fallback: < 90 slow, <= 130 medium, else fast
UNKNOWN_CATEGORY = "unknown"
DURATION_BANDS = ("< 2 min", "2-3 min", "3-4 min", "4-5 min", "> 5 min")
TEMPO_GROUPS = ("slow (< 100 BPM)", "medium (100-140 BPM)", "fast (> 140 BPM)")
POPULARITY_HIGH_MIN = 70   # high popularity: >= 70
POPULARITY_LOW_MAX = 30    # low popularity: < 30


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_to_int(c, true_text: str = "True", false_text: str = "False") -> Column:
    """Text flag to 0/1: exactly ``True`` -> 1, ``False`` -> 0, anything else (NULL too) -> 0."""
    c = col_(c)
    return F.when(c == true_text, 1).when(c == false_text, 0).otherwise(0).cast("int")


def int_to_label(c, one_label: str, zero_label: str) -> Column:
    c = col_(c)
    return F.when(c == 1, one_label).when(c == 0, zero_label)


def ratio(num, den, eps: float = 1e-4) -> Column:
    """num / (den + eps), both as double; the offset keeps a zero denominator finite."""
    return col_(num).cast("double") / (col_(den).cast("double") + F.lit(eps))


def tempo_category(c, cuts: Sequence[float] = TEMPO_CUTS_FEATURE,
                   labels: Sequence[str] = TEMPO_CATEGORY_LABELS) -> Column:
    """``< lo`` -> slow, ``[lo, hi]`` -> medium, ``> hi`` -> fast; NULL stays NULL."""
    c = col_(c).cast("double")
    lo, hi = cuts
    return (F.when(c < lo, labels[0]).when(c <= hi, labels[1])
            .when(c > hi, labels[2]))


def duration_minutes(c="duration_ms") -> Column:
    return col_(c) / F.lit(60000.0)


def duration_band(minutes) -> Column:
    """Bands of 1 minute from 2 to 5; 5 itself falls into the last band."""
    m = col_(minutes)
    return (F.when(m < 2, DURATION_BANDS[0]).when(m < 3, DURATION_BANDS[1])
            .when(m < 4, DURATION_BANDS[2]).when(m < 5, DURATION_BANDS[3])
            .when(m.isNotNull(), DURATION_BANDS[4]))


def tempo_group(c) -> Column:
    c = col_(c)
    return (F.when(c < 100, TEMPO_GROUPS[0]).when(c <= 140, TEMPO_GROUPS[1])
            .when(c.isNotNull(), TEMPO_GROUPS[2]))


def popularity_class(c) -> Column:
    c = col_(c)
    return F.when(c >= POPULARITY_HIGH_MIN, "high").when(c < POPULARITY_LOW_MAX, "low")


def safe_name(c) -> Column:
    """File-safe name: lower case, spaces and dashes to ``_``, parentheses dropped."""
    lowered = F.lower(col_(c))
    return F.translate(F.translate(lowered, " -", "__"), "()", "")


def bin_index(x, lo, width, n_bins: int, check_range: bool = True) -> Column:
    """Equal-width bin of ``x`` in ``[lo, lo + n*width]``; the last bin is closed on the right.

    Values outside the range get NULL (skip the check when the bounds are the
    data's own min/max). ``width`` 0 puts every value in bin 0.
    """
    x = col_(x).cast("double")
    lo = col_(lo).cast("double") if not isinstance(lo, (int, float)) else F.lit(float(lo))
    width = col_(width).cast("double") if not isinstance(width, (int, float)) else F.lit(float(width))
    hi = lo + width * n_bins
    raw = F.when(width > 0, F.floor((x - lo) / width)).otherwise(F.lit(0))
    idx = F.least(raw, F.lit(n_bins - 1)).cast("int")
    return F.when((x >= lo) & (x <= hi), idx) if check_range else idx


def hash_order(*cols) -> Column:
    """A deterministic pseudo-random order key: first 32 bits of md5 over the columns.

    Unlike ``rand(seed)`` it does not depend on partitioning, and DuckDB computes
    the same number (``'0x' || substr(md5(..), 1, 8)``).
    """
    text = F.concat_ws("|", *[col_(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
