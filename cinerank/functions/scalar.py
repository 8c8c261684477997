"""Column -> Column helpers (all built-in expressions, whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's:
# age buckets (upper bounds, first match wins; older ages get no bucket)
AGE_BUCKETS = [18, 24, 34, 44, 49, 55, 100]
# like/dislike thresholds offered, and the default
BINARY_THRESHOLDS = [2.0, 2.5, 3.0, 3.5, 4.0]
DEFAULT_BINARY_THRESHOLD = 3.0
# prediction scale
SCORE_MIN, SCORE_MAX = 1.0, 5.0

# ASCII punctuation as explicit ranges: ! to /, : to @, [ to `, { to ~
PUNCT_PATTERN = "[!-/:-@\\[-`{-~]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binarise(score, threshold: float = DEFAULT_BINARY_THRESHOLD) -> Column:
    """PRJ-1: score >= threshold -> 1 else -1."""
    return F.when(col(score) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(-1)).cast("int")


def clamp(x, lo: float = SCORE_MIN, hi: float = SCORE_MAX) -> Column:
    """PRJ-2: bound a prediction to [lo, hi]."""
    return F.least(F.greatest(col(x), F.lit(lo)), F.lit(hi))


def rescale(x, lo: float = SCORE_MIN, hi: float = SCORE_MAX,
            src_lo: float = 0.0, src_hi: float = 1.0) -> Column:
    """PRJ-3: linear map from [src_lo, src_hi] to [lo, hi]."""
    return (col(x) - F.lit(src_lo)) / F.lit(src_hi - src_lo) * F.lit(hi - lo) + F.lit(lo)


def age_bucket(age) -> Column:
    """PRJ-4: first upper bound with age <= bound; null above the last one."""
    out = None
    for b in AGE_BUCKETS:
        cond = col(age) <= F.lit(b)
        out = F.when(cond, F.lit(b)) if out is None else out.when(cond, F.lit(b))
    return out


def normalise_title(title) -> Column:
    """PRJ-7: drop a trailing '(YYYY)' and a trailing ', The'."""
    t = F.trim(F.regexp_replace(col(title), "\\s*\\(\\d{4}\\)\\s*$", ""))
    return F.trim(F.regexp_replace(t, ",\\s*The$", ""))


def trimmed_split(s, sep: str) -> Column:
    """PRJ-8: split and trim every element."""
    return F.transform(F.split(col(s), sep), lambda x: F.trim(x))


def strip_punctuation_lower(text) -> Column:
    """SCL-3: lower-case and delete ASCII punctuation."""
    return F.regexp_replace(F.lower(col(text)), PUNCT_PATTERN, "")


def tokenise(text) -> Column:
    """SCL-4: whitespace tokens of normalised text, empty tokens removed."""
    return F.filter(F.split(F.trim(strip_punctuation_lower(text)), "\\s+"), lambda t: F.length(t) > 0)


def dot(a, b) -> Column:
    """SCL-10: dot product of two equal-length double arrays."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def dec(x, scale: int = 9) -> Column:
    """Round a similarity to DECIMAL(18, scale) so sums are order-independent."""
    return col(x).cast(f"decimal(18,{scale})")


def r6(x) -> Column:
    """Round a reported double to 6 places (adding 0.0 turns -0.0 into 0.0)."""
    return F.round(col(x).cast("double"), 6) + F.lit(0.0)


def r6_dec(x) -> Column:
    """Round a DECIMAL to 6 places exactly (decimal arithmetic), then report a double."""
    return F.round(col(x), 6).cast("double") + F.lit(0.0)
