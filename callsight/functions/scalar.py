"""Small scalar helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """Num / den as double; NULL when den is 0 (never an ANSI error)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def percent(num, den) -> Column:
    return ratio(num, den) * F.lit(100.0)


def round2(c, half_even: bool = False) -> Column:
    """2 decimals; ``half_even`` reproduces pandas/NumPy rounding."""
    return F.bround(_col(c), 2) if half_even else F.round(_col(c), 2)


def percent_label(p) -> Column:
    """``round(p, 2)`` as text plus ``%``."""
    return F.concat(F.round(_col(p), 2).cast("string"), F.lit("%"))


def flag_int(cond) -> Column:
    """Boolean to 0/1 (NULL stays NULL)."""
    return _col(cond).cast("int")


def format_id(prefix: str, number) -> Column:
    """Prefix + zero-padded 9-digit number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%09d", _col(number).cast("long"))


def clip(c, lo: float, hi: float) -> Column:
    """Bound to [lo, hi]."""
    return F.least(F.greatest(_col(c), F.lit(float(lo))), F.lit(float(hi)))


def prob_at(probability, k: int) -> Column:
    """K-th entry of an MLlib probability vector."""
    return vector_to_array(_col(probability))[k]


def decode_label(idx, labels: Sequence[str]) -> Column:
    """Index to label; an index outside the list becomes its own text."""
    arr = F.array(*[F.lit(x) for x in labels])
    i = _col(idx).cast("int")
    inside = (i >= 0) & (i < len(labels))
    return F.when(inside, F.element_at(arr, i + 1)).otherwise(_col(idx).cast("string"))


def label_flags(c, mapping: Mapping) -> Column:
    """Lookup through a fixed dict; unmapped keys give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[_col(c)]


def category_or_default(c, default: str = "sin_categoria") -> Column:
    """NULL category to a default label."""
    return F.coalesce(_col(c), F.lit(default))
