"""Scalar column expressions used by the operators.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "let", "znorm_fixed", "regex_extract_trim", "first_char_default", "compose_id", "split_id_entity",
    "split_id_row", "file_stem_id", "safe_div", "clip", "map_values", "collapse_listed",
    "collapse_unlisted", "bin_right_closed", "bin_searchsorted_right", "finite", "bool_flag",
    "round_percent", "array_dot", "array_l2_norm", "array_l2_distance", "array_znorm",
    "to_double_array", "array_moments", "parse_spec_field",
]

# The name pattern used to pull a title out of "Last, Title. First".
TITLE_PATTERN = r",\s*([^\.]+)\."


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Spark inlines projected columns into the expressions that use them; inside a
    higher-order function that means re-evaluating them per element.  Binding the
    value as the argument of a one-element ``transform`` evaluates it exactly once.
    """
    return F.transform(F.array(value), body)[0]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_extract_trim(c, pattern: str = TITLE_PATTERN, group: int = 1) -> Column:
    """Capture group, trimmed; no match -> null."""
    return F.nullif(F.trim(F.regexp_extract(col_(c), pattern, group)), F.lit(""))


def first_char_default(c, default: str = "U") -> Column:
    return F.substring(F.coalesce(col_(c), F.lit(default)), 1, 1)


def compose_id(entity, row) -> Column:
    return F.concat_ws("_", col_(entity).cast("string"), col_(row).cast("string"))


def split_id_entity(c, width: int | None = None) -> Column:
    """Entity part: fixed ``width`` prefix when given, else text before the last '_'."""
    if width is not None:
        return F.substring(col_(c), 1, width)
    return F.regexp_extract(col_(c), r"^(.*)_[^_]*$", 1)


def split_id_row(c) -> Column:
    return F.regexp_extract(col_(c), r"_([^_]*)$", 1).cast("long")


def file_stem_id(path, sep: str = "__") -> Column:
    base = F.element_at(F.split(col_(path), "/"), -1)
    return F.element_at(F.split(base, sep, 2), 1)


def safe_div(a, b) -> Column:
    """a / b with a zero divisor giving null (ANSI-safe)."""
    return F.try_divide(col_(a), F.nullif(col_(b), F.lit(0)))


def clip(c, lo=None, hi=None) -> Column:
    out = col_(c)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return out


def map_values(c, mapping: dict) -> Column:
    """Canonicalise through a dict literal; unmapped values pass through."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col_(c)), col_(c)) if mapping else col_(c)


def collapse_listed(c, listed: Sequence[str], to: str = "Rare") -> Column:
    """Listed values -> ``to``; everything else (including null) unchanged."""
    return F.when(col_(c).isin(list(listed)), F.lit(to)).otherwise(col_(c))


def collapse_unlisted(c, keep: Sequence[str], to: str = "Rare") -> Column:
    """Values not in ``keep`` (null too) -> ``to``."""
    return F.when(col_(c).isin(list(keep)), col_(c)).otherwise(F.lit(to))


def bin_right_closed(c, edges: Sequence[float], labels: Sequence[str], missing: str = "nan") -> Column:
    """Right-closed bins (lo, hi]; outside every bin -> ``missing``."""
    x = col_(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(missing))


def bin_searchsorted_right(c, thresholds: Sequence[float]) -> Column:
    """Number of thresholds <= x (``searchsorted(side='right')``)."""
    x = col_(c)
    return sum((x >= F.lit(t)).cast("long") for t in thresholds)


def finite(c) -> Column:
    x = col_(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def bool_flag(cond: Column) -> Column:
    return cond.cast("int")


def round_percent(c, digits: int = 2) -> Column:
    return F.round(col_(c) * 100, digits)


def to_double_array(c) -> Column:
    return F.transform(col_(c), lambda v: v.cast("double"))


def array_dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def array_l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(col_(a), F.lit(0.0), lambda s, v: s + v * v))


def array_l2_distance(a, b) -> Column:
    d = F.zip_with(col_(a), col_(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, v: s + v))


def array_znorm(a, mean=None, sd=None) -> Column:
    """(v - mean) / std (population); std below 1e-9 -> zeros.

    Pass precomputed ``mean``/``sd`` columns (see ``array_moments``) so the
    moments are evaluated once per row, not once per element.
    """
    arr = col_(a)
    if mean is None or sd is None:
        mean, sd = array_moments(arr)
    return F.when(sd > 1e-9, F.transform(arr, lambda v: (v - mean) / sd)).otherwise(
        F.transform(arr, lambda v: v * 0.0))


def znorm_fixed(a, n: int, eps: float = 1e-6) -> Column:
    """(v - mean) / (std + eps) for a length-``n`` array, population std, moments evaluated once."""
    return let(col_(a), lambda arr: let(
        F.aggregate(arr, F.lit(0.0), lambda s, v: s + v) / n,
        lambda m: let(F.sqrt(F.aggregate(arr, F.lit(0.0), lambda s, v: s + (v - m) * (v - m)) / n),
                      lambda sd: F.transform(arr, lambda v: (v - m) / (sd + eps)))))


def array_moments(a):
    """(mean, population std) of a numeric array column."""
    arr = col_(a)
    n = F.size(arr)
    s1 = F.aggregate(arr, F.lit(0.0), lambda s, v: s + v)
    s2 = F.aggregate(arr, F.lit(0.0), lambda s, v: s + v * v)
    mean = s1 / n
    return mean, F.sqrt(F.greatest(s2 / n - mean * mean, F.lit(0.0)))


def parse_spec_field(spec, key: str, default: float = 0.0) -> Column:
    """Value following ``key`` in an underscore-separated spec; missing -> default."""
    parts = F.split(col_(spec), "_")
    pos = F.array_position(parts, F.lit(key))
    val = F.try_element_at(parts, (pos + 1).cast("int")).cast("double")
    return F.when(pos > 0, F.coalesce(val, F.lit(default))).otherwise(F.lit(default))

