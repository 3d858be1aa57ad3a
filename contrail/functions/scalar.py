"""Scalar column helpers (I1-I14). All are built-in Spark expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern a delay string must match to count as numeric (C4):
# optional leading minus signs, digits with at most one dot, or the text "nan".
NUMERIC_TEXT_PATTERN = r"^(-*[0-9]*\.?[0-9]+|-*[0-9]+\.?|nan)$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int | None) -> Column:
    """ROUND(x, n) (I1); ``None`` keeps full precision."""
    return col(c) if digits is None else F.round(col(c), digits)


def is_flag(c) -> Column:
    """``c = 1`` as in ``CASE WHEN f = 1``."""
    return col(c) == F.lit(1)


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` -> bigint, 0 on no match."""
    return F.count_if(cond)


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 (SQLite semantics, ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num, den, digits: int | None = 2) -> Column:
    """``ROUND(CAST(num AS FLOAT) / den * 100, digits)``."""
    return rnd(ratio(num, den) * F.lit(100.0), digits)


def pct0(num, den, digits: int | None = 4) -> Column:
    """``ROUND(COALESCE(num * 100.0 / den, 0.0), digits)``."""
    return rnd(F.coalesce(ratio(col(num) * F.lit(100.0), den), F.lit(0.0)), digits)


def avg0(c, digits: int | None = 2) -> Column:
    """``ROUND(COALESCE(AVG(c), 0.0), digits)``."""
    return rnd(F.coalesce(F.avg(col(c)), F.lit(0.0)), digits)


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; SQL only NULL."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def all_of(preds) -> Column:
    """AND-fold of optional predicates (D4); no predicate -> TRUE."""
    preds = [p for p in preds if p is not None]
    return reduce(and_, preds) if preds else F.lit(True)


def route_label(o, d, arrow: str) -> Column:
    """``o || arrow || d``: NULL if either side is NULL, like ``||``."""
    return F.concat(col(o), F.lit(arrow), col(d))


def code_name_label(code, name) -> Column:
    """``code || ' - ' || name``."""
    return F.concat(col(code), F.lit(" - "), col(name))


def day_label(day_name, full_date) -> Column:
    """``day_name (yyyy-mm-dd)``."""
    return F.concat(col(day_name), F.lit(" ("), F.date_format(col(full_date), "yyyy-MM-dd"), F.lit(")"))


def short_day_label(day_name, full_date) -> Column:
    """``day_name mm-dd`` (I8)."""
    return F.concat(col(day_name), F.lit(" "), F.date_format(col(full_date), "MM-dd"))


def date_key(c) -> Column:
    """yyyymmdd integer key of a date."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k) -> Column:
    k = col(k)
    return F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int"))


def stripped(c) -> Column:
    """Text without the white space around it (blanks, tabs, line ends)."""
    return F.trim(col(c).cast("string"), F.lit(" \t\n\v\f\r"))


def numeric_text_ok(c) -> Column:
    """True when the text without white space around it is a valid number (or NULL); C4's rule."""
    t = stripped(c)
    return col(c).isNull() | t.rlike(NUMERIC_TEXT_PATTERN)


def to_number(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` (I9): invalid -> NULL, NaN -> NULL.

    ``try_cast`` alone would also accept Java float suffixes ('1d', '2f');
    'inf' and '-inf' stay infinite, as in the reference.
    """
    t = stripped(c)
    v = F.when(~t.rlike(r"[0-9.][dDfF]$"), t.try_cast("double"))
    return F.nanvl(v, F.lit(None).cast("double"))  # v stands once, so it is parsed once


def hours_between(later, earlier) -> Column:
    """Elapsed hours between two timestamps."""
    return (F.unix_timestamp(col(later)) - F.unix_timestamp(col(earlier))) / F.lit(3600.0)


def capitalize(c) -> Column:
    """Python ``str.capitalize`` (I13): first character upper, the rest lower
    ('late aircraft' -> 'Late aircraft'; ``initcap`` would capitalise each word)."""
    s = col(c)
    return F.concat(F.upper(s.substr(F.lit(1), F.lit(1))),
                    F.lower(s.substr(F.lit(2), F.length(s))))


def map_values(c, mapping: dict, default=None) -> Column:
    """Value map with a default (I13): ``mapping.get(v, default)`` as a CASE."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(
            col(c) == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


# --------------------------------------------------------------------------- one-row sides
def one_row(*aggregates):
    """Combine one-row aggregates (global ``agg`` results) side by side.

    Each input is a global aggregate, so each has exactly one row; the
    result is one row. This is the scalar-subquery shape (E7/E8), never a
    product of two data-sized inputs.
    """
    out = aggregates[0]
    for a in aggregates[1:]:
        out = out.crossJoin(a)
    return out


def with_scalars(df, scalars):
    """Attach a one-row aggregate (medians, min/max) to every row of ``df``:
    the one-row side is broadcast, so ``df`` is neither shuffled nor multiplied."""
    return df.crossJoin(F.broadcast(scalars))
