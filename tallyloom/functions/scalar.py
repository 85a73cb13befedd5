"""Column expressions for cleaning: lenient casts, sentinels, flags, codes, safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lenient(col, kind: str, default=None) -> Column:
    """Cast that yields NULL (then the default) instead of failing on text that does not parse."""
    cast = _c(col).cast("string").try_cast(kind)
    return cast if default is None else F.coalesce(cast, F.lit(default).cast(kind))


def ratio(num, den) -> Column:
    """Quotient with NULL for a zero denominator."""
    return F.try_divide(_c(num), _c(den))


def sentinel_to_null(col, sentinel=0) -> Column:
    return F.nullif(_c(col), F.lit(sentinel))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 otherwise (NULL counts as not holding)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def any_flag(*cols) -> Column:
    total = _c(cols[0])
    for col in cols[1:]:
        total = total + _c(col)
    return flag(total > 0)


def truth_code(col, yes: str = "true", no: str = "false") -> Column:
    """1 / 0 / NULL from text truth values; anything else is NULL, see `truth_unknown`."""
    return F.when(_c(col) == yes, F.lit(1)).when(_c(col) == no, F.lit(0))


def truth_unknown(col, yes: str = "true", no: str = "false") -> Column:
    return flag(~F.coalesce(_c(col).isin(yes, no), F.lit(False)))


def code_by_members(col, groups: dict[int, list], default: int = 0) -> Column:
    """Category code by membership: {code: [values]}."""
    out = None
    for code, values in groups.items():
        test = _c(col).isin(*values)
        out = F.when(test, F.lit(code)) if out is None else out.when(test, F.lit(code))
    return out.otherwise(F.lit(default))


def dummies(col: str, levels: list, prefix: str | None = None) -> dict[str, Column]:
    """One 0/1 column per named level."""
    return {f"{prefix or col}_{level}": flag(F.col(col) == F.lit(level)) for level in levels}


def money(col, symbol: str = "$") -> Column:
    """Number from text with a currency symbol."""
    return F.replace(_c(col), F.lit(symbol), F.lit("")).try_cast("double")


def pad_left(col, width: int, fill: str = "0") -> Column:
    """Left-pad; text already longer than the width is kept whole."""
    text = _c(col).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, fill))


def epoch_date(col) -> Column:
    """UTC date of epoch seconds, whatever the session time zone is."""
    days = F.floor(_c(col) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def odds_probability(odds) -> Column:
    return ratio(_c(odds), F.lit(1.0) + _c(odds))


def threshold_class(prob, cut: float = 0.5) -> Column:
    return flag(_c(prob) > cut)


def joined_text(*cols, sep: str = " ", null_policy: str = "drop") -> Column:
    """Concatenate text fields; NULL if any part is NULL ("drop") or NULL parts as empty text ("blank")."""
    parts = [_c(c) if null_policy == "drop" else F.coalesce(_c(c), F.lit("")) for c in cols]
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(sep), part]
    return F.concat(*pieces)
