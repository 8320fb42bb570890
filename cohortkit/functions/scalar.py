"""Column-level functions (cleaning rules P5-P25 and the null rules N1-N16).

All of them return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen; only text beyond ASCII is decomposed in Python.
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from typing import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied analyses for equal results).
# Missing-value tokens treated as null.
MISSING_TOKENS = ["", "Faltan Datos", "Missing data"]
# Roman grade numerals I..V and their grades.
ROMAN_GRADES = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}
# Characters trimmed from both ends of a text: every white space character of Unicode.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Sentinel for "never occurred" in time-to-event columns.
NEVER_OCCURRED = 1_000_000
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: ColumnOrName, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """P5: missing tokens -> null."""
    c = _c(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def zfill(c: ColumnOrName, width: int) -> Column:
    """Left-pad with zeros but never truncate (``lpad`` truncates)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def code_normalise(c: ColumnOrName, width: int = 3) -> Column:
    """Text of the code, cut at the first '.', zero-padded to ``width``."""
    s = F.split(_c(c).cast("string"), "[.]").getItem(0)
    return zfill(s, width)


def to_number(c: ColumnOrName) -> Column:
    """P8 / N15: '' -> null, unparsable -> null, else double."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s == "", F.lit(None)).otherwise(s).try_cast("double")


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Non-strict parse; bad text -> null."""
    return F.to_date(F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt)))


def sentinel_flag(c: ColumnOrName, sentinel: float = NEVER_OCCURRED) -> Column:
    """1 when the value is the sentinel, else 0 (null -> 0)."""
    return F.when(_c(c) == sentinel, 1).otherwise(0).cast("int")


def sentinel_to_null(c: ColumnOrName, sentinel: float = NEVER_OCCURRED) -> Column:
    """The sentinel becomes null."""
    c = _c(c)
    return F.when(c == sentinel, F.lit(None)).otherwise(c)


def row_total(cols: Iterable[ColumnOrName]) -> Column:
    """Row sum that is null only when every item is null."""
    cs = [_c(c) for c in cols]
    all_null = reduce(lambda a, b: a & b, [c.isNull() for c in cs])
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs])
    return F.when(all_null, F.lit(None)).otherwise(total)


def row_sum_fill0(cols: Iterable[ColumnOrName]) -> Column:
    """Sum of the items with null read as 0."""
    cs = [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols]
    return reduce(lambda a, b: a + b, cs) if cs else F.lit(0.0)


def differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    """N5: 'a != b' where a null on either side counts as a difference."""
    return F.coalesce(_c(a) != _c(b), F.lit(True))


def differs_non_null(a: ColumnOrName, b: ColumnOrName) -> Column:
    """A real difference between two present values."""
    a, b = _c(a), _c(b)
    return a.isNotNull() & b.isNotNull() & (a != b)


@F.pandas_udf(StringType())
def _decomposed(texts: pd.Series) -> pd.Series:
    def plain(t):
        return None if t is None else "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch))
    return texts.map(plain)


def strip_accents(c: ColumnOrName) -> Column:
    """Compatibility decomposition without combining marks, for every code
    point (Spark SQL has no function for it).  Only texts with a character
    beyond ASCII go to Python; all others are returned as they are."""
    s = _c(c)
    return F.coalesce(_decomposed(F.when(F.octet_length(s) > F.char_length(s), s)), s)


def normalise_text(c: ColumnOrName) -> Column:
    """Trim, strip accents, lower, hyphens and punctuation to
    space, squeeze spaces.  'nan'/'none'/'' become ''."""
    s = F.btrim(_c(c).cast("string"), F.lit(WHITE_SPACE))
    s = F.when(F.lower(s).isin("nan", "none"), F.lit("")).otherwise(s)
    s = F.lower(strip_accents(s))
    s = F.regexp_replace(s, "[\\x{2010}\\x{2011}\\x{2012}\\x{2013}\\x{2014}\\x{2212}-]+", " ")
    s = F.regexp_replace(s, "[^\\p{L}\\p{N}_\\s]", " ")
    s = F.regexp_replace(s, "\\s+", " ")
    return F.trim(s)


def grade_parse(c: ColumnOrName) -> Column:
    """A number -> rounded (half-even) int; 'Grade IV' / 'Grado IV' ->
    1-5; else the first lone digit 1-5; else null."""
    raw = _c(c).cast("string")
    num = F.trim(raw).try_cast("double")
    num_ok = num.isNotNull() & ~F.isnan(num) & (F.abs(num) < 1e18)
    s = F.lower(F.trim(raw))
    roman = F.upper(F.regexp_extract(s, "(grade|grado)\\s*([ivx]+)", 2))
    roman_map = F.create_map(*[x for k, v in ROMAN_GRADES.items() for x in (F.lit(k), F.lit(v))])
    digit = F.regexp_extract(s, "\\b([1-5])\\b", 1)
    return (F.when(raw.isNull(), F.lit(None))
            .when(num_ok, F.bround(num, 0).cast("int"))
            .when(roman != "", F.try_element_at(roman_map, roman))
            .when(digit != "", digit.cast("int"))
            .cast("int"))


def clip_round_grade(x: ColumnOrName, lo: float = 1, hi: float = 5) -> Column:
    """Clip to [lo, hi] then round half-to-even."""
    return F.bround(F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(x).cast("double"))), 0)


def disagreement_flag(a: ColumnOrName, b: ColumnOrName) -> Column:
    """1 when the two grades differ."""
    return (_c(a) != _c(b)).cast("int")


def disagreement_magnitude(a: ColumnOrName, b: ColumnOrName) -> Column:
    """|a - b| as int."""
    return F.abs(_c(a) - _c(b)).cast("int")


def scale_unit(arr: ColumnOrName, mean: float = 0.5, std: float = 0.5) -> Column:
    """(x - mean) / std on every element."""
    return F.transform(_c(arr), lambda x: (x.cast("double") - mean) / std)


def unscale_clamp(arr: ColumnOrName, mean: float = 0.5, std: float = 0.5) -> Column:
    """P24 inverse with clamp to [0, 1]."""
    return F.transform(_c(arr), lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x.cast("double") * std + mean)))


def abs_error(pred: ColumnOrName, actual: ColumnOrName) -> Column:
    """P25."""
    return F.abs(_c(pred) - _c(actual))


def earliest(cols: Iterable[ColumnOrName], undated: str = "9999-12-31") -> Column:
    """Row-wise minimum skipping nulls; undated rows get a far sentinel."""
    cs = [_c(c).cast("timestamp") for c in cols]
    m = cs[0] if len(cs) == 1 else F.least(*cs)
    return F.coalesce(m, F.lit(undated).cast("timestamp"))


def years_between(end: ColumnOrName, start: ColumnOrName, lo: float = 0, hi: float = 120) -> Column:
    """Age in years (days / 365.25); outside [lo, hi] -> null."""
    y = F.datediff(_c(end), _c(start)) / F.lit(365.25)
    return F.when(y.between(lo, hi), y)


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """P11."""
    return F.datediff(_c(end), _c(start))
