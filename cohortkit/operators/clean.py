"""Projection, renaming and cleaning operators.

Every operator takes column names, works only on the ones present, and
reports the missing ones in its return value instead of failing silently.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import broadcast_if_small


def present(df: DataFrame, cols: Iterable[str]) -> tuple[list[str], list[str]]:
    have = set(df.columns)
    cols = list(cols)
    return [c for c in cols if c in have], [c for c in cols if c not in have]


def select_present(df: DataFrame, cols: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """Keep the listed columns that exist (in the listed order)."""
    keep, missing = present(df, cols)
    return df.select(*keep), missing


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop listed columns, ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary, only the columns that exist."""
    m = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(m) if m else df


def suffix_columns(df: DataFrame, cols: Iterable[str], suffix: str = "_2") -> DataFrame:
    """P3 (suffix form): the right side's duplicate names get a suffix."""
    return rename_columns(df, {c: f"{c}{suffix}" for c in cols})


def coalesce_duplicate(df: DataFrame, base: str, copy: str) -> DataFrame:
    """Merge a duplicated column into ``base`` and drop ``copy``.

    If the copy has more non-null values, ``base`` wins and is filled from the
    copy; otherwise the copy wins and is filled from ``base`` (identical
    columns give ``base`` either way).  The two counts come from one scalar
    subquery over the table.
    """
    if copy not in df.columns:
        return df
    stats = df.agg(F.count(base).alias("nb"), F.count(copy).alias("nc"))
    copy_denser = stats.select(F.col("nc") > F.col("nb")).scalar()
    merged = F.when(copy_denser, F.coalesce(F.col(base), F.col(copy))) \
              .otherwise(F.coalesce(F.col(copy), F.col(base)))
    return df.withColumn(base, merged).drop(copy)


def nullify_tokens(df: DataFrame, cols: Iterable[str], tokens: Iterable[str] = S.MISSING_TOKENS) -> DataFrame:
    """P5 on many columns in one projection."""
    keep, _ = present(df, cols)
    return df.withColumns({c: S.missing_to_null(c, tokens) for c in keep})


def map_values(df: DataFrame, labels: DataFrame, columns: Iterable[str],
               normalise: Callable[[Column], Column] | None = None,
               suffix: str = "") -> tuple[DataFrame, list[str]]:
    """Apply a ``(column, code, label)`` table; unmapped codes -> null.

    Each column is looked up with a left join against its slice of the label
    table (broadcast when a bounded count proves it small).  ``normalise``
    (e.g. ``code_normalise``, P7) turns the raw value into the code text
    first.  Returns the frame and the columns that were not present.
    """
    keep, missing = present(df, columns)
    out = df
    for c in keep:
        lab = (labels.where(F.col("column") == c)
                     .select(F.col("code").cast("string").alias(f"__code_{c}"),
                             F.col("label").alias(f"__label_{c}"))
                     .dropDuplicates([f"__code_{c}"]))
        key = normalise(F.col(c)) if normalise else F.col(c).cast("string")
        out = (out.withColumn(f"__key_{c}", key)
                  .join(broadcast_if_small(lab), F.col(f"__key_{c}") == F.col(f"__code_{c}"), "left")
                  .withColumn(f"{c}{suffix}", F.col(f"__label_{c}"))
                  .drop(f"__key_{c}", f"__code_{c}", f"__label_{c}"))
    return out, missing


def clean_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Numbers stored as text -> double in one projection."""
    keep, _ = present(df, cols)
    return df.withColumns({c: S.to_number(c) for c in keep})


def parse_dates(df: DataFrame, cols: Iterable[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """P9."""
    keep, _ = present(df, cols)
    return df.withColumns({c: S.parse_date(c, fmt) for c in keep})


def date_parts(df: DataFrame, pattern: str = "date", drop: bool = True) -> DataFrame:
    """P10: year / month / day for every column whose name contains
    ``pattern``; the originals are dropped."""
    cols = [c for c in df.columns if pattern in c.lower()]
    parts = {}
    for c in cols:
        parts[f"{c}_year"] = F.year(c)
        parts[f"{c}_month"] = F.month(c)
        parts[f"{c}_day"] = F.dayofmonth(c)
    out = df.withColumns(parts) if parts else df
    return out.drop(*cols) if drop else out


def add_durations(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{out: (end, start)}`` day differences."""
    return df.withColumns({o: S.days_between(e, s) for o, (e, s) in pairs.items()
                           if e in df.columns and s in df.columns})


def add_age(df: DataFrame, out: str, end: str, start: str, fallback: str | None = None,
            lo: float = 0, hi: float = 120) -> DataFrame:
    """Guarded age in years; an existing ``fallback`` column fills gaps."""
    age = S.years_between(end, start, lo, hi)
    if fallback and fallback in df.columns:
        fb = F.col(fallback).cast("double")
        age = F.coalesce(age, F.when(fb.between(lo, hi), fb))
    return df.withColumn(out, age)


def add_row_total(df: DataFrame, out: str, items: Iterable[str]) -> DataFrame:
    """P13 (min_count=1 rule N7)."""
    keep, _ = present(df, items)
    return df.withColumn(out, S.row_total(keep) if keep else F.lit(None).cast("double"))


def add_prefix_sum(df: DataFrame, out: str, prefix: str) -> DataFrame:
    """Sum of all columns starting with ``prefix`` (null read as 0)."""
    cols = [c for c in df.columns if c.startswith(prefix) and c != out]
    return df.withColumn(out, S.row_sum_fill0(cols))


def add_combined(df: DataFrame, out: str, a: str, b: str) -> DataFrame:
    """Plain sum; null when either side is null."""
    if a not in df.columns or b not in df.columns:
        return df
    return df.withColumn(out, F.col(a) + F.col(b))


def extract_sentinels(df: DataFrame, cols: Iterable[str], sentinel: float = S.NEVER_OCCURRED,
                      flag_suffix: str = "_never_occurred") -> DataFrame:
    """Sentinel -> flag column + null."""
    keep, _ = present(df, cols)
    flags = {f"{c}{flag_suffix}": S.sentinel_flag(c, sentinel) for c in keep}
    return df.withColumns(flags).withColumns({c: S.sentinel_to_null(c, sentinel) for c in keep})


def drop_incomplete(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any critical column."""
    keep, _ = present(df, cols)
    return df.na.drop(subset=keep) if keep else df


def total_audit(df: DataFrame, total_col: str, items: Sequence[str],
                key_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Recompute the total (rule N7), flag rows whose stored total
    differs (a null on either side counts as a difference, N5).

    Returns ``(kept_rows, report)``; the report has one row: rows checked,
    mismatches, and min / mean / max of the non-null differences.
    """
    keep, _ = present(df, items)
    d = df.withColumn("__recalc", S.row_total(keep)) \
          .withColumn("__diff", F.col("__recalc") - F.col(total_col)) \
          .withColumn("__bad", F.coalesce(F.col("__diff") != 0, F.lit(True)))
    report = d.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if("__bad").alias("n_mismatch"),
                   F.min("__diff").alias("diff_min"),
                   F.avg(F.when(F.col("__bad"), F.col("__diff"))).alias("diff_mean"),
                   F.max("__diff").alias("diff_max"))
    kept = d.where(~F.col("__bad")).drop("__recalc", "__diff", "__bad")
    return kept, report


def group_by_membership(df: DataFrame, col: str, out: str, groups: Mapping[str, Iterable[str]],
                        default: str, normalise: bool = True) -> DataFrame:
    """Map a value to the first group whose list holds it (after
    P19 normalisation), ``default`` otherwise, null for null/empty input.

    The lists become a small ``(key, group)`` table joined by broadcast.
    """
    spark = df.sparkSession
    rows = []
    for g, values in groups.items():
        for v in values:
            rows.append((v, g))
    lookup = spark.createDataFrame(rows, "value string, grp string")
    norm = S.normalise_text if normalise else (lambda c: F.col(c) if isinstance(c, str) else c)
    lookup = (lookup.withColumn("__key", norm(F.col("value")))
                    .withColumn("__ord", F.monotonically_increasing_id()))
    # first group wins when a key is listed twice
    from pyspark.sql import Window
    w = Window.partitionBy("__key").orderBy("__ord")
    lookup = (lookup.withColumn("__r", F.row_number().over(w)).where("__r = 1")
                    .select("__key", F.col("grp").alias("__grp")))
    key = norm(F.col(col))
    d = df.withColumn("__k", key).join(F.broadcast(lookup), F.col("__k") == F.col("__key"), "left")
    res = F.when(F.col(col).isNull() | (F.col("__k") == ""), F.lit(None)) \
           .otherwise(F.coalesce(F.col("__grp"), F.lit(default)))
    return d.withColumn(out, res).drop("__k", "__key", "__grp")


def filter_columns_by_patterns(df: DataFrame, patterns: Iterable[str],
                               keep_cols: Iterable[str] = ()) -> DataFrame:
    """Keep the columns whose names contain none of the substrings
    (``keep_cols`` are always kept)."""
    pats = list(patterns)
    always = set(keep_cols)
    return df.select(*[c for c in df.columns if c in always or not any(p in c for p in pats)])
