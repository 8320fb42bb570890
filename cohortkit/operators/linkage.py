"""Linking two extracts.

The merge of two visit-level extracts is: drop exact duplicates, number
each entity's visits by earliest date (undated last, explicit tie key),
join n-th visit to n-th visit, then check identity columns pair by pair.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalar as S
from ..functions import windows as Wn
from ..session import broadcast_if_small


def join_on(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
            how: str = "inner") -> DataFrame:
    """Equi-join on a composite key whose names differ between sides.
    Both sides large -> sort-merge / shuffled hash chosen by AQE."""
    cond = [left[l] == right[r] for l, r in zip(left_keys, right_keys)]
    return left.join(right, cond, how)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicate rows (partial aggregation before the shuffle)."""
    return df.dropDuplicates(list(subset) if subset else None)


def duplicated_ids(df: DataFrame, id_cols: str | Sequence[str]) -> DataFrame:
    """Ids that occur more than once, with their counts."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return (df.groupBy(*ids).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def visit_number(df: DataFrame, id_col: str, date_cols: Sequence[str], tie_cols: Sequence[str],
                 out: str = "visit_number") -> DataFrame:
    """1-based visit number per entity ordered by the earliest of the
    date columns (undated rows last, N9), then by the tie key.  Uses the
    skew-safe row number so one entity with a third of the rows is split."""
    d = df.withColumn("__sort_date", S.earliest(date_cols))
    r = Wn.row_number(d, [id_col], ["__sort_date", *tie_cols], out=out)
    return r.drop("__sort_date")


def visit_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
               left_dates: Sequence[str], right_dates: Sequence[str],
               left_tie: Sequence[str], right_tie: Sequence[str],
               visit_col: str = "visit_number", suffix: str = "_2") -> DataFrame:
    """De-duplicate both sides, number visits, join visit n to visit n.
    Right-side columns that clash with left names get ``suffix``."""
    l = visit_number(dedupe(left), left_id, left_dates, left_tie, visit_col)
    r = visit_number(dedupe(right), right_id, right_dates, right_tie, visit_col)
    clash = [c for c in r.columns if c in l.columns]
    r = r.withColumnsRenamed({c: f"{c}{suffix}" for c in clash})
    return join_on(l, r, [left_id, visit_col], [right_id, f"{visit_col}{suffix}"], "inner")


def identity_check(merged: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Mismatches per identity pair in one aggregation (null on either
    side is a mismatch, N5); ``accepted`` is true when there are none."""
    aggs = [F.count_if(S.differs(a, b)).alias(f"m{i}") for i, (a, b) in enumerate(pairs)]
    counts = merged.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stack = F.stack(F.lit(len(pairs)), *[x for i, (a, b) in enumerate(pairs)
                                         for x in (F.lit(a), F.lit(b), F.col(f"m{i}"))])
    return (counts.select("n_rows", stack.alias("left_col", "right_col", "n_mismatch"))
                  .withColumn("accepted", F.col("n_mismatch") == 0))


def mismatch_rows(merged: DataFrame, pairs: Sequence[tuple[str, str]], key_cols: Sequence[str]) -> DataFrame:
    """The mismatching rows of every pair, appended into one table."""
    parts = []
    for a, b in pairs:
        parts.append(merged.where(S.differs(a, b)).select(
            *key_cols, F.lit(a).alias("left_col"),
            F.col(a).cast("string").alias("left_value"), F.col(b).cast("string").alias("right_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def attach_label(df: DataFrame, labels: DataFrame, key: str, label_key: str | None = None,
                 how: str = "inner") -> DataFrame:
    """J4 (inner: entities without a label are dropped) / J5 (left: a key
    join replacing positional alignment).  The label table is broadcast only
    when a bounded count proves it small."""
    label_key = label_key or key
    lab = labels if label_key == key else labels.withColumnRenamed(label_key, key)
    return df.join(broadcast_if_small(lab), on=key, how=how)


def pair_by_rank(a: DataFrame, b: DataFrame, label_col: str, key_col: str,
                 suffix_a: str = "_a", suffix_b: str = "_b") -> DataFrame:
    """Within each label pair the i-th row of A with the i-th row of B
    (ordered by key), up to the smaller count."""
    ra = Wn.row_number(a, [label_col], [key_col], out="pair_rank")
    rb = Wn.row_number(b, [label_col], [key_col], out="pair_rank")
    ra = ra.withColumnsRenamed({c: f"{c}{suffix_a}" for c in ra.columns if c not in (label_col, "pair_rank")})
    rb = rb.withColumnsRenamed({c: f"{c}{suffix_b}" for c in rb.columns if c not in (label_col, "pair_rank")})
    return ra.join(rb, on=[label_col, "pair_rank"], how="inner")


def missing_labels(pairs: DataFrame, expected: DataFrame, label_col: str) -> DataFrame:
    """Expected labels that have no pair (left anti join)."""
    return expected.join(pairs.select(label_col).distinct(), on=label_col, how="left_anti")


def lookup_with_default(df: DataFrame, col: str, table: DataFrame, key: str, value: str,
                        out: str, default) -> DataFrame:
    """Dictionary join with a default for unmatched keys."""
    t = table.select(F.col(key).alias("__lk"), F.col(value).alias("__lv")).dropDuplicates(["__lk"])
    d = df.join(broadcast_if_small(t), F.col(col) == F.col("__lk"), "left")
    return d.withColumn(out, F.coalesce(F.col("__lv"), F.lit(default))).drop("__lk", "__lv")


def compare_predictions(base: DataFrame, variant: DataFrame, key: str, actual: str,
                        base_pred: str, variant_pred: str) -> DataFrame:
    """Baseline vs variant on the same rows (equi-join on the key)."""
    v = variant.select(key, F.col(variant_pred).alias("__vp"))
    return (base.select(key, actual, base_pred).join(v, on=key, how="inner")
                .select(key, actual, F.col(base_pred).alias("pred_base"), F.col("__vp").alias("pred_variant"),
                        (F.col(base_pred) == F.col(actual)).cast("int").alias("correct_base"),
                        (F.col("__vp") == F.col(actual)).cast("int").alias("correct_variant")))


def compare_counts(df: DataFrame, key: str, actual: str, base_pred: str, variants: dict[str, str], classes: Sequence) -> DataFrame:
    """J10 for many variants at once: ``(variant, n11, n12, n21, n22)`` of the
    pairs that ``compare_predictions`` joins for each of ``variants`` (name ->
    column), all predictions being columns of ``df`` and among ``classes``.  Rows
    are counted by key in one shuffle and a key's pairs are products of its
    counts, so no pair is built, however often a key repeats."""
    y, n = F.col(actual), F.col("__n")
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.count(actual).alias("__y"),
        *[F.count_if(y == c).alias(f"__y{i}") for i, c in enumerate(classes)],
        *[F.count_if((y == c) & (F.col(base_pred) == c)).alias(f"__b{i}") for i, c in enumerate(classes)],
        *[F.count_if(F.col(v) == c).alias(f"__v{j}_{i}") for j, v in enumerate(variants.values()) for i, c in enumerate(classes)])
    whole, right, sums = F.sum(F.col("__y") * n), [F.col(f"__b{i}") for i in range(len(classes))], []
    wrong = [F.col(f"__y{i}") - b for i, b in enumerate(right)]
    for j in range(len(variants)):
        hit = [F.col(f"__v{j}_{i}") for i in range(len(classes))]
        n11 = F.sum(sum((b * v for b, v in zip(right, hit)), F.lit(0)))
        n12 = F.sum(sum((b * (n - v) for b, v in zip(right, hit)), F.lit(0)))
        n21 = F.sum(sum((w * v for w, v in zip(wrong, hit)), F.lit(0)))
        sums += [n11.alias(f"__n11_{j}"), n12.alias(f"__n12_{j}"), n21.alias(f"__n21_{j}")]
    wide = rows.agg(whole.alias("__whole"), *sums)

    def of(part: str, j: int):
        return F.coalesce(F.col(f"__{part}_{j}"), F.lit(0)).cast("long").alias(part)
    one = [F.struct(F.lit(v).alias("variant"), of("n11", j), of("n12", j), of("n21", j),
                    F.coalesce(F.col("__whole") - F.col(f"__n11_{j}") - F.col(f"__n12_{j}") - F.col(f"__n21_{j}"), F.lit(0)).cast("long").alias("n22"))
           for j, v in enumerate(variants)]
    return wide.select(F.inline(F.array(*one)))


def align_columns(df: DataFrame, schema: StructType | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The training column list: absent columns added as typed nulls,
    extra columns dropped, same order."""
    fields = schema.fields if isinstance(schema, StructType) else None
    names = [f.name for f in fields] if fields else list(schema)
    types = {f.name: f.dataType for f in fields} if fields else {}
    cols = [F.col(k) for k in keep]
    for n in names:
        if n in df.columns:
            cols.append(F.col(n).cast(types[n]) if n in types else F.col(n))
        else:
            cols.append(F.lit(None).cast(types.get(n, "string")).alias(n))
    return df.select(*cols)
