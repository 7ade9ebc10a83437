"""Row-wise features, category handling, fills and table-level filters.

Group statistics attached to rows (counts, medians, modes, frequencies) are
computed as a ``groupBy`` on the key and joined back instead of a window
partitioned by the key: partial aggregation keeps a hot key from landing in
one task, and the statistics table has one row per key, which adaptive
execution broadcasts when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.operators.quantiles import grouped_medians
from stratum.operators.scan import range_scan


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def finite_filter(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = S.finite(c) if cond is None else cond & S.finite(c)
    return df.filter(cond)


def min_support_filter(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keep rows of keys with at least ``n`` rows (HAVING + semi-join)."""
    keep = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(key)
    return df.join(keep, key, "left_semi")


def in_range_filter(df: DataFrame, ref: DataFrame, key: str, value: str, ref_value: str) -> DataFrame:
    """Keep rows whose ``value`` lies in the [min, max] of ``ref_value`` for the same key."""
    rng = ref.groupBy(key).agg(F.min(ref_value).alias("_lo"), F.max(ref_value).alias("_hi"))
    return (df.join(rng, key).filter(F.col(value).between(F.col("_lo"), F.col("_hi")))
            .drop("_lo", "_hi"))


def collapse_infrequent(df: DataFrame, c: str, n: int, out: str | None = None, to: str = "Rare") -> DataFrame:
    """Values seen fewer than ``n`` times -> ``to`` (counts via group-by, joined back)."""
    freq = df.groupBy(c).agg(F.count(F.lit(1)).alias("_freq"))
    res = df.join(freq, df[c].eqNullSafe(freq[c]), "left").drop(freq[c])
    return res.withColumn(out or c, F.when(F.col("_freq") < n, F.lit(to)).otherwise(F.col(c))).drop("_freq")


def ordinal_encode(df: DataFrame, c: str, out: str) -> DataFrame:
    """Category -> 0-based code in sorted value order; null has no code.

    The ranking runs on the distinct values, over range partitions, so a
    column with very many of them is numbered by all tasks.
    """
    codes = range_scan(df.select(c).distinct().filter(F.col(c).isNotNull()), [], [F.col(c).asc()], out)
    return df.join(codes, c, "left")


def align_columns(df: DataFrame, expected: Sequence[str], fill=0.0) -> DataFrame:
    """Select ``expected`` in order; columns the table lacks are filled with ``fill``."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in expected])


def select_except(df: DataFrame, exclude: Sequence[str], prefix: str | None = None) -> DataFrame:
    keep = [c for c in df.columns if c not in set(exclude) and not (prefix and c.startswith(prefix))]
    return df.select(*keep)


def optional_column(df: DataFrame, c: str, dtype: str = "double") -> DataFrame:
    """Use ``c`` when present, else add it as a typed null."""
    return df if c in df.columns else df.withColumn(c, F.lit(None).cast(dtype))


def group_count(df: DataFrame, key: str, out: str) -> DataFrame:
    """Group size attached to each row; null key -> null size."""
    cnt = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return df.join(cnt, key, "left")


def share_per_member(df: DataFrame, amount: str, size: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(amount) / F.greatest(F.col(size), F.lit(1)))


def group_median_fill(df: DataFrame, key: str, c: str, out: str | None = None) -> DataFrame:
    """Null -> median of its group, computed over all rows of the group."""
    med = grouped_medians(df, [key], {"_med": c})
    res = df.join(med, df[key].eqNullSafe(med[key]), "left").drop(med[key])
    return res.withColumn(out or c, F.coalesce(F.col(c), F.col("_med"))).drop("_med")


def train_median_fill(df: DataFrame, key: str, c: str, is_train: str, out: str | None = None) -> DataFrame:
    """Null -> group median over train rows only; unseen group -> global train median."""
    tr = df.filter(F.col(is_train))
    med = grouped_medians(tr, [key], {"_gmed": c})
    glob = grouped_medians(tr, [], {"_all": c})  # one row
    res = df.join(med, key, "left").crossJoin(F.broadcast(glob))
    return (res.withColumn(out or c, F.coalesce(F.col(c), F.col("_gmed"), F.col("_all")))
            .drop("_gmed", "_all"))


def mode_value(df: DataFrame, c: str) -> DataFrame:
    """Most frequent non-null value; ties -> smallest value (one row)."""
    return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_cnt"))
            .orderBy(F.col("_cnt").desc(), F.col(c).asc()).limit(1).select(F.col(c).alias("_mode")))


def mode_fill(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    m = mode_value(df, c)  # exactly one row
    return (df.crossJoin(F.broadcast(m)).withColumn(out or c, F.coalesce(F.col(c), F.col("_mode")))
            .drop("_mode"))


def simple_impute(train: DataFrame, apply_to: DataFrame, numeric: Sequence[str],
                  categorical: Sequence[str]) -> DataFrame:
    """Median for numerics and most-frequent for categoricals, fitted on ``train``."""
    fitted = grouped_medians(train, [], {f"_fit_{c}": c for c in numeric}) if numeric else None
    res = apply_to
    if fitted is not None:
        res = res.crossJoin(F.broadcast(fitted))
    for c in categorical:
        res = res.crossJoin(F.broadcast(mode_value(train, c).withColumnRenamed("_mode", f"_fit_{c}")))
    for c in list(numeric) + list(categorical):
        res = res.withColumn(c, F.coalesce(F.col(c), F.col(f"_fit_{c}"))).drop(f"_fit_{c}")
    return res


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Count and share per value (share over a one-row total)."""
    cnt = df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    tot = df.agg(F.count(F.lit(1)).alias("_tot"))
    return cnt.crossJoin(F.broadcast(tot)).withColumn("share", F.col("count") / F.col("_tot")).drop("_tot")


def group_stat_table(df: DataFrame, key: str, metric: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(metric).alias("max"), F.avg(metric).alias("mean"),
                               F.count(metric).alias("count"))


def interaction_features(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def skew_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c)) for c in cols})


# The selector's bin-to-variant table and its fallback variant.
SELECTOR_BIN_VARIANTS = {
    0: "pf_scale_5_hold_0.2",
    1: "pf_scale_3_hold_0.15",
    2: "pf_scale_12_beam_0.2_hold_0.15",
    3: "pf_scale_5_hold_0.15",
    4: "pf_scale_5_beam_0.05_hold_0.05",
    5: "pf_scale_12_beam_0.2_hold_0.05",
}
SELECTOR_GLOBAL_VARIANT = "pf_scale_8_hold_0.2"


def bin_code_variant(df: DataFrame, entity: str, eval_flag: Column, z: str, n_threshold: float,
                     span_thresholds: Sequence[float], variants: dict | None = None,
                     default: str = SELECTOR_GLOBAL_VARIANT) -> DataFrame:
    """Per entity: code = n_bin + 2*z_bin over the eval zone -> variant name."""
    variants = SELECTOR_BIN_VARIANTS if variants is None else variants
    ev = df.withColumn("_ev", eval_flag)
    g = ev.groupBy(entity).agg(
        F.sum(F.col("_ev").cast("long")).cast("double").alias("n_eval"),
        F.coalesce(F.max(F.when(F.col("_ev"), F.col(z))) - F.min(F.when(F.col("_ev"), F.col(z))),
                   F.lit(0.0)).alias("z_span"))
    code = ((F.col("n_eval") > F.lit(n_threshold)).cast("long")
            + 2 * S.bin_searchsorted_right("z_span", span_thresholds))
    g = g.withColumn("code", code)
    return g.withColumn("variant", S.map_values(F.col("code").cast("string"),
                                                {str(k): v for k, v in variants.items()}))\
            .withColumn("variant", F.when(F.col("code").isin(list(variants)), F.col("variant"))
                        .otherwise(F.lit(default)))


# ---- passenger-table feature build ---------------------------------------------------------------

# Title synonyms, the common-title list, the listed rare titles, and the
# family-size buckets (right-closed edges) used by the passenger feature build.
TITLE_CANON = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
COMMON_TITLES = ["Mr", "Mrs", "Miss", "Master"]
RARE_TITLES = ["Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona"]
FAMILY_EDGES = [0, 1, 4, 100]
FAMILY_LABELS = ["alone", "small", "large"]


def passenger_features(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target-free enrichment of a passenger table (train and test together).

    Title (extracted, canonicalised, unlisted -> Rare), FamilySize, IsAlone,
    FamilyBucket, TicketGroupSize (counted over train + test), Fare filled by
    class median over both, FarePerPerson, Deck (U when unknown), Embarked
    filled with the mode, Age filled with the train-only median of its Title
    (global train median for an unseen title).
    """
    both = union_tag(train, test)
    t = S.regex_extract_trim("Name")
    both = both.withColumn("Title", S.collapse_unlisted(S.map_values(t, TITLE_CANON), COMMON_TITLES))
    both = both.withColumn("FamilySize", F.col("SibSp") + F.col("Parch") + 1)
    both = both.withColumn("IsAlone", S.bool_flag(F.col("FamilySize") == 1))
    both = both.withColumn("FamilyBucket", S.bin_right_closed("FamilySize", FAMILY_EDGES, FAMILY_LABELS))
    both = group_count(both, "Ticket", "TicketGroupSize")
    both = group_median_fill(both, "Pclass", "Fare")
    both = share_per_member(both, "Fare", "TicketGroupSize", "FarePerPerson")
    both = both.withColumn("Deck", S.first_char_default("Cabin"))
    both = mode_fill(both, "Embarked")
    both = train_median_fill(both.withColumn("_is_tr", F.col("_src") == "tr"), "Title", "Age", "_is_tr").drop("_is_tr")
    both = both.withColumn("Age", F.col("Age").cast("double"))
    keep = ["Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "Embarked", "Title", "FamilySize", "IsAlone",
            "FamilyBucket", "TicketGroupSize", "FarePerPerson", "Deck"]
    tr = both.filter(F.col("_src") == "tr").select("PassengerId", *([c for c in ["Survived"] if c in train.columns]), *keep)
    te = both.filter(F.col("_src") == "te").select("PassengerId", *keep)
    return tr, te


def union_tag(train: DataFrame, test: DataFrame, tag: str = "_src") -> DataFrame:
    return (train.withColumn(tag, F.lit("tr"))
            .unionByName(test.withColumn(tag, F.lit("te")), allowMissingColumns=True))


def title_listed_rare(name_col: str = "Name") -> Column:
    """The model-side Title rule: extracted, canonicalised, listed rare titles -> Rare."""
    return S.collapse_listed(S.map_values(S.regex_extract_trim(name_col), TITLE_CANON), RARE_TITLES)
