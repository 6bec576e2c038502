"""Gold stores, the modelling set, the training calendar and the splits."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators.ranking import exact_rank
from churnlake.schema import (
    GOLD_FEATURE_COLUMNS, KEYS, OOT_MONTHS, SPLIT_SEED, TRAIN_RATIO, TRAIN_TEST_MONTHS,
)


def gold_feature_store(silver_features: DataFrame, silver_meta: DataFrame) -> DataFrame:
    """features ⨝ meta on (customerID, Snapshot_Date), keys first and once.

    Both sides are full-size, so this is a sort-merge join on the two keys (AQE
    may demote it to a broadcast when one side turns out small at run time, and
    splits skewed partitions).  Keys are unique per row, so no key is hot.
    """
    return silver_features.join(silver_meta, KEYS, "inner").select(GOLD_FEATURE_COLUMNS)


def gold_label_store(silver_labels: DataFrame) -> DataFrame:
    """The label store is the silver label table as is."""
    return silver_labels.select("customerID", "Churn", "Snapshot_Date")


def eda_set(gold_features: DataFrame, labels: DataFrame) -> DataFrame:
    """features ⨝ meta ⨝ labels on both keys (the merged analysis set)."""
    return gold_features.join(labels, KEYS, "inner")


def train_calendar(train_date: Column, tt_months: int = TRAIN_TEST_MONTHS,
                   oot_months: int = OOT_MONTHS) -> list[Column]:
    """oot_end = T-1d, oot_start = T-1mo, tt_end = oot_start-1d, tt_start = oot_start-3mo."""
    oot_start = F.add_months(train_date, -oot_months)
    return [
        train_date.alias("model_train_date"),
        F.date_sub(train_date, 1).alias("oot_end_date"),
        oot_start.alias("oot_start_date"),
        F.date_sub(oot_start, 1).alias("train_test_end_date"),
        F.add_months(oot_start, -tt_months).alias("train_test_start_date"),
    ]


def calendar_dates(train_date: str, tt_months: int = TRAIN_TEST_MONTHS,
                   oot_months: int = OOT_MONTHS) -> dict[str, dt.date]:
    """The same calendar as Python dates (used to build partition-pruning filters)."""
    t = dt.date.fromisoformat(train_date)

    def add_months(d: dt.date, m: int) -> dt.date:
        y, mo = divmod(d.month - 1 + m, 12)
        y, mo = d.year + y, mo + 1
        last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30,
                31, 31, 30, 31, 30, 31][mo - 1]
        return dt.date(y, mo, min(d.day, last))

    oot_start = add_months(t, -oot_months)
    return {
        "model_train_date": t,
        "oot_end_date": t - dt.timedelta(days=1),
        "oot_start_date": oot_start,
        "train_test_end_date": oot_start - dt.timedelta(days=1),
        "train_test_start_date": add_months(oot_start, -tt_months),
    }


def modelling_set(labels: DataFrame, gold_features: DataFrame, train_date: str) -> DataFrame:
    """labels ⟕ features inside [train_test_start, oot_end]; unmatched labels keep null features.

    The date range is a literal filter on both sides, so it reaches the
    parquet scans (partition pruning on Snapshot_Date-partitioned stores).
    """
    cal = calendar_dates(train_date)
    lo, hi = cal["train_test_start_date"], cal["oot_end_date"]
    lab = labels.where(F.col("Snapshot_Date").between(F.lit(lo), F.lit(hi)))
    feat = gold_features.where(F.col("Snapshot_Date").between(F.lit(lo), F.lit(hi)))
    feature_cols = [c for c in gold_features.columns if c not in KEYS]
    return lab.join(feat, KEYS, "left").select(*KEYS, "Churn", *feature_cols)


def temporal_split(mset: DataFrame, train_date: str) -> DataFrame:
    """Adds ``part``: 'train_test' or 'oot' by calendar; rows without a label are left out."""
    cal = calendar_dates(train_date)
    d = F.col("Snapshot_Date")
    part = (F.when(d.between(F.lit(cal["oot_start_date"]), F.lit(cal["oot_end_date"])), F.lit("oot"))
            .when(d.between(F.lit(cal["train_test_start_date"]), F.lit(cal["train_test_end_date"])),
                  F.lit("train_test")))
    return mset.where(F.col("Churn").isNotNull()).withColumn("part", part).where(F.col("part").isNotNull())


def split_hash(seed: int = SPLIT_SEED) -> Column:
    """Deterministic 60-bit shuffle key from md5(customerID|Snapshot_Date|seed)."""
    text = F.concat_ws("|", F.col("customerID"), F.col("Snapshot_Date").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


HASH_BITS, HASH_STEP = 60, 12


def select_thresholds(narrow: DataFrame, wanted: dict) -> dict:
    """The ``wanted[label]``-th smallest ``_h`` per label: (threshold, rows above the place with that hash).

    Found by histograms of the next ``HASH_STEP`` bits of the hash, inside the bucket that holds the place: a few
    passes over (label, hash), of which at most labels x 2**HASH_STEP counts reach the driver.  Rows are neither
    ranked nor shuffled.
    """
    found = {label: (0, k, None) for label, k in wanted.items() if k > 0}     # prefix, rows still to take, rows in it
    out = {label: (-1, 0) for label, k in wanted.items() if k <= 0}
    for done in range(HASH_STEP, HASH_BITS + 1, HASH_STEP):
        open_ = {label: f for label, f in found.items() if label not in out}
        if not open_:
            break
        shift = HASH_BITS - done
        inside = F.lit(False)
        for label, (prefix, _, _) in open_.items():
            inside = inside | ((F.col("_y") == F.lit(label)) & (F.shiftright("_h", shift + HASH_STEP) == F.lit(prefix)))
        counts = (narrow.where(inside).groupBy("_y", F.shiftright("_h", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        for label, (_, left, _) in open_.items():
            for bucket, n in sorted((r["b"], r["n"]) for r in counts if r["_y"] == label):
                if left <= n:
                    found[label] = (bucket, left, n)
                    if left == n:                   # the whole bucket: its last possible hash
                        out[label] = (((bucket + 1) << shift) - 1, 0)
                    break
                left -= n
    for label, (prefix, left, n) in found.items():
        if label not in out:
            out[label] = (prefix, n - left)
    return out


def stratified_split(df: DataFrame, label_col: str = "Churn", ratio: float = TRAIN_RATIO,
                     seed: int = SPLIT_SEED, exact: bool = True) -> DataFrame:
    """Adds ``part`` 'train'/'test': per label, the first floor(ratio*n) rows in hash order train.

    ``exact`` finds each label's threshold hash by iterated histograms, so rows stay where they are; only if rows
    with equal hashes (repeated keys) lie across a threshold they are ranked.  ``exact=False`` is a one-pass
    hash threshold with the same expected proportions.  Rows without a label are left out.
    """
    keyed = df.withColumn("_h", split_hash(seed))
    if not exact:
        part = F.when(F.pmod(F.col("_h"), F.lit(10000)) < int(ratio * 10000), "train").otherwise("test")
        return keyed.withColumn("part", part).drop("_h")
    narrow = keyed.select(F.col(label_col).alias("_y"), "_h").where(F.col("_y").isNotNull())
    sizes = {r["_y"]: r["n"] for r in narrow.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = select_thresholds(narrow, {label: math.floor(n * ratio) for label, n in sizes.items()})
    if any(tied for _, tied in cuts.values()):
        ranked = exact_rank(keyed.where(F.col(label_col).isNotNull()), [label_col], ["_h", *KEYS], "_rank")
        limit = F.create_map(*[F.lit(v) for label, n in sizes.items() for v in (label, math.floor(n * ratio))])
        part = F.when(F.col("_rank") <= limit[F.col(label_col)], "train").otherwise("test")
        return ranked.withColumn("part", part).drop("_h", "_rank")
    train = F.lit(False)
    for label, (cut, _) in cuts.items():
        train = train | ((F.col(label_col) == F.lit(label)) & (F.col("_h") <= F.lit(cut)))
    return keyed.where(F.col(label_col).isNotNull()).withColumn("part", F.when(train, "train").otherwise("test")).drop("_h")


def split_summary(parts: DataFrame, label_col: str = "Churn") -> DataFrame:
    """Rows and mean label per part, mean rounded to 2 places."""
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.round(F.avg(F.col(label_col).cast("double")), 2).alias("label_mean"),
    )
