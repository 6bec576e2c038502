"""Out-of-time monitoring: scores + truth per month, exact AUC, PSI, KDE tables.

Scale notes
- AUC works on the (month, score) histogram: ties collapse map-side, and the
  cumulative negative count comes from the range-partitioned running sum, so
  no month is ever held by a single task.
- PSI edges are exact linear percentiles computed the same way; binning is a
  per-row array filter against <= 11 broadcast edges.
- KDE evaluates 200 grid points per *distinct* value and sums with partial
  aggregation; the grid never meets the raw rows in a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.scoring import clip, heuristic_score, label_is_yes, month_label
from churnlake.operators.ranking import exact_quantiles, running_sums
from churnlake.session import checkpoint, stored
from churnlake.schema import (
    AUC_ALERT, AUC_PASS_MEAN, CONSTANT_FILLS, KDE_CUT, KDE_GRID_SIZE, KEYS, PSI_CRITICAL,
    PSI_DECILES, PSI_WARNING, PSI_ZERO_SHARE, SCORE_CLIP,
)

JOIN_ROWS = 250_000     # of each table, in one task of a join
MONITOR_FEATURES = ["churn_probability", "monthly_charges"]


def with_heuristic_score(df: DataFrame) -> DataFrame:
    """Adds ``churn_probability`` from filled tenure / MonthlyCharges / Contract."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in CONSTANT_FILLS.items()}
    return df.withColumn("churn_probability",
                         heuristic_score(filled["tenure"], filled["MonthlyCharges"], F.col("Contract")))


def monitoring_set(gold_features: DataFrame, labels: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Score + truth + month per customer snapshot.

    features ⨝ labels on both keys (labels with a null value are left out), then
    the model scores (customerID, Snapshot_Date, churn_probability) if given,
    else the heuristic score.  Output columns: customerID, snapshot_date,
    month_start, month, churn_probability, actual_churn, monthly_charges.
    """
    base = gold_features.join(labels.where(F.col("Churn").isNotNull()), KEYS, "inner")
    if scores is not None:
        base = base.join(scores.select(*KEYS, "churn_probability"), KEYS, "inner")
    else:
        base = with_heuristic_score(base)
    d = F.col("Snapshot_Date")
    return base.select(
        "customerID",
        d.alias("snapshot_date"),
        F.trunc(d, "month").alias("month_start"),
        month_label(d).alias("month"),
        F.col("churn_probability").cast("double").alias("churn_probability"),
        F.col("Churn").cast("int").alias("actual_churn"),
        F.col("MonthlyCharges").cast("double").alias("monthly_charges"),
    )


def predictions_from_scores(scored: DataFrame, model_name: str, cut: float = 0.5) -> DataFrame:
    """(customerID, snapshot_date, model_name, model_predictions, churn_probability)."""
    return scored.select(
        "customerID", F.col("Snapshot_Date").alias("snapshot_date"), F.lit(model_name).alias("model_name"),
        (F.col("churn_probability") > cut).cast("int").alias("model_predictions"),
        F.col("churn_probability"),
    )


def pred_truth_join(predictions: DataFrame, silver_features: DataFrame, labels: DataFrame) -> DataFrame:
    """predictions ⨝ (features ⨝ labels) on (customerID, snapshot_date); prediction renamed.

    One task sorts its part of all three tables, so the number of parts follows the rows: left to themselves the
    parts are merged to one per core, and a task's memory grows with the tables.
    """
    keys = ["customerID", "snapshot_date"]
    predictions = predictions.withColumnRenamed("model_predictions", "binary_prediction")
    silver_features = silver_features.select(*KEYS, "MonthlyCharges")
    labels = labels.where(F.col("Churn").isNotNull()).select(*KEYS, "Churn")
    parts = math.ceil(max(df.count() for df in (predictions, silver_features, labels)) / JOIN_ROWS)
    if parts > 1:           # fewer than the session's partitions would be dealt out again
        parts = max(parts, int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        predictions = predictions.repartition(parts, *keys)
        silver_features, labels = silver_features.repartition(parts, *KEYS), labels.repartition(parts, *KEYS)
    truth = silver_features.join(labels, KEYS, "inner").select(
        "customerID", F.col("Snapshot_Date").alias("snapshot_date"),
        F.col("Churn").alias("actual_churn"), F.col("MonthlyCharges").alias("monthly_charges"),
    )
    joined = predictions.join(truth, keys, "inner")
    return joined.withColumn("month", month_label("snapshot_date"))


def customer_only_fanout(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Size of a customer-only features ⨝ labels join without building it.

    Joining on customerID alone pairs every feature snapshot with every label
    snapshot of the customer.  The pairs are not materialised: per customer the
    joined row count is the product of the two per-side counts.
    """
    sides = features.select(*KEYS, F.lit(1).alias("_f")).unionByName(labels.select(*KEYS, F.lit(0).alias("_f")))
    per = sides.groupBy(*KEYS).agg(F.sum("_f").alias("_nf"), F.sum(1 - F.col("_f")).alias("_nl"))
    out = per.where(F.col("customerID").isNotNull()).groupBy("customerID").agg(
        F.sum("_nf").alias("feature_rows"), F.sum("_nl").alias("label_rows"),
        # pairs of one snapshot; a null date equals nothing
        F.sum(F.when(F.col("Snapshot_Date").isNotNull(), F.col("_nf") * F.col("_nl")).otherwise(0)).alias("_same"))
    both = F.col("feature_rows") * F.col("label_rows")
    return out.where(both > 0).select(
        "customerID", F.col("feature_rows").cast("bigint"), F.col("label_rows").cast("bigint"),
        both.cast("bigint").alias("joined_rows"), (both - F.col("_same")).cast("bigint").alias("cross_snapshot_rows"))


def label_test_yes(raw_labels: DataFrame) -> DataFrame:
    """Raw label text 'Yes' -> 1, anything else (null included) -> 0."""
    return raw_labels.select("customerID", "Snapshot_Date", label_is_yes("Churn").alias("actual_churn"))


def scenario_expand(mon: DataFrame, months: list[tuple[str, str]], step: float = 0.02) -> DataFrame:
    """Copy the population once per scenario month, set its date, shift the score by idx*step, clip.

    The copies come from exploding a literal array per row (a fixed x len(months)
    fan-out), not from a join.
    """
    scen = F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(m).alias("month"), F.to_date(F.lit(d)).alias("date"))
        for i, (m, d) in enumerate(months)
    ])
    ex = mon.select("customerID", F.col("snapshot_date").alias("source_date"), "churn_probability",
                    "actual_churn", "monthly_charges", F.explode(scen).alias("s"))
    return ex.select(
        "customerID", "source_date", F.col("s.idx").alias("scenario"), F.col("s.month").alias("month"),
        F.col("s.date").alias("snapshot_date"), "actual_churn", "monthly_charges",
        F.round(clip(F.col("churn_probability") + F.col("s.idx") * step, *SCORE_CLIP), 6)
        .alias("churn_probability"),
    )


# ---- AUC ---------------------------------------------------------------------

def grouped_auc(df: DataFrame, group_cols: list[str], label_col: str = "actual_churn",
                score_col: str = "churn_probability", digits: int | None = 6) -> DataFrame:
    """Exact ROC AUC per group with average ranks for ties (Mann-Whitney).

    AUC = Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N); null when a group has one class.
    Output: group_cols + (n, positives, auc).
    """
    y = F.col(label_col).cast("int")
    s = F.col(score_col).cast("double")
    hist = (df.where(y.isNotNull() & s.isNotNull())
            .groupBy(*group_cols, s.alias("_s"))
            .agg(F.sum(y).cast("bigint").alias("_pos"), F.sum(1 - y).cast("bigint").alias("_neg")))
    return auc_of_histogram(hist, group_cols, digits)


def auc_of_histogram(hist: DataFrame, group_cols: list[str], digits: int | None = 6) -> DataFrame:
    """``grouped_auc`` from a histogram: group_cols, score ``_s``, positive and negative rows ``_pos``, ``_neg``."""
    cum = running_sums(hist, group_cols, ["_s"], ["_neg"])
    contrib = F.col("_pos") * ((F.col("cum__neg") - F.col("_neg")) + F.col("_neg") * 0.5)
    agg = cum.groupBy(*group_cols).agg(
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"), F.sum(contrib).alias("_U"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                 F.col("_U") / (F.col("_P").cast("double") * F.col("_N")))
    return agg.select(*group_cols, (F.col("_P") + F.col("_N")).cast("bigint").alias("n"),
                      F.col("_P").cast("bigint").alias("positives"), (auc if digits is None else F.round(auc, digits)).alias("auc"))


def monthly_auc(mon: DataFrame, digits: int | None = 6) -> DataFrame:
    """AUC per month, rounded for display, with the alert flag (unrounded auc < 0.65)."""
    return month_alerts(grouped_auc(mon, ["month_start"], digits=None), digits)


def month_alerts(auc: DataFrame, digits: int | None = 6) -> DataFrame:
    shown = F.col("auc") if digits is None else F.round("auc", digits)
    return auc.select(
        "month_start", month_label("month_start").alias("month"), "n", "positives", shown.alias("auc"),
        (F.col("auc") < AUC_ALERT).alias("below_alert"),
    )


def auc_summary(monthly: DataFrame) -> DataFrame:
    """Plain mean of the monthly AUCs and the pass mark (mean >= 0.8); ``monthly`` is to be unrounded."""
    return monthly.where(F.col("auc").isNotNull()).agg(
        F.count(F.lit(1)).cast("bigint").alias("months"),
        F.round(F.avg("auc"), 6).alias("mean_auc"),
        F.round(F.min("auc"), 6).alias("min_auc"),
        F.round(F.max("auc"), 6).alias("max_auc"),
        F.count_if(F.col("auc") < AUC_ALERT).cast("bigint").alias("months_below_alert"),
        (F.avg("auc") >= AUC_PASS_MEAN).alias("passes"),
    )


# ---- deciles / PSI -------------------------------------------------------------

def long_features(mon: DataFrame, features: list[str] | None = None) -> DataFrame:
    """(feature, month_start, value) for the monitored numeric columns."""
    features = features or MONITOR_FEATURES
    stack = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in features)
    return mon.selectExpr("month_start", f"stack({len(features)}, {stack}) AS (feature, value)")


def approx_quantiles(long: DataFrame, probs: list[float], group_cols: list[str],
                     accuracy: int = 10_000) -> DataFrame:
    """One-pass approximate quantiles (``percentile_approx``: mergeable sketches, no ranking job).

    Output as ``exact_quantiles``: group_cols + (q_idx, prob, value); rank error <= 1/accuracy.
    """
    q = (long.where(F.col("value").isNotNull()).groupBy(*group_cols)
         .agg(F.percentile_approx("value", probs, accuracy).alias("_q")))
    return q.select(*group_cols, F.posexplode("_q").alias("q_idx", "value")).select(
        *group_cols, F.col("q_idx").cast("int").alias("q_idx"),
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("q_idx") + 1).alias("prob"), "value")


def deciles(mon: DataFrame, features: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Deciles (0..100 by 10) per feature and month: exact linear interpolation by default,
    ``exact=False`` for one-pass approximate quantiles on very large data."""
    probs = [d / 100 for d in PSI_DECILES]
    long = long_features(mon, features)
    q = (exact_quantiles(long, "value", probs, ["feature", "month_start"]) if exact
         else approx_quantiles(long, probs, ["feature", "month_start"]))
    return q.select("feature", "month_start", "q_idx", F.round("prob", 2).alias("prob"),
                    F.round("value", 6).alias("value"))


def psi_table(long: DataFrame, baseline: Column | None = None, exact: bool = True) -> DataFrame:
    """PSI of every (feature, month) against the baseline rows.

    ``baseline`` is a predicate on (feature, month_start, value); None means the
    earliest month.  Edges: exact deciles of the baseline, de-duplicated, outer
    edges ±inf, right-closed bins; shares of 0 become 1e-4; constant baseline -> 0.
    The raw rows are read once into a (feature, month, value) histogram that
    is checkpointed; baseline month, quantiles, binning and shares all work from it.
    Output: feature, month_start, psi, after_baseline (month later than every baseline month).
    ``exact=False`` takes the edges from one-pass approximate quantiles of the baseline rows.
    """
    hist = checkpoint(long.where(F.col("value").isNotNull())
                      .groupBy("feature", "month_start", "value").agg(F.count(F.lit(1)).alias("_c")))
    return psi_from_histogram(hist, baseline, None if exact else long)


def psi_from_histogram(hist: DataFrame, baseline: Column | None = None, approx_from: DataFrame | None = None) -> DataFrame:
    """``psi_table`` from a histogram (feature, month_start, value, ``_c`` rows), which is read several times
    (a written table).  ``approx_from``: rows whose approximate quantiles give the edges."""
    probs = [d / 100 for d in PSI_DECILES]
    if baseline is None:
        baseline = F.col("month_start") == hist.agg(F.min("month_start")).scalar()
    hist = hist.withColumn("_is_base", baseline.cast("int"))
    last_base = hist.where(F.col("_is_base") == 1).agg(F.max("month_start")).scalar()
    base = hist.where(F.col("_is_base") == 1)
    if approx_from is None:
        q = exact_quantiles(base, "value", probs, ["feature"], weight_col="_c")
    else:
        q = approx_quantiles(approx_from.where(baseline), probs, ["feature"])
    edges = q.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_e"))
    edges = edges.select(
        "feature", (F.size("_e") - 1).alias("_nb"),
        F.when(F.size("_e") > 2, F.slice("_e", 2, F.size("_e") - 2)).otherwise(F.array().cast("array<double>"))
        .alias("_inner"),
    )
    # <= 11 edges per monitored feature: bounded broadcast.
    binned = hist.join(F.broadcast(edges), "feature", "inner").select(
        "feature", "month_start", "_is_base", "_nb", "_c",
        F.size(F.filter("_inner", lambda e: e < F.col("value"))).alias("_bin"))
    counts = binned.groupBy("feature", "month_start", "_bin").agg(F.sum("_c").alias("_c"))
    totals = counts.groupBy("feature", "month_start").agg(F.sum("_c").alias("_t"))
    base_counts = binned.where(F.col("_is_base") == 1).groupBy("feature", "_bin").agg(F.sum("_c").alias("_c"))
    base_tot = base_counts.groupBy("feature").agg(F.sum("_c").alias("_bt"))
    grid = (totals.join(F.broadcast(edges.select("feature", "_nb")), "feature")
            .where(F.col("_nb") >= 1)
            .select("feature", "month_start", "_t", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_bin")))
    share = grid.join(counts, ["feature", "month_start", "_bin"], "left").select(
        "feature", "month_start", "_bin",
        (F.coalesce(F.col("_c"), F.lit(0)) / F.col("_t")).alias("_a"))
    bshare = (base_counts.join(base_tot, "feature")
              .select("feature", "_bin", (F.col("_c") / F.col("_bt")).alias("_e")))
    zero = F.lit(PSI_ZERO_SHARE)
    a = F.when(F.col("_a") == 0, zero).otherwise(F.col("_a"))
    e = F.when(F.coalesce(F.col("_e"), F.lit(0.0)) == 0, zero).otherwise(F.col("_e"))
    terms = share.join(bshare, ["feature", "_bin"], "left").select(
        "feature", "month_start", ((a - e) * F.log(a / e)).alias("_term"))
    psi = terms.groupBy("feature", "month_start").agg(F.sum("_term").alias("_psi"))
    months = hist.select("feature", "month_start").distinct()
    return months.join(psi, ["feature", "month_start"], "left").select(
        "feature", "month_start", F.coalesce(F.col("_psi"), F.lit(0.0)).alias("psi"),
        (F.col("month_start") > last_base).alias("after_baseline"))


def psi_status(psi: Column) -> Column:
    return (F.when(psi > PSI_CRITICAL, F.lit("critical"))
            .when(psi > PSI_WARNING, F.lit("warning")).otherwise(F.lit("stable")))


def psi_report(mon: DataFrame, baseline_month: str | None = None,
               features: list[str] | None = None, exact: bool = True) -> DataFrame:
    """PSI of each later month against the baseline month (default: the earliest month)."""
    long = long_features(mon, features)
    baseline = None if baseline_month is None else F.col("month_start") == F.to_date(F.lit(baseline_month))
    table = psi_table(long, baseline, exact=exact).where("after_baseline")
    return table.select("feature", "month_start", month_label("month_start").alias("month"),
                        F.round("psi", 6).alias("psi"), psi_status(F.col("psi")).alias("status"))


STATS_BYTES = 64 << 20
KDE_BLOCK = 10          # points of a curve that one row adds to


# ---- KDE ------------------------------------------------------------------------

def kde_table(long: DataFrame, grid_size: int = KDE_GRID_SIZE, cut: float = KDE_CUT,
              bin_fraction: float | None = None) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, ``grid_size`` points, support ±cut·bw) per (feature, month_start).

    Output: feature, month_start, point int, x double, density double.  Groups
    with fewer than two values or no spread have no curve.

    Work is grid_size x (distinct values per group), in blocks of points: a value meets
    each block once and adds to all its sums there.  Exact by default; for
    continuous values at very large n pass ``bin_fraction`` (e.g. 0.02): every
    value is snapped to a grid of bw·bin_fraction before the histogram, which
    bounds the distinct values per group by the data range / (bw·fraction) while
    keeping every row's weight (density error ~ fraction²/24 relative).
    """
    vals = stored(long.where(F.col("value").isNotNull()), "kde_values")       # read twice
    stats = vals.groupBy("feature", "month_start").agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("value").alias("_sd"),
        F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    stats = stats.where((F.col("_n") >= 2) & (F.col("_sd") > 0)).select(
        "feature", "month_start", "_n",
        (F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_bw"),
        "_lo", "_hi")
    stats = stats.select(
        "*", (F.col("_lo") - F.col("_bw") * cut).alias("_g0"), (F.col("_hi") + F.col("_bw") * cut).alias("_g1"))
    if bin_fraction:
        width = F.col("_bw") * bin_fraction
        snapped = vals.join(stats.select("feature", "month_start", "_bw"), ["feature", "month_start"], "inner")
        snapped = snapped.select("feature", "month_start",
                                 (F.round(F.col("value") / width) * width).alias("value"))
        hist = snapped.groupBy("feature", "month_start", "value").agg(F.count(F.lit(1)).alias("_c"))
    else:
        hist = vals.groupBy("feature", "month_start", "value").agg(F.count(F.lit(1)).alias("_c"))
    step = (F.col("_g1") - F.col("_g0")) / (grid_size - 1)
    norm = F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi)
    # grid x distinct values: one row per value and block of points, partial sums of all points of a block
    blocks = hist.join(stats, ["feature", "month_start"], "inner").select(
        "feature", "month_start", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1), F.lit(KDE_BLOCK))).alias("_block"),
        "_c", (step / F.col("_bw")).alias("_dz"), ((F.col("_g0") - F.col("value")) / F.col("_bw")).alias("_z0"))
    sums = [F.sum(F.col("_c") * F.exp(-0.5 * F.pow(F.col("_z0") + (F.col("_block") + i) * F.col("_dz"), 2))).alias(f"_s{i}")
            for i in range(min(KDE_BLOCK, grid_size))]
    dens = (blocks.groupBy("feature", "month_start", "_block").agg(*sums)
            .select("feature", "month_start", "_block", F.posexplode(F.array(*[f"_s{i}" for i in range(len(sums))])).alias("_i", "_sum"))
            .select("feature", "month_start", (F.col("_block") + F.col("_i")).alias("point"), "_sum")
            .where(F.col("point") < grid_size))
    out = dens.join(stats, ["feature", "month_start"], "inner").select(
        "feature", "month_start", F.col("point").cast("int").alias("point"),
        F.round(F.when(F.col("point") == grid_size - 1, F.col("_g1"))
                .otherwise(F.col("_g0") + F.col("point") * step), 6).alias("x"),
        F.round(F.col("_sum") / norm, 6).alias("density"))
    return out


def kde_binned(long: DataFrame, grid_size: int = KDE_GRID_SIZE, cut: float = KDE_CUT, resolution: int = 32,
               radius: float = 8.0) -> DataFrame:
    """The curves of ``kde_table`` by linear binning: each value's mass is split over its two neighbours on a grid
    of bandwidth / ``resolution``, proportionally to their distance, and the bins are convolved with a kernel cut
    off at ``radius`` bandwidths, so a bin reaches only the points near it.

    Work: one partial aggregate over the rows, then bins x points within the radius; the bins of a group number
    at most its spread / bandwidth * ``resolution``, however many distinct values it has.  Error of the density:
    at most (1 / resolution**2 / 8 + exp(-radius**2 / 2)) / (bandwidth * sqrt(2 pi)), as linear interpolation of
    the kernel is off by at most width**2 / 8 of its largest second derivative.
    """
    vals = stored(long.where(F.col("value").isNotNull()), "kde_values")       # read twice
    stats = vals.groupBy("feature", "month_start").agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("value").alias("_sd"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    stats = stats.where((F.col("_n") >= 2) & (F.col("_sd") > 0)).select(
        "feature", "month_start", "_n", (F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_bw"), "_lo", "_hi")
    stats = checkpoint(stats.select("*", (F.col("_bw") / resolution).alias("_w"), (F.col("_lo") - F.col("_bw") * cut).alias("_g0"),
                                    ((F.col("_hi") - F.col("_lo") + 2 * F.col("_bw") * cut) / (grid_size - 1)).alias("_step")))
    side = F.broadcast(stats) if stats.count() * 256 <= STATS_BYTES else stats      # one row per feature and month
    place = (F.col("value") - F.col("_lo")) / F.col("_w")
    low = F.floor(place)
    split = F.array(F.struct(low.alias("bin"), (1 - (place - low)).alias("m")), F.struct((low + 1).alias("bin"), (place - low).alias("m")))
    bins = (vals.join(side, ["feature", "month_start"]).select("feature", "month_start", F.explode(split).alias("_b"))
            .groupBy("feature", "month_start", F.col("_b.bin").alias("_bin")).agg(F.sum("_b.m").alias("_m")))
    at = F.col("_lo") + F.col("_bin") * F.col("_w")
    first = F.greatest(F.ceil((at - radius * F.col("_bw") - F.col("_g0")) / F.col("_step")), F.lit(0))
    last = F.least(F.floor((at + radius * F.col("_bw") - F.col("_g0")) / F.col("_step")), F.lit(grid_size - 1))
    near = bins.join(side, ["feature", "month_start"]).where((F.col("_m") > 0) & (first <= last)).select(
        "feature", "month_start", "_m", "_bw", at.alias("_at"), "_g0", "_step", F.explode(F.sequence(first, last)).alias("point"))
    x = F.col("_g0") + F.col("point") * F.col("_step")
    sums = near.select("feature", "month_start", "point", (F.col("_m") * F.exp(-0.5 * F.pow((x - F.col("_at")) / F.col("_bw"), 2))).alias("_d")) \
        .groupBy("feature", "month_start", "point").agg(F.sum("_d").alias("_d"))
    points = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1)).cast("array<bigint>")).alias("point"))
    return points.join(sums, ["feature", "month_start", "point"], "left").select(
        "feature", "month_start", F.col("point").cast("int").alias("point"), F.round(x, 6).alias("x"),
        F.round(F.coalesce("_d", F.lit(0.0)) / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi)), 6).alias("density"))


def kde(mon: DataFrame, feature: str, bin_fraction: float | None = None) -> DataFrame:
    return kde_table(long_features(mon, [feature]), bin_fraction=bin_fraction)


# ---- classification metrics -------------------------------------------------------

def confusion_matrix(df: DataFrame, label_col: str = "actual_churn", pred_col: str = "prediction") -> DataFrame:
    """Counts on the full 2x2 grid (absent cells are 0)."""
    y, p = F.col(label_col).cast("int"), F.col(pred_col).cast("int")
    agg = df.where(y.isNotNull() & p.isNotNull()).agg(*[
        F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    stack = ", ".join(f"{a}, {b}, c{a}{b}" for a in (0, 1) for b in (0, 1))
    return agg.selectExpr(f"stack(4, {stack}) AS (label, prediction, n)").select(
        F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("n").cast("bigint"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, label_col: str = "actual_churn", pred_col: str = "prediction") -> DataFrame:
    """Precision, recall, f1, support per class + accuracy, macro and weighted averages (zero division -> 0)."""
    y, p = F.col(label_col).cast("int"), F.col(pred_col).cast("int")
    cm = df.where(y.isNotNull() & p.isNotNull()).agg(
        *[F.count_if((y == a) & (p == b)).cast("double").alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    c = {k: F.col(k) for k in ("c00", "c01", "c10", "c11")}
    total = c["c00"] + c["c01"] + c["c10"] + c["c11"]
    per = {}
    for k in (0, 1):
        tp = c[f"c{k}{k}"]
        pred_k = c[f"c0{k}"] + c[f"c1{k}"]
        true_k = c[f"c{k}0"] + c[f"c{k}1"]
        prec, rec = _safe_div(tp, pred_k), _safe_div(tp, true_k)
        per[k] = (prec, rec, _safe_div(2 * prec * rec, prec + rec), true_k)
    acc = _safe_div(c["c00"] + c["c11"], total)
    rows = [
        F.struct(F.lit("0").alias("class"), *[v.alias(n) for v, n in zip(per[0], ["precision", "recall", "f1", "support"])]),
        F.struct(F.lit("1").alias("class"), *[v.alias(n) for v, n in zip(per[1], ["precision", "recall", "f1", "support"])]),
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 total.alias("support")),
        F.struct(F.lit("macro avg").alias("class"),
                 *[((per[0][i] + per[1][i]) / 2).alias(n) for i, n in enumerate(["precision", "recall", "f1"])],
                 total.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[_safe_div(per[0][i] * per[0][3] + per[1][i] * per[1][3], total).alias(n)
                   for i, n in enumerate(["precision", "recall", "f1"])],
                 total.alias("support")),
    ]
    out = cm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("class", *[F.round(n, 6).alias(n) for n in ["precision", "recall", "f1"]],
                      F.col("support").cast("bigint").alias("support"))


def accuracy_f1(df: DataFrame, label_col: str = "actual_churn", pred_col: str = "prediction") -> DataFrame:
    rep = classification_report(df, label_col, pred_col)
    return rep.groupBy().agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("precision"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "1", F.col("f1"))).alias("f1"),
    )
