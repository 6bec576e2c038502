"""Silver layer: typed, cleaned feeds and the one-pass cleaning funnel.

Each cleaner is one projection plus one conjunctive filter, so Catalyst keeps
the whole step inside a single whole-stage-codegen span and it stays a narrow
(map-only) stage at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.cleaning import (
    collapse_to_no, extract_number, is_present, sentinel_to_unknown, text_to_date,
    text_to_int, yes_no_int,
)
from churnlake.schema import (
    MONTHLY_CHARGES_MAX, NO_INTERNET_COLUMNS, NO_PHONE_COLUMNS, SILVER_FEATURE_COLUMNS,
    SILVER_LABEL_COLUMNS, SILVER_META_COLUMNS, SIMPLE_STRING_FEATURES, TENURE_MAX, TENURE_MIN,
)


def _final(df: DataFrame, order: list[str]) -> DataFrame:
    """Ordered projection to the final columns; absent columns are tolerated."""
    return df.select([c for c in order if c in df.columns])


def feature_rules(df: DataFrame) -> list[tuple[str, Column]]:
    """Ordered (step, keep-condition) pairs of the features cleaner, on raw columns."""
    rules: list[tuple[str, Column]] = []
    tenure = text_to_int("tenure")
    rules.append(("tenure", (tenure >= TENURE_MIN) & (tenure <= TENURE_MAX)))
    rules.append(("PhoneService", yes_no_int("PhoneService").isNotNull()))
    for c in SIMPLE_STRING_FEATURES:
        if c in df.columns:
            rules.append((c, is_present(c)))
    rules.append(("PaperlessBilling", F.lit(True)))
    rules.append(("PaymentMethod", F.lit(True)))
    mc = extract_number("MonthlyCharges")
    rules.append(("MonthlyCharges", (mc > 0) & (mc < MONTHLY_CHARGES_MAX)))
    rules.append(("TotalCharges", extract_number("TotalCharges") > 0))
    return rules


def meta_rules(df: DataFrame) -> list[tuple[str, Column]]:
    g = F.lower(F.col("gender"))
    return [
        ("gender", g.isin("male", "female")),
        ("SeniorCitizen", text_to_int("SeniorCitizen").isin(0, 1)),
        ("Partner", yes_no_int("Partner").isNotNull()),
        ("Dependents", yes_no_int("Dependents").isNotNull()),
    ]


def _all(rules: list[tuple[str, Column]]) -> Column:
    cond = F.lit(True)
    for _, rule in rules:
        cond = cond & F.coalesce(rule, F.lit(False))
    return cond


def clean_features(raw: DataFrame) -> DataFrame:
    """Raw features (strings) -> silver features (typed)."""
    typed = {
        "customerID": F.col("customerID").cast("string"),
        "tenure": text_to_int("tenure"),
        "PhoneService": yes_no_int("PhoneService"),
        "PaperlessBilling": yes_no_int(sentinel_to_unknown("PaperlessBilling")),
        "PaymentMethod": sentinel_to_unknown("PaymentMethod").cast("string"),
        "MonthlyCharges": extract_number("MonthlyCharges"),
        "TotalCharges": extract_number("TotalCharges"),
    }
    for c in SIMPLE_STRING_FEATURES:
        if c in raw.columns:
            typed[c] = F.col(c)
    for c in NO_PHONE_COLUMNS:
        if c in raw.columns:
            typed[c] = collapse_to_no(c, "no phone service")
    for c in NO_INTERNET_COLUMNS:
        if c in raw.columns:
            typed[c] = collapse_to_no(c, "no internet service")
    if "Snapshot_Date" in raw.columns:
        typed["Snapshot_Date"] = text_to_date("Snapshot_Date")
    kept = raw.filter(_all(feature_rules(raw)))
    return _final(kept.select([typed[c].alias(c) for c in SILVER_FEATURE_COLUMNS if c in typed]),
                  SILVER_FEATURE_COLUMNS)


def clean_meta(raw: DataFrame) -> DataFrame:
    """Raw meta -> silver meta: gender male=1/female=0, SeniorCitizen 0/1, Partner/Dependents yes/no."""
    g = F.lower(F.col("gender"))
    typed = {
        "customerID": F.col("customerID").cast("string"),
        "gender": F.when(g == "male", F.lit(1)).when(g == "female", F.lit(0)).cast("int"),
        "SeniorCitizen": text_to_int("SeniorCitizen"),
        "Partner": yes_no_int("Partner"),
        "Dependents": yes_no_int("Dependents"),
    }
    if "Snapshot_Date" in raw.columns:
        typed["Snapshot_Date"] = text_to_date("Snapshot_Date")
    kept = raw.filter(_all(meta_rules(raw)))
    return _final(kept.select([typed[c].alias(c) for c in SILVER_META_COLUMNS if c in typed]),
                  SILVER_META_COLUMNS)


def clean_labels(raw: DataFrame) -> DataFrame:
    """Raw labels -> silver labels: Churn yes/no -> 1/0, anything else kept as null."""
    typed = {"customerID": F.col("customerID").cast("string"), "Churn": yes_no_int("Churn")}
    if "Snapshot_Date" in raw.columns:
        typed["Snapshot_Date"] = text_to_date("Snapshot_Date")
    return _final(raw.select([typed[c].alias(c) for c in SILVER_LABEL_COLUMNS if c in typed]),
                  SILVER_LABEL_COLUMNS)


CLEANERS = {"features": clean_features, "meta": clean_meta, "labels": clean_labels}
RULES = {"features": feature_rules, "meta": meta_rules, "labels": lambda df: []}


def silver(raw_feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: CLEANERS[name](df) for name, df in raw_feeds.items()}


def cleaning_funnel(raw: DataFrame, feed: str) -> DataFrame:
    """Rows left after each cleaning rule, in rule order, from ONE scan of the input.

    Output: (step_no int, step string, rows bigint, dropped bigint); step 0 is the input.
    Each step count is ``count_if(rule_1 AND .. AND rule_k)``, all in a single
    aggregation (partial counts per task, one tiny final merge).
    """
    rules = RULES[feed](raw)
    aggs = [F.count(F.lit(1)).alias("s0")]
    cond = F.lit(True)
    for i, (_, rule) in enumerate(rules, start=1):
        cond = cond & F.coalesce(rule, F.lit(False))
        aggs.append(F.count_if(cond).alias(f"s{i}"))
    counts = raw.agg(*aggs)
    names = ["input"] + [name for name, _ in rules]
    stack = ", ".join(f"{i}, '{n}', s{i}, s0 - s{i}" for i, n in enumerate(names))
    long = counts.selectExpr(f"stack({len(names)}, {stack}) as (step_no, step, rows, dropped)")
    return long.select(
        F.col("step_no").cast("int").alias("step_no"), "step",
        F.col("rows").cast("bigint").alias("rows"), F.col("dropped").cast("bigint").alias("dropped"),
    )
