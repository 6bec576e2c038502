"""Feature preparation as Spark ML stages (fit on train, applied everywhere)."""

from __future__ import annotations

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.schema import TENURE_GROUP_EDGES, TENURE_GROUP_LABELS


def tenure_group_stage(col: str = "tenure", out: str = "tenure_group") -> Transformer:
    """Right-closed model tenure groups as a SQL stage (persisted with the pipeline)."""
    parts = [f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{lab}'"
             for (lo, hi), lab in zip(zip(TENURE_GROUP_EDGES[:-1], TENURE_GROUP_EDGES[1:]), TENURE_GROUP_LABELS)]
    parts.append(f"WHEN {col} > {TENURE_GROUP_EDGES[-1]} THEN '{TENURE_GROUP_LABELS[-1]}'")
    return SQLTransformer(statement=f"SELECT *, CASE {' '.join(parts)} END AS {out} FROM __THIS__")


def indexers(cols: list[str], keep_unseen: bool = True) -> StringIndexer:
    """Alphabetical category index; unseen and null values go to an extra last slot."""
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], stringOrderType="alphabetAsc",
                         handleInvalid="keep" if keep_unseen else "error")


def one_hot(cols: list[str]) -> OneHotEncoder:
    """One column per seen category; the extra slot is dropped, so unseen/null -> all zeros."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                         dropLast=True)


def preprocessor(numeric: list[str], categorical: list[str], tenure_groups: bool = True) -> Pipeline:
    """Column transformer: standard-scaled numerics + one-hot categoricals -> ``features``."""
    cats = categorical + (["tenure_group"] if tenure_groups else [])
    stages = [tenure_group_stage()] if tenure_groups else []
    stages += [
        VectorAssembler(inputCols=numeric, outputCol="_num", handleInvalid="keep"),
        StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True),
        indexers(cats),
        one_hot(cats),
        VectorAssembler(inputCols=["_num_scaled"] + [f"{c}_ohe" for c in cats], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def feature_names(model, numeric: list[str], categorical: list[str], tenure_groups: bool = True) -> list[str]:
    """Encoded feature names in vector order: numerics, then ``col_value`` per kept category."""
    cats = categorical + (["tenure_group"] if tenure_groups else [])
    idx_model = next(s for s in model.stages if hasattr(s, "labelsArray"))
    names = list(numeric)
    for c, labels in zip(cats, idx_model.labelsArray):
        names += [f"{c}_{v}" for v in labels]
    return names


# ---- stand-alone encoders/scalers as DataFrame -> DataFrame ----------------------------

def label_encode(fit_on: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Sorted-order integer codes per column (nulls and unseen -> number of seen values)."""
    casted = [F.col(c).cast("string").alias(f"{c}_s") for c in cols]
    model = indexers([f"{c}_s" for c in cols]).fit(fit_on.select("*", *casted))
    out = model.transform(df.select("*", *casted))
    return out.select(*[c for c in df.columns if c not in cols],
                      *[F.col(f"{c}_s_idx").cast("int").alias(c) for c in cols])


def one_hot_slots(fit_on: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form of the one-hot encoding: which slot is set per row and column (null = all zeros)."""
    model = Pipeline(stages=[indexers(cols), one_hot(cols)]).fit(fit_on)
    out = model.transform(df)
    stack = ", ".join(f"'{c}', `{c}`, `{c}_ohe`" for c in cols)
    long = out.selectExpr("customerID", "Snapshot_Date", f"stack({len(cols)}, {stack}) AS (column_name, category, vec)")
    arr = vector_to_array(F.col("vec"))
    slot = F.array_position(F.transform(arr, lambda x: x > 0.5), True)
    return long.select("customerID", "Snapshot_Date", "column_name", "category",
                       F.when(slot > 0, (slot - 1).cast("int")).alias("slot"),
                       F.size(arr).alias("width"))


def drop_first_categories(fit_on: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column, as text: the labels of the fitted indexer."""
    as_text = fit_on.select(*[F.col(c).cast("string").alias(c) for c in cols])
    model = StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], stringOrderType="alphabetAsc",
                          handleInvalid="skip").fit(as_text)
    return {c: list(labels) for c, labels in zip(cols, model.labelsArray)}


def _checked_unseen(df: DataFrame, cats: dict[str, list[str]]) -> DataFrame:
    seen = F.lit(True)
    for c, values in cats.items():
        seen = seen & (F.col(c).isNull() | F.col(c).cast("string").isin(values))
    return df.where(F.when(seen, F.lit(True)).otherwise(
        F.raise_error(F.lit("unseen category in one_hot_drop_first")).cast("boolean")))


def one_hot_drop_first(fit_on: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Named 0/1 columns ``col_value`` for every category but the first (alphabetical) one.

    Categories come from ``fit_on``; a value not seen there raises, as in the
    source encoder.  Values that differ only in case ('Yes'/'YES') give names
    that differ only in case: refer to them by position, or run with
    ``spark.sql.caseSensitive=true``.
    """
    cats = drop_first_categories(fit_on, cols)
    dummies = [(F.col(c).cast("string") == v).cast("int").alias(f"{c}_{v}") for c in cols for v in cats[c][1:]]
    return _checked_unseen(df, cats).select(*[c for c in df.columns if c not in cols], *dummies)


def one_hot_drop_first_long(fit_on: DataFrame, df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """The same dummies as (keys..., dummy, value) rows: one row per kept category and input row."""
    cats = drop_first_categories(fit_on, cols)
    items = F.array(*[F.struct(F.lit(f"{c}_{v}").alias("dummy"), (F.col(c).cast("string") == v).cast("int").alias("value"))
                      for c in cols for v in cats[c][1:]])
    return _checked_unseen(df, cats).select(*keys, F.explode(items).alias("_d")).select(*keys, "_d.dummy", "_d.value")


def standard_scale(fit_on: DataFrame, df: DataFrame, cols: list[str], population: bool = False) -> DataFrame:
    """(x - mean) / std with statistics of ``fit_on``; ``population`` uses n (not n-1)."""
    stats = fit_on.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                       *[(F.stddev_pop(c) if population else F.stddev_samp(c)).alias(f"s_{c}") for c in cols]).first()
    return df.select(*[c for c in df.columns if c not in cols], *[
        F.when(F.lit(stats[f"s_{c}"] or 0.0) != 0,
               (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)).otherwise(F.lit(0.0)).alias(c)
        for c in cols])


def minmax_scale(fit_on: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Per-column min-max scaling fitted on ``fit_on`` (constant column -> 0.5, as MinMaxScaler)."""
    stats = fit_on.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    out = []
    for c in cols:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        if lo is None or hi is None or hi == lo:
            out.append(F.when(F.col(c).isNotNull(), F.lit(0.5)).alias(c))
        else:
            out.append(((F.col(c) - F.lit(float(lo))) / F.lit(float(hi - lo))).alias(c))
    return df.select(*[c for c in df.columns if c not in cols], *out)
