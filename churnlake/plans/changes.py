"""Change-driven backfill: only months whose upstream content changed are rebuilt.

A feed's month is summed up by an order-free digest of its rows: each row's MD5
gives two 60-bit numbers, whose sums over the rows are exact decimals, so the
digest does not depend on files, partitions or order, and a row that occurs
twice counts twice.  Digests are computed in one aggregation with partial sums
and are stored per feed and month beside the layers, after a rebuild succeeded:
a run that failed half-way is simply planned again.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.cleaning import text_to_date
from churnlake.operators import stores
from churnlake.operators.clean import CLEANERS
from churnlake.schema import RAW_SCHEMAS, SILVER_SCHEMAS
from churnlake.session import checkpoint
from churnlake.sources import feeds

FEEDS = ["features", "meta", "labels"]
# gold table -> feeds that it needs
GOLD_INPUTS = {"feature_store": ["features", "meta"], "label_store": ["labels"]}
DIGEST_SCHEMA = "feed string, snapshot_date date, rows long, digest string"


def row_text(columns: list[str]) -> Column:
    """A row as text: ``=value`` or ``-`` (null) per column, between unit separators."""
    return F.concat_ws("\x1f", *[F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(c).cast("string")))
                                 for c in columns])


def month_digests(raw: dict[str, DataFrame]) -> DataFrame:
    """(feed, snapshot_date, rows, digest) of every feed and parsable snapshot date."""
    parts = []
    for feed, df in raw.items():
        md5 = F.md5(row_text(df.columns))
        halves = [F.conv(F.substring(md5, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16)]
        sums = (df.select(text_to_date("Snapshot_Date").alias("snapshot_date"), halves[0].alias("a"), halves[1].alias("b"))
                .where(F.col("snapshot_date").isNotNull()).groupBy("snapshot_date")
                .agg(F.count(F.lit(1)).alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b")))
        parts.append(sums.select(F.lit(feed).alias("feed"), "snapshot_date", "rows",
                                 F.concat_ws(":", F.col("a").cast("string"), F.col("b").cast("string")).alias("digest")))
    return reduce(DataFrame.unionByName, parts)


def backfill_plan(current: DataFrame, stored: DataFrame, calendar: DataFrame) -> DataFrame:
    """(step, layer, feed, snapshot_date, action, reason) for every expected month, in dependency order by step.

    Actions: ``rebuild`` (upstream is new or changed), ``skip`` (unchanged), ``keep`` (upstream is gone, what was
    built stays) and ``wait`` (upstream never came).  A gold table waits while one of its feeds is missing.
    """
    names = F.array(*[F.lit(f) for f in FEEDS])
    expected = calendar.select(F.col("snapshot_date"), F.explode(names).alias("feed"))
    months = (expected.unionByName(current.select("snapshot_date", "feed")).unionByName(stored.select("snapshot_date", "feed"))
              .distinct())
    now = current.select("feed", "snapshot_date", F.struct("rows", "digest").alias("now"))
    was = stored.select("feed", "snapshot_date", F.struct("rows", "digest").alias("was"))
    status = (F.when(F.col("now").isNull() & F.col("was").isNull(), "missing").when(F.col("now").isNull(), "removed")
              .when(F.col("was").isNull(), "new").when(F.col("now") == F.col("was"), "unchanged").otherwise("changed"))
    seen = months.join(now, ["feed", "snapshot_date"], "left").join(was, ["feed", "snapshot_date"], "left").select(
        "feed", "snapshot_date", status.alias("status"))
    action = {"missing": "wait", "removed": "keep", "new": "rebuild", "changed": "rebuild", "unchanged": "skip"}
    act = F.create_map(*[F.lit(x) for pair in action.items() for x in pair])[F.col("status")]
    out = [seen.select(F.lit(step).alias("step"), F.lit(layer).alias("layer"), "feed", "snapshot_date", act.alias("action"),
                       F.col("status").alias("reason")) for step, layer in ((1, "bronze"), (2, "silver"))]
    by_month = seen.groupBy("snapshot_date").pivot("feed", FEEDS).agg(F.first("status"))
    for table, inputs in GOLD_INPUTS.items():
        said = F.array_join(F.array_compact(F.array(*[
            F.when(F.col(f) != "unchanged", F.concat(F.lit(f"{f} "), F.col(f))) for f in inputs])), ", ")
        any_is = lambda s, inputs=inputs: reduce(Column.__or__, [F.col(f) == s for f in inputs])
        gold = (F.when(any_is("missing"), "wait").when(any_is("removed"), "keep")
                .when(any_is("new") | any_is("changed"), "rebuild").otherwise("skip"))
        out.append(by_month.select(F.lit(3).alias("step"), F.lit("gold").alias("layer"), F.lit(table).alias("feed"), "snapshot_date",
                                   gold.alias("action"), F.when(said == "", "unchanged").otherwise(said).alias("reason")))
    return reduce(DataFrame.unionByName, out)


def read_digests(spark: SparkSession, root: str) -> DataFrame:
    """The stored digests; none before the first run."""
    path = f"{root}/_digests"
    if not feeds.has_files(spark, path, "*.parquet"):
        return spark.createDataFrame([], DIGEST_SCHEMA)
    return spark.read.schema(DIGEST_SCHEMA).parquet(path)


def _of_months(df: DataFrame, months: list[dt.date]) -> DataFrame:
    days = [m.isoformat() for m in months] if dict(df.dtypes)["Snapshot_Date"] == "string" else [F.lit(m) for m in months]
    return df.where(F.col("Snapshot_Date").isin(days))


def backfill_changed(spark: SparkSession, raw: dict[str, DataFrame], root: str, calendar: DataFrame) -> DataFrame:
    """Plan against the stored digests, rebuild what changed in dependency order, store the new digests.

    Every layer is one job per table over all its months; each month replaces its partition only.  Returns the
    plan that was carried out.
    """
    digests = checkpoint(month_digests({f: raw[f].select(*RAW_SCHEMAS[f].names) for f in FEEDS}))
    plan = checkpoint(backfill_plan(digests, checkpoint(read_digests(spark, root)), calendar))
    todo: dict[tuple[str, str], list[dt.date]] = {}
    for r in plan.where("action = 'rebuild'").collect():        # a few rows a month
        todo.setdefault((r["layer"], r["feed"]), []).append(r["snapshot_date"])
    for feed in FEEDS:
        if months := todo.get(("bronze", feed)):
            feeds.write_bronze(feeds.bronze(raw[feed], [m.isoformat() for m in months]), f"{root}/bronze/{feed}")
    for feed in FEEDS:
        if months := todo.get(("silver", feed)):
            rows = _of_months(feeds.read_bronze(spark, f"{root}/bronze/{feed}", feed), months)
            feeds.write_partitioned(CLEANERS[feed](rows), f"{root}/silver/{feed}")
    silver = {f: feeds.read_store(spark, f"{root}/silver/{f}", schema=SILVER_SCHEMAS[f]) for f in FEEDS
              if feeds.has_files(spark, f"{root}/silver/{f}", "*.parquet")}
    for table, inputs in GOLD_INPUTS.items():
        if (months := todo.get(("gold", table))) and all(f in silver for f in inputs):
            sides = [_of_months(silver[f], months) for f in inputs]
            gold = stores.gold_feature_store(*sides) if table == "feature_store" else stores.gold_label_store(*sides)
            feeds.write_partitioned(gold, f"{root}/gold/{table}")
    built = digests.join(plan.where("layer = 'bronze' AND action = 'rebuild'").select("feed", "snapshot_date"), ["feed", "snapshot_date"], "left_semi")
    feeds.write_partitioned(built, f"{root}/_digests", partition_by=["feed", "snapshot_date"])
    return plan
