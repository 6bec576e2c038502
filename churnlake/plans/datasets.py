"""The medallion chain over written stores: raw drops -> silver -> gold.

The raw drops and each silver and gold store are written once per session, at
first use, as files partitioned by Snapshot_Date; what ``Datamart`` hands out
are scans of these files, so that date filters prune partitions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from churnlake.operators.clean import silver
from churnlake.operators.stores import eda_set, gold_feature_store, gold_label_store
from churnlake.session import FILE_ROWS, session_key, shared_path, small_methods, stored
from churnlake.sources.feeds import read_raw_csv, read_store, write_partitioned, write_raw_csv
from churnlake.sources.fixtures import order_months, raw_feeds

# (application id, sf_dir, planted) -> folder of the raw CSV drops written this session
_RAW_DROPS: dict[tuple[str, str, bool], str] = {}
# (application id, sf_dir) -> the rows that the raw feeds are derived from, written this session
_ORDER_MONTHS: dict[tuple[str, str], DataFrame] = {}
# (application id, sf_dir, planted, store) -> folder of the store written this session
_STORES: dict[tuple[str, str, bool, str], str] = {}


def raw_drops(spark: SparkSession, sf_dir: str, planted: bool = False) -> str:
    """Write the derived raw feeds once per session as CSV drops in the shared folder.

    The source pipeline starts from raw CSV files; deriving the feeds from
    ``orders`` is a fixture step, so it runs once and every job then starts from
    the files like a production run does (and survives executor loss).  The orders are grouped once for all feeds;
    the drops are compressed, in files of limited size, as each is read by one task.
    """
    key = (session_key(spark), sf_dir, planted)
    if key not in _RAW_DROPS:
        root = shared_path(spark, "raw_drops")
        if key[:2] not in _ORDER_MONTHS:
            _ORDER_MONTHS[key[:2]] = stored(order_months(spark, sf_dir), "order_months")
        with small_methods(spark):
            for feed, df in raw_feeds(spark, sf_dir, planted=planted, base=_ORDER_MONTHS[key[:2]]).items():
                write_raw_csv(df, f"{root}/{feed}", compression="gzip", maxRecordsPerFile=FILE_ROWS)
        _RAW_DROPS[key] = root
    return _RAW_DROPS[key]


# stores whose rows are those of another store with the same partitions
_COPIES = {"gold_label_store"}


def written(spark: SparkSession, name: str, df: DataFrame) -> str:
    """Folder of a new store with the rows of ``df``."""
    path = shared_path(spark, name)
    with small_methods(spark):
        write_partitioned(df, path, rebalance=name not in _COPIES)
    return path


class _Layer(dict):
    """Tables by name, each made at first use."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._make(name)
        return self[name]


class Datamart:
    def __init__(self, spark: SparkSession, sf_dir: str, planted: bool = False):
        self.spark, self.sf_dir, self.planted = spark, sf_dir, planted

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        root = raw_drops(self.spark, self.sf_dir, self.planted)
        return {feed: read_raw_csv(self.spark, f"{root}/{feed}", feed) for feed in ("features", "meta", "labels")}

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        key = (session_key(self.spark), self.sf_dir, self.planted, name)
        if key not in _STORES:
            _STORES[key] = written(self.spark, name, df)
        return read_store(self.spark, _STORES[key], schema=df.schema)

    @cached_property
    def silver_plan(self) -> dict[str, DataFrame]:
        """The silver tables as plans over the raw drops."""
        return silver(self.raw)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return _Layer(lambda feed: self._store(f"silver_{feed}", self.silver_plan[feed]))

    @property
    def gold_features_plan(self) -> DataFrame:
        return gold_feature_store(self.silver["features"], self.silver["meta"])

    @property
    def gold_labels_plan(self) -> DataFrame:
        return gold_label_store(self.silver["labels"])

    @cached_property
    def gold_features(self) -> DataFrame:
        return self._store("gold_feature_store", self.gold_features_plan)

    @cached_property
    def gold_labels(self) -> DataFrame:
        return self._store("gold_label_store", self.gold_labels_plan)

    @property
    def eda(self) -> DataFrame:
        return eda_set(self.gold_features, self.gold_labels)
