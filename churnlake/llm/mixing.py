"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order get the weights in turn and share all
words; no target passes ``MAX_EPOCHS`` times its source, the excess going to
the others by weight (one water level, found from running sums over the
sources sorted by the level at which each is full).  Selection: a source's
documents stand in a pseudo-random but fixed order and are read round and
round until the target is met; a document's takes follow from the words before
it.  Curriculum: each weight class has a piecewise-linear weight over training
time; its integral is the share of the target due by a time, and inverting it
at a copy's place in its source's stream gives the copy's position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.llm.common import (
    BLACK, all_of, broadcast_if_small, load, put_back, range_index, running_before, set_apart, shuffle_width, text_of)
from churnlake.session import checkpoint

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# weight over training time 0..1 per weight class: (time, factor) knots
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)),
)


def invert_schedule(knots: tuple, share: Column) -> Column:
    """Time at which the integral of the piecewise-linear schedule reaches ``share`` (0..1) of its total."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total = sum(areas)
    if total <= 0 or min(w for _, w in knots) < 0:
        raise ValueError("a schedule needs weights of 0 or more and a positive integral")
    out, done = None, 0.0
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        rest = share * F.lit(total) - F.lit(done)       # area still to cover inside this segment
        slope = (w1 - w0) / (t1 - t0)
        under = F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0))
        root = F.lit(w0) + F.sqrt(under)
        time = F.lit(t0) + F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))
        done += area
        inside = share <= F.lit(done / total)
        out = F.when(inside, time) if out is None else out.when(inside, time)
    return F.least(F.greatest(out.otherwise(F.lit(float(knots[-1][0]))), F.lit(0.0)), F.lit(1.0))


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, class, weight, target) from rows (source, size)."""
    per = checkpoint(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                     .withColumn("last", F.col("source").isNull()))
    per = range_index(per, [], ["last", "source"], "rank")
    per = per.withColumn("class", (F.col("rank") % len(weights)).cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("bigint") for w in weights]), F.col("class") + 1))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    per = per.withColumn("full_at", F.col("cap").cast("double") / F.col("weight"))
    per = running_before(per, [], ["full_at", "last", "source"], ["cap", "weight"])
    # four totals come to the driver
    all_words, all_weights = (x or 0 for x in per.agg(F.sum("source_size"), F.sum("weight")).first())
    level_words = (F.col("cap_before").cast("double")
                   + F.col("full_at") * (F.lit(all_weights) - F.col("weight_before")).cast("double"))
    per = checkpoint(per.withColumn("full", level_words <= F.lit(float(all_words))))
    full_words, open_weights = (x or 0 for x in per.agg(
        F.sum(F.when(F.col("full"), F.col("cap"))), F.sum(F.when(~F.col("full"), F.col("weight")))).first())
    return per.select(
        "source", "source_size", "class", "weight",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
            (F.col("weight") * F.lit(all_words - full_words)).cast("double")
            / F.lit(float(open_weights or 1))).alias("target"))


def mix(docs: DataFrame, keys: list[str], weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        schedules: tuple = SCHEDULES, whole: bool = False) -> DataFrame:
    """One row per document, range-sorted by training position: ``keys``, size, source_size, target,
    takes (array of copy, words, position) and first_position (null if nothing is taken).

    ``docs`` needs ``text`` and ``source``.  ``whole`` takes a copy entirely if at least half of it lies
    within the target and else not at all; otherwise the copy on the edge is cut, so that a source's
    takes add up to its rounded target.  Null texts and texts without words have size 0 and are never
    taken; null sources are one source, the last; repeated rows count and are taken like any others.
    """
    spark = docs.sparkSession
    rows = docs.select(
        *keys, "source", F.regexp_count(text_of(), F.lit(BLACK)).cast("bigint").alias("size"),
        F.coalesce(F.md5(F.col(keys[0]).cast("string").cast("binary")), F.lit("")).alias("mixed"))
    rows = checkpoint(rows)     # narrow: texts are read once
    targets = source_targets(rows, weights, max_epochs)
    placed = running_before(rows, ["source"], ["mixed", *keys, "size"], ["size"])
    t = targets.select(F.col("source").alias("__s"), "source_size", "target", "class")
    t = broadcast_if_small(t, 256)      # one row per source
    placed = placed.join(t, placed["source"].eqNullSafe(t["__s"]), "inner")
    goal = F.floor(F.col("target") + 0.5)
    takes = []
    for k in range(max_epochs):
        start = F.col("size_before") + F.col("source_size") * k
        words = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), goal - start))
        if whole:
            words = F.when(words * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("bigint"))
        # the middle of the copy in the source's stream, as a share of the target
        share = F.least(F.try_divide(start.cast("double") + words.cast("double") / 2, F.col("target")), F.lit(1.0))
        position = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            position = F.when(F.col("class") % len(schedules) == i, invert_schedule(knots, share)).otherwise(position)
        takes.append(F.when(words > 0, F.struct(F.lit(k).alias("copy"), words.alias("words"), position.alias("position"))))
    out = placed.select(*keys, "mixed", "size", "source_size", "target", F.array_compact(F.array(*takes)).alias("takes"))
    out = out.withColumn("first_position", F.get("takes", F.lit(0))["position"])
    # the fixed order spreads the untaken rows (null position) over the range partitions
    return (out.repartitionByRange(shuffle_width(spark), "first_position", "mixed")
            .sortWithinPartitions("first_position", "mixed").drop("mixed"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every column of ``docs``, one row per whole copy taken, range-sorted by position.

    The plan is joined back on (doc_id, source, hash of the text).  Rows that agree in all three are
    told apart by a number within the key, on both sides, so each keeps its own copies.  Null and empty texts have
    no words and are never taken; an empty table gives no rows; extra columns of any name pass through.
    """
    spark = docs.sparkSession
    plain, at = set_apart(docs)
    keys = ["key_id", "key_src", "key_h"]
    keyed = plain.withColumns({"key_id": F.col(at["doc_id"]), "key_src": F.col(at["source"]), "key_h": F.xxhash64(text_of(at["text"]))})
    plan = mix(keyed.select(F.col(at["text"]).alias("text"), F.col(at["source"]).alias("source"), *keys), keys, whole=True, **options)
    plan = checkpoint(plan.select(*keys, "takes"))
    most = plan.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    number = F.lit(1)
    if most > 1:
        number = F.row_number()
        plan = plan.withColumn("no", number.over(Window.partitionBy(*keys).orderBy(F.size("takes"), F.col("takes").cast("string"))))
        # by all columns, so that a part that is done again numbers its rows alike
        keyed = keyed.withColumn("no", number.over(Window.partitionBy(*keys).orderBy(F.xxhash64(*at.values()))))
    else:
        plan, keyed = plan.withColumn("no", number), keyed.withColumn("no", number)
    names = [*keys, "no"]
    chosen = plan.where(F.size("takes") > 0).select(*[F.col(k).alias(f"p_{k}") for k in names], "takes")
    out = keyed.join(chosen, all_of([F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in names]), "inner")
    out = out.select(*at.values(), F.explode("takes").alias("take")).withColumn("at", F.col("take.position"))
    return put_back(out.repartitionByRange(shuffle_width(spark), "at", at["doc_id"]).sortWithinPartitions("at", at["doc_id"]), at)


def op3_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents."""
    out = mix(load(spark, sf_dir, "documents"), ["doc_id"])
    return out.select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("takes", F.lit(0).cast("bigint"), lambda a, t: a + t["words"]).alias("taken"),
        F.round("first_position", 6).alias("first_position"))
