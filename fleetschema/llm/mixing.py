"""Mixing sources to target weights by hash-threshold histograms.

Tokens are summed by source and hash bucket; the bucket in which a source's
budget ends is the only one looked at again, in finer buckets, until a single
hash value is left. Rows are then kept by comparing their hash with the source's
threshold, so nothing is sorted and a source with a third of all rows is summed
map-side before it is shuffled. Thresholds are nested: a larger budget keeps
every row that a smaller one keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetschema.functions.ordering import numbered
from fleetschema.llm.common import SPACED_WORD, col, free
from fleetschema.staging import stage

HASH_BITS = 60
STEP_BITS = 12


def words(text: Column) -> Column:
    """Number of words between white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, seed: int) -> Column:
    """60 bits of MD5, the same in every engine; NULL hashes like the empty string."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, NULL last, take the weights in turn and share
    ``share`` of the total. A target stops at ``cap`` times its source's size; the
    excess goes to the others by weight. Whether a source is stopped depends on
    one number, the words per unit of weight, so each round is one aggregate and
    the driver sees three sums.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], name="rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight), "mix-sources")
    most = F.col("source_size") * F.lit(float(cap))

    def level(rate: float | None) -> float | None:
        stopped = F.lit(False) if rate is None else F.lit(rate) * F.col("weight") > most
        total, held, left = ranked.agg(
            F.sum("source_size"), F.sum(F.when(stopped, most)), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        return None if not left else (share * total - (held or 0.0)) / left

    rate, following = None, level(None)
    while following is not None and following != rate:
        rate, following = following, level(following)
    target = most if following is None else F.least(F.lit(following) * F.col("weight"), most)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def thresholds(points: DataFrame, budgets: DataFrame) -> DataFrame:
    """The hash below which each source's rows stay within its budget.

    points: (source, hash, size); budgets: (source, budget). A row belongs to the
    budget when the sizes of its source up to and including its hash are not above
    it; ``threshold`` is the first hash beyond, or 2**60.
    """
    spark = points.sparkSession
    shift = HASH_BITS
    active = points.withColumn("before", F.lit(0).cast("long"))
    solved = None
    while active is not None:
        shift = max(0, shift - STEP_BITS)
        bucketed = active.withColumn("bucket", F.shiftright("hash", shift))
        sums = bucketed.groupBy("source", "bucket", "before").agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        running = Window.partitionBy("source").orderBy("bucket")  # at most 2**12 buckets a source
        ends = sums.withColumn("upto", F.sum("words").over(running) + F.col("before"))
        named = budgets.withColumnRenamed("source", "its")
        ends = ends.join(named, F.col("source").eqNullSafe(F.col("its"))).where(F.col("upto") > F.col("budget"))
        first = ends.groupBy("source").agg(
            F.min_by(F.struct("bucket", "low", "high", (F.col("upto") - F.col("words")).alias("start")), "bucket").alias("e")
        )
        first = stage(first.select("source", "e.*"), "mix-boundary")
        done = first.where("low = high").select("source", F.col("low").alias("threshold"))
        solved = done if solved is None else solved.unionByName(done)
        rest = first.where("low < high").select(
            F.col("source").alias("its"), F.col("bucket").alias("its_bucket"), F.col("start")
        )
        if rest.isEmpty():
            active = None
        else:  # only the boundary bucket goes on
            inside = F.col("source").eqNullSafe(F.col("its")) & (F.col("bucket") == F.col("its_bucket"))
            finer = bucketed.join(rest, inside).select("source", "hash", "size", F.col("start").alias("before"))
            active = stage(finer, "mix-bucket")
    named = solved.withColumnRenamed("source", "its").withColumnRenamed("threshold", "found")
    return budgets.join(named, F.col("source").eqNullSafe(F.col("its")), "left").select(
        "source", F.coalesce("found", F.lit(1 << HASH_BITS)).alias("threshold")
    )


def mix_sources(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 10,
) -> DataFrame:
    """Every input row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` is how often the mix takes the row (0 up to ``cap``) and ``taken``
    is ``copies * size``. NULL text has size 0, NULL source is a source of its own,
    rows with the same key get the same copies, an empty table gives no rows. An
    added column takes an underscore where the input has its name.
    """
    columns = df.columns
    size, total, target, copies, taken = (free(columns, n) for n in ("size", "source_size", "target", "copies", "taken"))
    spot = free([*columns, size], "hash")
    rows = df.withColumns({size: words(col(text)), spot: unit_hash(col(key), seed)})
    points = stage(rows.select(col(source).alias("source"), F.col(spot).alias("hash"), F.col(size).alias("size")), "mix-points")
    sizes = stage(points.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    plan = source_targets(sizes, weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = stage(plan.withColumn("whole", whole), "mix-targets")
    budgets = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    limits = thresholds(points, budgets).withColumnRenamed("source", "its")
    plan = plan.join(limits, F.col("source").eqNullSafe(F.col("its"))).drop("its")
    plan = stage(plan, "mix-plan")  # one row per source
    named = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in plan.columns])
    times = F.col("__mix_whole") + (F.col(spot) < F.col("__mix_threshold")).cast("long")
    return rows.join(named, col(source).eqNullSafe(F.col("__mix_source"))).select(
        *[col(c) for c in columns],
        F.col(size),
        F.col("__mix_source_size").alias(total),
        F.col("__mix_target").alias(target),
        times.alias(copies),
        (times * F.col(size)).alias(taken),
    )
