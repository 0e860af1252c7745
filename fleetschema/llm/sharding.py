"""Sharding by k-d tree partitioning, with DataFrame operations only.

A node of the tree is split along the metadata dimension in which it is widest,
at the weighted median of its rows' bytes, until every leaf holds its share. The
median is searched for by histograms: bytes are summed by node and bucket, the
bucket in which the median lies is cut again, first by the dimension's value,
then among equal values by the hash of the text. All nodes of a level are
searched for at once, so the rounds grow with the depth of the tree and not with
the data, and a value that a third of the rows share is summed map-side.

Rows with equal text are one unit and stay together, at the smallest metadata
that any of them has, as long as the unit holds no more than ``unit_share`` of a
leaf; the rows of a larger one are units of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetschema.llm.common import col, free, quoted
from fleetschema.staging import stage, stage_observed

BUCKETS = 1024
TIE_BITS = 40
#: a cut may miss its place by this share of a leaf before equal values are looked into further
TOLERANCE = 1 / 4096


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; NULL has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    """Unsigned CRC32 of the UTF-8 bytes; NULL like the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def category(value: Column) -> Column:
    """A place for a name, the same everywhere: the first 32 bits of a hash; NULL is 0."""
    return F.coalesce(F.shiftrightunsigned(F.xxhash64(value), 33) + 1, F.lit(0)).cast("long")


def _median_cuts(points: DataFrame, nodes: DataFrame, n_dims: int) -> DataFrame:
    """(node, dim, cut, tie): rows with (value, hash) up to (cut, tie) go left.

    points: node, weight, tie, d0..; nodes: node, dim, goal (bytes that should go
    left), slack (bytes by which a cut may miss).
    """
    value = F.coalesce(*[F.when(F.col("dim") == k, F.col(f"d{k}")) for k in range(n_dims)])
    # written once: each step reads it, and no plan holds the way there
    rows = stage(points.join(nodes, "node").select("node", "weight", value.alias("value"), "tie"), "kd-values")
    limits = rows.groupBy("node").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    state = nodes.join(limits, "node").select(
        "node", "goal", "slack", "low", "high", F.lit(0).cast("long").alias("before"),
        F.lit(False).alias("ties"), F.lit(None).cast("long").alias("at"),
        F.lit(None).cast("long").alias("cut"), F.lit(None).cast("long").alias("cut_tie"),
    )
    state, seen = stage_observed(state, "kd-state", open=F.count(F.when(F.col("cut").isNull(), 1)))
    while seen.get("open"):
        open_ = state.where("cut IS NULL").select("node", "goal", "slack", "low", "high", "before", "ties", "at")
        x = F.when(F.col("ties"), F.col("tie")).otherwise(F.col("value"))
        inside = rows.join(open_, "node").where(x.between(F.col("low"), F.col("high"))).where(
            ~F.col("ties") | (F.col("value") == F.col("at"))
        )
        width = F.floor((F.col("high") - F.col("low")) / BUCKETS) + 1
        hist = inside.groupBy("node", F.floor((x - F.col("low")) / width).alias("bucket")).agg(
            F.sum("weight").alias("bytes"), F.min(x).alias("first"), F.max(x).alias("last")
        )
        running = Window.partitionBy("node").orderBy("bucket")  # at most BUCKETS + 1 rows a node
        hist = hist.withColumn("upto", F.sum("bytes").over(running))
        upto = F.col("upto") + F.col("before")
        ends = hist.join(open_, "node").where(upto >= F.col("goal")).groupBy("node").agg(
            F.min_by(F.struct("bucket", "bytes", "first", "last", upto.alias("upto")), "bucket").alias("e")
        )
        step = state.join(ends.select("node", "e.*"), "node", "left")
        alone = F.col("first") == F.col("last")
        fine = F.col("bytes") <= F.col("slack")
        # a bucket small enough, or a single unit, goes to the side that misses the goal by less
        left_too = F.col("upto") - F.col("goal") <= F.col("goal") - (F.col("upto") - F.col("bytes"))
        end = F.when(left_too, F.col("last")).otherwise(F.col("first") - 1)
        settled = F.col("cut").isNull() & (fine | (F.col("ties") & alone))
        deeper = F.col("cut").isNull() & ~settled & ~F.col("ties") & alone
        narrower = F.col("cut").isNull() & ~settled & ~deeper
        state = step.select(
            "node", "goal", "slack",
            F.when(deeper, F.lit(0)).when(narrower, F.col("first")).otherwise(F.col("low")).cast("long").alias("low"),
            F.when(deeper, F.lit((1 << TIE_BITS) - 1)).when(narrower, F.col("last")).otherwise(F.col("high")).cast("long").alias("high"),
            F.when(deeper | narrower, F.col("upto") - F.col("bytes")).otherwise(F.col("before")).cast("long").alias("before"),
            (F.col("ties") | deeper).alias("ties"),
            F.when(deeper, F.col("first")).otherwise(F.col("at")).cast("long").alias("at"),
            F.when(settled & F.col("ties"), F.col("at")).when(settled, end).otherwise(F.col("cut")).cast("long").alias("cut"),
            F.when(settled & F.col("ties"), end).when(settled, F.lit(1 << TIE_BITS)).otherwise(F.col("cut_tie")).cast("long").alias("cut_tie"),
        )
        state, seen = stage_observed(state, "kd-state", open=F.count(F.when(F.col("cut").isNull(), 1)))
    return nodes.join(state.select("node", "cut", "cut_tie"), "node").select("node", "dim", "cut", "cut_tie")


def _descend(points: DataFrame, cuts: DataFrame, n_dims: int) -> DataFrame:
    """``points`` one level further down; a node without a cut is a leaf and keeps its number."""
    value = F.coalesce(*[F.when(F.col("dim") == k, F.col(f"d{k}")) for k in range(n_dims)])
    right = (value > F.col("cut")) | ((value == F.col("cut")) & (F.col("tie") > F.col("cut_tie")))
    went = cuts.select("node", "dim", "cut", "cut_tie", "half")
    moved = points.join(went, "node", "left")
    return moved.withColumn("node", F.col("node") + F.when(right, F.col("half")).otherwise(F.lit(0))).drop(
        "dim", "cut", "cut_tie", "half"
    )


def kd_shards(
    df: DataFrame,
    weight: Column,
    unit: Column,
    dims: Mapping[str, Column],
    order: Column,
    shards: int | None = None,
    target_bytes: int | None = None,
    unit_share: float = 0.01,
    row: Sequence[str] = (),
) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 up) and ``slot`` (0 up in its shard, no gaps).

    Either ``shards`` or ``target_bytes`` (how much a leaf holds) is given. ``unit``
    is a 64-bit hash that equal texts share, ``order`` a column by which rows of a
    shard are dealt to slots. Dimensions are longs without NULL below 2**40. A shard's
    number is the first leaf number of its node, so neighbours in the tree are
    neighbours in number. An empty table gives no rows; repeated rows stay and are
    weighed each; the added columns take an underscore where the input has their name.
    ``row`` names columns that identify a row and are not returned: with them the
    wide rows meet their shard and slot in one join and are shuffled once.
    """
    spark, names, n = df.sparkSession, list(dims), len(dims)
    columns = df.columns
    shard, slot = free(columns, "shard"), free([*columns, free(columns, "shard")], "slot")
    keys = {f"__d{k}": dims[name] for k, name in enumerate(names)}
    marks = {f"__row{k}": col(name) for k, name in enumerate(row)}
    added = marks | {"__weight": weight.cast("long"), "__unit": unit, "__own": F.xxhash64(unit, order), **keys}
    added = [c.alias(name) for name, c in added.items()]
    narrow = stage(df.select(*added), "kd-rows")
    full = df.select(*[F.col(quoted(c)).alias(f"__in{k}") for k, c in enumerate(columns)], *added)
    total, rows = narrow.agg(F.coalesce(F.sum("__weight"), F.lit(0)), F.count(F.lit(1))).first()
    leaves = shards or max(1, -(-total // target_bytes))
    share = total / leaves

    # units of several rows that are light enough to stay together
    groups = narrow.groupBy("__unit").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__weight").alias("__bytes"), *[F.min(k).alias(f"{k}_least") for k in keys]
    )
    groups = groups.where((F.col("__n") > 1) & (F.col("__bytes") <= unit_share * share)).drop("__n", "__bytes")
    groups = stage(groups, "kd-units")

    def placed(rows_: DataFrame) -> DataFrame:
        joined = rows_.join(groups, "__unit", "left")
        together = F.col("__d0_least").isNotNull()
        tie = F.when(together, F.col("__unit")).otherwise(F.col("__own")).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
        return joined.withColumns(
            # no literal: a join on a constant would lose its key
            {"node": (F.col("__weight") * 0).cast("int"), "weight": F.col("__weight"), "tie": tie}
            | {f"d{k}": F.coalesce(f"__d{k}_least", f"__d{k}") for k in range(n)}
        )

    inner = ["node", "weight", "tie", *[f"d{k}" for k in range(n)]]
    points = stage(placed(narrow).select(*inner), "kd-points")
    ranges = points.agg(*[F.min(f"d{k}") for k in range(n)], *[F.max(f"d{k}") for k in range(n)]).first()
    spans = [max(1, (ranges[n + k] or 0) - (ranges[k] or 0)) for k in range(n)]

    tree = []  # for each level the cuts of its nodes
    open_ = spark.createDataFrame([(0, leaves)], "node int, leaves int") if leaves > 1 and rows else None
    while open_ is not None:
        stats = points.join(open_, "node").groupBy("node", "leaves").agg(
            F.sum("weight").alias("bytes"), *[(F.max(f"d{k}") - F.min(f"d{k}")).alias(f"w{k}") for k in range(n)]
        )
        # the widest dimension as a share of its whole range; of equal ones the first
        widths = [F.struct((F.col(f"w{k}") / spans[k]).alias("w"), F.lit(-k).alias("k")) for k in range(n)]
        half = F.floor(F.col("leaves") / 2).cast("int")
        nodes = stats.select(
            "node",
            "leaves",
            half.alias("half"),
            (-F.array_max(F.array(*widths))["k"]).alias("dim"),
            (F.col("bytes") * half / F.col("leaves")).alias("goal"),
            F.lit(share * TOLERANCE).alias("slack"),
        )
        nodes = stage(nodes, "kd-nodes")
        cuts = _median_cuts(points, nodes.select("node", "dim", "goal", "slack"), n)
        cuts = stage(cuts.join(nodes.select("node", "half", "leaves"), "node"), "kd-cuts")
        tree.append(cuts)
        points = stage(_descend(points, cuts, n), "kd-points")
        children = cuts.select("node", F.col("half").alias("leaves")).unionByName(
            cuts.select((F.col("node") + F.col("half")).alias("node"), (F.col("leaves") - F.col("half")).alias("leaves"))
        )
        open_, seen = stage_observed(children.where("leaves > 1"), "kd-open", n=F.count(F.lit(1)))
        open_ = open_ if seen.get("n") else None

    # slots: numbered in small blocks of each shard, after the rows of its earlier blocks
    blocks = max(64, -(-rows // 20_000))
    block = F.pmod(F.xxhash64("__own"), F.lit(blocks)).alias("__block")
    narrow_out = placed(narrow)
    for cuts in tree:
        narrow_out = _descend(narrow_out, cuts, n)
    narrow_out = stage(narrow_out.select(*marks, "node", "__own", block), "kd-leaves")
    counts = narrow_out.groupBy("node", "__block").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy("node").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("node", "__block", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    starts = stage(starts, "kd-blocks")
    inside = Window.partitionBy("node", "__block").orderBy("__own")
    place = F.row_number().over(inside) - 1
    where = [F.col("node").cast("int").alias(shard), (F.col("__start") + F.col("__place")).cast("long").alias(slot)]

    if row:
        dealt = narrow_out.withColumn("__place", place).join(starts, ["node", "__block"]).select(*marks, *where)
        wide = df.select(*[F.col(quoted(c)).alias(f"__in{k}") for k, c in enumerate(columns)], *[c.alias(m) for m, c in marks.items()])
        joined = wide.join(stage(dealt, "kd-slots"), list(marks))
        return joined.select(*[F.col(f"__in{k}").alias(c) for k, c in enumerate(columns) if c not in row], shard, slot)
    out = placed(full)
    for cuts in tree:
        out = _descend(out, cuts, n)
    out = out.withColumn("__block", block).withColumn("__place", place).join(starts, ["node", "__block"])
    return out.select(*[F.col(f"__in{k}").alias(c) for k, c in enumerate(columns)], *where)


def text_unit(text: Column) -> Column:
    """64 bits that equal texts share; NULL is like the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text_crc(text))


def shard_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    dims: tuple[str, ...] = ("lang", "source"),
    length: str = "n_chars",
    weight: Column | None = None,
    unit: Column | None = None,
    **options,
) -> DataFrame:
    """``kd_shards`` of documents along their metadata: names by hash, the length by its number (negative or NULL: 0).

    ``weight`` and ``unit`` are for frames that hold ``text_size`` and ``text_unit`` in place of the text.
    """
    places = {length: F.greatest(F.coalesce(col(length).cast("long"), F.lit(0)), F.lit(0))} | {d: category(col(d)) for d in dims}
    weight = text_size(col(text)) if weight is None else weight
    unit = text_unit(col(text)) if unit is None else unit
    return kd_shards(df, weight, unit, places, F.xxhash64(col(key)), **options)
