"""View dependencies. An edge (db_id, ref_oid, view_oid) says that the view reads the object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetschema.operators.diff import TABLE
from fleetschema.staging import new_folder, stage

NODE = ["db_id", "oid"]
VIEW = ["db_id", "oid", "schema_name", "name", "is_materialized"]


def dependency_edges(depends: DataFrame, rewrite: DataFrame) -> DataFrame:
    """Normal dependencies joined with the rewrite rule that stands for the view; self edges dropped."""
    return (
        depends.where("deptype = 'n'")
        .join(rewrite.select("db_id", F.col("oid").alias("objid"), F.col("ev_class").alias("view_oid")), ["db_id", "objid"])
        .where("view_oid <> refobjid")
        .select("db_id", F.col("refobjid").alias("ref_oid"), "view_oid")
        .distinct()
    )


def altered_tables(columns_diff: DataFrame, current_tables: DataFrame) -> DataFrame:
    """Current tables with at least one column difference: (db_id, oid, schema_name, name)."""
    changed = columns_diff.select("db_id", "schema_name", F.col("table_name").alias("name")).distinct()
    return current_tables.select("db_id", "oid", "schema_name", "name").join(changed, TABLE, "left_semi")


def _touched(altered: DataFrame, dropped_tables: DataFrame) -> DataFrame:
    """No table is in both: an altered one has columns in the target."""
    columns = ["db_id", "oid", "schema_name", "name"]
    return altered.select(columns).unionByName(dropped_tables.select(columns))


def direct_dependents(depends: DataFrame, views: DataFrame, objects: DataFrame) -> DataFrame:
    """Views that read one of the objects (db_id, oid)."""
    # not made distinct: a join right after a grouping cannot split an object that very many views read
    touched = objects.select("db_id", F.col("oid").alias("ref_oid"))
    readers = (
        depends.where("view_oid <> ref_oid")
        .join(touched, ["db_id", "ref_oid"], "left_semi")
        .select("db_id", F.col("view_oid").alias("oid"))
        .distinct()
    )
    return views.select(VIEW).join(readers, NODE, "left_semi")


def tenant_views(
    altered: DataFrame, dropped_tables: DataFrame, depends: DataFrame, current_views: DataFrame, target_views: DataFrame
) -> DataFrame:
    """Views outside the target that read an altered or dropped table, with the tables they read.

    ``depends_on`` is one array per view; PostgreSQL bounds the relations a view
    can name to some 65,000.
    """
    tables = _touched(altered, dropped_tables).select(
        "db_id", F.col("oid").alias("ref_oid"), F.concat_ws(".", "schema_name", "name").alias("reads")
    )
    reads = (
        depends.where("view_oid <> ref_oid")
        .join(tables, ["db_id", "ref_oid"])
        .groupBy("db_id", F.col("view_oid").alias("oid"))
        .agg(F.array_sort(F.collect_set("reads")).alias("depends_on"))
    )
    return (
        current_views.join(target_views.select(TABLE), TABLE, "left_anti")
        .join(reads, NODE)
        .select(
            *VIEW[:4],
            "expression",
            "is_materialized",
            "depends_on",
            F.lit("PENDING").alias("status"),
            F.lit(None).cast("string").alias("error_msg"),
        )
    )


def affected_views(
    views_diff: DataFrame, altered: DataFrame, dropped_tables: DataFrame, depends: DataFrame, current_views: DataFrame
) -> DataFrame:
    """Current views that changed, or that read an altered or dropped table."""
    changed = current_views.select(VIEW).join(views_diff.select(TABLE), TABLE, "left_semi")
    readers = direct_dependents(depends, current_views, _touched(altered, dropped_tables))
    return changed.unionByName(readers).distinct()


def dependency_closure(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Everything reached from the seeds, with the shallowest depth; seeds have depth 1.

    Breadth first: a node is kept when first met, which gives the shallowest
    depth and ends on cycles. Every level is written to the shared folder. Edges to
    the nodes met last are dropped, so no later level reads them or what was met before.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "closure")
    frontier = stage(seeds.select(NODE).distinct(), "level", f"{folder}/depth=1")
    left = edges.select("db_id", "ref_oid", "view_oid").distinct()
    depth = 1
    while not frontier.isEmpty() and (max_depth is None or depth < max_depth):
        depth += 1
        met = frontier.withColumnRenamed("oid", "view_oid")
        left = stage(left.join(met, ["db_id", "view_oid"], "left_anti"), "edges")
        following = left.join(frontier.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"]).select(
            "db_id", F.col("view_oid").alias("oid")
        )
        frontier = stage(following.distinct(), "level", f"{folder}/depth={depth}")
    return spark.read.schema(_node_schema(seeds) + ", depth int").parquet(folder)


def dependency_paths(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """The closure with one shortest path to every node: (db_id, oid, depth, path, is_cycle).

    ``path`` goes from a seed to the node; of several shortest ones it is the first
    in order of oids. A level takes the smallest path of the nodes before, so
    neither walks nor all paths are listed; a path has as many oids as the depth.
    ``is_cycle`` marks nodes that can reach themselves, not those that only lie
    behind a cycle.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "paths")
    start = seeds.select(NODE).distinct().withColumn("path", F.array("oid"))
    frontier = stage(start, "level", f"{folder}/depth=1")
    all_edges = stage(edges.select("db_id", "ref_oid", "view_oid").distinct(), "edges")
    left, depth = all_edges, 1
    while not frontier.isEmpty() and (max_depth is None or depth < max_depth):
        depth += 1
        met = frontier.select("db_id", F.col("oid").alias("view_oid"))
        left = stage(left.join(met, ["db_id", "view_oid"], "left_anti"), "edges")
        steps = left.join(frontier.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"])
        first = steps.groupBy("db_id", F.col("view_oid").alias("oid")).agg(F.min("path").alias("path"))
        frontier = stage(first.withColumn("path", F.concat("path", F.array("oid"))), "level", f"{folder}/depth={depth}")
    oid = seeds.schema["oid"].dataType.simpleString()
    found = spark.read.schema(f"{_node_schema(seeds)}, path array<{oid}>, depth int").parquet(folder)
    reached = found.select(NODE)
    inner = all_edges.join(reached.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"], "left_semi")
    on_cycle = strongly_connected(inner).select(*NODE, F.lit(True).alias("is_cycle"))
    marked = found.join(on_cycle, NODE, "left")
    return marked.select(*NODE, "depth", "path", F.coalesce("is_cycle", F.lit(False)).alias("is_cycle"))


def closure_by_recursion(edges: DataFrame, seeds: DataFrame, max_depth: int = 100) -> DataFrame:
    """The rows of ``dependency_closure`` by one recursive statement, for graphs of few paths.

    Every walk without a repeated node is followed, as a recursive query does, so
    the caller has to know that there are few; ``dependency_closure`` meets each
    node once. Spark ends a recursion that goes on after 100 levels
    (``spark.sql.cteRecursionLevelLimit``) or has made 1,000,000 rows
    (``spark.sql.cteRecursionRowLimit``), which is raised as an error here; one
    that ends before ``max_depth`` is whole.
    """
    walk = """
        WITH RECURSIVE walk (db_id, oid, depth, path) AS (
          SELECT db_id, oid, 1, array(oid) FROM {seeds}
          UNION ALL
          SELECT w.db_id, e.view_oid, w.depth + 1, array_append(w.path, e.view_oid)
          FROM walk w JOIN {edges} e ON e.db_id = w.db_id AND e.ref_oid = w.oid
          WHERE w.depth < :most AND NOT array_contains(w.path, e.view_oid)
        )
        SELECT db_id, oid, min(depth) AS depth FROM walk GROUP BY db_id, oid"""
    steps = edges.select("db_id", "ref_oid", "view_oid").distinct()
    spark = edges.sparkSession
    try:
        found = spark.sql(walk, {"most": max_depth}, seeds=seeds.select(NODE).distinct(), edges=steps)
        return stage(found, "recursive-closure")
    except Exception as error:
        if "RECURSION_LEVEL_LIMIT_EXCEEDED" in str(error) or "RECURSION_ROW_LIMIT_EXCEEDED" in str(error):
            raise ValueError("too many levels or walks for one recursive statement; use dependency_closure") from error
        raise


def strongly_connected(edges: DataFrame) -> DataFrame:
    """Nodes that lie on a cycle: (db_id, oid, component), the component named by its smallest oid.

    Nodes that nothing leads to, or that lead nowhere, are trimmed until every one
    left has both. Then each node takes the smallest oid that reaches it as its
    colour; a node of its own colour is a pivot, and what reaches the pivot inside
    its colour is its component. Components leave the graph, and the rest goes on.
    A self edge is a cycle. Each round is a written table of what changed in it.
    """
    spark = edges.sparkSession
    edges = stage(edges.select("db_id", "ref_oid", "view_oid").distinct(), "edges")
    loops = edges.where("ref_oid = view_oid").select("db_id", F.col("ref_oid").alias("oid"), F.col("ref_oid").alias("component"))
    left = stage(edges.where("ref_oid <> view_oid"), "edges")
    folder, round_ = new_folder(spark, "components"), 0
    spark.createDataFrame([], loops.schema).write.parquet(f"{folder}/round=0")
    while True:
        left = _trimmed(left)
        if left.isEmpty():
            break
        round_ += 1
        colours = _coloured(left)
        same = (
            left.join(colours.withColumnsRenamed({"oid": "ref_oid", "colour": "a"}), ["db_id", "ref_oid"])
            .join(colours.withColumnsRenamed({"oid": "view_oid", "colour": "b"}), ["db_id", "view_oid"])
            .where("a = b")
            .select("db_id", "ref_oid", "view_oid", F.col("a").alias("colour"))
        )
        found = _reaching(stage(same, "colour-edges"), colours.where("oid = colour"))
        # a pivot that only itself reaches lies between cycles, not on one
        large = found.groupBy("db_id", "colour").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        found.join(large, ["db_id", "colour"], "left_semi").select(*NODE, F.col("colour").alias("component")).write.parquet(
            f"{folder}/round={round_}"
        )
        for end in ("ref_oid", "view_oid"):
            left = left.join(found.select("db_id", F.col("oid").alias(end)), ["db_id", end], "left_anti")
        left = stage(left.select("db_id", "ref_oid", "view_oid"), "edges")
    found = spark.read.schema(loops.schema).parquet(folder).select(*NODE, "component")
    return found.unionByName(loops.join(found, NODE, "left_anti"))


def _trimmed(left: DataFrame) -> DataFrame:
    """The edges between nodes that each have an edge to them and one from them."""
    before, now = -1, left.count()
    while now and now != before:
        led_to = left.select("db_id", F.col("view_oid").alias("ref_oid")).distinct()
        leading = left.select("db_id", F.col("ref_oid").alias("view_oid")).distinct()
        kept = left.join(led_to, ["db_id", "ref_oid"], "left_semi").join(leading, ["db_id", "view_oid"], "left_semi")
        left = stage(kept.select("db_id", "ref_oid", "view_oid"), "trimmed")
        before, now = now, left.count()
    return left


def _coloured(left: DataFrame) -> DataFrame:
    """(db_id, oid, colour): the smallest oid from which each node can be reached, itself included."""
    nodes = left.select("db_id", F.col("ref_oid").alias("oid"))
    colours = stage(nodes.distinct().withColumn("colour", F.col("oid")), "colours")
    changed = colours
    while not changed.isEmpty():
        sent = left.join(changed.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"])
        offered = sent.groupBy("db_id", F.col("view_oid").alias("oid")).agg(F.min("colour").alias("offered"))
        changed = stage(
            colours.join(offered, NODE).where("offered < colour").select(*NODE, F.col("offered").alias("colour")), "changed"
        )
        better = changed.withColumnRenamed("colour", "better")
        colours = stage(
            colours.join(better, NODE, "left").select(*NODE, F.coalesce("better", "colour").alias("colour")), "colours"
        )
    return colours


def _reaching(same: DataFrame, pivots: DataFrame) -> DataFrame:
    """(db_id, oid, colour): pivots and all that reach one inside its colour."""
    spark = pivots.sparkSession
    folder, depth = new_folder(spark, "reaching"), 0
    frontier = stage(pivots, "reaching", f"{folder}/depth=0")
    left = same
    while not frontier.isEmpty():
        depth += 1
        met = frontier.withColumnRenamed("oid", "ref_oid").drop("colour")
        left = stage(left.join(met, ["db_id", "ref_oid"], "left_anti"), "colour-edges")
        before = left.join(frontier.withColumnRenamed("oid", "view_oid"), ["db_id", "view_oid", "colour"])
        before = before.select("db_id", F.col("ref_oid").alias("oid"), "colour").distinct()
        frontier = stage(before, "reaching", f"{folder}/depth={depth}")
    return spark.read.schema(pivots.schema).parquet(folder).select(*NODE, "colour")


def cycle_members(order: DataFrame, edges: DataFrame) -> DataFrame:
    """The order with what is on a cycle told from what lies behind one.

    ``order`` comes from ``recreation_order`` over the same edges. (db_id, oid,
    level, in_cycle, behind_cycle, component): one of the flags is set for the
    nodes that the order leaves to the end, and ``component`` names the cycle.
    """
    rest = stage(order.where("in_cycle").select(NODE), "left-over")
    inner = (
        edges.select("db_id", "ref_oid", "view_oid")
        .join(rest.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"], "left_semi")
        .join(rest.withColumnRenamed("oid", "view_oid"), ["db_id", "view_oid"], "left_semi")
        .where("ref_oid <> view_oid")  # the order takes no notice of a view that reads itself
    )
    on_cycle = strongly_connected(inner)
    there = F.col("component").isNotNull()
    return order.join(on_cycle, NODE, "left").select(
        *NODE, "level", there.alias("in_cycle"), (F.col("in_cycle") & ~there).alias("behind_cycle"), "component"
    )


def _node_schema(nodes: DataFrame) -> str:
    return ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in NODE)


def recreation_order(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Level of every node by its longest path inside ``nodes``: (db_id, oid, level, in_cycle).

    Level 1 has no edge to it. A round marks the edges that leave the nodes placed
    last; the nodes whose remaining edges are all marked are placed next. What is
    left when a round places nothing is a cycle or lies behind one: it comes last,
    flagged. Each round writes the edges that were left, so the work shrinks.
    """
    spark = edges.sparkSession
    nodes = stage(nodes.select(NODE).distinct(), "nodes")
    left = stage(
        edges.select("db_id", "ref_oid", "view_oid")
        .where("view_oid <> ref_oid")
        .distinct()
        .join(nodes.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"], "left_semi")
        .join(nodes.withColumnRenamed("oid", "view_oid"), ["db_id", "view_oid"], "left_semi"),
        "edges",
    )
    folder = new_folder(spark, "order")
    blocked = left.select("db_id", F.col("view_oid").alias("oid")).distinct()
    ready, level = stage(nodes.join(blocked, NODE, "left_anti"), "level", f"{folder}/level=1"), 1
    while not ready.isEmpty():
        marks = ready.select("db_id", F.col("oid").alias("ref_oid"), F.lit(True).alias("mark"))
        marked = stage(
            left.select("db_id", "ref_oid", "view_oid")
            .join(marks, ["db_id", "ref_oid"], "left")
            .withColumn("gone", F.col("mark").isNotNull())
            .drop("mark"),
            "edges",
        )
        level += 1
        freed = marked.groupBy("db_id", F.col("view_oid").alias("oid")).agg(F.bool_and("gone").alias("free"))
        # written, since a join right after a grouping cannot split a node with very many edges
        ready = stage(freed.where("free").select(NODE), "level", f"{folder}/level={level}")
        left = marked.where("NOT gone")
    placed = spark.read.schema(_node_schema(nodes) + ", level int").parquet(folder)
    rest = nodes.join(placed, NODE, "left_anti")
    return placed.select(*NODE, "level", F.lit(False).alias("in_cycle")).unionByName(
        rest.select(*NODE, F.lit(level).alias("level"), F.lit(True).alias("in_cycle"))
    )


def creation_order(
    current_views: DataFrame,
    target_views: DataFrame,
    views_diff: DataFrame,
    dropped: DataFrame,
    current_depends: DataFrame,
    target_depends: DataFrame,
) -> DataFrame:
    """Order in which views of the target are created: (db_id, oid, level, in_cycle), oids of the target.

    These are the target's versions of the ``dropped`` current views (db_id, oid),
    and its new views. What a view reads is said by the target's dependencies, and
    by the current ones of views whose text stays the same.
    """
    old = current_views.select(*TABLE, F.col("oid").alias("old_oid")).join(
        dropped.select("db_id", F.col("oid").alias("old_oid")), ["db_id", "old_oid"], "left_semi"
    )
    back = stage(target_views.select(*TABLE, "oid").join(old, TABLE).select("db_id", "old_oid", "oid"), "views-back")
    fresh = target_views.join(views_diff.where("is_new").select(TABLE), TABLE, "left_semi").select(NODE)
    same = back.join(views_diff.select(NODE), NODE, "left_anti")
    kept = (
        current_depends.select("db_id", "ref_oid", "view_oid")
        .join(same.select("db_id", F.col("old_oid").alias("view_oid"), F.col("oid").alias("reader")), ["db_id", "view_oid"])
        .join(back.select("db_id", F.col("old_oid").alias("ref_oid"), F.col("oid").alias("read")), ["db_id", "ref_oid"])
        .select("db_id", F.col("read").alias("ref_oid"), F.col("reader").alias("view_oid"))
    )
    edges = target_depends.select("db_id", "ref_oid", "view_oid").unionByName(kept)
    return recreation_order(edges, back.select(NODE).unionByName(fresh))
