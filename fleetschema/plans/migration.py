"""A whole run: snapshots of both sides, their differences, the numbered worklist."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetschema.operators import diff, graph, snapshots
from fleetschema.plans import worklist as w
from fleetschema.sources.catalog import BUCKET, bucketed, of_databases
from fleetschema.staging import discard, stage

KINDS = ("tables", "columns", "constraints", "indexes", "sequences", "views")
DIFFS = (  # the first two are part of others
    "new_tables", "dropped_tables", "columns_diff", "constraints_diff", "indexes_diff", "sequences_diff", "views_diff",
    "dropped_columns", "dropped_constraints", "dropped_indexes",
)


# Columns of the snapshots; `default`, `start`, `min` and `max` of a catalog have longer names here.
SNAPSHOT_COLUMNS = {
    "tables": "db_id int, oid long, schema_name string, name string, relkind string",
    "columns": "db_id int, table_oid long, schema_name string, table_name string, name string, nullable boolean, "
    "type string, length int, default_expr string, attnum int",
    "constraints": "db_id int, oid long, name string, type string, table_oid long, ref_table_oid long, "
    "cols array<smallint>, ref_cols array<smallint>, expression string, on_delete string, on_update string",
    "indexes": "db_id int, oid long, table_oid long, name string, expression string, backs_constraint string",
    "sequences": "db_id int, oid long, schema_name string, name string, type string, start_value long, "
    "min_value long, max_value long, increment long, cycles boolean",
    "views": "db_id int, oid long, schema_name string, name string, expression string, is_materialized boolean",
    "depends": "db_id int, ref_oid long, view_oid long",
}


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Writes snapshots, differences or a worklist as ``path/name`` in folders of several databases; an earlier run is replaced."""
    for name, df in tables.items():
        bucketed(df).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{name}")


def read_snapshots(spark: SparkSession, path: str, databases: Iterable[int] | None = None) -> dict[str, DataFrame]:
    """The snapshots of both sides, as written by ``write_tables``; of some databases, or of all."""
    names = [f"{side}_{kind}" for side in ("target", "current") for kind in (*KINDS, "depends")]
    databases = None if databases is None else list(databases)

    def read(name: str) -> DataFrame:
        columns = SNAPSHOT_COLUMNS[name.split("_", 1)[1]]
        return of_databases(spark.read.schema(f"{columns}, {BUCKET} int").parquet(f"{path}/{name}"), databases)

    return {n: read(n) for n in names}


def take_snapshots(raw: dict[str, DataFrame], side: str) -> dict[str, DataFrame]:
    """The six snapshots of one side and its dependency edges, by names such as ``target_tables``."""
    out = {f"{side}_{kind}": getattr(snapshots, f"snapshot_{kind}")(raw) for kind in KINDS}
    return out | {f"{side}_depends": graph.dependency_edges(raw["depend"], raw["rewrite"])}


def difference(s: dict[str, DataFrame], name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """One of the ten differences; those it builds on come from ``known`` where given."""
    def of(other: str) -> DataFrame:
        return known[other] if known and other in known else difference(s, other, known)

    match name:
        case "new_tables":
            return diff.new_tables(s["target_tables"], s["current_tables"])
        case "columns_diff":
            return diff.columns_diff(s["target_columns"], s["current_columns"], of("new_tables"))
        case "constraints_diff":
            return diff.constraints_diff(
                s["target_constraints"], s["target_tables"], s["current_tables"], s["current_constraints"]
            )
        case "indexes_diff":
            return diff.indexes_diff(s["target_indexes"], s["target_tables"], s["current_tables"], s["current_indexes"])
        case "sequences_diff":
            return diff.sequences_diff(s["target_sequences"], s["current_sequences"])
        case "views_diff":
            return diff.views_diff(s["target_views"], s["current_views"])
        case "dropped_tables":
            return diff.dropped_tables(s["current_tables"], s["target_tables"])
        case "dropped_columns":
            return diff.dropped_columns(s["current_columns"], s["target_columns"], of("dropped_tables"))
        case "dropped_constraints":
            return diff.dropped_constraints(s["current_constraints"], s["target_constraints"], of("dropped_tables"))
        case "dropped_indexes":
            return diff.dropped_indexes(s["current_indexes"], s["target_indexes"], of("dropped_tables"))
    raise ValueError(f"no difference named {name!r}")


def stage_differences(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The differences as written tables, since each feeds several rules; ``altered`` is added to them.

    Jobs that do not depend on each other are submitted together, so that the
    last tasks of one leave no executor idle.
    """
    known: dict[str, DataFrame] = {}

    def write(name: str) -> None:
        known[name] = stage(difference(s, name, known), name)

    with ThreadPoolExecutor(len(DIFFS)) as jobs:
        list(jobs.map(write, DIFFS[:2]))
        list(jobs.map(write, DIFFS[2:]))
    known["altered"] = stage(graph.altered_tables(known["columns_diff"], s["current_tables"]), "altered")
    return known


def affected(s: dict[str, DataFrame], d: dict[str, DataFrame]) -> DataFrame:
    """Current views that have to be dropped."""
    return graph.affected_views(
        d["views_diff"], d["altered"], d["dropped_tables"], s["current_depends"], s["current_views"]
    )


def with_owners(
    s: Mapping[str, DataFrame], d: Mapping[str, DataFrame]
) -> tuple[Mapping[str, DataFrame], Mapping[str, DataFrame]]:
    """The same with constraints and indexes that have the schema and name of their table, each joined and written once."""
    sides = {"constraints_diff": "target", "dropped_constraints": "current", "dropped_indexes": "current"}
    objects = {f"{side}_{kind}": side for side in ("current", "target") for kind in ("constraints", "indexes")} | sides

    def write(name: str) -> tuple[str, DataFrame]:
        return name, stage(w.on_table((d if name in sides else s)[name], s[f"{objects[name]}_tables"]), f"owned-{name}")

    with ThreadPoolExecutor(len(objects)) as jobs:
        owned = dict(jobs.map(write, objects))
    return ChainMap({n: f for n, f in owned.items() if n not in sides}, s), ChainMap({n: owned[n] for n in sides}, d)


def phase_one(s: dict[str, DataFrame], d: dict[str, DataFrame], hit: DataFrame | None = None) -> DataFrame:
    """The drops, each object queued once. ``hit`` are the ``affected`` views, if they are written already."""
    ct, cc, ci = s["current_tables"], s["current_constraints"], s["current_indexes"]
    return w.union_rules(
        w.plan_drop_views(affected(s, d) if hit is None else hit),
        w.queue_drops(
            w.plan_drop_removed_fks(d["dropped_constraints"], ct),
            w.plan_drop_fks_to_altered(cc, ct, d["altered"]),
            w.plan_drop_pks(cc, d["altered"]),
            w.plan_drop_backed(cc, ci, d["altered"]),
            w.plan_drop_backed_removed(cc, ci, ct, s["target_indexes"], s["target_tables"]),
            w.plan_drop_indexes(ci, d["altered"], d["new_tables"]),
            w.plan_drop_removed_indexes(d["dropped_indexes"], ct),
        ),
    )


def phase_two(s: dict[str, DataFrame], d: dict[str, DataFrame]) -> DataFrame:
    new, columns = d["new_tables"], d["columns_diff"]
    return w.union_rules(
        w.plan_schemas(new),
        w.plan_create_sequences(d["sequences_diff"]),
        w.plan_alter_sequences(d["sequences_diff"]),
        w.plan_create_tables(new),
        w.plan_new_table_columns(s["target_columns"], new),
        w.plan_alter_aggregate(columns, new),
        w.plan_set_not_null(columns, new),
        w.plan_alter_type(columns, new),
        w.plan_drop_tables(d["dropped_tables"]),
        w.plan_add_checks(d["constraints_diff"], s["target_tables"]),
        w.plan_add_uniques(d["constraints_diff"], s["target_tables"]),
        w.plan_drop_checks_uniques(d["dropped_constraints"], s["current_tables"]),
    )


def creation(s: dict[str, DataFrame], d: dict[str, DataFrame], hit: DataFrame | None = None) -> DataFrame:
    """Order in which the target's versions of dropped views, of all that read them, and its new views come."""
    dropped = graph.dependency_closure(s["current_depends"], affected(s, d) if hit is None else hit)
    return graph.creation_order(
        s["current_views"], s["target_views"], d["views_diff"], dropped, s["current_depends"], s["target_depends"]
    )


def phase_three(s: dict[str, DataFrame], d: dict[str, DataFrame], queue: DataFrame, order: DataFrame) -> DataFrame:
    """Rebuilds what phase one dropped. ``queue`` is read many times: pass it staged."""
    cc, ct = s["current_constraints"], s["current_tables"]
    tc, tt = s["target_constraints"], s["target_tables"]
    pks = stage(w.plan_recreate_pks(queue, cc, ct, tc, tt), "recreated-keys")  # rows of their own, and read by the next rule
    return w.union_rules(
        w.plan_recreate_indexes(queue, s["current_indexes"], ct, s["target_indexes"], tt),
        pks,
        w.plan_recreate_fks(queue, pks, cc, ct, tc, tt),
        w.plan_recreate_views(order, s["target_views"]),
    )


def build_worklist(s: dict[str, DataFrame], d: dict[str, DataFrame] | None = None) -> DataFrame:
    """The numbered worklist of every database. ``s`` are the snapshots of both sides, best read from tables.

    What several rules read is written once: the differences, the owners of
    constraints and indexes, the affected views. Rule rows are written with a row
    number of their phase before they are put in order; then what was written for
    them is deleted, the differences only if they were not given.
    """
    made = stage_differences(s) if d is None else {}
    d = made or d

    def rows(phase: DataFrame, name: str) -> DataFrame:
        return stage(phase.withColumn("_row", F.monotonically_increasing_id()), name)

    with ThreadPoolExecutor(2) as jobs:
        owners = jobs.submit(lambda: with_owners(s, d))
        hit = stage(affected(s, d), "affected")
        order = jobs.submit(lambda: creation(s, d, hit))
        own, diffs = owners.result()
        second = jobs.submit(lambda: rows(phase_two(own, diffs), "phase-two"))
        queue = rows(phase_one(own, diffs, hit), "queue")
        third = rows(phase_three(own, diffs, queue, order.result()), "phase-three")
        phases = w.union_rules(queue, second.result(), third)
    # the phases are written, so nothing reads the owners and what else was written for them
    discard(*own.maps[0].values(), *diffs.maps[0].values(), hit, *(made.values() if made else ()))
    return w.number_worklist(phases)
