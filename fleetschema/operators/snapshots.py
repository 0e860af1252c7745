"""Typed snapshots of the raw catalogs, one row per object, keyed by ``db_id``.

``namespace`` and ``type`` are the small sides; they are joined without a hint, so
Spark broadcasts them while they are below its size threshold and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.staging import stage

# Schemas that never take part, the same list for both sides.
IGNORED_SCHEMAS = ("pg_toast", "pg_catalog", "information_schema", "_migrations")


def _schemas(raw: dict[str, DataFrame], key: str) -> DataFrame:
    return raw["namespace"].where(~F.col("nspname").isin(*IGNORED_SCHEMAS)).select(
        "db_id", F.col("oid").alias(key), F.col("nspname").alias("schema_name")
    )


def _classes(raw: dict[str, DataFrame], *kinds: str) -> DataFrame:
    """Classes of the given kinds with their schema."""
    return (
        raw["class"]
        .where(F.col("relkind").isin(*kinds))
        .join(_schemas(raw, "relnamespace"), ["db_id", "relnamespace"])
        .select("db_id", "oid", "schema_name", F.col("relname").alias("name"), "relkind")
    )


def _types(raw: dict[str, DataFrame], key: str) -> DataFrame:
    return raw["type"].select("db_id", F.col("oid").alias(key), F.col("typname").alias("type"))


def _texts(raw: dict[str, DataFrame], *object_types: str) -> DataFrame:
    """Exported texts; oids are only unique inside one catalog, hence the object type."""
    return raw["definitions"].where(F.col("object_type").isin(*object_types)).select(
        "db_id", F.col("object_oid").alias("oid"), F.col("definition").alias("expression")
    )


def snapshot_tables(raw: dict[str, DataFrame]) -> DataFrame:
    return _classes(raw, "r", "m")


def snapshot_columns(raw: dict[str, DataFrame]) -> DataFrame:
    """Columns with their number in the table, to which key numbers of constraints refer.

    A table has at most 1,600 columns, so its defaults fit into one map; the
    attributes, the large side, are then shuffled by table once. The type's name
    is added last, from the small side.
    """
    tables = _classes(raw, "r").select(
        "db_id", F.col("oid").alias("table_oid"), "schema_name", F.col("name").alias("table_name")
    )
    attributes = raw["attribute"].where("attnum > 0 AND NOT attisdropped").select(
        "db_id",
        F.col("attrelid").alias("table_oid"),
        "attnum",
        F.col("attname").alias("name"),
        (~F.col("attnotnull")).alias("nullable"),
        "atttypid",
        F.col("atttypmod").alias("length"),
    )
    defaults = (
        raw["attrdef"]
        .select("db_id", "oid", F.col("adrelid").alias("table_oid"), F.col("adnum").alias("attnum"))
        .join(_texts(raw, "column_default"), ["db_id", "oid"])
        .groupBy("db_id", "table_oid")
        .agg(F.map_from_entries(F.collect_list(F.struct("attnum", "expression"))).alias("defaults"))
    )
    return (
        attributes.join(tables.join(defaults, ["db_id", "table_oid"], "left"), ["db_id", "table_oid"])
        .join(_types(raw, "atttypid"), ["db_id", "atttypid"])
        .select(
            "table_oid", "db_id", "schema_name", "table_name", "name", "nullable", "type", "length",
            F.try_element_at("defaults", F.col("attnum")).alias("default_expr"), "attnum",
        )
    )


def snapshot_constraints(raw: dict[str, DataFrame]) -> DataFrame:
    def oid(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(0))

    def action(c: str) -> Column:
        return F.nullif(F.trim(F.col(c)), F.lit(""))

    return (
        raw["constraint"]
        .join(_schemas(raw, "connamespace").select("db_id", "connamespace"), ["db_id", "connamespace"])
        .join(_texts(raw, "constraint"), ["db_id", "oid"], "left")
        .select(
            "oid",
            "db_id",
            F.col("conname").alias("name"),
            F.col("contype").alias("type"),
            oid("conrelid").alias("table_oid"),
            oid("confrelid").alias("ref_table_oid"),
            F.col("conkey").alias("cols"),
            F.col("confkey").alias("ref_cols"),
            "expression",
            action("confdeltype").alias("on_delete"),
            action("confupdtype").alias("on_update"),
        )
    )


def snapshot_indexes(raw: dict[str, DataFrame]) -> DataFrame:
    """Indexes with the name of the constraint that each one backs."""
    backing = raw["constraint"].where("conindid <> 0 AND contype IN ('p', 'u', 'x')").select(
        "db_id", F.col("conindid").alias("oid"), F.col("conname").alias("backs_constraint")
    )
    return (
        raw["index"]
        .select("db_id", F.col("indexrelid").alias("oid"), F.col("indrelid").alias("table_oid"))
        .join(_classes(raw, "i", "I").select("db_id", "oid", "name"), ["db_id", "oid"])
        .join(_texts(raw, "index"), ["db_id", "oid"], "left")
        .join(backing, ["db_id", "oid"], "left")
        .select("oid", "db_id", "table_oid", "name", "expression", "backs_constraint")
    )


def snapshot_sequences(raw: dict[str, DataFrame]) -> DataFrame:
    return (
        raw["sequence"]
        .withColumnRenamed("seqrelid", "oid")
        .join(_classes(raw, "S").select("db_id", "oid", "schema_name", "name"), ["db_id", "oid"])
        .join(_types(raw, "seqtypid"), ["db_id", "seqtypid"])
        .select(
            "oid",
            "db_id",
            "schema_name",
            "name",
            "type",
            F.col("seqstart").alias("start_value"),
            F.col("seqmin").alias("min_value"),
            F.col("seqmax").alias("max_value"),
            F.col("seqincrement").alias("increment"),
            F.col("seqcycle").alias("cycles"),
        )
    )


def snapshot_views(raw: dict[str, DataFrame]) -> DataFrame:
    return (
        _classes(raw, "v", "m")
        .join(_texts(raw, "view", "materialized_view"), ["db_id", "oid"])
        .select("oid", "db_id", "schema_name", "name", "expression", (F.col("relkind") == "m").alias("is_materialized"))
    )


def object_definitions(raw: dict[str, DataFrame]) -> DataFrame:
    """Every catalog object in one long relation:
    (db_id, object_type, object_oid, table_oid, schema_name, object_name, definition)."""
    spaces = raw["namespace"].select("db_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("schema_name"))
    named = raw["class"].join(spaces, ["db_id", "relnamespace"]).select(
        "db_id", F.col("oid").alias("table_oid"), "schema_name", F.col("relname"), "relkind"
    )
    owner = named.drop("relkind")
    # Relation kind and the object type it is listed as.
    kinds = {"r": "table", "v": "view", "m": "materialized_view"}
    relations = named.where(F.col("relkind").isin(*kinds)).select(
        "db_id",
        F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("relkind")).alias("object_type"),
        F.col("table_oid").alias("object_oid"),
        "table_oid",
        "schema_name",
        F.col("relname").alias("object_name"),
    )

    def listed(df: DataFrame, object_type: str, oid: str, name: Column, table_oid: str = "table_oid") -> DataFrame:
        return df.select(
            "db_id",
            F.lit(object_type).alias("object_type"),
            F.col(oid).alias("object_oid"),
            F.col(table_oid).cast("long").alias("table_oid"),
            "schema_name",
            name.alias("object_name"),
        )

    indexes = raw["index"].join(owner.withColumnRenamed("table_oid", "indexrelid"), ["db_id", "indexrelid"])
    constraints = raw["constraint"].withColumn("table_oid", F.col("conrelid")).join(owner, ["db_id", "table_oid"])
    functions = (
        raw["proc"]
        .withColumnRenamed("pronamespace", "relnamespace")
        .join(spaces.where("schema_name <> 'pg_catalog'"), ["db_id", "relnamespace"])
        .withColumn("table_oid", F.lit(None))
    )
    attributes = raw["attribute"].where("NOT attisdropped").select(
        "db_id", F.col("attrelid").alias("table_oid"), F.col("attnum").alias("adnum"), "attname"
    )
    defaults = (
        raw["attrdef"]
        .withColumnRenamed("adrelid", "table_oid")
        .join(attributes, ["db_id", "table_oid", "adnum"])
        .join(owner, ["db_id", "table_oid"])
    )
    triggers = raw["trigger"].where("NOT tgisinternal").withColumnRenamed("tgrelid", "table_oid").join(
        owner, ["db_id", "table_oid"]
    )
    objects = (
        relations.unionByName(listed(indexes, "index", "indexrelid", F.col("relname"), "indrelid"))
        .unionByName(listed(constraints, "constraint", "oid", F.col("conname")))
        .unionByName(listed(functions, "function", "oid", F.col("proname")))
        .unionByName(listed(defaults, "column_default", "oid", F.concat("relname", F.lit("."), "attname")))
        .unionByName(listed(triggers, "trigger", "oid", F.col("tgname")))
    )
    texts = raw["definitions"].select("db_id", "object_type", "object_oid", "definition")
    return objects.join(texts, ["db_id", "object_type", "object_oid"], "left").withColumn(
        "definition", F.when(F.col("object_type") != "table", F.col("definition"))
    )


#: of one join cell of ``fan_out_model``: rows of the model and databases
MODEL_ROWS, FOLLOWERS = 2_000, 1_000


def fan_out_model(model: DataFrame, databases: DataFrame, model_key: str = "model_id") -> DataFrame:
    """The rows of its model for every database: ``databases`` is (db_id, model_id).

    Each database names the model it follows, so this is an equi join. All of
    them may name the same one: the rows of a model are dealt to as many parts and
    its databases to as many groups as their numbers need, and each part meets each
    group. A row is copied once for each group of databases, a database once for each
    part of its model; neither goes with the number of shuffle partitions.
    """
    followers = databases.select("db_id", model_key).distinct()
    rows = model.drop("db_id") if "db_id" in model.columns else model

    def pieces(df: DataFrame, most: int, name: str) -> DataFrame:
        return df.groupBy(model_key).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))

    cells = pieces(rows, MODEL_ROWS, "_parts").join(pieces(followers, FOLLOWERS, "_groups"), model_key)
    cells = stage(cells.withColumn("_zero", F.lit(0).cast("long")), "model-cells")  # one row for each model

    def dealt(df: DataFrame, own: str, n: str, other: str, m: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*df.columns), F.col(n)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(m) - 1))
        # a key that is a constant would leave no equality to join by
        keyed = df.withColumn("_zero", F.pmod(F.xxhash64(*df.columns), F.lit(1)).cast("long"))
        return keyed.join(cells, [model_key, "_zero"]).select(*df.columns, place.alias(own), every.alias(other))

    # as many tasks as there are shuffle partitions: adaptive execution would go by the small inputs and not by what comes out
    tasks, cell = int(databases.sparkSession.conf.get("spark.sql.shuffle.partitions")), [model_key, "_part", "_group"]
    left = dealt(followers, "_group", "_groups", "_part", "_parts").repartition(tasks, *cell)
    right = dealt(rows, "_part", "_parts", "_group", "_groups").repartition(tasks, *cell)
    return left.join(right, cell).drop("_part", "_group")
