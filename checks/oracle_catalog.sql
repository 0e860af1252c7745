-- name: o_raw_counts
SELECT side, relation, db_id, count(*) AS n, CAST(sum(number) AS BIGINT) AS numbers, CAST(sum(length(text)) AS BIGINT) AS characters FROM (
  SELECT 'current' AS side, 'namespace' AS relation, db_id, CAST(oid AS BIGINT) AS number, nspname AS text FROM raw_current_namespace
  UNION ALL SELECT 'target', 'namespace', db_id, CAST(oid AS BIGINT) AS number, nspname AS text FROM raw_target_namespace
  UNION ALL SELECT 'current', 'class', db_id, CAST(oid AS BIGINT) AS number, relname AS text FROM raw_current_class
  UNION ALL SELECT 'target', 'class', db_id, CAST(oid AS BIGINT) AS number, relname AS text FROM raw_target_class
  UNION ALL SELECT 'current', 'attribute', db_id, CAST(attrelid + attnum AS BIGINT) AS number, attname AS text FROM raw_current_attribute
  UNION ALL SELECT 'target', 'attribute', db_id, CAST(attrelid + attnum AS BIGINT) AS number, attname AS text FROM raw_target_attribute
  UNION ALL SELECT 'current', 'type', d.db_id, CAST(oid AS BIGINT) AS number, typname AS text FROM raw_type, (SELECT DISTINCT db_id FROM current_tables) d
  UNION ALL SELECT 'target', 'type', d.db_id, CAST(oid AS BIGINT) AS number, typname AS text FROM raw_type, (SELECT DISTINCT db_id FROM target_tables) d
  UNION ALL SELECT 'current', 'attrdef', db_id, CAST(oid AS BIGINT) AS number, '' AS text FROM raw_current_attrdef
  UNION ALL SELECT 'target', 'attrdef', db_id, CAST(oid AS BIGINT) AS number, '' AS text FROM raw_target_attrdef
  UNION ALL SELECT 'current', 'constraint', db_id, CAST(oid AS BIGINT) AS number, conname AS text FROM raw_current_constraint
  UNION ALL SELECT 'target', 'constraint', db_id, CAST(oid AS BIGINT) AS number, conname AS text FROM raw_target_constraint
  UNION ALL SELECT 'current', 'index', db_id, CAST(indexrelid AS BIGINT) AS number, '' AS text FROM raw_current_index
  UNION ALL SELECT 'target', 'index', db_id, CAST(indexrelid AS BIGINT) AS number, '' AS text FROM raw_target_index
  UNION ALL SELECT 'current', 'sequence', db_id, CAST(seqrelid + seqmax AS BIGINT) AS number, '' AS text FROM raw_current_sequence
  UNION ALL SELECT 'target', 'sequence', db_id, CAST(seqrelid + seqmax AS BIGINT) AS number, '' AS text FROM raw_target_sequence
  UNION ALL SELECT 'current', 'proc', db_id, CAST(oid AS BIGINT) AS number, proname AS text FROM raw_current_proc
  UNION ALL SELECT 'target', 'proc', db_id, CAST(oid AS BIGINT) AS number, proname AS text FROM raw_target_proc
  UNION ALL SELECT 'current', 'trigger', db_id, CAST(oid AS BIGINT) AS number, tgname AS text FROM raw_current_trigger
  UNION ALL SELECT 'target', 'trigger', db_id, CAST(oid AS BIGINT) AS number, tgname AS text FROM raw_target_trigger
  UNION ALL SELECT 'current', 'definitions', db_id, CAST(object_oid AS BIGINT) AS number, definition AS text FROM raw_current_texts
  UNION ALL SELECT 'target', 'definitions', db_id, CAST(object_oid AS BIGINT) AS number, definition AS text FROM raw_target_texts
  UNION ALL SELECT 'target', 'depend', db_id, CAST(objid + refobjid AS BIGINT) AS number, deptype AS text FROM raw_target_depend
  UNION ALL SELECT 'target', 'rewrite', db_id, CAST(oid + ev_class AS BIGINT) AS number, '' AS text FROM raw_target_rewrite
  UNION ALL SELECT 'current', 'depend', db_id, CAST(objid + refobjid AS BIGINT) AS number, deptype AS text FROM raw_current_depend
  UNION ALL SELECT 'current', 'rewrite', db_id, CAST(oid + ev_class AS BIGINT) AS number, '' AS text FROM raw_current_rewrite) x
GROUP BY side, relation, db_id

-- name: s01_read_catalog
SELECT * FROM o_raw_counts

-- name: o_{x}_objects
SELECT db_id, CASE relkind WHEN 'r' THEN 'table' ELSE 'materialized_view' END AS object_type, oid AS object_oid, oid AS table_oid, schema_name, name AS object_name, CAST(NULL AS VARCHAR) AS definition
FROM (SELECT * FROM {x}_tables UNION ALL SELECT DISTINCT 1259, db_id, 'pg_catalog', 'pg_class', 'r' FROM {x}_tables
  UNION ALL SELECT DISTINCT 1260, db_id, '_migrations', 'worklist', 'r' FROM {x}_tables) t
UNION ALL SELECT db_id, CASE WHEN is_materialized THEN 'materialized_view' ELSE 'view' END, oid, oid, schema_name, name, expression FROM {x}_views
UNION ALL SELECT i.db_id, 'index', i.oid, i.table_oid, t.schema_name, i.name, i.expression FROM {x}_indexes i JOIN {x}_tables t ON t.oid = i.table_oid
UNION ALL SELECT c.db_id, 'constraint', c.oid, c.table_oid, t.schema_name, c.name, c.expression FROM {x}_constraints c JOIN {x}_tables t ON t.oid = c.table_oid
UNION ALL SELECT db_id, 'function', oid, NULL, 's1', proname, 'CREATE FUNCTION ' || proname FROM raw_{x}_proc WHERE pronamespace = 2001
UNION ALL SELECT db_id, 'column_default', table_oid * 100 + CAST(substr(name, 2) AS INT), table_oid, schema_name, table_name || '.' || name, default_expr FROM {x}_columns WHERE default_expr IS NOT NULL
UNION ALL SELECT g.db_id, 'trigger', g.oid, g.tgrelid, t.schema_name, g.tgname, 'CREATE TRIGGER ' || g.tgname FROM raw_{x}_trigger g JOIN {x}_tables t ON t.oid = g.tgrelid WHERE NOT g.tgisinternal

-- name: s02_object_definitions
SELECT 'current' AS side, * FROM o_current_objects UNION ALL SELECT 'target', * FROM o_target_objects

-- name: s03_snapshot_tables
SELECT 'current' AS side, db_id, oid, schema_name, name, relkind FROM current_tables
UNION ALL SELECT 'current', db_id, oid, schema_name, name, 'm' FROM current_views WHERE is_materialized
UNION ALL SELECT 'target', db_id, oid, schema_name, name, relkind FROM target_tables
UNION ALL SELECT 'target', db_id, oid, schema_name, name, 'm' FROM target_views WHERE is_materialized

-- name: s04_snapshot_columns
SELECT 'current' AS side, *, CAST(substr(name, 2) AS INT) AS attnum FROM current_columns UNION ALL SELECT 'target', *, CAST(substr(name, 2) AS INT) FROM target_columns

-- name: o_{x}_keys
SELECT '{x}' AS side, *, CASE WHEN type = 'f' THEN 'a' END AS on_delete, CASE WHEN type <> 'f' THEN NULL WHEN oid % 3 = 0 THEN 'c' ELSE 'a' END AS on_update,
  CASE WHEN type = 'u' THEN '2' WHEN type = 'c' AND oid % 2 = 0 THEN '1,3' ELSE '1' END AS cols, CASE WHEN type = 'f' THEN '1' ELSE '' END AS ref_cols
FROM {x}_constraints

-- name: s05_snapshot_constraints
SELECT * FROM o_current_keys UNION ALL SELECT * FROM o_target_keys

-- name: s06_snapshot_indexes
SELECT 'current' AS side, * FROM current_indexes
UNION ALL SELECT 'target', *, CASE WHEN expression LIKE 'CREATE UNIQUE INDEX %' THEN name END FROM target_indexes

-- name: s07_snapshot_sequences
SELECT 'current' AS side, * FROM current_sequences UNION ALL SELECT 'target', * FROM target_sequences

-- name: s08_snapshot_views
SELECT 'current' AS side, * FROM current_views UNION ALL SELECT 'target', * FROM target_views

-- name: s09_fan_out_model
SELECT CAST(s.s_suppkey AS INT) AS db_id, t.db_id AS model_id, t.schema_name, t.name, t.relkind
FROM supplier s JOIN target_tables t ON t.db_id = s.s_suppkey % 20
