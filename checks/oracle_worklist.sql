-- name: o_w01
SELECT 1 AS rule, db_id, 1 AS phase, CASE WHEN is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END AS object_type, 'DROP' AS ddl_operation,
  schema_name, CAST(NULL AS VARCHAR) AS table_name, name AS object_name,
  'DROP ' || CASE WHEN is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END || ' IF EXISTS ' || schema_name || '.' || name || ' CASCADE;' AS ddl,
  TRUE AS is_temporary_drop, 'PENDING' AS status,
  CASE WHEN is_materialized THEN 0 ELSE 1 END AS ord_level, schema_name AS ord_1, name AS ord_2, CAST(NULL AS VARCHAR) AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_affected

-- name: o_cur_con
SELECT c.*, t.schema_name, t.name AS table_name FROM current_constraints c JOIN current_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid

-- name: o_tgt_con
SELECT c.*, t.schema_name, t.name AS table_name FROM target_constraints c JOIN target_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid

-- name: o_cur_idx
SELECT c.*, t.schema_name, t.name AS table_name FROM current_indexes c JOIN current_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid

-- name: o_tgt_idx
SELECT c.*, t.schema_name, t.name AS table_name FROM target_indexes c JOIN target_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid

-- name: o_backed
SELECT DISTINCT c.db_id, c.oid, c.name, c.table_oid, c.schema_name, c.table_name, i.name AS index_name
FROM o_cur_con c JOIN current_indexes i ON i.db_id = c.db_id AND i.table_oid = c.table_oid AND i.backs_constraint = c.name

-- name: o_con_drops
SELECT 2 AS rule, 1 AS phase, oid FROM o_dropped_constraints WHERE type = 'f'
UNION ALL SELECT 3, 1, oid FROM current_constraints WHERE type = 'f' AND (db_id, ref_table_oid) IN (SELECT (db_id, oid) FROM o_altered)
UNION ALL SELECT 4, 1, oid FROM current_constraints WHERE type = 'p' AND (db_id, table_oid) IN (SELECT (db_id, oid) FROM o_altered)
UNION ALL SELECT DISTINCT 5, 1, oid FROM o_backed WHERE (db_id, table_oid) IN (SELECT (db_id, oid) FROM o_altered)
UNION ALL SELECT DISTINCT 6, 1, oid FROM o_backed WHERE (db_id, schema_name, table_name, index_name) NOT IN (SELECT (db_id, schema_name, table_name, name) FROM o_tgt_idx)
UNION ALL SELECT 20, 2, oid FROM o_dropped_constraints WHERE type IN ('c', 'u')

-- name: o_idx_drops
SELECT 7 AS rule, oid FROM current_indexes WHERE backs_constraint IS NULL AND (db_id, table_oid) IN (SELECT (db_id, oid) FROM o_altered)
UNION ALL SELECT 8, oid FROM o_dropped_indexes

-- name: o_w02
SELECT d.rule, c.db_id, d.phase, 'CONSTRAINT' AS object_type, 'DROP' AS ddl_operation, c.schema_name, c.table_name, c.name AS object_name,
  'ALTER TABLE ' || c.schema_name || '.' || c.table_name || ' DROP CONSTRAINT IF EXISTS ' || c.name || ';' AS ddl,
  d.rule BETWEEN 3 AND 6 AS is_temporary_drop, 'PENDING' AS status, 0 AS ord_level,
  CASE WHEN d.rule <= 4 THEN c.name ELSE c.schema_name END AS ord_1, CASE WHEN d.rule <= 4 THEN c.schema_name ELSE c.table_name END AS ord_2,
  CASE WHEN d.rule <= 4 THEN c.table_name ELSE c.name END AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_con_drops d JOIN o_cur_con c ON c.oid = d.oid

-- name: o_w07
SELECT d.rule, i.db_id, 1 AS phase, 'INDEX' AS object_type, 'DROP' AS ddl_operation, i.schema_name, CAST(NULL AS VARCHAR) AS table_name, i.name AS object_name,
  'DROP INDEX IF EXISTS ' || i.schema_name || '.' || i.name || ';' AS ddl, d.rule = 7 AS is_temporary_drop, 'PENDING' AS status, 0 AS ord_level,
  i.name AS ord_1, i.schema_name AS ord_2, i.table_name AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_idx_drops d JOIN o_cur_idx i ON i.oid = d.oid

-- name: o_queue
SELECT * FROM o_w01
UNION ALL SELECT * FROM (SELECT * FROM (SELECT * FROM o_w02 WHERE rule < 20 UNION ALL SELECT * FROM o_w07) x
  QUALIFY row_number() OVER (PARTITION BY db_id, object_type, schema_name, table_name, object_name ORDER BY rule) = 1) y

-- name: o_seq
SELECT *, ' MINVALUE ' || min_value || ' MAXVALUE ' || ifnull(max_value, 9223372036854775807) || ' INCREMENT ' || increment || CASE WHEN cycles THEN ' CYCLE;' ELSE ' NO CYCLE;' END AS bounds
FROM o_sequences_diff

-- name: o_rendered
SELECT db_id, schema_name, table_name, name, type || CASE WHEN lower(type) LIKE '%char%' AND ifnull(length, -1) <> -1 THEN '(' || length || ')' ELSE '' END AS bare,
  CASE WHEN nullable THEN '' ELSE ' NOT NULL' END || ifnull(' DEFAULT ' || default_expr, '') AS suffix
FROM target_columns

-- name: o_objects_2
SELECT 9 AS rule, db_id, 'SCHEMA' AS object_type, 'CREATE' AS ddl_operation, schema_name, schema_name AS object_name, 'CREATE SCHEMA IF NOT EXISTS ' || schema_name || ';' AS ddl, schema_name AS ord_1, CAST(NULL AS VARCHAR) AS ord_2
FROM (SELECT DISTINCT db_id, schema_name FROM o_new_tables) n
UNION ALL SELECT 10, db_id, 'SEQUENCE', 'CREATE', schema_name, name, 'CREATE SEQUENCE IF NOT EXISTS ' || schema_name || '.' || name || ' AS ' || type || ' START ' || start_value || bounds, schema_name, name FROM o_seq WHERE is_new
UNION ALL SELECT 11, db_id, 'SEQUENCE', 'ALTER', schema_name, name, 'ALTER SEQUENCE ' || schema_name || '.' || name || ' AS ' || type || bounds, schema_name, name FROM o_seq WHERE is_changed
UNION ALL SELECT 12, db_id, 'TABLE', 'CREATE', schema_name, name, 'CREATE TABLE IF NOT EXISTS ' || schema_name || '.' || name || ' ();', schema_name, name FROM o_new_tables
UNION ALL SELECT 17, db_id, 'TABLE', 'DROP', schema_name, name, 'DROP TABLE IF EXISTS ' || schema_name || '.' || name || ';', schema_name, name FROM o_dropped_tables WHERE relkind = 'r'

-- name: o_w09
SELECT rule, db_id, 2 AS phase, object_type, ddl_operation, schema_name, CAST(NULL AS VARCHAR) AS table_name, object_name, ddl, FALSE AS is_temporary_drop, 'PENDING' AS status,
  0 AS ord_level, ord_1, ord_2, CAST(NULL AS VARCHAR) AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_objects_2

-- name: o_existing_diff
SELECT d.*, r.bare, r.suffix FROM o_columns_diff d JOIN o_rendered r USING (db_id, schema_name, table_name, name) WHERE NOT d.new_table

-- name: o_column_ddl
SELECT 13 AS rule, 'CREATE' AS ddl_operation, db_id, schema_name, table_name, CAST(NULL AS VARCHAR) AS name,
  string_agg('ADD COLUMN IF NOT EXISTS ' || name || ' ' || bare || suffix, ', ' ORDER BY name) AS body
FROM o_rendered r WHERE (db_id, schema_name, table_name) IN (SELECT (db_id, schema_name, name) FROM o_new_tables) GROUP BY db_id, schema_name, table_name
UNION ALL SELECT 14, 'ALTER', db_id, schema_name, table_name, NULL,
  string_agg(CASE operation_type WHEN 'ADD_COLUMN' THEN 'ADD COLUMN ' || name || ' ' || bare || suffix WHEN 'SET_DEFAULT' THEN 'ALTER COLUMN ' || name || ' SET DEFAULT ' || default_expr
    ELSE 'ALTER COLUMN ' || name || ' ' || replace(operation_type, '_', ' ') END, ', ' ORDER BY name, operation_type)
FROM o_existing_diff WHERE operation_type NOT IN ('ALTER_TYPE', 'SET_NOT_NULL') GROUP BY db_id, schema_name, table_name
UNION ALL SELECT 15, 'ALTER', db_id, schema_name, table_name, name, 'ALTER COLUMN ' || name || ' SET NOT NULL' FROM o_existing_diff WHERE operation_type = 'SET_NOT_NULL'
UNION ALL SELECT 16, 'ALTER', db_id, schema_name, table_name, name,
  'ADD COLUMN new_' || name || ' ' || bare || suffix || ';' || chr(10) || 'UPDATE ' || schema_name || '.' || table_name || ' SET new_' || name || ' = ' || name || '::' || bare || ';' || chr(10)
  || 'ALTER TABLE ' || schema_name || '.' || table_name || ' DROP COLUMN ' || name || ';' || chr(10) || 'ALTER TABLE ' || schema_name || '.' || table_name || ' RENAME COLUMN new_' || name || ' TO ' || name
FROM o_existing_diff WHERE operation_type = 'ALTER_TYPE'

-- name: o_w13
SELECT rule, db_id, 2 AS phase, 'COLUMN' AS object_type, ddl_operation, schema_name, table_name, name AS object_name, 'ALTER TABLE ' || schema_name || '.' || table_name || ' ' || body || ';' AS ddl,
  FALSE AS is_temporary_drop, 'PENDING' AS status, 0 AS ord_level, schema_name AS ord_1, table_name AS ord_2, name AS ord_3, CAST(rule AS BIGINT) AS ord_oid
FROM o_column_ddl

-- name: o_known_con
SELECT t.*, c.type AS c_type, q.rule FROM o_tgt_con t JOIN o_cur_con c USING (db_id, schema_name, table_name, name)
JOIN o_queue q ON q.db_id = t.db_id AND q.schema_name = t.schema_name AND q.table_name = t.table_name AND q.object_name = t.name AND q.object_type = 'CONSTRAINT' AND q.is_temporary_drop

-- name: o_pk_state
SELECT p.db_id, p.table_oid, bool_or(q.rule IS NOT NULL) AS any_gone, bool_or(k.oid IS NOT NULL) AS any_back
FROM o_tgt_con p LEFT JOIN o_queue q ON q.object_type = 'CONSTRAINT' AND q.db_id = p.db_id AND q.schema_name = p.schema_name AND q.table_name = p.table_name AND q.object_name = p.name
LEFT JOIN o_known_con k ON k.oid = p.oid AND k.c_type <> 'f'
WHERE p.type = 'p' GROUP BY p.db_id, p.table_oid

-- name: o_con_adds
SELECT 18 AS rule, 2 AS phase, oid FROM o_constraints_diff WHERE is_new AND type = 'c'
UNION ALL SELECT 19, 2, oid FROM o_constraints_diff WHERE is_new AND type = 'u'
UNION ALL SELECT 22, 3, oid FROM o_known_con WHERE c_type IN ('p', 'u', 'x')
UNION ALL SELECT 23, 3, k.oid FROM o_known_con k LEFT JOIN o_pk_state s ON s.db_id = k.db_id AND s.table_oid = k.ref_table_oid
WHERE k.c_type = 'f' AND (ifnull(s.any_back, FALSE) OR NOT ifnull(s.any_gone, FALSE))

-- name: o_w18
SELECT a.rule, c.db_id, a.phase, 'CONSTRAINT' AS object_type, 'CREATE' AS ddl_operation, c.schema_name, c.table_name, c.name AS object_name,
  'ALTER TABLE ' || c.schema_name || '.' || c.table_name || ' ADD CONSTRAINT ' || c.name || ' ' || c.expression || ';' AS ddl, FALSE AS is_temporary_drop, 'PENDING' AS status,
  0 AS ord_level, c.schema_name AS ord_1, c.table_name AS ord_2, c.name AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_con_adds a JOIN o_tgt_con c ON c.oid = a.oid

-- name: o_w21
SELECT 21 AS rule, t.db_id, 3 AS phase, 'INDEX' AS object_type, 'CREATE' AS ddl_operation, t.schema_name, CAST(NULL AS VARCHAR) AS table_name, t.name AS object_name, t.expression || ';' AS ddl,
  FALSE AS is_temporary_drop, 'PENDING' AS status, 0 AS ord_level, t.schema_name AS ord_1, t.name AS ord_2, CAST(NULL AS VARCHAR) AS ord_3, CAST(0 AS BIGINT) AS ord_oid
FROM o_tgt_idx t JOIN o_cur_idx c USING (db_id, schema_name, table_name, name)
JOIN o_queue q ON q.db_id = t.db_id AND q.schema_name = t.schema_name AND q.object_name = t.name AND q.object_type = 'INDEX' AND q.is_temporary_drop

-- name: o_back
SELECT db_id, oid FROM o_affected
UNION SELECT b.db_id, e.view_oid FROM o_back b JOIN o_edges e ON e.db_id = b.db_id AND e.ref_oid = b.oid

-- name: o_views_back
SELECT b.db_id, b.oid AS old_oid, t.oid FROM o_back b JOIN current_views c ON c.db_id = b.db_id AND c.oid = b.oid
JOIN target_views t ON t.db_id = c.db_id AND t.schema_name = c.schema_name AND t.name = c.name

-- name: o_created
SELECT db_id, oid FROM o_views_back UNION SELECT db_id, oid FROM o_views_diff WHERE is_new

-- name: o_back_edges
SELECT DISTINCT e.db_id, e.ref_oid, e.view_oid FROM (SELECT db_id, ref_oid, view_oid FROM target_depends
  UNION ALL SELECT e.db_id, r.oid, v.oid FROM o_edges e JOIN o_views_back r ON r.db_id = e.db_id AND r.old_oid = e.ref_oid
    JOIN o_views_back v ON v.db_id = e.db_id AND v.old_oid = e.view_oid WHERE (v.db_id, v.oid) NOT IN (SELECT (db_id, oid) FROM o_views_diff)) e
JOIN o_created a ON a.oid = e.ref_oid AND a.db_id = e.db_id JOIN o_created b ON b.oid = e.view_oid AND b.db_id = e.db_id WHERE e.ref_oid <> e.view_oid

-- name: o_back_reach
SELECT db_id, ref_oid AS a, view_oid AS b FROM o_back_edges
UNION SELECT r.db_id, r.a, e.view_oid FROM o_back_reach r JOIN o_back_edges e ON e.db_id = r.db_id AND e.ref_oid = r.b

-- name: o_back_cyclic
SELECT DISTINCT r.db_id, r.b AS oid FROM o_back_reach r JOIN o_back_reach s ON s.db_id = r.db_id AND s.a = r.a AND s.b = r.a

-- name: o_back_longest
SELECT v.db_id, v.oid, 1 AS level FROM o_created v WHERE NOT EXISTS (FROM o_back_edges e WHERE e.db_id = v.db_id AND e.view_oid = v.oid)
UNION SELECT l.db_id, e.view_oid, l.level + 1 FROM o_back_longest l JOIN o_back_edges e ON e.db_id = l.db_id AND e.ref_oid = l.oid
WHERE (e.db_id, e.view_oid) NOT IN (SELECT (db_id, oid) FROM o_back_cyclic)

-- name: o_back_order
SELECT db_id, oid, max(level) AS level FROM o_back_longest GROUP BY db_id, oid
UNION ALL SELECT db_id, oid, 2147483647 FROM o_back_cyclic

-- name: o_w24
SELECT 24 AS rule, t.db_id, 3 AS phase, CASE WHEN t.is_materialized THEN 'MATERIALIZED VIEW' ELSE 'VIEW' END AS object_type, 'CREATE' AS ddl_operation, t.schema_name,
  CAST(NULL AS VARCHAR) AS table_name, t.name AS object_name,
  'CREATE ' || CASE WHEN t.is_materialized THEN 'MATERIALIZED VIEW ' ELSE 'OR REPLACE VIEW ' END || t.schema_name || '.' || t.name || ' AS ' || t.expression || ';' AS ddl,
  FALSE AS is_temporary_drop, 'PENDING' AS status, o.level AS ord_level, CAST(NULL AS VARCHAR) AS ord_1, CAST(NULL AS VARCHAR) AS ord_2, CAST(NULL AS VARCHAR) AS ord_3, t.oid AS ord_oid
FROM target_views t JOIN o_back_order o ON o.db_id = t.db_id AND o.oid = t.oid

-- name: o_rules
SELECT * FROM o_queue UNION ALL SELECT * FROM o_w09 UNION ALL SELECT * FROM o_w13 UNION ALL SELECT * FROM o_w02 WHERE rule = 20
UNION ALL SELECT * FROM o_w18 UNION ALL SELECT * FROM o_w21 UNION ALL SELECT * FROM o_w24

-- name: worklist
SELECT db_id, phase, row_number() OVER (PARTITION BY db_id, phase ORDER BY CASE WHEN rule BETWEEN 14 AND 16 THEN 14 ELSE rule END, ord_level NULLS LAST, ord_1 NULLS LAST, ord_2 NULLS LAST, ord_3 NULLS LAST, ord_oid) AS seq,
  object_type, ddl_operation, schema_name, table_name, object_name, ddl, is_temporary_drop, status
FROM o_rules

-- name: w25_render_type
SELECT db_id, schema_name, table_name, name, bare || suffix AS rendered FROM o_rendered

-- name: w26_number_worklist
SELECT * FROM worklist

-- name: w27_classify_strategy
SELECT db_id, schema_name, table_name, CASE WHEN bool_or(operation_type = 'ALTER_TYPE') THEN 'SHADOW'
  WHEN count(*) FILTER (operation_type <> 'SET_NOT_NULL') > 1 THEN 'AGGREGATE' ELSE 'DIRECT' END AS strategy
FROM o_columns_diff WHERE NOT new_table GROUP BY db_id, schema_name, table_name

-- name: fx_runs
SELECT db_id, phase, seq, CASE WHEN seq % 50 = 0 AND db_id % 3 = 0 THEN 'ERROR' ELSE 'DONE' END AS status, CASE WHEN seq % 50 = 0 AND db_id % 3 = 0 THEN 'failed at ' || CAST(seq AS STRING) END AS error_msg, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS recorded_at
FROM worklist WHERE seq % 7 <> 0 OR db_id % 4 = 1
UNION ALL SELECT db_id, phase, seq, 'DONE', NULL, CAST('2024-01-02 00:00:00' AS TIMESTAMP) FROM worklist WHERE seq % 100 = 0 AND (seq % 7 <> 0 OR db_id % 4 = 1)

-- name: o_recorded
SELECT w.db_id, w.phase, w.seq, w.object_type, w.ddl_operation, w.schema_name, w.table_name, w.object_name, w.ddl, w.is_temporary_drop,
  ifnull(r.status, w.status) AS status, r.error_msg, CASE WHEN r.status = 'DONE' THEN r.recorded_at END AS executed_at
FROM worklist w LEFT JOIN (SELECT * FROM fx_runs QUALIFY row_number() OVER (PARTITION BY db_id, phase, seq ORDER BY recorded_at DESC) = 1) r USING (db_id, phase, seq)

-- name: l01_pending
SELECT * EXCLUDE (error_msg, executed_at) FROM o_recorded WHERE status = 'PENDING'

-- name: l02_record_status
SELECT * REPLACE (strftime(executed_at, '%Y-%m-%d %H:%M:%S') AS executed_at) FROM o_recorded

-- name: l03_publish_gate
SELECT db_id, count(*) FILTER (status IS DISTINCT FROM 'DONE') = 0 AS publish FROM o_recorded GROUP BY db_id

-- name: l04_run_report
SELECT phase, object_type, ddl_operation, status, count(*) AS n FROM o_recorded GROUP BY ALL

-- name: l04_run_errors
SELECT db_id, phase, seq, object_type, ddl_operation, schema_name, table_name, object_name, error_msg FROM o_recorded WHERE status = 'ERROR'

-- name: o_wanted
SELECT d.db_id, CASE WHEN d.is_new THEN 'NEW ' ELSE 'CHANGED ' END || k AS kind, t.schema_name, t.name AS table_name, d.name
FROM (SELECT 'CONSTRAINT' AS k, db_id, table_oid, name, is_new, is_changed FROM o_constraints_diff
  UNION ALL SELECT 'INDEX', db_id, table_oid, name, is_new, is_changed FROM o_indexes_diff) d
JOIN target_tables t ON t.db_id = d.db_id AND t.oid = d.table_oid WHERE d.is_new OR d.is_changed
UNION ALL SELECT o.db_id, 'NEW ' || k, t.schema_name, t.name, o.name
FROM (SELECT 'CONSTRAINT' AS k, db_id, table_oid, name FROM target_constraints UNION ALL SELECT 'INDEX', db_id, table_oid, name FROM target_indexes) o
JOIN target_tables t ON t.db_id = o.db_id AND t.oid = o.table_oid JOIN o_new_tables n ON n.db_id = t.db_id AND n.schema_name = t.schema_name AND n.name = t.name

-- name: l04_unplanned_differences
SELECT * FROM o_wanted w WHERE kind LIKE '%CONSTRAINT' AND NOT EXISTS (FROM worklist p WHERE p.ddl_operation = 'CREATE' AND p.object_type = 'CONSTRAINT'
  AND p.db_id = w.db_id AND p.schema_name = w.schema_name AND p.table_name = w.table_name AND p.object_name = w.name)
UNION ALL SELECT * FROM o_wanted w WHERE kind LIKE '%INDEX' AND NOT EXISTS (FROM worklist p WHERE p.ddl_operation = 'CREATE' AND p.object_type = 'INDEX'
  AND p.db_id = w.db_id AND p.schema_name = w.schema_name AND p.object_name = w.name)
UNION ALL SELECT db_id, CASE WHEN is_new THEN 'NEW SEQUENCE' ELSE 'CHANGED SEQUENCE' END, schema_name, NULL, name FROM o_sequences_diff
WHERE (db_id, schema_name, name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type = 'SEQUENCE')
UNION ALL SELECT db_id, CASE WHEN is_new THEN 'NEW VIEW' ELSE 'CHANGED VIEW' END, schema_name, NULL, name FROM o_views_diff
WHERE (db_id, schema_name, name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type LIKE '%VIEW' AND ddl_operation = 'CREATE')
UNION ALL SELECT db_id, 'NEW TABLE', schema_name, NULL, name FROM o_new_tables
WHERE (db_id, schema_name, name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type = 'TABLE' AND ddl_operation = 'CREATE')
UNION ALL SELECT db_id, operation_type, schema_name, table_name, name FROM o_columns_diff
WHERE (db_id, schema_name, table_name) NOT IN (SELECT (db_id, schema_name, table_name) FROM worklist WHERE object_type = 'COLUMN')
UNION ALL SELECT db_id, CASE relkind WHEN 'm' THEN 'DROPPED MATERIALIZED VIEW' ELSE 'DROPPED TABLE' END, schema_name, NULL, name FROM o_dropped_tables
WHERE (db_id, schema_name, name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type IN ('TABLE', 'MATERIALIZED VIEW') AND ddl_operation = 'DROP')
UNION ALL SELECT db_id, 'DROPPED COLUMN', schema_name, table_name, name FROM o_dropped_columns
UNION ALL SELECT c.db_id, 'DROPPED CONSTRAINT', t.schema_name, t.name, c.name FROM o_dropped_constraints c JOIN current_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid
WHERE (c.db_id, t.schema_name, t.name, c.name) NOT IN (SELECT (db_id, schema_name, table_name, object_name) FROM worklist WHERE object_type = 'CONSTRAINT' AND ddl_operation = 'DROP')
UNION ALL SELECT c.db_id, 'DROPPED INDEX', t.schema_name, t.name, c.name FROM o_dropped_indexes c JOIN current_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid
WHERE (c.db_id, t.schema_name, c.name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type = 'INDEX' AND ddl_operation = 'DROP')
UNION ALL SELECT db_id, 'DROPPED SEQUENCE', schema_name, NULL, name FROM current_sequences
WHERE (db_id, schema_name, name) NOT IN (SELECT (db_id, schema_name, name) FROM target_sequences)
UNION ALL SELECT db_id, 'TENANT VIEW', schema_name, NULL, object_name FROM worklist WHERE object_type LIKE '%VIEW' AND ddl_operation = 'DROP'
AND (db_id, schema_name, object_name) NOT IN (SELECT (db_id, schema_name, object_name) FROM worklist WHERE object_type LIKE '%VIEW' AND ddl_operation = 'CREATE')

-- name: l03_publish_databases
SELECT e.event_id, CASE WHEN g.publish THEN upper(e.event_type) ELSE e.event_type END AS event_type, g.db_id, CASE WHEN g.publish THEN 2 ELSE 1 END AS version
FROM events e JOIN l03_publish_gate g ON g.db_id = e.user_id % 20 WHERE NOT (g.publish AND e.event_id % 3 = 0)
