-- Fixture views: a synthetic fleet of 20 databases derived from the given tables.
-- Each block is the body of one view; the text runs on Spark and on DuckDB.
-- A name holding {x} stands for two views, current and target.

-- name: fx_tables
SELECT o_orderkey AS ok, CAST(o_custkey % 20 AS INT) AS db_id, 's' || substr(o_orderpriority,1,1) AS schema_name, 't' || CAST(o_orderkey AS STRING) AS name, CASE WHEN o_orderkey % 23 = 0 THEN 'm' ELSE 'r' END AS relkind, MIN(o_orderkey) OVER (PARTITION BY o_custkey) AS ref_ok, o_custkey AS ck
  FROM orders

-- name: current_tables
SELECT 100000000 + ok AS oid, db_id, schema_name, name, relkind
  FROM fx_tables
  WHERE ok % 11 <> 0

-- name: target_tables
SELECT 200000000 + ok AS oid, db_id, schema_name, name, relkind
  FROM fx_tables
  WHERE ok % 13 <> 0

-- name: fx_columns
SELECT l_orderkey AS ok, l_linenumber AS ln, MIN(l_partkey) AS pk, MIN(l_suppkey) AS sk, MIN(l_returnflag) AS rf, MIN(l_linestatus) AS ls, MIN(l_quantity) AS q
  FROM lineitem GROUP BY l_orderkey, l_linenumber

-- name: current_columns
SELECT t.oid AS table_oid, t.db_id, t.schema_name, t.name AS table_name, 'c' || CAST(ln AS STRING) AS name, ls = 'O' AS nullable, CASE rf WHEN 'A' THEN 'int4' WHEN 'N' THEN 'varchar' ELSE 'timestamp' END AS type, CASE WHEN pk % 29 = 0 THEN NULL WHEN rf = 'N' THEN CAST(q AS INT) + 4 ELSE -1 END AS length, CASE WHEN pk % 5 = 0 THEN NULL WHEN pk % 5 = 1 THEN '' ELSE CAST(pk % 5 AS STRING) END AS default_expr
  FROM fx_columns c JOIN current_tables t ON t.oid = 100000000 + c.ok AND t.relkind = 'r'
  WHERE pk % 19 <> 0

-- name: target_columns
SELECT t.oid AS table_oid, t.db_id, t.schema_name, t.name AS table_name, 'c' || CAST(ln AS STRING) AS name, CASE WHEN sk % 9 = 0 THEN ls <> 'O' ELSE ls = 'O' END AS nullable, CASE WHEN pk % 7 = 0 THEN 'int8' WHEN rf = 'A' THEN 'int4' WHEN rf = 'N' THEN 'varchar' ELSE 'timestamp' END AS type, CASE WHEN pk % 7 = 0 THEN -1 WHEN rf = 'N' AND pk % 8 = 0 THEN CAST(q AS INT) + 14 WHEN rf = 'N' THEN CAST(q AS INT) + 4 ELSE -1 END AS length, CASE WHEN sk % 10 = 3 THEN NULL WHEN sk % 10 = 4 THEN '0' WHEN pk % 5 = 0 THEN NULL WHEN pk % 5 = 1 THEN '' ELSE CAST(pk % 5 AS STRING) END AS default_expr
  FROM fx_columns c JOIN target_tables t ON t.oid = 200000000 + c.ok AND t.relkind = 'r'
  WHERE pk % 17 <> 0

-- name: fx_constraints
SELECT ok, ref_ok, k.kind, k.pre || '_t' || CAST(ok AS STRING) AS name
  FROM fx_tables CROSS JOIN (SELECT 'p' AS kind, 'pk' AS pre
  UNION ALL SELECT 'f', 'fk'
  UNION ALL SELECT 'u', 'uq'
  UNION ALL SELECT 'c', 'ck') k
  WHERE relkind = 'r'

-- name: current_constraints
SELECT 300000000 + ok * 4 + CASE kind WHEN 'p' THEN 0 WHEN 'f' THEN 1 WHEN 'u' THEN 2 ELSE 3 END AS oid, t.db_id, c.name, kind AS type, t.oid AS table_oid, r.oid AS ref_table_oid, CASE kind WHEN 'p' THEN 'PRIMARY KEY (c1)' WHEN 'f' THEN 'FOREIGN KEY (c1) REFERENCES t' || CAST(ref_ok AS STRING) || '(c1)' WHEN 'u' THEN 'UNIQUE (c2)' ELSE 'CHECK (c1 > 0)' END AS expression
  FROM fx_constraints c JOIN current_tables t ON t.oid = 100000000 + c.ok LEFT JOIN current_tables r ON c.kind = 'f' AND r.oid = 100000000 + c.ref_ok
  WHERE kind = 'p' OR (kind = 'f' AND ok % 3 = 0) OR (kind = 'u' AND ok % 4 = 0) OR (kind = 'c' AND ok % 5 = 0)

-- name: target_constraints
SELECT 400000000 + ok * 4 + CASE kind WHEN 'p' THEN 0 WHEN 'f' THEN 1 WHEN 'u' THEN 2 ELSE 3 END AS oid, t.db_id, c.name, kind AS type, t.oid AS table_oid, r.oid AS ref_table_oid, CASE kind WHEN 'p' THEN 'PRIMARY KEY (c1)' WHEN 'f' THEN 'FOREIGN KEY (c1) REFERENCES t' || CAST(ref_ok AS STRING) || '(c1)' WHEN 'u' THEN 'UNIQUE (c2)' WHEN 'c' THEN CASE WHEN ok % 20 = 0 THEN 'CHECK (c1 >= 0)' ELSE 'CHECK (c1 > 0)' END END AS expression
  FROM fx_constraints c JOIN target_tables t ON t.oid = 200000000 + c.ok LEFT JOIN target_tables r ON c.kind = 'f' AND r.oid = 200000000 + c.ref_ok
  WHERE kind = 'p' OR (kind = 'f' AND (ok % 6 = 0 OR ok % 7 = 0)) OR (kind = 'u' AND (ok % 8 = 0 OR ok % 9 = 0)) OR (kind = 'c' AND (ok % 10 = 0 OR ok % 6 = 0))

-- name: current_indexes
SELECT 500000000 + ok * 4 + n.n AS oid, t.db_id, t.oid AS table_oid, 'ix_t' || CAST(ok AS STRING) || '_' || CAST(n.n AS STRING) AS name, 'CREATE INDEX ON ' || t.name || ' (c' || CAST(n.n AS STRING) || ')' AS expression, CAST(NULL AS STRING) AS backs_constraint
  FROM fx_tables f JOIN current_tables t ON t.oid = 100000000 + f.ok CROSS JOIN (SELECT 1 AS n
  UNION ALL SELECT 2) n
  WHERE (ok + n.n) % 6 <> 0
  UNION ALL SELECT oid + 300000000, db_id, table_oid, name, 'CREATE UNIQUE INDEX ' || name, name
  FROM current_constraints
  WHERE type IN ('p', 'u')

-- name: target_indexes
SELECT 900000000 + ok * 4 + n.n AS oid, t.db_id, t.oid AS table_oid, 'ix_t' || CAST(ok AS STRING) || '_' || CAST(n.n AS STRING) AS name, 'CREATE INDEX ON ' || t.name || ' (c' || CAST(n.n AS STRING) || CASE WHEN ok % 10 = 0 THEN ' DESC)' ELSE ')' END AS expression
  FROM fx_tables f JOIN target_tables t ON t.oid = 200000000 + f.ok CROSS JOIN (SELECT 1 AS n
  UNION ALL SELECT 2) n
  WHERE (ok + n.n) % 7 <> 0
  UNION ALL SELECT oid + 300000000, db_id, table_oid, name, 'CREATE UNIQUE INDEX ' || name
  FROM target_constraints
  WHERE type IN ('p', 'u')

-- name: current_sequences
SELECT 1100000000 + p_partkey AS oid, CAST(p_partkey % 20 AS INT) AS db_id, 's1' AS schema_name, 'q' || CAST(p_partkey AS STRING) AS name, CASE WHEN p_size % 2 = 0 THEN 'int4' ELSE 'int8' END AS type, CAST(1 AS BIGINT) AS start_value, CAST(1 AS BIGINT) AS min_value, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(1000 * p_size AS BIGINT) END AS max_value, CAST(1 AS BIGINT) AS increment, p_size % 5 = 0 AS cycles
  FROM part
  WHERE p_partkey % 9 <> 0

-- name: target_sequences
SELECT 1200000000 + p_partkey AS oid, CAST(p_partkey % 20 AS INT) AS db_id, 's1' AS schema_name, 'q' || CAST(p_partkey AS STRING) AS name, CASE WHEN p_size % 2 = 0 AND p_partkey % 10 <> 0 THEN 'int4' ELSE 'int8' END AS type, CAST(1 + p_partkey % 2 AS BIGINT) AS start_value, CAST(1 AS BIGINT) AS min_value, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(1000 * p_size AS BIGINT) END AS max_value, CAST(CASE WHEN p_partkey % 25 = 0 THEN 5 ELSE 1 END AS BIGINT) AS increment, p_size % 5 = 0 AS cycles
  FROM part
  WHERE p_partkey % 8 <> 0

-- name: fx_views
SELECT c_custkey AS ck, CAST(c_custkey % 20 AS INT) AS db_id, CAST(FLOOR(c_custkey / 20.0) AS BIGINT) AS loc, 'v' || CAST(c_custkey AS STRING) AS name, c_custkey % 15 = 0 AS is_materialized
  FROM customer

-- name: current_views
SELECT 1300000000 + ck AS oid, db_id, 's1' AS schema_name, name, 'SELECT ' || CAST(ck % 7 AS STRING) AS expression, is_materialized
  FROM fx_views
  WHERE loc % 9 <> 8

-- name: target_views
SELECT 1400000000 + ck AS oid, db_id, 's1' AS schema_name, name, 'SELECT ' || CAST(CASE WHEN ck % 6 = 0 THEN 9 ELSE ck % 7 END AS STRING) AS expression, is_materialized
  FROM fx_views
  WHERE loc % 7 <> 6

-- name: current_depends
SELECT t.db_id, t.oid AS ref_oid, v.oid AS view_oid
  FROM fx_tables f JOIN current_tables t ON t.oid = 100000000 + f.ok JOIN current_views v ON v.oid = 1300000000 + f.ck
  WHERE f.ok % 4 = 0
  UNION ALL SELECT c.db_id, p.oid, c.oid
  FROM fx_views x JOIN current_views c ON c.oid = 1300000000 + x.ck JOIN current_views p ON p.oid = 1300000000 + CAST(FLOOR(x.loc / 2.0) AS BIGINT) * 20 + x.db_id
  WHERE x.loc > 0
  UNION ALL SELECT c.db_id, p.oid, c.oid
  FROM fx_views x JOIN current_views c ON c.oid = 1300000000 + x.ck JOIN current_views p ON p.oid = c.oid + 20
  WHERE x.loc = 0 AND x.db_id = 3

-- name: target_depends
SELECT c.db_id, p.oid AS ref_oid, c.oid AS view_oid
  FROM fx_views x JOIN target_views c ON c.oid = 1400000000 + x.ck JOIN target_views p ON p.oid = 1400000000 + CAST(FLOOR(x.loc / 2.0) AS BIGINT) * 20 + x.db_id
  WHERE x.loc > 0
  UNION ALL SELECT t.db_id, t.oid, v.oid
  FROM fx_tables f JOIN target_tables t ON t.oid = 200000000 + f.ok JOIN target_views v ON v.oid = 1400000000 + f.ck
  WHERE f.ok % 4 = 0

-- name: raw_{x}_namespace
SELECT d.db_id, n.oid, n.nspname
  FROM (SELECT DISTINCT db_id
  FROM {x}_tables) d CROSS JOIN (SELECT 2001 AS oid, 's1' AS nspname
  UNION ALL SELECT 2002, 's2'
  UNION ALL SELECT 2003, 's3'
  UNION ALL SELECT 2004, 's4'
  UNION ALL SELECT 2005, 's5'
  UNION ALL SELECT 11, 'pg_catalog'
  UNION ALL SELECT 2999, '_migrations') n

-- name: raw_type
SELECT 23 AS oid, 'int4' AS typname
  UNION ALL SELECT 20, 'int8'
  UNION ALL SELECT 1043, 'varchar'
  UNION ALL SELECT 1114, 'timestamp'

-- name: raw_{x}_class
SELECT db_id, oid, 2000 + CAST(substr(schema_name,2,1) AS INT) AS relnamespace, name AS relname, relkind
  FROM {x}_tables
  UNION ALL SELECT i.db_id, i.oid, 2000 + CAST(substr(t.schema_name,2,1) AS INT), i.name, 'i'
  FROM {x}_indexes i JOIN {x}_tables t ON t.db_id = i.db_id AND t.oid = i.table_oid
  UNION ALL SELECT db_id, oid, 2001, name, 'S'
  FROM {x}_sequences
  UNION ALL SELECT db_id, oid, 2001, name, CASE WHEN is_materialized THEN 'm' ELSE 'v' END
  FROM {x}_views
  UNION ALL SELECT DISTINCT db_id, CAST(1259 AS BIGINT), 11, 'pg_class', 'r'
  FROM {x}_tables
  UNION ALL SELECT DISTINCT db_id, CAST(1260 AS BIGINT), 2999, 'worklist', 'r'
  FROM {x}_tables

-- name: raw_{x}_attribute
SELECT c.db_id, c.table_oid AS attrelid, c.name AS attname, y.oid AS atttypid, c.length AS atttypmod, CAST(substr(c.name,2) AS INT) AS attnum, NOT c.nullable AS attnotnull, FALSE AS attisdropped
  FROM {x}_columns c JOIN raw_type y ON y.typname = c.type
  UNION ALL SELECT db_id, oid, 'ctid', 20, -1, -1, TRUE, FALSE
  FROM {x}_tables
  UNION ALL SELECT db_id, oid, 'gone', 23, -1, 90, FALSE, TRUE
  FROM {x}_tables

-- name: raw_{x}_attrdef
SELECT db_id, table_oid * 100 + CAST(substr(name,2) AS INT) AS oid, table_oid AS adrelid, CAST(substr(name,2) AS INT) AS adnum, default_expr
  FROM {x}_columns
  WHERE default_expr IS NOT NULL

-- name: raw_{x}_constraint
SELECT c.db_id, c.oid, c.name AS conname, c.type AS contype, 2000 + CAST(substr(t.schema_name,2,1) AS INT) AS connamespace, c.table_oid AS conrelid, COALESCE(c.ref_table_oid, 0) AS confrelid, CASE WHEN c.type IN ('p','u') THEN c.oid + 300000000 ELSE 0 END AS conindid, CASE WHEN c.type = 'f' THEN 'a' ELSE ' ' END AS confdeltype, CASE WHEN c.type <> 'f' THEN ' ' WHEN c.oid % 3 = 0 THEN 'c' ELSE 'a' END AS confupdtype, split(CASE WHEN c.type = 'u' THEN '2' WHEN c.type = 'c' AND c.oid % 2 = 0 THEN '1,3' ELSE '1' END, ',') AS conkey, CASE WHEN c.type = 'f' THEN split('1', ',') END AS confkey
  FROM {x}_constraints c JOIN {x}_tables t ON t.db_id = c.db_id AND t.oid = c.table_oid

-- name: raw_{x}_index
SELECT db_id, oid AS indexrelid, table_oid AS indrelid
  FROM {x}_indexes

-- name: raw_{x}_sequence
SELECT s.db_id, s.oid AS seqrelid, y.oid AS seqtypid, start_value AS seqstart, min_value AS seqmin, max_value AS seqmax, increment AS seqincrement, cycles AS seqcycle
  FROM {x}_sequences s JOIN raw_type y ON y.typname = s.type

-- name: raw_{x}_definitions
SELECT db_id, 'column_default' AS object_type, oid AS object_oid, default_expr AS definition
  FROM raw_{x}_attrdef
  UNION ALL SELECT db_id, 'constraint', oid, expression
  FROM {x}_constraints
  UNION ALL SELECT db_id, 'index', oid, expression
  FROM {x}_indexes
  UNION ALL SELECT db_id, CASE WHEN is_materialized THEN 'materialized_view' ELSE 'view' END, oid, expression
  FROM {x}_views

-- name: raw_{x}_proc
SELECT CAST(s_suppkey % 20 AS INT) AS db_id, 1500000000 + s_suppkey AS oid, CASE WHEN s_suppkey % 10 = 0 THEN 11 ELSE 2001 END AS pronamespace, 'f_{x}_' || CAST(s_suppkey AS STRING) AS proname
  FROM supplier

-- name: raw_{x}_trigger
SELECT db_id, 1700000000 + oid AS oid, oid AS tgrelid, 'tr_' || name AS tgname, oid % 4 = 0 AS tgisinternal
  FROM {x}_tables
  WHERE oid % 10 < 4

-- name: raw_{x}_texts
SELECT db_id, object_type, object_oid, definition
  FROM raw_{x}_definitions
  UNION ALL SELECT db_id, 'function', oid, 'CREATE FUNCTION ' || proname
  FROM raw_{x}_proc
  UNION ALL SELECT db_id, 'trigger', oid, 'CREATE TRIGGER ' || tgname
  FROM raw_{x}_trigger

-- name: raw_{x}_rewrite
SELECT DISTINCT db_id, view_oid + 500000000 AS oid, view_oid AS ev_class
  FROM {x}_depends

-- name: raw_{x}_depend
SELECT db_id, view_oid + 500000000 AS objid, ref_oid AS refobjid, 'n' AS deptype
  FROM {x}_depends
  UNION ALL SELECT db_id, oid, ev_class, 'i'
  FROM raw_{x}_rewrite
  UNION ALL SELECT db_id, oid, ev_class, 'n'
  FROM raw_{x}_rewrite
  WHERE ev_class % 3 = 0

