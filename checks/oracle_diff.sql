-- name: o_new_tables
SELECT t.db_id, t.schema_name, t.name FROM target_tables t
WHERE t.relkind = 'r' AND NOT EXISTS (FROM current_tables c WHERE c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name)

-- name: o_dropped_tables
SELECT c.db_id, c.oid, c.schema_name, c.name, c.relkind FROM current_tables c
WHERE NOT EXISTS (FROM target_tables t WHERE c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name)

-- name: o_column_pairs
SELECT t.*, c.table_oid AS c_oid, c.type AS c_type, c.length AS c_length, c.nullable AS c_nullable, c.default_expr AS c_default
FROM target_columns t LEFT JOIN current_columns c USING (db_id, schema_name, table_name, name)

-- name: o_columns_diff
SELECT p.db_id, p.schema_name, p.table_name, p.name, p.type, p.nullable, p.length, p.default_expr, o.operation_type,
  EXISTS (FROM o_new_tables n WHERE n.db_id = p.db_id AND n.schema_name = p.schema_name AND n.name = p.table_name) AS new_table
FROM o_column_pairs p
JOIN (VALUES ('ADD_COLUMN'), ('ALTER_TYPE'), ('SET_NOT_NULL'), ('DROP_NOT_NULL'), ('DROP_DEFAULT'), ('SET_DEFAULT')) o(operation_type)
ON CASE o.operation_type
  WHEN 'ADD_COLUMN' THEN p.c_oid IS NULL
  WHEN 'ALTER_TYPE' THEN p.c_oid IS NOT NULL AND (p.type <> p.c_type OR ifnull(p.length, -1) <> ifnull(p.c_length, -1))
  WHEN 'SET_NOT_NULL' THEN p.c_nullable AND NOT p.nullable
  WHEN 'DROP_NOT_NULL' THEN NOT p.c_nullable AND p.nullable
  ELSE p.c_oid IS NOT NULL AND ifnull(p.default_expr, '') <> ifnull(p.c_default, '')
    AND (p.default_expr IS NULL) = (o.operation_type = 'DROP_DEFAULT')
END

-- name: o_altered
SELECT oid, db_id, schema_name, name FROM current_tables
WHERE (db_id, schema_name, name) IN (SELECT (db_id, schema_name, table_name) FROM o_columns_diff)

-- name: o_constraints_diff
SELECT a.db_id, a.oid, a.table_oid, a.name, a.type, a.expression, b.oid IS NULL AS is_new,
  b.oid IS NOT NULL AND a.expression IS DISTINCT FROM b.expression AS is_changed
FROM target_constraints a
JOIN target_tables t ON t.oid = a.table_oid AND t.db_id = a.db_id
JOIN current_tables c ON c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name
LEFT JOIN current_constraints b ON b.db_id = a.db_id AND b.table_oid = c.oid AND b.name = a.name

-- name: o_indexes_diff
SELECT a.db_id, a.oid, a.table_oid, a.name, a.expression, b.oid IS NULL AS is_new,
  b.oid IS NOT NULL AND a.expression IS DISTINCT FROM b.expression AS is_changed
FROM target_indexes a
JOIN target_tables t ON t.oid = a.table_oid AND t.db_id = a.db_id
JOIN current_tables c ON c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name
LEFT JOIN current_indexes b ON b.db_id = a.db_id AND b.table_oid = c.oid AND b.name = a.name

-- name: o_sequences_diff
SELECT * FROM (
  SELECT t.*, c.oid IS NULL AS is_new,
    c.oid IS NOT NULL AND ifnull(t.min_value <> c.min_value OR t.max_value <> c.max_value OR t.increment <> c.increment
      OR t.cycles <> c.cycles OR t.type <> c.type, FALSE) AS is_changed
  FROM target_sequences t LEFT JOIN current_sequences c ON c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name) x
WHERE is_new OR is_changed

-- name: o_views_diff
SELECT * FROM (
  SELECT t.*, c.oid IS NULL AS is_new, c.oid IS NOT NULL AND t.expression <> c.expression AS is_changed
  FROM target_views t LEFT JOIN current_views c ON c.db_id = t.db_id AND c.schema_name = t.schema_name AND c.name = t.name) x
WHERE is_new OR is_changed

-- name: o_dropped_columns
SELECT c.db_id, c.schema_name, c.table_name, c.name FROM current_columns c
WHERE (c.db_id, c.schema_name, c.table_name, c.name) NOT IN (SELECT (db_id, schema_name, table_name, name) FROM target_columns)
  AND (c.db_id, c.table_oid) NOT IN (SELECT (db_id, oid) FROM o_dropped_tables)

-- name: o_dropped_constraints
SELECT c.db_id, c.oid, c.name, c.type, c.table_oid, c.expression FROM current_constraints c
WHERE (c.db_id, c.name) NOT IN (SELECT (db_id, name) FROM target_constraints)
  AND (c.db_id, c.table_oid) NOT IN (SELECT (db_id, oid) FROM o_dropped_tables)

-- name: o_dropped_indexes
SELECT c.db_id, c.oid, c.name, c.table_oid, c.expression FROM current_indexes c
WHERE (c.db_id, c.name) NOT IN (SELECT (db_id, name) FROM target_indexes)
  AND (c.db_id, c.table_oid) NOT IN (SELECT (db_id, oid) FROM o_dropped_tables)

-- name: d01_new_tables
SELECT * FROM o_new_tables

-- name: d02_add_column
SELECT * FROM o_columns_diff WHERE operation_type = 'ADD_COLUMN'

-- name: d03_alter_type
SELECT * FROM o_columns_diff WHERE operation_type = 'ALTER_TYPE'

-- name: d04_set_not_null
SELECT * FROM o_columns_diff WHERE operation_type = 'SET_NOT_NULL'

-- name: d05_drop_not_null
SELECT * FROM o_columns_diff WHERE operation_type = 'DROP_NOT_NULL'

-- name: d06_drop_default
SELECT * FROM o_columns_diff WHERE operation_type = 'DROP_DEFAULT'

-- name: d07_set_default
SELECT * FROM o_columns_diff WHERE operation_type = 'SET_DEFAULT'

-- name: d08_columns_diff
SELECT * FROM o_columns_diff

-- name: d09_constraints_diff
SELECT * FROM o_constraints_diff

-- name: d10_indexes_diff
SELECT * FROM o_indexes_diff

-- name: d11_sequences_diff
SELECT * FROM o_sequences_diff

-- name: d12_views_diff
SELECT * FROM o_views_diff

-- name: d13_dropped_tables
SELECT * FROM o_dropped_tables

-- name: d14_dropped_columns
SELECT * FROM o_dropped_columns

-- name: d15_dropped_constraints
SELECT * FROM o_dropped_constraints

-- name: d16_dropped_indexes
SELECT * FROM o_dropped_indexes

-- name: d17_row_diff
SELECT ifnull(t.k, c.k) AS o_orderkey, CASE WHEN c.k IS NULL THEN 'ADDED' WHEN t.k IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS op,
  CASE WHEN c.k IS NULL OR t.k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN t.s IS DISTINCT FROM c.s THEN 'o_orderstatus' END,
    CASE WHEN t.p IS DISTINCT FROM c.p THEN 'o_orderpriority' END) END AS changed_columns
FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 35 = 0 THEN NULL ELSE o_orderpriority END AS p
  FROM orders WHERE o_orderkey % 13 <> 0) t
FULL JOIN (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 11 <> 0) c ON t.k = c.k
WHERE t.k IS NULL OR c.k IS NULL OR (t.s, t.p) IS DISTINCT FROM (c.s, c.p)

-- name: d17_row_diff_repeated
SELECT k AS l_orderkey, ln AS l_linenumber, CASE WHEN t_n > 1 OR c_n > 1 THEN 'DUPLICATE_KEY' WHEN c_n = 0 THEN 'ADDED' WHEN t_n = 0 THEN 'REMOVED' ELSE 'CHANGED' END AS op,
  CASE WHEN t_n = 1 AND c_n = 1 THEN concat_ws(',', CASE WHEN t_q <> c_q THEN 'l_quantity' END, CASE WHEN t_d <> c_d THEN 'l_discount' END) ELSE '' END AS changed_columns
FROM (SELECT k, ln, count(*) FILTER (side = 't') AS t_n, count(*) FILTER (side = 'c') AS c_n,
    max(q) FILTER (side = 't') AS t_q, max(q) FILTER (side = 'c') AS c_q, max(d) FILTER (side = 't') AS t_d, max(d) FILTER (side = 'c') AS c_d
  FROM (SELECT 't' AS side, l_orderkey AS k, l_linenumber AS ln, l_quantity AS q, CASE WHEN l_suppkey % 4 = 0 THEN l_discount + 1 ELSE l_discount END AS d FROM lineitem WHERE l_partkey % 13 <> 0
    UNION ALL SELECT 'c', l_orderkey, l_linenumber, CASE WHEN l_suppkey % 6 = 0 THEN l_quantity + 1 ELSE l_quantity END, l_discount FROM lineitem WHERE l_partkey % 11 <> 0) u
  GROUP BY k, ln) g
WHERE t_n <> 1 OR c_n <> 1 OR t_q <> c_q OR t_d <> c_d

-- name: d17_row_diff_sequences
SELECT db_id, schema_name, name, op, changed_columns FROM (
  SELECT db_id, schema_name, name, CASE WHEN c.oid IS NULL THEN 'ADDED' WHEN t.oid IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS op,
    CASE WHEN c.oid IS NULL OR t.oid IS NULL THEN '' ELSE concat_ws(',',
      CASE WHEN t.type IS DISTINCT FROM c.type THEN 'type' END, CASE WHEN t.start_value IS DISTINCT FROM c.start_value THEN 'start_value' END,
      CASE WHEN t.max_value IS DISTINCT FROM c.max_value THEN 'max_value' END, CASE WHEN t.increment IS DISTINCT FROM c.increment THEN 'increment' END) END AS changed_columns
  FROM target_sequences t FULL JOIN current_sequences c USING (db_id, schema_name, name)) x
WHERE op <> 'CHANGED' OR changed_columns <> ''

-- name: d17_row_diff_by_blocks
SELECT o_orderkey, CASE WHEN o_orderkey % 1301 = 0 THEN 'REMOVED' WHEN o_orderkey % 1103 = 0 THEN 'ADDED' ELSE 'CHANGED' END AS op,
  CASE WHEN o_orderkey % 1301 <> 0 AND o_orderkey % 1103 <> 0 THEN 'o_orderpriority' ELSE '' END AS changed_columns
FROM orders WHERE (o_orderkey % 1301 = 0) <> (o_orderkey % 1103 = 0) OR (o_orderkey % 907 = 0 AND o_orderkey % 1301 <> 0 AND o_orderkey % 1103 <> 0 AND o_orderpriority IS NOT NULL)
