-- name: r01_add_columns
SELECT l_orderkey, l_linenumber, l_partkey, 'n/a' AS note, CAST(7 AS BIGINT) AS batch, CAST(NULL AS DOUBLE) AS weight, 'abc' AS code, '00000000-0000-0000-0000-000000000000' AS owner FROM lineitem

-- name: o_event_codes
SELECT event_id, event_type, user_id, CASE WHEN event_id % 13 = 0 THEN 'x' || event_id WHEN event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS code FROM events

-- name: r02_rewrite_column_type
SELECT event_id, event_type, user_id, TRY_CAST(code AS INT) AS code FROM o_event_codes

-- name: r02_rewrite_failures
SELECT event_type, count(*) FILTER (code IS NOT NULL AND TRY_CAST(code AS INT) IS NULL) AS n, CAST(0 AS BIGINT) AS n_truncated FROM o_event_codes GROUP BY event_type

-- name: r02_rewrite_char
SELECT c_custkey, substr(c_name, 1, 10) AS c_name FROM customer

-- name: r02_rewrite_char_failures
SELECT c_mktsegment, CAST(0 AS BIGINT) AS n, count(*) FILTER (length(c_name) > 10) AS n_truncated FROM customer GROUP BY c_mktsegment

-- name: r03_validate_not_null
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (l_linenumber = 7) AS null_line, count(*) FILTER (l_suppkey % 10 = 3) AS null_supp FROM lineitem GROUP BY l_returnflag

-- name: r04_validate_unique
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1

-- name: r04_validate_primary_key
SELECT k, n FROM (SELECT NULLIF(user_id % 50, 7) AS k, count(*) AS n FROM events GROUP BY 1) x WHERE k IS NULL OR n > 1

-- name: r04_constraints_by_key_number
SELECT 'app' AS schema_name, * FROM (
  SELECT 'lineitem' AS table_name, 'line_key' AS name, 'u' AS type, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x) AS n
  UNION ALL SELECT 'lineitem', 'line_part', 'f', (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (FROM part p WHERE p.p_partkey % 10 <> 0 AND p.p_partkey = l.l_partkey))
  UNION ALL SELECT 'lineitem', 'line_flag', 'c', (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
  UNION ALL SELECT 'lineitem', 'line_discount', 'c', (SELECT count(*) FROM lineitem WHERE l_discount > 0.08)
  UNION ALL SELECT 'orders', 'order_key', 'p', 0
  UNION ALL SELECT 'orders', 'order_customer', 'u', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1) x)
  UNION ALL SELECT 'orders', 'order_booked', 'x', NULL) y

-- name: r05_validate_foreign_key
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l WHERE NOT EXISTS (FROM part p WHERE p.p_partkey % 10 <> 0 AND p.p_partkey = l.l_partkey)

-- name: r05_orphan_keys
SELECT l_partkey, count(*) AS n FROM lineitem l WHERE NOT EXISTS (FROM part p WHERE p.p_partkey % 10 <> 0 AND p.p_partkey = l.l_partkey) GROUP BY l_partkey

-- name: o_gone_orders
SELECT o_orderkey, 1 AS depth FROM orders WHERE o_custkey % 50 = 7 AND o_custkey IN (SELECT c_custkey FROM customer)
UNION SELECT o.o_orderkey, g.depth + 1 FROM o_gone_orders g JOIN orders o ON o.o_orderkey // 3 = g.o_orderkey AND o.o_orderkey // 3 <> 0

-- name: o_gone
SELECT o_orderkey, min(depth) AS depth FROM o_gone_orders GROUP BY o_orderkey

-- name: o_line
SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber

-- name: r05_foreign_key_effects
SELECT table_name, key, effect, columns, CAST(depth AS INT) AS depth FROM (
  SELECT 'customer' AS table_name, '{"c_custkey":' || c_custkey || '}' AS key, 'DELETE' AS effect, '' AS columns, 0 AS depth FROM customer WHERE c_custkey % 50 = 7
  UNION ALL SELECT 'part', '{"p_partkey":' || p_partkey || '}', 'DELETE', '', 0 FROM part WHERE p_partkey % 40 = 3
  UNION ALL SELECT 'part', '{"p_partkey":' || p_partkey || '}', 'UPDATE', 'p_partkey', 0 FROM part WHERE p_partkey % 40 = 5
  UNION ALL SELECT 'supplier', '{"s_suppkey":' || s_suppkey || '}', 'DELETE', '', 0 FROM supplier WHERE s_suppkey % 10 = 1
  UNION ALL SELECT 'orders', '{"o_orderkey":' || o_orderkey || '}', 'DELETE', '', depth FROM o_gone
  UNION ALL SELECT 'line', '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}', 'DELETE', '', depth + 1 FROM o_line JOIN o_gone ON o_orderkey = l_orderkey
  UNION ALL SELECT 'line', '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}', CASE WHEN l_partkey % 40 = 3 THEN 'SET_NULL' ELSE 'UPDATE' END, 'l_partkey', 1
    FROM o_line WHERE l_partkey % 40 IN (3, 5) AND l_partkey IN (SELECT p_partkey FROM part) AND l_orderkey NOT IN (SELECT o_orderkey FROM o_gone)
  UNION ALL SELECT 'line', '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}', 'RESTRICTED', 'l_suppkey', 1
    FROM o_line WHERE l_suppkey % 10 = 1 AND l_suppkey IN (SELECT s_suppkey FROM supplier) AND l_orderkey NOT IN (SELECT o_orderkey FROM o_gone)) x

-- name: r06_validate_check
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity <> 50 AND l_discount > 0.08

-- name: r07_validate_exclusion
SELECT event_id, user_id FROM (
  SELECT event_id, user_id, ts, max(ts + INTERVAL 2 HOUR) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM events) x
WHERE earlier > ts

-- name: o_booked
SELECT event_id, CAST(user_id % 20 AS INT) AS db_id, event_type, ts, CASE WHEN event_id % 97 <> 0 THEN ts + INTERVAL 30 HOUR END AS te,
  CASE WHEN event_id % 89 <> 0 THEN event_id * 7 % 100 END AS desk_from, event_id * 7 % 100 + event_id % 6 AS desk_to FROM events

-- name: r07_excluded_boxes
SELECT r.event_id, r.db_id FROM o_booked r WHERE EXISTS (FROM o_booked s WHERE s.db_id = r.db_id AND s.event_id < r.event_id AND s.event_type <> r.event_type
  AND coalesce(s.ts < r.te, TRUE) AND coalesce(r.ts < s.te, TRUE) AND coalesce(s.desk_from <= r.desk_to, TRUE) AND coalesce(r.desk_from <= s.desk_to, TRUE))

-- name: r04_fleet_violations
SELECT d.db_id, 'app' AS schema_name, x.table_name, x.name, x.type, CASE WHEN x.name <> 'booked_shape' THEN CAST(coalesce(v.n, 0) AS BIGINT) END AS n
FROM (SELECT CAST(unnest(range(20)) AS INT) AS db_id) d
JOIN (VALUES ('orders', 'order_key', 'p', 1), ('lines', 'line_key', 'u', 1), ('lines', 'line_order', 'f', 1), ('lines', 'line_discount', 'c', 1),
  ('booked', 'booked_desk', 'x', 4), ('booked', 'booked_shape', 'x', 5)) x(table_name, name, type, every) ON d.db_id % x.every = 0
LEFT JOIN (
  SELECT db_id, 'line_key' AS name, count(*) AS n FROM (SELECT l_orderkey % 20 AS db_id FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) k GROUP BY db_id
  UNION ALL SELECT l_orderkey % 20, 'line_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) GROUP BY 1
  UNION ALL SELECT l_orderkey % 20, 'line_discount', count(*) FROM lineitem WHERE l_discount > CASE WHEN l_orderkey % 2 = 1 THEN 0.08 ELSE 0.05 END GROUP BY 1
  UNION ALL SELECT r.db_id, 'booked_desk', count(*) FROM o_booked r WHERE EXISTS (FROM o_booked s WHERE s.db_id = r.db_id AND s.event_id <> r.event_id AND s.event_type = r.event_type
    AND coalesce(s.ts < r.te, TRUE) AND coalesce(r.ts < s.te, TRUE) AND coalesce(s.desk_from <= r.desk_to, TRUE) AND coalesce(r.desk_from <= s.desk_to, TRUE)) GROUP BY 1
) v ON v.db_id = d.db_id AND v.name = x.name

-- name: r08_conform_table
SELECT event_id, substr(event_type, 1, 4) AS event_type, TRY_CAST(code AS INT) AS code, 'eu' AS region, CAST(NULL AS INT) AS shard FROM o_event_codes

-- name: r08_conform_violations
SELECT * FROM (SELECT 'code' AS column_name, 'NOT_CASTABLE' AS violation, count(*) FILTER (code IS NOT NULL AND TRY_CAST(code AS INT) IS NULL) AS n FROM o_event_codes
  UNION ALL SELECT 'code', 'IS_NULL', count(*) FILTER (TRY_CAST(code AS INT) IS NULL) FROM o_event_codes
  UNION ALL SELECT 'event_type', 'TRUNCATED', count(*) FILTER (length(event_type) > 4) FROM o_event_codes
  UNION ALL SELECT 'shard', 'IS_NULL', count(*) FROM o_event_codes) x WHERE n > 0

-- name: o_fleet
SELECT event_id, event_type, code, CAST(user_id % 20 AS INT) AS db_id, CAST(user_id % 20 % 4 AS INT) AS kind,
  CASE WHEN user_id % 20 % 4 = 3 THEN 'uk' WHEN user_id % 20 % 4 = 2 AND event_id % 5 <> 0 THEN 'us' END AS region,
  CASE WHEN user_id % 20 % 4 = 3 THEN CAST(event_id % 10 AS INT) END AS shard FROM o_event_codes

-- name: r08_conform_fleet
SELECT event_id, CASE WHEN kind IN (0, 2) THEN substr(event_type, 1, 4) ELSE event_type END AS event_type, TRY_CAST(code AS INT) AS code, db_id,
  CASE WHEN kind IN (0, 1) THEN 'eu' ELSE region END AS region, CASE WHEN kind = 3 THEN shard END AS shard FROM o_fleet

-- name: r08_conform_fleet_violations
SELECT * FROM (
  SELECT db_id, 'code' AS column_name, 'NOT_CASTABLE' AS violation, count(*) FILTER (code IS NOT NULL AND TRY_CAST(code AS INT) IS NULL) AS n FROM o_fleet GROUP BY db_id
  UNION ALL SELECT db_id, 'code', 'IS_NULL', count(*) FILTER (kind IN (0, 2) AND TRY_CAST(code AS INT) IS NULL) FROM o_fleet GROUP BY db_id
  UNION ALL SELECT db_id, 'event_type', 'TRUNCATED', count(*) FILTER (kind IN (0, 2) AND length(event_type) > 4) FROM o_fleet GROUP BY db_id
  UNION ALL SELECT db_id, 'region', 'IS_NULL', count(*) FILTER (kind = 2 AND region IS NULL) FROM o_fleet GROUP BY db_id
  UNION ALL SELECT db_id, 'shard', 'IS_NULL', count(*) FILTER (kind < 3) FROM o_fleet GROUP BY db_id) x WHERE n > 0

-- name: r09_assign_sequence
SELECT event_id, CAST(100 + ((row_number() OVER (ORDER BY event_id) - 1) % 500) * 5 AS BIGINT) AS id FROM events

-- name: r09_assign_sequence_plain
SELECT o_orderkey, CAST(1000 - 3 * (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS BIGINT) AS id FROM orders

-- name: o_rebuilt
SELECT c.c_custkey, c.c_mktsegment, sum(q.qty) AS qty, CAST(count(*) AS BIGINT) AS orders
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) q ON q.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey, c.c_mktsegment

-- name: r10_rebuild_views
SELECT 'app.totals' AS view_name, c_custkey AS key, qty FROM o_rebuilt
UNION ALL SELECT 'app.v_order_qty', l_orderkey, sum(l_quantity) FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'audit.totals', c_custkey, CAST(orders AS DOUBLE) FROM o_rebuilt

-- name: r10_rebuild_status
SELECT 0 AS db_id, * FROM (VALUES ('app', 'v_order_qty', 1, 'REBUILT', true), ('app', 'v_order_customer', 2, 'REBUILT', false), ('app', 'totals', 3, 'REBUILT', true),
  ('audit', 'v_order_customer', 3, 'REBUILT', false), ('audit', 'totals', 4, 'REBUILT', true), ('app', 'loop_a', 5, 'IN_CYCLE', false), ('app', 'loop_b', 5, 'IN_CYCLE', false),
  ('app', 'behind', 5, 'IN_CYCLE', false)) v(schema_name, name, level, status, written)
UNION ALL SELECT 1, 'app', 'totals', 1, 'REBUILT', true
