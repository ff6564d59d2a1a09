"""The registered queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

LINES = """lines AS (
  SELECT l_orderkey o, l_linenumber k, l_partkey p, count(*) c FROM lineitem GROUP BY ALL)"""
SUCCESSION = LINES + """, e AS MATERIALIZED (
  SELECT a.p AS src, b.p AS dst, CAST(sum(a.c * b.c) AS DOUBLE) AS weight
  FROM lines a JOIN lines b ON a.o = b.o AND b.k = a.k + 1 AND a.p <> b.p GROUP BY 1, 2)"""
PLACES = """e AS MATERIALIZED (
  SELECT CAST(o_orderkey AS BIGINT) * 5 AS src, CAST(o_custkey AS BIGINT) * 5 + 1 AS dst FROM orders
  UNION ALL SELECT CAST(c_custkey AS BIGINT) * 5 + 1, CAST(c_nationkey AS BIGINT) * 5 + 3 FROM customer
  UNION ALL SELECT CAST(s_suppkey AS BIGINT) * 5 + 2, CAST(s_nationkey AS BIGINT) * 5 + 3 FROM supplier
  UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 5 + 3, CAST(n_regionkey AS BIGINT) * 5 + 4 FROM nation)"""
STATES = """states AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY user_id, event_type) - 1 AS pos, user_id, event_type
  FROM (SELECT DISTINCT user_id, event_type FROM events))"""
TRANSITIONS = STATES + """, steps AS (
  SELECT user_id, event_type,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events),
e AS MATERIALIZED (
  SELECT a.pos AS src, b.pos AS dst, CAST(count(*) AS DOUBLE) AS weight
  FROM steps s JOIN states a ON a.user_id = s.user_id AND a.event_type = s.event_type
  JOIN states b ON b.user_id = s.user_id AND b.event_type = s.next_type GROUP BY 1, 2)"""
PURCHASES = """e AS MATERIALIZED (
  SELECT DISTINCT o_custkey AS src, -l_partkey - 1 AS dst
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

# Distinct nodes of e with dense positions, and the cells of its matrix.
NODE_LIST = """nl AS MATERIALIZED (
  SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos
  FROM (SELECT src AS id FROM e UNION SELECT dst FROM e)),
cells AS MATERIALIZED (
  SELECT r.pos AS "row", c.pos AS col, weight AS value
  FROM e JOIN nl r ON r.id = src JOIN nl c ON c.id = dst)"""

# Labels by the smallest id, spread over e in both directions.
COMPONENTS = """u AS MATERIALIZED (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
cc(n, l) USING KEY (n) AS (
  SELECT a, a FROM u GROUP BY a
  UNION SELECT u.b, min(cc.l) FROM cc JOIN u ON u.a = cc.n JOIN recurring.cc p ON p.n = u.b
  GROUP BY u.b HAVING min(cc.l) < min(p.l))"""

# Smallest id that reaches a node (fore) and that it reaches (back). Nodes on which the two
# agree are settled; mutual reach over edges inside a class of equal pairs settles the rest.
STRONG = """d AS MATERIALIZED (SELECT DISTINCT src, dst FROM e),
v AS MATERIALIZED (SELECT src AS n FROM d UNION SELECT dst FROM d),
fo(n, l) USING KEY (n) AS (
  SELECT n, n FROM v
  UNION SELECT d.dst, min(fo.l) FROM fo JOIN d ON d.src = fo.n JOIN recurring.fo p ON p.n = d.dst
  GROUP BY d.dst HAVING min(fo.l) < min(p.l)),
ba(n, l) USING KEY (n) AS (
  SELECT n, n FROM v
  UNION SELECT d.src, min(ba.l) FROM ba JOIN d ON d.dst = ba.n JOIN recurring.ba p ON p.n = d.src
  GROUP BY d.src HAVING min(ba.l) < min(p.l)),
mark AS MATERIALIZED (SELECT fo.n, fo.l AS f, ba.l AS b FROM fo JOIN ba ON fo.n = ba.n),
inner_e AS MATERIALIZED (
  SELECT d.src, d.dst FROM d JOIN mark x ON x.n = d.src JOIN mark y ON y.n = d.dst
  WHERE x.f <> x.b AND x.f = y.f AND x.b = y.b),
r(a, b) AS (
  SELECT n, n FROM mark WHERE f <> b
  UNION SELECT r.a, i.dst FROM r JOIN inner_e i ON i.src = r.b)"""
STRONG_SELECT = """ SELECT n AS id, f AS component FROM mark WHERE f = b
UNION ALL SELECT x.a, min(x.b) FROM r x JOIN r y ON x.a = y.b AND x.b = y.a GROUP BY x.a"""


def _pagerank(graph: str, rounds: int) -> str:
    return f"""WITH RECURSIVE {graph}, d AS MATERIALIZED (SELECT DISTINCT src, dst FROM e),
v AS MATERIALIZED (SELECT src AS n FROM d UNION SELECT dst FROM d),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS c FROM v),
od AS MATERIALIZED (SELECT src, CAST(count(*) AS DOUBLE) AS k FROM d GROUP BY 1),
w AS MATERIALIZED (
  SELECT d.src, d.dst, 1 / od.k AS p FROM d JOIN od ON d.src = od.src
  UNION ALL SELECT v.n, NULL, 1.0 FROM v WHERE v.n NOT IN (SELECT src FROM d)),
pr(i, n, r) AS (
  SELECT 0, v.n, 1 / nn.c FROM v, nn
  UNION ALL
  SELECT t.i + 1, v.n, 0.15 / nn.c + 0.85 * (coalesce(s.x, 0) + t.dm / nn.c)
  FROM (SELECT pr.i, sum(CASE WHEN w.dst IS NULL THEN pr.r ELSE 0 END) AS dm
        FROM pr JOIN w ON w.src = pr.n WHERE pr.i < {rounds} GROUP BY pr.i) t CROSS JOIN nn CROSS JOIN v
  LEFT JOIN (SELECT w.dst AS n, sum(pr.r * w.p) AS x FROM pr JOIN w ON w.src = pr.n
             WHERE w.dst IS NOT NULL GROUP BY 1) s ON s.n = v.n)
SELECT n AS id, round(r, 9) AS rank FROM pr WHERE i = {rounds}"""


def _bfs(graph: str, source: int, directed: bool, limit: int | None = None) -> str:
    both = "SELECT src, dst FROM e" + ("" if directed else " UNION SELECT dst, src FROM e")
    bound = "" if limit is None else f" AND b.d < {limit}"
    return f"""WITH RECURSIVE {graph}, s AS MATERIALIZED ({both}),
b(n, d) USING KEY (n) AS (
  SELECT CAST({source} AS BIGINT), 0
  UNION SELECT s.dst, min(b.d + 1) FROM b JOIN s ON s.src = b.n
  WHERE s.dst NOT IN (SELECT n FROM recurring.b){bound} GROUP BY s.dst)
SELECT row_number() OVER (ORDER BY d, n) - 1 AS pos, n AS value FROM b"""


def _triangles(graph: str) -> str:
    return f"""WITH {graph}, t AS MATERIALIZED (
  SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e WHERE src <> dst)
SELECT count(*) AS triangles FROM t x JOIN t y ON x.b = y.a JOIN t z ON z.a = x.a AND z.b = y.b"""


def _modularity(graph: str, labels: str) -> str:
    return f"""WITH {graph}, lab AS ({labels}),
named AS (SELECT a.c AS a, b.c AS b, weight FROM e JOIN lab a ON a.id = src JOIN lab b ON b.id = dst),
ends AS (
  SELECT a AS c, weight AS k, CASE WHEN a = b THEN weight ELSE 0 END AS inside FROM named
  UNION ALL SELECT b, weight, 0 FROM named),
sums AS (SELECT c, sum(k) AS k, sum(inside) AS inside FROM ends GROUP BY c)
SELECT round(2 * sum(inside) / sum(k) - sum(k * k) / (sum(k) * sum(k)), 9) AS modularity FROM sums"""


def _count_diff(left: str, right: str, keys: str, columns: str) -> str:
    return f"""WITH both_sides AS (
  SELECT {keys}, sum(l) AS left_n, sum(r) AS right_n FROM (
    SELECT *, 1 AS l, 0 AS r FROM ({left}) UNION ALL SELECT *, 0, 1 FROM ({right}))
  GROUP BY {keys})
SELECT {keys}, CASE WHEN right_n = 0 THEN 'only_left' WHEN left_n = 0 THEN 'only_right' ELSE 'count' END
  AS issue{columns} FROM both_sides WHERE left_n <> right_n"""


_NEAR = "abs(l.value - r.value) <= 1e-9 * greatest(abs(l.value), abs(r.value))"


def _value_diff(left: str, right: str, keys: list[str], differ: str) -> str:
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys)
    names = ", ".join(f"coalesce(l.{k}, r.{k}) AS {k}" for k in keys)
    first = keys[0]
    return f"""SELECT {names},
  CASE WHEN r.{first} IS NULL THEN 'only_left' WHEN l.{first} IS NULL THEN 'only_right' ELSE 'value' END AS issue,
  l.value AS left_value, r.value AS right_value
FROM ({left}) l FULL JOIN ({right}) r ON {on}
WHERE l.{first} IS NULL OR r.{first} IS NULL OR {differ}"""


_PAIR_RANK = """SELECT l_suppkey AS src, l_partkey AS dst, row_number() OVER (
  PARTITION BY l_suppkey, l_partkey ORDER BY l_quantity) - 1 AS rank, l_quantity AS value FROM lineitem"""
_NODES = "SELECT src AS id FROM e UNION SELECT dst FROM e"
_SUM_CELLS = 'merged AS MATERIALIZED (SELECT "row", col, sum(value) AS value FROM cells GROUP BY 1, 2)'

ORACLES = {
    "edges_from_lines":
        "SELECT l_orderkey AS order_id, l_partkey AS part_id, l_quantity AS quantity FROM lineitem",
    "edge_set_from_orders": "SELECT o_custkey AS customer, o_orderkey AS order_id FROM orders",
    "node_map_typed_sizes": "SELECT p_partkey AS part, CAST(p_size AS BIGINT) AS size FROM part",
    "node_set_ordered_parts": "SELECT DISTINCT l_partkey AS part FROM lineitem",
    "vector_from_embedding": """SELECT vec_id, CAST(i - 1 AS BIGINT) AS pos,
  CAST(round(embedding[i], 6) AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "dense_positions_of_prices": """SELECT row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS pos,
  p_partkey AS id FROM part""",
    "coo_of_succession": f'WITH {SUCCESSION}, {NODE_LIST} SELECT "row", col, value FROM cells',
    "coo_of_places_undirected": f"""WITH {PLACES}, nl AS (
  SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM ({_NODES})),
s AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e WHERE src <> dst)
SELECT r.pos AS "row", c.pos AS col, true AS is_edge
FROM s JOIN nl r ON r.id = src JOIN nl c ON c.id = dst""",
    "coo_roundtrip": f"WITH {TRANSITIONS} SELECT src, dst, CAST(weight AS BIGINT) AS weight FROM e",
    "csr_offsets": f"""WITH {SUCCESSION}, {NODE_LIST}, {_SUM_CELLS},
per_row AS (SELECT "row" AS pos, count(*) AS n FROM merged GROUP BY 1),
rows_ AS (SELECT nl.pos, coalesce(n, 0) AS n FROM nl LEFT JOIN per_row ON per_row.pos = nl.pos
  UNION ALL SELECT max(pos) + 1, 0 FROM nl)
SELECT pos, CAST(coalesce(sum(n) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS BIGINT) AS "offset" FROM rows_""",
    "csr_indices": f"""WITH {SUCCESSION}, {NODE_LIST}, {_SUM_CELLS}
SELECT row_number() OVER (ORDER BY "row", col) - 1 AS pos, col AS dst, value FROM merged""",
    "csr_roundtrip": f"WITH {SUCCESSION} SELECT src, dst, weight FROM e",
    "property_graph_nodes": "SELECT p_partkey AS id, p_retailprice AS weight FROM part",
    "bipartite_sides": """SELECT c_custkey AS id, 0 AS side FROM customer
UNION ALL SELECT -p_partkey - 1, 1 FROM part""",
    "graph_build_nodes": f"WITH {SUCCESSION} {_NODES}",
    "graph_violations": """WITH e AS (SELECT o_custkey AS src, o_orderkey AS dst FROM orders)
SELECT 'endpoint_not_in_nodes' AS rule, id FROM (SELECT src AS id FROM e UNION SELECT dst FROM e)
WHERE id NOT IN (SELECT l_orderkey FROM lineitem)""",
    "bipartite_violations": """WITH e AS (
  SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
n0 AS (SELECT c_custkey AS id FROM customer), n1 AS (SELECT p_partkey AS id FROM part),
ends AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
inside AS (SELECT src, dst FROM e WHERE
  (src IN (SELECT id FROM n0) AND dst IN (SELECT id FROM n0))
  OR (src IN (SELECT id FROM n1) AND dst IN (SELECT id FROM n1)))
SELECT 'in_both_sides' AS rule, id FROM n0 WHERE id IN (SELECT id FROM n1)
UNION ALL SELECT 'endpoint_in_no_side', id FROM ends
  WHERE id NOT IN (SELECT id FROM n0) AND id NOT IN (SELECT id FROM n1)
UNION ALL SELECT 'edge_inside_side', id FROM (SELECT src AS id FROM inside UNION SELECT dst FROM inside)""",
    "vector_violations": """SELECT 'duplicate_id' AS rule, CAST(l_linenumber AS BIGINT) AS id FROM lineitem
GROUP BY l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'duplicate_id', event_id FROM events GROUP BY event_id HAVING count(*) > 1""",
    "contains_batch": """SELECT DISTINCT l_orderkey AS id FROM lineitem
WHERE l_orderkey IN (SELECT p_partkey FROM part)""",
    "node_map_get": """SELECT p_partkey AS id, p_retailprice AS weight FROM part
WHERE p_partkey IN (SELECT l_orderkey FROM lineitem)""",
    "vector_length": "SELECT coalesce(max(event_id) + 1, 0) AS length FROM events",
    "num_nodes": f"""WITH s AS (WITH {SUCCESSION} {_NODES}), p AS (WITH {PLACES} {_NODES})
SELECT 'edges' AS "of", count(*) AS num_nodes FROM s
UNION ALL SELECT 'map', count(*) FROM part
UNION ALL SELECT 'set', count(DISTINCT l_partkey) FROM lineitem
UNION ALL SELECT 'graph', count(*) FROM p""",
    "edge_properties": f"""WITH {SUCCESSION}
SELECT true AS is_directed, 'float' AS dtype, (SELECT count(*) FROM ({_NODES})) AS num_nodes,
  count(*) AS num_edges, bool_or(weight < 0) AS has_negative_weights FROM e""",
    "node_map_properties": "SELECT 'float' AS dtype, count(*) AS num_nodes FROM part",
    "graph_properties": """WITH e AS (SELECT c_custkey AS src, CAST(c_nationkey AS BIGINT) AS dst, c_acctbal FROM customer)
SELECT true AS is_directed, 'map' AS edge_type, 'float' AS edge_dtype, 'set' AS node_type,
  CAST(NULL AS VARCHAR) AS node_dtype,
  (SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e)) AS num_nodes,
  count(*) AS num_edges, bool_or(c_acctbal < 0) AS edge_has_negative_weights FROM e""",
    "bipartite_properties": f"""WITH {PURCHASES}
SELECT false AS is_directed, 'set' AS edge_type, CAST(NULL AS VARCHAR) AS edge_dtype,
  'set' AS node0_type, CAST(NULL AS VARCHAR) AS node0_dtype,
  'set' AS node1_type, CAST(NULL AS VARCHAR) AS node1_dtype,
  (SELECT count(*) FROM customer) AS num_nodes0, (SELECT count(*) FROM part) AS num_nodes1,
  count(*) AS num_edges, CAST(NULL AS BOOLEAN) AS edge_has_negative_weights FROM e""",
    "vector_diff": _value_diff(
        "SELECT event_id AS pos, value FROM events",
        "SELECT event_id AS pos, floor(value) AS value FROM events WHERE event_type <> 'click'",
        ["pos"], "l.value IS DISTINCT FROM r.value"),
    "node_map_diff": _value_diff(
        "SELECT p_partkey AS id, p_retailprice AS value FROM part",
        """SELECT p_partkey AS id,
  p_retailprice * CASE WHEN p_size > 25 THEN CAST(1.5 AS DOUBLE) ELSE CAST('1.000000000001' AS DOUBLE) END
  AS value FROM part""", ["id"], f"NOT ({_NEAR})"),
    "node_set_diff": _count_diff(
        "SELECT DISTINCT o_orderkey AS id FROM orders", "SELECT DISTINCT l_orderkey AS id FROM lineitem",
        "id", ""),
    "edge_set_diff": _count_diff(
        "SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem",
        "SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem", "src, dst",
        ", CAST(left_n AS BIGINT) AS left_n, CAST(right_n AS BIGINT) AS right_n"),
    "edge_map_diff": _value_diff(
        _PAIR_RANK, _PAIR_RANK + " WHERE l_returnflag <> 'R'", ["src", "dst", "rank"],
        "l.value IS DISTINCT FROM r.value"),
    "graph_diff": f"""WITH {SUCCESSION}, f AS (SELECT * FROM e WHERE weight = 1),
lost AS ({_NODES} EXCEPT (SELECT src FROM f UNION SELECT dst FROM f))
SELECT 'node' AS part, id AS src, CAST(NULL AS BIGINT) AS dst, 'only_left' AS issue FROM lost
UNION ALL SELECT 'edge', src, dst, 'only_left' FROM e WHERE weight <> 1""",
    "bipartite_diff": f"""WITH {PURCHASES}, kept AS MATERIALIZED (
  SELECT DISTINCT o_custkey AS src, -l_partkey - 1 AS dst
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R')
SELECT 'node0' AS part, c_custkey AS src, CAST(NULL AS BIGINT) AS dst, 'only_left' AS issue
FROM customer WHERE c_custkey NOT IN (SELECT src FROM kept)
UNION ALL SELECT 'node1', -p_partkey - 1, NULL, 'only_left' FROM part
WHERE -p_partkey - 1 NOT IN (SELECT dst FROM kept)
UNION ALL SELECT 'edge', least(src, dst), greatest(src, dst), 'only_left'
FROM (SELECT * FROM e EXCEPT SELECT * FROM kept)""",
    "nodeset_from_vector": "SELECT DISTINCT l_partkey AS id FROM lineitem",
    "nodemap_sort": """SELECT row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS pos,
  p_partkey AS value FROM part""",
    "nodemap_sort_topk": """SELECT row_number() OVER (ORDER BY p_retailprice DESC, p_partkey DESC) - 1 AS pos,
  p_partkey AS value FROM part ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 10""",
    "nodemap_select": """SELECT p_partkey AS id, p_retailprice AS weight FROM part
WHERE p_partkey IN (SELECT o_custkey FROM orders)""",
    "nodemap_filter": "SELECT p_partkey AS id FROM part WHERE p_retailprice >= 950",
    "nodemap_apply": "SELECT p_partkey AS id, round(p_retailprice * 1.19, 4) AS weight FROM part",
    "nodemap_apply_scalar":
        "SELECT p_partkey AS id, CAST(trunc(p_retailprice) AS BIGINT) % 7 AS weight FROM part",
    "nodemap_reduce": "SELECT max(p_retailprice) AS value FROM part",
    "nodemap_to_nodeset": "SELECT p_partkey AS id FROM part",
    "edgemap_from_edgeset":
        f"WITH {SUCCESSION} SELECT src, dst, CAST(2.5 AS DOUBLE) AS weight FROM e",
    "edgemap_to_edgeset": f"WITH {SUCCESSION} SELECT src, dst FROM e",
    "assign_uniform_weight": f"WITH {TRANSITIONS} SELECT src, dst, 1 AS weight FROM e",
    "filter_edges": f"WITH {TRANSITIONS} SELECT src, dst, weight FROM e WHERE weight >= 3",
    "filter_edges_scalar": f"WITH {TRANSITIONS} SELECT src, dst, weight FROM e WHERE weight < 3",
    "aggregate_edges": f"""WITH {SUCCESSION}
SELECT id, sum(weight) AS weight FROM (
  SELECT src AS id, weight FROM e UNION ALL SELECT dst, weight FROM e) GROUP BY id""",
    "connected_components_succession":
        f"WITH RECURSIVE {SUCCESSION}, {COMPONENTS} SELECT n AS id, l AS component FROM cc",
    "connected_components_places":
        f"WITH RECURSIVE {PLACES}, {COMPONENTS} SELECT n AS id, l AS component FROM cc",
    "connected_components_transitions": f"""WITH RECURSIVE {TRANSITIONS}, {COMPONENTS}
SELECT pos AS id, coalesce(l, pos) AS component FROM states LEFT JOIN cc ON n = pos""",
    "strong_components_succession": f"WITH RECURSIVE {SUCCESSION}, {STRONG} {STRONG_SELECT}",
    "strong_components_repeated":
        f"WITH RECURSIVE {SUCCESSION.replace(', e AS', ', steps AS')}, "
        f"e AS MATERIALIZED (SELECT * FROM steps WHERE weight >= 2), {STRONG} {STRONG_SELECT}",
    "strong_components_transitions": f"WITH RECURSIVE {TRANSITIONS}, {STRONG} {STRONG_SELECT}",
    "strong_components_places": f"WITH RECURSIVE {PLACES}, {STRONG} {STRONG_SELECT}",
    "pagerank_succession": _pagerank(SUCCESSION, 10),
    "pagerank_places": _pagerank(PLACES, 4),
    "bfs_succession": _bfs(SUCCESSION, 0, directed=True),
    "bfs_places_undirected": _bfs(PLACES, 4, directed=False),
    "bfs_places_depth": _bfs(PLACES, 4, directed=False, limit=2),
    "triangle_count_succession": _triangles(SUCCESSION),
    "triangle_count_transitions": _triangles(TRANSITIONS),
    "projection_customers": f"""WITH {PURCHASES}
SELECT DISTINCT a.src, b.src AS dst FROM e a JOIN e b ON a.dst = b.dst AND a.src < b.src""",
    "projection_parts": f"""WITH {PURCHASES}
SELECT DISTINCT a.dst AS src, b.dst FROM e a JOIN e b ON a.src = b.src AND a.dst < b.dst""",
    "modularity_of_users": _modularity(TRANSITIONS, "SELECT pos AS id, user_id AS c FROM states"),
    "modularity_of_part_sizes": _modularity(SUCCESSION, "SELECT p_partkey AS id, p_size AS c FROM part"),
    # Draws and Louvain labels depend on hashes and on the order of moves: what must hold is compared.
    "choose_random": """SELECT least(100, count(DISTINCT l_partkey)) AS drawn, least(100, count(DISTINCT l_partkey)) AS distinct_ids,
  least(100, count(DISTINCT l_partkey)) AS members FROM lineitem""",
    "louvain_transitions_quality": f"""WITH {STATES} SELECT count(*) AS labelled, count(*) AS distinct_ids,
  CAST(0 AS BIGINT) AS misnamed, CAST(0 AS BIGINT) AS isolated_joined, true AS score_is_own, true AS score_is_high FROM states""",
    "louvain_places_quality": f"""WITH {PLACES} SELECT count(*) AS labelled, count(*) AS distinct_ids,
  CAST(0 AS BIGINT) AS misnamed, CAST(0 AS BIGINT) AS isolated_joined, true AS score_is_own, true AS score_is_high FROM ({_NODES})""",
    "property_graph_saved": f"WITH {SUCCESSION} SELECT src, dst, weight, p_retailprice AS price FROM e JOIN part ON p_partkey = src",
    "bipartite_saved": """SELECT c_custkey AS id, c_acctbal AS weight, true AS weighted FROM customer
UNION ALL SELECT -p_partkey - 1, p_retailprice, true FROM part""",
    "coo_roundtrip_undirected": f"WITH {PLACES} SELECT least(src, dst) AS src, greatest(src, dst) AS dst FROM e",
    "coo_node_values": "SELECT p_partkey AS id, p_retailprice AS weight FROM part",
    "graph_build_weighted_nodes": "SELECT p_partkey AS id, p_retailprice AS weight FROM part",
    "edge_violations": """SELECT 'null_endpoint' AS rule, c_custkey AS id FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "node_map_violations": """SELECT DISTINCT 'null_id' AS rule, CAST(NULL AS BIGINT) AS id FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'duplicate_id', o_custkey FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey HAVING count(*) > 1""",
    "bipartite_uncovered": f"""WITH {PURCHASES} SELECT DISTINCT 'endpoint_in_no_side' AS rule, dst AS id FROM e
WHERE dst NOT IN (SELECT -p_partkey - 1 FROM part WHERE p_size > 25)""",
    "bipartite_other_side": f"WITH {PURCHASES} SELECT DISTINCT dst AS id FROM e",
    "vector_get": "SELECT event_id AS pos, value FROM events WHERE event_id IN (SELECT o_orderkey FROM orders)",
    "bipartite_sizes": f"""WITH {PURCHASES}
SELECT 'nodes' AS "of", (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS n
UNION ALL SELECT 'edges', count(*) FROM e""",
    "vector_properties": "SELECT 'float' AS dtype, coalesce(max(event_id) + 1, 0) AS length FROM events",
    "edge_set_properties": f"""WITH {SUCCESSION} SELECT true AS is_directed, (SELECT count(*) FROM ({_NODES})) AS num_nodes,
  count(*) AS num_edges FROM e""",
    "bipartite_properties_weighted": """SELECT false AS is_directed, 'map' AS edge_type, 'float' AS edge_dtype,
  'map' AS node0_type, 'float' AS node0_dtype, 'set' AS node1_type, CAST(NULL AS VARCHAR) AS node1_dtype,
  (SELECT count(*) FROM customer) AS num_nodes0, count(DISTINCT o_orderkey) AS num_nodes1, count(*) AS num_edges,
  bool_or(o_totalprice < 100000) AS edge_has_negative_weights FROM orders""",
    "vector_table": "SELECT event_id AS event, value AS amount FROM events",
    "node_map_diff_repeated": """WITH r AS (
  SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS k, l_quantity AS v FROM lineitem),
s AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS k, l_quantity AS v
  FROM lineitem WHERE l_returnflag <> 'R')
SELECT r.id AS id, CASE WHEN s.id IS NULL THEN 'only_left' ELSE 'value' END AS issue, r.v AS left_value, s.v AS right_value
FROM r LEFT JOIN s ON r.id = s.id AND r.k = s.k WHERE s.v IS NULL OR s.v <> r.v""",
    "node_map_diff_of_types": "SELECT p_partkey AS id, 'type' AS issue FROM part",
    "nodemap_apply_large": """SELECT c_custkey AS id, coalesce(o_orderkey + 9007199254740994, -1) AS weight
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
    "nodemap_apply_batch": "SELECT p_partkey AS id, CAST(floor(p_retailprice * 2) AS BIGINT) AS weight FROM part",
    "nodemap_reduce_all": """SELECT 'sum' AS how, CAST(sum(p_size) AS BIGINT) AS value FROM part
UNION ALL SELECT 'min', min(p_size) FROM part UNION ALL SELECT 'max', max(p_size) FROM part
UNION ALL SELECT 'count', count(p_size) FROM part""",
    "aggregate_edges_least": f"""WITH {SUCCESSION}, low AS (SELECT dst AS id, min(weight) AS w FROM e GROUP BY dst)
SELECT n.id, least(3.0::DOUBLE, coalesce(w, 3.0::DOUBLE)) AS weight FROM ({_NODES}) n LEFT JOIN low ON low.id = n.id""",
    "pagerank_converged": _pagerank(SUCCESSION, 60).replace("round(r, 9)", "round(r, 8)"),
    "projection_nodes": "SELECT -p_partkey - 1 AS id, p_retailprice AS weight FROM part",
    # In a forest, a node lies on the paths from its region to all nodes below it.
    "betweenness_places": f"""WITH RECURSIVE {PLACES}, up(low, high) AS (
  SELECT src, dst FROM e UNION ALL SELECT up.low, e.dst FROM up JOIN e ON e.src = up.high),
below AS (SELECT high AS id, count(*)::DOUBLE AS n FROM up GROUP BY high)
SELECT v.id, CASE WHEN v.id % 5 = 4 THEN 0.0::DOUBLE ELSE coalesce(n, 0.0::DOUBLE) END AS weight
FROM ({_NODES}) v LEFT JOIN below ON below.id = v.id""",
    "betweenness_repeated": f"""WITH RECURSIVE {SUCCESSION.replace(', e AS', ', steps AS')},
e AS MATERIALIZED (SELECT src, dst FROM steps WHERE weight >= 2),
v AS MATERIALIZED (SELECT src AS id FROM steps UNION SELECT dst FROM steps),
b(s, n, d) USING KEY (s, n) AS (
  SELECT id, id, 0 FROM v
  UNION SELECT b.s, e.dst, min(b.d + 1) FROM b JOIN e ON e.src = b.n LEFT JOIN recurring.b q ON q.s = b.s AND q.n = e.dst
  WHERE q.s IS NULL GROUP BY b.s, e.dst),
far AS MATERIALIZED (SELECT * FROM b),
p(s, n, d, c) AS (
  SELECT id, id, 0, 1.0::DOUBLE FROM v
  UNION ALL SELECT p.s, e.dst, p.d + 1, sum(p.c) FROM p JOIN e ON e.src = p.n
    JOIN far ON far.s = p.s AND far.n = e.dst AND far.d = p.d + 1 GROUP BY p.s, e.dst, p.d),
paths AS MATERIALIZED (SELECT * FROM p),
x AS (
  SELECT a.n AS id, sum(a.c * z.c / t.c) AS w FROM paths a JOIN paths z ON z.s = a.n
    JOIN paths t ON t.s = a.s AND t.n = z.n AND t.d = a.d + z.d WHERE a.s <> a.n AND z.n <> a.n GROUP BY a.n),
nn AS (SELECT count(*)::DOUBLE AS c FROM v)
SELECT v.id, round(coalesce(w, 0.0::DOUBLE) / ((c - 1) * (c - 2)), 12) AS weight FROM v LEFT JOIN x ON x.id = v.id, nn""",
}
