"""Queries over the graph, hierarchies and pathways."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import graph as G
from loomgraph.sources.rebase import SQL_EDGES, SQL_NODES, edges, nodes, read




def _first(spark, d, label):
    return nodes(spark, d).filter(F.col("label") == label).agg(F.min("name")).first()[0]


def stats_by_label(spark, d):
    return nodes(spark, d).groupBy("label").agg(F.count("*").alias("n"))


def stats_by_type(spark, d):
    return edges(spark, d).groupBy("type").agg(F.count("*").alias("n"))


def degree_by_node(spark, d):
    return G.degree(nodes(spark, d), edges(spark, d))


def one_hop_neighbours(spark, d):
    return G.one_hop(edges(spark, d), G.degree(nodes(spark, d), edges(spark, d)), _first(spark, d, "Supplier"), ["SUPPLIES", "IN_NATION"], 30)


def graph_relations(spark, d):
    near = G.both_ways(edges(spark, d)).filter(F.contains(F.lower("name"), F.lit(_first(spark, d, "Nation").lower())))
    return near.select("name", "type", "other").distinct().orderBy("name", "type", "other").limit(15)


def hub_profile(spark, d):
    return G.hub(nodes(spark, d), edges(spark, d), "Supplier", {"parts": "SUPPLIES", "nations": "IN_NATION"}).select("name", F.array_join("parts", ",").alias("parts"), F.array_join("nations", ",").alias("nations"))


def differential_shared(spark, d):
    return G.differential(edges(spark, d), "SUPPLIES", _first(spark, d, "Supplier"))


def _parents(spark, d):
    return edges(spark, d).filter(F.col("type").isin("IN_NATION", "IN_REGION")).select(F.col("src").alias("child"), F.col("dst").alias("parent"))


def ontology_closure(spark, d):
    return G.closure(_parents(spark, d), 5)


def ontology_up(spark, d):
    c = G.closure(_parents(spark, d), 5)
    return c.filter((F.col("depth") > 0) & F.contains(F.lower("descendant"), F.lit("000000001"))).select("descendant", "ancestor", "depth")


def ontology_down(spark, d):
    c = G.closure(_parents(spark, d), 3).filter("depth > 0")
    r = nodes(spark, d).filter("label = 'Region'").select(F.col("name").alias("ancestor"))
    g = r.join(c, "ancestor", "left").groupBy("ancestor").agg(F.slice(F.array_sort(F.collect_set("descendant")), 1, 20).alias("members"))
    return g.select("ancestor", F.array_join("members", ",").alias("members"))


def ontology_cross(spark, d):
    """Pairs of a supplier's region and a part it supplies whose other suppliers lie in another region."""
    up = G.closure(_parents(spark, d), 5)
    region = up.join(nodes(spark, d).filter("label = 'Region'").select(F.col("name").alias("ancestor")), "ancestor").select(F.col("descendant").alias("src"), F.col("ancestor").alias("region"))
    s = edges(spark, d).filter("type = 'SUPPLIES'").select("src", "dst").join(region, "src")
    a, b = s.select("dst", F.col("region").alias("one")).distinct(), s.select("dst", F.col("region").alias("two")).distinct()
    return a.join(b, "dst").filter("one < two").groupBy("one", "two").agg(F.count("*").alias("parts"))


def cross_system(spark, d):
    """Each supplier, its region, how many parts it supplies, and the first part by name, if any."""
    up = G.closure(_parents(spark, d), 5).filter("depth = 2")
    s = edges(spark, d).filter("type = 'SUPPLIES'").groupBy("src").agg(F.count_distinct("dst").alias("parts"), F.min("dst").alias("first_part"))
    n = nodes(spark, d).filter("label = 'Supplier'").select("name")
    return n.join(up, F.col("name") == F.col("descendant"), "left").join(s, F.col("name") == F.col("src"), "left").select("name", F.col("ancestor").alias("region"), F.coalesce("parts", F.lit(0)).alias("parts"), "first_part")


def coverage_pct(spark, d):
    mapped = edges(spark, d).filter("type = 'SUPPLIES'").select(F.col("dst_label").alias("label"), F.col("dst").alias("name")).union(edges(spark, d).filter("type = 'IN_NATION'").select("src_label", "src"))
    return G.coverage(nodes(spark, d), mapped)


def unmapped_entities(spark, d):
    """Parts that no supplier supplies and customers without an urgent order are mapped to nothing."""
    buys = read(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("name"))
    mapped = edges(spark, d).filter("type = 'SUPPLIES'").select(F.col("dst").alias("name")).union(buys)
    return nodes(spark, d).filter(F.col("label").isin("Customer", "Part")).join(mapped.distinct(), "name", "left_anti").select("label", "name").orderBy("label", "name")


def _steps(spark, d):
    """A user's events as steps: by time, those of one day have one order."""
    e = read(spark, d, "events")
    return e.select(F.col("user_id").alias("dag"), F.struct("ts", "event_id").alias("at"), F.to_date("ts").alias("ord"), F.concat("event_type", F.lit(" "), F.col("event_id")).alias("node"), "event_type")


def dag_edges(spark, d):
    return G.step_edges(_steps(spark, d))


def dag_paths(spark, d):
    named = _steps(spark, d).select("dag", F.col("node").alias("src"), "event_type")
    p = G.step_edges(_steps(spark, d)).join(named, ["dag", "src"]).filter(F.contains(F.lower("src"), F.lit("click")))
    return p.select("dag", "src", "dst").distinct().groupBy("dag").agg(F.count("*").alias("steps"), F.min("src").alias("first_src"))


def dag_list(spark, d):
    return G.step_edges(_steps(spark, d)).groupBy("dag", "kind").agg(F.count("*").alias("n"))


def code_longest_prefix(spark, d):
    codes = read(spark, d, "part").select(F.replace(F.replace("p_brand", F.lit("Brand#"), F.lit("B")), F.lit("_"), F.lit("")).alias("b"), "p_type", "p_size")
    c = codes.select(F.upper(F.concat("b", F.left("p_type", F.lit(3)), F.col("p_size"))).alias("code")).distinct()
    known = c.filter(F.length("code") >= 5).select(F.left("code", F.lit(5)).alias("code")).filter("code < 'B3'").union(c.select(F.left("code", F.lit(1)).alias("code"))).distinct()
    return G.longest_prefix(c, known)


def endpoint_ci(spark, d):
    """Endpoints matched on lower case: each nation's name in upper case finds its node."""
    n = nodes(spark, d).filter("label = 'Nation'")
    asked = n.select(F.upper("name").alias("asked"))
    return asked.join(n, F.lower("asked") == F.lower("name")).select("asked", "name")


def category_theta(spark, d):
    """The first brand (by catalogue order) that a type's text holds a piece of, or the other way round."""
    t = read(spark, d, "part").select("p_type").distinct().withColumn("key", F.lower("p_type"))
    cats = spark.createDataFrame([(i, c) for i, c in enumerate(["steel", "economy", "tin", "o", "promo", "standard"])], "ord int, cat string")
    m = t.join(F.broadcast(cats), F.contains("key", "cat") | F.contains("cat", "key"))
    return m.groupBy("p_type").agg(F.min_by("cat", "ord").alias("cat"))


_STEPS = """steps AS (SELECT user_id AS dag, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, ts::DATE AS ord, event_type || ' ' || event_id AS node FROM events),
lin AS (SELECT dag, node AS src, lead(node) OVER w AS dst, lead(ord) OVER w AS o2, ord FROM steps WINDOW w AS (PARTITION BY dag ORDER BY pos)),
rk AS (SELECT *, dense_rank() OVER (PARTITION BY dag ORDER BY ord) AS r FROM steps), la AS (SELECT dag, r, arg_max(node, pos) AS src, count(*) AS n FROM rk GROUP BY 1, 2),
dag AS (SELECT dag, src, dst, 'linear' AS kind FROM lin WHERE o2 <> ord UNION ALL SELECT k.dag, p.src, k.node, 'branch' FROM rk k JOIN la f ON f.dag = k.dag AND f.r = k.r AND f.n > 1 JOIN la p ON p.dag = k.dag AND p.r + 1 = k.r)"""
_CLOSE = f"""{SQL_EDGES}, par AS (SELECT DISTINCT src AS child, dst AS parent FROM edges WHERE type IN ('IN_NATION', 'IN_REGION')),
up AS (SELECT n AS descendant, n AS ancestor, 0 AS depth FROM (SELECT child AS n FROM par UNION SELECT parent FROM par) UNION SELECT descendant, parent, depth + 1 FROM up JOIN par ON child = ancestor WHERE depth < 5),
closure AS (SELECT descendant, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2)"""
_BOTH = "bw AS (SELECT src AS name, dst AS other, dst_label AS other_label, type FROM edges UNION ALL SELECT dst, src, src_label, type FROM edges)"
_DEG = "deg AS (SELECT n.label, n.name, count(e.name) AS degree FROM nodes n LEFT JOIN (SELECT src_label AS label, src AS name FROM edges UNION ALL SELECT dst_label, dst FROM edges) e ON e.label = n.label AND e.name = n.name GROUP BY 1, 2)"
_CODE = "c AS (SELECT DISTINCT upper(replace(replace(p_brand, 'Brand#', 'B'), '_', '') || p_type[:3] || p_size) AS code FROM part), k AS (SELECT DISTINCT code[:5] AS code FROM c WHERE length(code) >= 5 AND code[:5] < 'B3' UNION SELECT code[:1] FROM c)"
SQL = {
    "stats_by_label": f"WITH {SQL_NODES} SELECT label, count(*) AS n FROM nodes GROUP BY 1",
    "stats_by_type": f"WITH {SQL_EDGES} SELECT type, count(*) AS n FROM edges GROUP BY 1",
    "degree_by_node": f"WITH {SQL_NODES}, {SQL_EDGES}, {_DEG} SELECT * FROM deg",
    "one_hop_neighbours": f"WITH {SQL_NODES}, {SQL_EDGES}, {_DEG}, {_BOTH} SELECT DISTINCT type, other_label, other, degree FROM bw LEFT JOIN deg ON deg.label = other_label AND deg.name = other WHERE bw.name = (SELECT min(s_name) FROM supplier) AND type IN ('SUPPLIES', 'IN_NATION') ORDER BY degree DESC, other, type LIMIT 30",
    "graph_relations": f"WITH {SQL_EDGES}, {_BOTH} SELECT DISTINCT name, type, other FROM bw WHERE contains(lower(name), (SELECT lower(min(n_name)) FROM nation)) ORDER BY name, type, other LIMIT 15",
    "hub_profile": f"""WITH {SQL_EDGES}, s AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'SUPPLIES' AND src_label = 'Supplier' QUALIFY row_number() OVER (PARTITION BY src ORDER BY dst) <= 20), n AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'IN_NATION')
      SELECT s_name AS name, coalesce((SELECT string_agg(dst, ',' ORDER BY dst) FROM s WHERE src = s_name), '') AS parts, coalesce((SELECT string_agg(dst, ',' ORDER BY dst) FROM n WHERE src = s_name), '') AS nations FROM supplier""",
    "differential_shared": f"WITH {SQL_EDGES}, e AS (SELECT DISTINCT src, dst FROM edges WHERE type = 'SUPPLIES'), m AS (SELECT dst FROM e WHERE src = (SELECT min(s_name) FROM supplier)) SELECT src AS other, count(DISTINCT dst) AS shared FROM e JOIN m USING (dst) WHERE src <> (SELECT min(s_name) FROM supplier) GROUP BY 1 ORDER BY shared DESC, other LIMIT 25",
    "ontology_closure": f"WITH RECURSIVE {_CLOSE} SELECT * FROM closure",
    "ontology_up": f"WITH RECURSIVE {_CLOSE} SELECT * FROM closure WHERE depth > 0 AND contains(lower(descendant), '000000001')",
    "ontology_down": f"WITH RECURSIVE {_CLOSE} SELECT r_name AS ancestor, coalesce(array_to_string(list_sort(list(DISTINCT descendant) FILTER (descendant IS NOT NULL))[:20], ','), '') AS members FROM region LEFT JOIN closure ON ancestor = r_name AND depth BETWEEN 1 AND 3 GROUP BY 1",
    "ontology_cross": f"WITH RECURSIVE {_CLOSE}, s AS (SELECT DISTINCT dst, ancestor AS region FROM edges JOIN closure ON descendant = src JOIN region ON r_name = ancestor WHERE type = 'SUPPLIES') SELECT a.region AS one, b.region AS two, count(*) AS parts FROM s a JOIN s b ON a.dst = b.dst AND a.region < b.region GROUP BY 1, 2",
    "cross_system": f"WITH RECURSIVE {_CLOSE}, p AS (SELECT src, count(DISTINCT dst) AS parts, min(dst) AS first_part FROM edges WHERE type = 'SUPPLIES' GROUP BY 1) SELECT s_name AS name, ancestor AS region, coalesce(parts, 0) AS parts, first_part FROM supplier LEFT JOIN closure ON descendant = s_name AND depth = 2 LEFT JOIN p ON src = s_name",
    "coverage_pct": f"WITH {SQL_NODES}, {SQL_EDGES}, m AS (SELECT dst_label AS label, dst AS name FROM edges WHERE type = 'SUPPLIES' UNION SELECT src_label, src FROM edges WHERE type = 'IN_NATION') SELECT n.label, count(*) AS total, count(m.name) AS mapped, count(m.name) * 100 // count(*) AS percent FROM nodes n LEFT JOIN m ON m.label = n.label AND m.name = n.name GROUP BY 1",
    "unmapped_entities": f"WITH {SQL_NODES}, {SQL_EDGES} SELECT label, name FROM nodes WHERE label IN ('Customer', 'Part') AND name NOT IN (SELECT dst FROM edges WHERE type = 'SUPPLIES') AND name NOT IN (SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT')",
    "dag_edges": f"WITH {_STEPS} SELECT * FROM dag",
    "dag_paths": f"WITH {_STEPS} SELECT dag, count(*) AS steps, min(src) AS first_src FROM (SELECT DISTINCT dag, src, dst FROM dag WHERE contains(lower(src), 'click')) GROUP BY 1",
    "dag_list": f"WITH {_STEPS} SELECT dag, kind, count(*) AS n FROM dag GROUP BY 1, 2",
    "code_longest_prefix": f"WITH {_CODE}, t AS (SELECT DISTINCT code, code[:n] AS match FROM c, (SELECT unnest([7, 5, 4, 3, 1]) AS n)) SELECT t.code, arg_max(match, length(match)) AS match FROM t WHERE match IN (SELECT code FROM k) GROUP BY 1",
    "endpoint_ci": "SELECT upper(n_name) AS asked, n_name AS name FROM nation",
    "category_theta": "WITH c AS (SELECT unnest(['steel', 'economy', 'tin', 'o', 'promo', 'standard']) AS cat, unnest(range(6)) AS ord) SELECT p_type, arg_min(cat, ord) AS cat FROM (SELECT DISTINCT p_type FROM part) JOIN c ON contains(lower(p_type), cat) OR contains(cat, lower(p_type)) GROUP BY 1",
}


def queries() -> dict:
    fs = [
        stats_by_label, stats_by_type, degree_by_node, one_hop_neighbours, graph_relations, hub_profile, differential_shared, ontology_closure, ontology_up, ontology_down, ontology_cross,
        cross_system, coverage_pct, unmapped_entities, dag_edges, dag_paths, dag_list, code_longest_prefix, endpoint_ci, category_theta,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
