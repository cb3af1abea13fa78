"""Property graph as two tables: hubs, neighbours, shared neighbours, hierarchies, pathways.

nodes(label, name); edges(src_label, src, type, dst_label, dst). A hub's edges are aggregated by type
before they are joined, so branches don't multiply. Hierarchies are closed once, by joins to a fixed
depth, and looked up after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.sources.files import stored


def both_ways(edges: DataFrame) -> DataFrame:
    """name, other, other_label, type: each edge from either end."""
    out = edges.select(F.col("src").alias("name"), F.col("dst").alias("other"), F.col("dst_label").alias("other_label"), "type")
    back = edges.select(F.col("dst").alias("name"), F.col("src").alias("other"), F.col("src_label").alias("other_label"), "type")
    return out.unionAll(back)


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """label, name, degree: 0 without an edge."""
    ends = edges.select(F.col("src_label").alias("label"), F.col("src").alias("name")).unionAll(edges.select("dst_label", "dst"))
    n = ends.groupBy("label", "name").agg(F.count("*").alias("degree"))
    return nodes.join(n, ["label", "name"], "left").select("label", "name", F.coalesce("degree", F.lit(0)).alias("degree"))


def one_hop(edges: DataFrame, degrees: DataFrame, name: str, types: list[str] | None = None, limit: int = 50) -> DataFrame:
    """Neighbours in either direction, the best connected first."""
    near = both_ways(edges).filter(F.col("name") == name)
    if types:
        near = near.filter(F.col("type").isin(types))
    d = degrees.select(F.col("label").alias("other_label"), F.col("name").alias("other"), "degree")
    return near.join(d, ["other_label", "other"], "left").select("type", "other_label", "other", "degree").distinct().orderBy(F.desc_nulls_last("degree"), "other", "type").limit(max(1, min(200, limit)))


def hub(nodes: DataFrame, edges: DataFrame, label: str, branches: dict[str, str], most: int = 20) -> DataFrame:
    """name and, for each branch (column: edge type), its distinct sorted ends, at most `most`. Ends of
    other nodes than these go before anything is told apart or sorted."""
    out = nodes.filter(F.col("label") == label).select("name")
    mine = out.distinct()
    for column, kind in branches.items():
        ends = both_ways(edges.filter(F.col("type") == kind)).select("name", "other").join(mine, "name", "left_semi").distinct()
        best = ends.withColumn("at", F.row_number().over(Window.partitionBy("name").orderBy("other"))).filter(F.col("at") <= most)
        part = best.groupBy("name").agg(F.array_sort(F.collect_set("other")).alias(column))
        out = out.join(part, "name", "left").withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
    return out


def differential(edges: DataFrame, kind: str, name: str, limit: int = 25) -> DataFrame:
    """Others that share a neighbour over edges of one type: other, shared."""
    e = edges.filter(F.col("type") == kind).select("src", "dst").distinct()
    mine = e.filter(F.col("src") == name).select("dst")
    return e.join(mine, "dst").filter(F.col("src") != name).groupBy(F.col("src").alias("other")).agg(F.count_distinct("dst").alias("shared")).orderBy(F.desc("shared"), "other").limit(limit)


def closure(parents: DataFrame, depth: int = 5) -> DataFrame:
    """descendant, ancestor, depth (the least) over parents (child, parent); 0 for itself; ends at `depth`, so a cycle
    does too, and when a level adds nothing. Every level is stored, so it is computed once."""
    e = stored(parents.select("child", "parent").distinct())
    names = e.select(F.col("child").alias("n")).union(e.select("parent")).distinct()
    out = names.select(F.col("n").alias("descendant"), F.col("n").alias("ancestor"), F.lit(0).alias("depth"))
    front = out
    for k in range(1, depth + 1):
        step = e.select(F.col("child").alias("ancestor"), F.col("parent").alias("_up"))
        front = stored(front.join(step, "ancestor").select("descendant", F.col("_up").alias("ancestor"), F.lit(k).alias("depth")).distinct())
        if not front.head(1):
            break
        out = out.unionAll(front)
    return out.groupBy("descendant", "ancestor").agg(F.min("depth").alias("depth"))


def longest_prefix(codes: DataFrame, catalogue: DataFrame, lengths=(7, 5, 4, 3, 1)) -> DataFrame:
    """code, match: the longest prefix, of the lengths that the catalogue's codes have."""
    tried = codes.select("code", F.explode(F.array_distinct(F.array(*(F.left("code", F.lit(n)) for n in lengths)))).alias("match"))
    hit = tried.join(catalogue.select(F.col("code").alias("match")).distinct(), "match")
    return hit.groupBy("code").agg(F.max_by("match", F.length("match")).alias("match"))


def coverage(nodes: DataFrame, mapped: DataFrame) -> DataFrame:
    """label, total, mapped, percent (whole)."""
    m = mapped.select("label", "name").distinct().withColumn("hit", F.lit(1))
    g = nodes.join(m, ["label", "name"], "left").groupBy("label").agg(F.count("*").alias("total"), F.count("hit").alias("mapped"))
    return g.withColumn("percent", F.call_function("div", F.col("mapped") * 100, F.col("total")))


def step_edges(steps: DataFrame) -> DataFrame:
    """dag, src, dst, kind over steps (dag, at, ord, node): each step to the next if the order changes (linear), and the
    last step of an order to every step of the next order where that one forks (branch). Both are kept."""
    by = Window.partitionBy("dag").orderBy("at")
    linear = steps.withColumn("dst", F.lead("node").over(by)).withColumn("ord2", F.lead("ord").over(by)).filter("ord2 <> ord").select("dag", F.col("node").alias("src"), "dst", F.lit("linear").alias("kind"))
    ranked = steps.withColumn("rank", F.dense_rank().over(Window.partitionBy("dag").orderBy("ord")))
    last = ranked.groupBy("dag", "rank").agg(F.max_by("node", "at").alias("src"), F.count("*").alias("n")).withColumn("next", F.col("rank") + 1)
    forks = ranked.join(last.filter("n > 1").select("dag", "rank"), ["dag", "rank"], "left_semi")
    branch = forks.join(last.select("dag", F.col("next").alias("rank"), "src"), ["dag", "rank"]).select("dag", "src", F.col("node").alias("dst"), F.lit("branch").alias("kind"))
    return linear.unionAll(branch)


def flatten_tree(tree: dict, parent: str | None = None, level: int = 0) -> list[tuple]:
    """(code, name, level, parent) of a nested tree of {code, name, children}."""
    out = [(tree["code"], tree.get("name", ""), level, parent)]
    for child in tree.get("children", []):
        out += flatten_tree(child, tree["code"], level + 1)
    return out


def ensure_nodes(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """label, name, node_label, node_name, made: what each wanted node (label, name) stands for: the node of that label
    with the same name whatever its case, else one of any label, else a new one."""
    key = F.lower("name")
    have = nodes.select("label", "name", key.alias("_k")).distinct()
    same = have.groupBy(F.col("label").alias("_l"), "_k").agg(F.min("name").alias("same"))
    other = have.groupBy("_k").agg(F.min(F.struct("label", "name")).alias("other"))
    w = wanted.select("label", "name", key.alias("_k")).distinct()
    j = w.join(same, (F.col("label") == F.col("_l")) & (w["_k"] == same["_k"]), "left").select("label", "name", w["_k"], "same").join(other, "_k", "left")
    label = F.when(F.col("same").isNotNull(), F.col("label")).otherwise(F.coalesce(F.col("other")["label"], F.col("label")))
    return j.select("label", "name", label.alias("node_label"), F.coalesce("same", F.col("other")["name"], "name").alias("node_name"), (F.col("same").isNull() & F.col("other").isNull()).alias("made"))


def replace_dag(edges: DataFrame, steps: DataFrame) -> DataFrame:
    """Edges (dag, src, dst, kind) after the pathways of steps were loaded again: theirs are new, others stay."""
    return edges.join(steps.select("dag").distinct(), "dag", "left_anti").unionByName(step_edges(steps))


def delete_dag(edges: DataFrame, name: str) -> DataFrame:
    return edges.filter(F.col("dag") != name)


def crossed(up: DataFrame, links: DataFrame, one: str, two: str, limit: int = 15) -> DataFrame:
    """src, dst of links whose ends lie under `one` and `two` of two hierarchies (up: descendant, ancestor)."""
    a = up.filter(F.col("ancestor") == one).select(F.col("descendant").alias("src"))
    b = up.filter(F.col("ancestor") == two).select(F.col("descendant").alias("dst"))
    return links.select("src", "dst").distinct().join(a, "src", "left_semi").join(b, "dst", "left_semi").orderBy("src", "dst").limit(limit)
