"""Consolidating pairwise matches into groups (problem 3).

Union-find runs inside every edge partition as it lies (no shuffle first) and keeps only a spanning forest: one
``node -> smallest node of its tree`` row per node. A node that came out under several roots ties those roots
together; these ties are the edges of a far smaller graph over roots, which goes through the same step in fewer
partitions, each holding at most ``rows_per_task`` edges, until no tie is left. The levels' maps are then read from
the top down. A level that hardly shrinks (an adversarial edge order) is first contracted by hooking every node to
the neighbour of least hash, which needs no task to hold more than its share, whatever the shape of the graph.

Defined results: blank and null uris are left out, uris are trimmed; a uri tied only to itself is in no group;
repeated edges change nothing; no edges give no rows. The group identifier is the smallest uri by code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import cut, drop, lookup, read

ROWS_PER_TASK = 1_000_000


def spanning_forest(edges: Iterator[tuple[str, str]]) -> dict[str, str]:
    """Smallest node of the tree of every node of the edges."""
    up: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while (parent := up[root]) != root:
            root = parent
        while (parent := up[x]) != root:
            up[x], x = root, parent
        return root

    for a, b in edges:
        up.setdefault(a, a)
        up.setdefault(b, b)
        a, b = find(a), find(b)
        if a < b:
            up[b] = a
        elif b < a:
            up[a] = b
    return {x: find(x) for x in up}


def _forest_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges() -> Iterator[tuple[str, str]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    forest = spanning_forest(edges())
    nodes = list(forest)
    for k in range(0, len(nodes), 50_000):
        part = nodes[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([forest[x] for x in part], pa.string())], names=["node", "root"])


def _level(edges: DataFrame) -> DataFrame:
    """(node, root): a spanning forest of each partition of (a, b)."""
    return edges.mapInArrow(_forest_of_partition, "node string, root string")


def _hook(edges: DataFrame, turn: int) -> DataFrame:
    """(node, root) contracting every node into its neighbour (or itself) of least hash: at least halves in a few turns."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b"))
    own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("b"))
    return both.groupBy("a").agg(F.min(rank).alias("m")).select(F.col("a").alias("node"), F.least(F.col("m"), own)["b"].alias("root"))


def components(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: strings); component is the smallest node of the group."""
    spark = edges.sparkSession
    levels: list[DataFrame] = []
    forest = cut(_level(edges.select("a", "b").where("a is not null and b is not null")))
    width, last, turn = max(1, forest.rdd.getNumPartitions()), None, 0
    while True:
        # the least root of a node stands for it; its other roots are tied to that one
        firsts = forest.groupBy("node").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("trees"))
        levels.append(cut(firsts.select("node", "root")))
        shared = forest.join(firsts.where("trees > 1").select("node", F.col("root").alias("first")), "node")
        ties = cut(shared.where("root <> first").select(F.col("first").alias("a"), F.col("root").alias("b")).distinct())
        drop(forest)
        n = ties.count()
        if n == 0:
            break
        if last is not None and n > 0.9 * last and n > rows_per_task:
            turn += 1
            hooked = cut(_hook(ties, turn))
            moved = ties.join(hooked.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(hooked.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            levels.append(hooked)
            ties = cut(moved.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
            n = ties.count()
            if n == 0:
                break
        last = n
        width = max(1, min(width // 2, -(-n // rows_per_task)))
        if n > rows_per_task:
            width = max(2, -(-n // rows_per_task))
        forest = cut(_level(ties.repartition(width, "a", "b")))
    found = levels[-1]
    for level in reversed(levels[:-1]):
        upper = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = lookup(level, upper, ["root"]).select("node", F.coalesce("top", "root").alias("root"))
    # hooking need not keep the smallest node as the root: name each group by its minimum
    if turn:
        names = found.groupBy("root").agg(F.min("node").alias("name"))
        found = lookup(found, names, ["root"]).select("node", F.col("name").alias("root"))
    return found.select("node", F.col("root").alias("component"))


def decision_edges(spark: SparkSession, base: str) -> DataFrame:
    """Star edges of the uris that one row of link_decisions ties together (first uri to each other one)."""
    uris = F.filter(
        F.transform(
            F.concat(F.array("chosen_canonical_uri"), F.coalesce("source_ids", F.array().cast("array<string>"))),
            lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""),
        ),
        lambda x: x.isNotNull() & (x != ""),
    )
    rows = read(spark, base, "link_decisions").select(uris.alias("uris")).where(F.size("uris") > 0)
    return rows.select(F.col("uris")[0].alias("a"), F.explode("uris").alias("b"))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    found = cut(components(decision_edges(spark, base)))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return lookup(found, sizes, ["component"], "inner").select(F.col("node").alias("uri"), F.col("component").alias("group_uri"))


def p3_groups(spark: SparkSession, base: str) -> DataFrame:
    """One group identifier for every entities.uri: its component, or itself when nothing ties it."""
    uris = read(spark, base, "entities").select("uri").where("uri is not null").distinct()
    found = components(decision_edges(spark, base)).select(F.col("node").alias("uri"), "component")
    return uris.join(found, "uri", "left").select("uri", F.coalesce("component", "uri").alias("group_uri"))


_TIES = """
with recursive rows as (
  select decision_id, list_distinct(list_filter(list_transform(list_concat([chosen_canonical_uri], coalesce(source_ids, [])), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x is not null and x <> '')) u from link_decisions),
star as (select distinct u[1] a, unnest(u) b from rows where len(u) > 0),
ties as (select a, b from star union select b, a from star),
walk(node, seen) as (select a, a from ties union select t.b, w.seen from walk w join ties t on t.a = w.node)
"""
ORACLE = {
    "p3_found": _TIES + ", g as (select node uri, min(seen) group_uri from walk group by 1) select uri, group_uri from g where group_uri in (select group_uri from g group by 1 having count(*) > 1)",
    "p3_groups": _TIES + ", g as (select node uri, min(seen) group_uri from walk group by 1) select e.uri, coalesce(g.group_uri, e.uri) group_uri from (select distinct uri from entities where uri is not null) e left join g using (uri)",
}
