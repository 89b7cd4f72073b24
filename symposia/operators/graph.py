"""Graph operators over (source, target) edges: size, centralities, ranks, triangles, components, communities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.runtime import counted_off, cut, drop, fetched, located, read

#: Betweenness holds the whole graph in each worker, greedy communities in one: arrays with places of 32 bits, so more edges are refused.
WHOLE_GRAPH_EDGES = (1 << 31) - 1
#: Sources of betweenness that walk together, and edges of them all.
WALKS, WALKED = 16, 3_000_000


def edges(spark: SparkSession, base: str) -> DataFrame:
    """Distinct (src, tgt) of the relations, endpoints trimmed, blank ones left out."""
    rows = read(spark, base, "relations").select(C.blank_to_null(F.col("source")).alias("src"), C.blank_to_null(F.col("target")).alias("tgt"))
    return rows.where("src is not null and tgt is not null").distinct()


def nodes(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.select(F.explode(F.array("src", "tgt")).alias("node")).distinct()


def graph_size(spark: SparkSession, base: str) -> DataFrame:
    e = edges(spark, base)
    both = e.agg(F.count(F.lit(1)).alias("edges")).join(nodes(e).agg(F.count(F.lit(1)).alias("nodes")), how="inner", on=F.lit(True))
    return both.select("nodes", "edges", F.when(F.col("nodes") > 1, F.round(F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1)), 9)).otherwise(0.0).alias("density"))


def degree_centrality(spark: SparkSession, base: str) -> DataFrame:
    e = edges(spark, base)
    ends = e.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(e.select(F.col("tgt").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    degree = cut(ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree")))
    n = degree.count()
    return degree.select("node", "out_degree", "in_degree", F.round((F.col("out_degree") + F.col("in_degree")) / F.lit(max(1, n - 1)), 6).alias("centrality"))


def undirected(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.where("src <> tgt").select(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b")).distinct()


def clustering(edge_rows: DataFrame) -> DataFrame:
    """(node, degree, triangles, coefficient), undirected. Edges point from the end of lower degree to the other, which
    keeps the wedges of a hub's neighbours few: no node starts more than about the square root of all edges."""
    und = cut(undirected(edge_rows))
    degree = und.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    d = lambda s: degree.select(F.col("node").alias(s), F.struct("degree", "node").alias(f"r{s}"))
    ranked = und.join(d("a"), "a").join(d("b"), "b")
    low = F.col("ra") < F.col("rb")
    out = cut(ranked.select(F.when(low, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(low, F.col("b")).otherwise(F.col("a")).alias("v"), F.when(low, F.col("rb")).otherwise(F.col("ra")).alias("rv")))
    wedge = out.alias("x").join(out.alias("y"), "u").where("x.rv < y.rv").select("u", F.col("x.v").alias("v"), F.col("y.v").alias("w"))
    closed = wedge.join(out.select(F.col("u").alias("v"), F.col("v").alias("w")), ["v", "w"], "left_semi")
    hits = closed.select(F.explode(F.array("u", "v", "w")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))
    joined = degree.join(hits, "node", "left").select("node", "degree", F.coalesce("triangles", F.lit(0)).cast("bigint").alias("triangles"))
    return joined.withColumn("coefficient", F.when(F.col("degree") > 1, F.round(2 * F.col("triangles") / (F.col("degree") * (F.col("degree") - 1)), 6)).otherwise(0.0))


def clustering_coefficients(spark: SparkSession, base: str) -> DataFrame:
    return clustering(edges(spark, base))


def average_clustering(spark: SparkSession, base: str) -> DataFrame:
    """One row: the mean coefficient over all nodes, those without neighbours counting as 0, and the number of triangles."""
    e = edges(spark, base)
    sums = clustering(e).agg(F.sum(F.round(F.col("coefficient") * 1_000_000).cast("bigint")).alias("c"), F.sum("triangles").alias("t"))
    both = sums.join(nodes(e).agg(F.count(F.lit(1)).alias("n")), how="inner", on=F.lit(True))
    return both.select(F.round(F.coalesce("c", F.lit(0)) / 1_000_000 / F.greatest("n", F.lit(1)), 6).alias("clustering"), (F.coalesce("t", F.lit(0)) / 3).cast("bigint").alias("triangles"))


def first_nodes(spark: SparkSession, base: str, most: int = 20) -> DataFrame:
    """(node, seq, centrality): degree centrality of the first ``most`` nodes in order of appearance (relations by uri, source before target)."""
    rows = read(spark, base, "relations").select("uri", C.blank_to_null(F.col("source")).alias("src"), C.blank_to_null(F.col("target")).alias("tgt")).where("uri is not null and src is not null and tgt is not null")
    seen = rows.select("uri", F.posexplode(F.array("src", "tgt")).alias("end", "node")).groupBy("node").agg(F.min(F.struct("uri", "end")).alias("at"))
    first = seen.orderBy("at", "node").limit(most)
    ranked = first.select("node", F.row_number().over(Window.orderBy("at", "node")).alias("seq"))
    return ranked.join(degree_centrality(spark, base), "node").select("node", "seq", F.round("centrality", 4).alias("centrality"))


def analytics_summary(spark: SparkSession, base: str) -> DataFrame:
    """(metric, value) of the whole graph; a metric that fails is reported as null, the others stand."""
    metrics = {
        "nodes": lambda: graph_size(spark, base).select(F.col("nodes").cast("double")),
        "edges": lambda: graph_size(spark, base).select(F.col("edges").cast("double")),
        "density": lambda: graph_size(spark, base).select("density"),
        "clustering": lambda: average_clustering(spark, base).select("clustering"),
        "components": lambda: graph_components(spark, base).select(F.countDistinct("component").cast("double")),
        "greatest_degree": lambda: degree_centrality(spark, base).select(F.max(F.col("in_degree") + F.col("out_degree")).cast("double")),
    }
    out = None
    for name, compute in metrics.items():
        try:
            row = compute().toDF("value").select(F.lit(name).alias("metric"), "value")
        except Exception:  # noqa: BLE001
            row = spark.createDataFrame([(name, None)], "metric string, value double")
        out = row if out is None else out.unionByName(row)
    return out


def pagerank(edge_rows: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(node, rank): the mass of nodes without outgoing edges is spread evenly. Rounds end when the ranks' moves sum to less
    than ``tolerance`` a node; each takes at most ``damping`` of the moves before it, so they do end."""
    out_degree = edge_rows.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    links = cut(edge_rows.join(out_degree, "src"))
    every = cut(nodes(edge_rows).join(out_degree.withColumnRenamed("src", "node"), "node", "left"))
    n = every.count()
    ranks = every.withColumn("rank", F.lit(1.0 / max(1, n)))
    lost = every.where("k is null").count() / max(1, n)
    while n:
        sent = links.join(ranks.select(F.col("node").alias("src"), "rank"), "src").groupBy(F.col("tgt").alias("node")).agg(F.sum(F.col("rank") / F.col("k")).alias("got"))
        moved = cut(ranks.join(sent, "node", "left").select("node", "k", F.col("rank").alias("before"), (F.lit((1 - damping) / n + damping * lost / n) + damping * F.coalesce("got", F.lit(0.0))).alias("rank")))
        drop(ranks)
        sums = moved.agg(F.sum(F.abs(F.col("rank") - F.col("before"))).alias("d"), F.sum(F.when(F.col("k").isNull(), F.col("rank")).otherwise(0.0)).alias("lost")).first()
        path = moved._symposia_path
        ranks, lost = moved.select("node", "k", "rank"), sums["lost"]
        ranks._symposia_path = path
        if sums["d"] < n * tolerance:
            break
    return ranks.select("node", "rank")


def page_ranks(spark: SparkSession, base: str) -> DataFrame:
    return pagerank(edges(spark, base)).select("node", F.round("rank", 9).alias("rank"))


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, component) of (a, b): least node reached, by alternating large-star and small-star steps until nothing moves.

    Each step is a partial aggregate by node and a join that spreads hubs."""
    both = cut(pairs.where("a is not null and b is not null").select("a", "b").distinct())
    every = both.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    star = both.where("a <> b")

    def step(e: DataFrame, large: bool) -> DataFrame:
        if large:
            nb = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            nb = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = nb.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = nb.join(least, "a")
        moved = joined.where("b > a") if large else joined
        new = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            new = new.unionByName(least.select("a", F.col("m").alias("b")))
        return new.where("a <> b").distinct()

    before = None
    while True:
        last, star = star, cut(step(step(star, True), False))
        drop(last)
        sign = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    roots = star.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return every.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def graph_components(spark: SparkSession, base: str) -> DataFrame:
    return connected_components(edges(spark, base).select(F.col("src").alias("a"), F.col("tgt").alias("b")))


def label_propagation(edge_rows: DataFrame, rounds: int = 8) -> DataFrame:
    """(node, community): ``rounds`` times every node takes the commonest label around it, the smallest among equals. The
    number of rounds is part of the definition: labels of even rings swap for ever."""
    und = undirected(edge_rows)
    both = cut(und.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(und.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    labels = cut(both.select("node").distinct().withColumn("label", F.col("node")))
    for _ in range(rounds):
        heard = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
        best = heard.groupBy("node").agg(F.max("n").alias("most")).join(heard, "node").where("n = most").groupBy("node").agg(F.min("label").alias("label"))
        labels = cut(best)
    return labels.select("node", F.col("label").alias("community"))


def communities(spark: SparkSession, base: str) -> DataFrame:
    return label_propagation(edges(spark, base))


def _numbered(edge_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, id) in the order of the names, and the edges (s, t) as these numbers; both in the shared folder."""
    edge_rows = cut(edge_rows.toDF("src", "tgt"))
    if edge_rows.count() > WHOLE_GRAPH_EDGES:
        raise ValueError(f"more than {WHOLE_GRAPH_EDGES} edges: use page ranks or label propagation")
    ids = counted_off(nodes(edge_rows).orderBy("node"))
    end = lambda c, name: ids.select(F.col("node").alias(c), F.col("id").cast("int").alias(name))
    return ids, cut(edge_rows.join(end("src", "s"), "src").join(end("tgt", "t"), "tgt").select("s", "t"))


def _links(uri: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the links of each node begin, and their ends."""
    table = fetched(uri)
    s, t = (table.column(c).to_numpy() for c in "st")
    order = np.lexsort((t, s))
    order = order[s[order] != t[order]]
    return np.searchsorted(s[order], np.arange(n + 1)), t[order]


def betweenness(edge_rows: DataFrame) -> DataFrame:
    """(node, betweenness), directed and normalised; sources are spread over the tasks, each walks its shortest paths."""
    ids, edge_rows = _numbered(edge_rows)
    spark, n, uri = ids.sparkSession, ids.count(), located(edge_rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, near = _links(uri, n)
        walks = max(1, min(WALKS, WALKED // max(1, len(near))))
        total, room = np.zeros(n), _room(walks * n)
        for pdf in frames:
            sources = pdf["node"].to_numpy()
            sources = sources[start[sources + 1] > start[sources]]
            for k in range(0, len(sources), walks):
                _dependencies(start, near, sources[k : k + walks], n, total, room)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"node": at, "part": total[at]})

    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    sums = spark.range(n).select(F.col("id").alias("node")).repartition(max(8, 4 * spark.sparkContext.defaultParallelism), "node").mapInPandas(run, "node bigint, part double").groupBy("node").agg(F.sum("part").alias("part"))
    return ids.join(sums.withColumnRenamed("node", "id"), "id", "left").select("node", F.round(F.coalesce("part", F.lit(0.0)) * scale, 9).alias("betweenness"))


def _room(size: int) -> tuple[np.ndarray, ...]:
    return np.zeros(size), np.zeros(size, bool), np.zeros(size, np.int32), np.zeros(size), np.zeros(size)


def _dependencies(start: np.ndarray, near: np.ndarray, sources: np.ndarray, n: int, total: np.ndarray | None = None, room: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """Sum over the sources of the share of their shortest paths that pass each node; all of them walk together, level by level.
    It is added to ``total``; ``room`` is left as it was, so that a walk costs what it reaches."""
    total = np.zeros(n) if total is None else total
    ways, seen, last, share, back = _room(len(sources) * n) if room is None else room
    front = np.arange(len(sources)) * n + sources
    ways[front], seen[front], levels, every = 1.0, True, [], [front]
    while len(front):
        node = front % n
        count = start[node + 1] - start[node]
        after = np.repeat(front - node, count) + near[np.repeat(start[node] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        new = ~seen[after]
        after = after[new]
        # links of a node stand together, before and after those to earlier levels are left out
        kept = np.diff(np.concatenate([[0], np.cumsum(new)])[np.concatenate([[0], np.cumsum(count)])])
        front, kept = front[kept > 0], kept[kept > 0]
        np.add.at(ways, after, np.repeat(ways[front], kept))
        levels.append((front, np.cumsum(kept) - kept, after))
        # the last to be written stands for a node that is reached more than once
        order = np.arange(len(after), dtype=np.int32)
        last[after] = order
        front = after[last[after] == order]
        seen[front] = True
        every.append(front)
    for (before, begin, after), reached in zip(reversed(levels), reversed(every), strict=False):
        if len(before):
            # what a node reached hands back for each way that leads to it
            back[reached] = (1 + share[reached]) / ways[reached]
            share[before] = ways[before] * np.add.reduceat(back[after], begin)
    share[every[0]] = 0.0
    reached = np.concatenate(every)
    np.add.at(total, reached % n, share[reached])
    ways[reached], seen[reached], share[reached] = 0.0, False, 0.0
    return total


def betweenness_centrality(spark: SparkSession, base: str) -> DataFrame:
    return betweenness(edges(spark, base))


def greedy_modularity(edge_rows: DataFrame) -> DataFrame:
    """(node, community) by greedy merging for the greatest gain of modularity; one worker holds the whole graph."""
    ids, pairs = _numbered(undirected(edge_rows))
    uri, n = located(pairs), ids.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            table = fetched(uri)
            found = _greedy(n, *(table.column(c).to_numpy() for c in "st"))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(found)], ["id", "root"])

    found = cut(ids.sparkSession.range(0, 1, 1, 1).mapInArrow(run, "id bigint, root bigint"))
    return ids.join(found, "id").join(ids.select(F.col("id").alias("root"), F.col("node").alias("community")), "root").select("node", "community")


def _greedy(n: int, s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The least member of each node's community. Numbers are in the order of the names: ties fall as they would by name.

    A gain only falls while the weight between two communities stays, so a pair waits in the heap with a gain it once had, and is
    put back with what it has now when its turn comes; a pair whose weight rises is put in again."""
    import heapq

    m = len(s)
    number = list(range(n))
    weight: list[dict[int, int] | None] = [{} for _ in number]
    heap = []
    degree = (np.bincount(s, minlength=n) + np.bincount(t, minlength=n)).tolist()
    double = 2.0 * m * m
    for i in range(0, m, 100_000):
        for a, b in zip(s[i : i + 100_000].tolist(), t[i : i + 100_000].tolist(), strict=True):
            # one object a number
            a, b = number[a], number[b]
            if a > b:
                a, b = b, a
            weight[a][b] = weight[b][a] = 1
            heap.append((degree[a] * degree[b] / double - 1 / m, a, b))
    parent = number[:]
    heapq.heapify(heap)
    bound = max(1000, 2 * len(heap))
    while heap:
        g, a, b = heapq.heappop(heap)
        if g >= 0:
            break
        near = weight[a]
        if near is None or (w := near.get(b)) is None:
            continue
        v = degree[a] * degree[b] / double - w / m
        if v != g:
            if g < v < 0:
                heapq.heappush(heap, (v, a, b))
            continue
        degree[a] += degree[b]
        parent[b] = a
        own = degree[a]
        for x, w in weight[b].items():
            other = weight[x]
            del other[b]
            if x != a:
                other[a] = near[x] = w = near.get(x, 0) + w
                v = own * degree[x] / double - w / m
                if v < 0:
                    heapq.heappush(heap, (v, a, x) if a < x else (v, x, a))
        weight[b] = None
        if len(heap) > bound:
            # most of it is out of date: the pairs as they stand now say the same
            heap = [(v, a, b) for a, near in enumerate(weight) if near for b, w in near.items() if a < b and (v := degree[a] * degree[b] / double - w / m) < 0]
            heapq.heapify(heap)
            bound = max(1000, 2 * len(heap))
    # a merger keeps the lesser number, so it comes before what it took in, and is the least of its members
    for x in range(n):
        parent[x] = parent[parent[x]]
    return np.array(parent, np.int64)


QUERIES = {
    "graph_size": graph_size,
    "degree_centrality": degree_centrality,
    "clustering_coefficients": clustering_coefficients,
    "average_clustering": average_clustering,
    "first_nodes": first_nodes,
    "analytics_summary": analytics_summary,
    "page_ranks": page_ranks,
    "graph_components": graph_components,
    "communities": communities,
    "betweenness_centrality": betweenness_centrality,
    "greedy_communities": lambda spark, base: greedy_modularity(edges(spark, base)),
}
EDGES = "e as (select distinct trim(source, ' \t\n\r') src, trim(target, ' \t\n\r') tgt from relations where trim(source, ' \t\n\r') <> '' and trim(target, ' \t\n\r') <> ''), n as (select src node from e union select tgt from e)"
_ROUNDS = 60
_PR = ", ".join(
    f"r{k} as materialized (select n.node, 0.15 / t.c + 0.85 * (select coalesce(sum(rank), 0) from r{k - 1} x where not exists (select 1 from e where e.src = x.node)) / t.c + 0.85 * coalesce(g.got, 0) rank from n cross join t left join (select e.tgt node, sum(r.rank / d.k) got from e join r{k - 1} r on r.node = e.src join d on d.src = e.src group by 1) g on g.node = n.node)"
    for k in range(1, _ROUNDS + 1)
)
_MOVES = " union all ".join(f"select {k} k, sum(abs(a.rank - b.rank)) d from r{k} a join r{k - 1} b using (node)" for k in range(1, _ROUNDS + 1))
_RANKS = " union all ".join(f"select {k} k, node, rank from r{k}" for k in range(1, _ROUNDS + 1))
_LP = ", ".join(
    f"h{k} as materialized (select node, min(label) label from (select node, label, n, max(n) over (partition by node) m from (select s.x node, l.label, count(*) n from s join h{k - 1} l on l.node = s.y group by 1, 2)) where n = m group by 1)"
    for k in range(1, 9)
)
_CC = """u as (select distinct least(src, tgt) a, greatest(src, tgt) b from e where src <> tgt), s as (select a x, b y from u union all select b, a from u),
d as (select x node, count(*) degree from s group by 1), t as (select p.x node, count(*) // 2 triangles from s p join s q on p.x = q.x and p.y <> q.y join s r on r.x = p.y and r.y = q.y group by 1),
cc as (select d.node, degree, coalesce(triangles, 0) triangles, case when degree > 1 then round(2 * coalesce(triangles, 0) / (degree * (degree - 1)), 6) else 0.0 end coefficient from d left join t using (node)),
ac as (select round(coalesce(sum(cast(round(coefficient * 1000000) as bigint)), 0) / 1000000 / greatest((select count(*) from n), 1), 6) clustering, cast(coalesce(sum(triangles), 0) // 3 as bigint) triangles from cc)"""
_DEGREE = "o as (select src node, count(*) k from e group by 1), i as (select tgt node, count(*) k from e group by 1), dc as (select n.node, coalesce(o.k, 0) as out_degree, coalesce(i.k, 0) as in_degree, round((coalesce(o.k, 0) + coalesce(i.k, 0)) / ((select count(*) from n) - 1), 6) as centrality from n left join o using (node) left join i using (node))"
ORACLE = {
    "graph_size": f"with {EDGES} select nodes, edges, round(edges / (nodes * (nodes - 1)), 9) as density from (select count(*) edges from e), (select count(*) nodes from n)",
    "degree_centrality": f"with {EDGES}, o as (select src node, count(*) k from e group by 1), i as (select tgt node, count(*) k from e group by 1) select n.node, coalesce(o.k, 0) as out_degree, coalesce(i.k, 0) as in_degree, round((coalesce(o.k, 0) + coalesce(i.k, 0)) / ((select count(*) from n) - 1), 6) as centrality from n left join o using (node) left join i using (node)",
    "clustering_coefficients": f"with {EDGES}, {_CC} select node, degree, triangles, coefficient from cc",
    "average_clustering": f"with {EDGES}, {_CC} select clustering, triangles from ac",
    "first_nodes": f"""with {EDGES}, {_DEGREE}, a as (select uri, trim(source, ' \t\n\r') src, trim(target, ' \t\n\r') tgt from relations where uri is not null and trim(source, ' \t\n\r') <> '' and trim(target, ' \t\n\r') <> ''),
b as (select node, min(struct_pack(u := uri, p := p)) pl from (select uri, 0 p, src node from a union all select uri, 1, tgt from a) group by 1), f as (select node, row_number() over (order by pl, node) seq from b)
select node, cast(seq as integer) as seq, round(centrality, 4) as centrality from f join dc using (node) where seq <= 20""",
    "analytics_summary": f"""with recursive {EDGES}, {_CC}, {_DEGREE}, g as (select src a, tgt b from e union select tgt, src from e union select node, node from n), w(node, seen) as (select a, b from g union select g.a, w.seen from w join g on g.b = w.node), cp as (select node, min(seen) c from w group by 1)
select 'nodes' as metric, cast(count(*) as double) as value from n union all select 'edges', count(*) from e union all select 'density', round((select count(*) from e) / ((select count(*) from n) * ((select count(*) from n) - 1)), 9)
union all select 'clustering', clustering from ac union all select 'components', count(distinct c) from cp union all select 'greatest_degree', max(in_degree + out_degree) from dc""",
    "communities": f"with {EDGES}, u as (select distinct least(src, tgt) a, greatest(src, tgt) b from e where src <> tgt), s as materialized (select a x, b y from u union all select b, a from u), h0 as (select distinct x node, x label from s), {_LP} select node, label as community from h8",
    "page_ranks": f"with {EDGES}, t as (select count(*) c from n), d as (select src, count(*) k from e group by 1), r0 as materialized (select node, 1.0 / c rank from n, t), {_PR}, mv as ({_MOVES}), rk as ({_RANKS}) select node, round(rank, 9) as rank from rk where k = (select min(k) from mv, t where d < c * 1e-6)",
    "graph_components": f"with recursive {EDGES}, s as (select src a, tgt b from e union select tgt, src from e union select node, node from n), w(node, seen) as (select a, b from s union select s.a, w.seen from w join s on s.b = w.node) select node, min(seen) as component from w group by 1",
}
