"""Top-k search by inner product over a neighbour graph.

The inner product is turned into a distance first: items become ``[x, sqrt(M^2
- |x|^2)]``, all of one length, so the nearest items are those with the
greatest product.  Equal vectors are one node.

*Building.*  Every node starts with random neighbours.  In each round it meets
its neighbours and a bounded number of the nodes that name it; within such a
group (at most twice ``degree`` + 1 vectors, one matrix product) each member
learns its best others, and every node keeps the ``degree`` best it heard of.
Rounds end when few edges change.

*Searching.*  All queries walk at once.  Each keeps a beam of its best nodes
seen; a round joins the beam's unvisited part with the graph, scores the nodes
not seen before and merges them in.  A query is done when its whole beam was
expanded.  Beams, visited pairs and edges are written tables, so a lost
executor costs one round; nothing but the entry vectors reaches the driver.

Every node also points to the next one in id order: the graph is connected,
and a beam as wide as the table finds everything.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reclab.functions.vectors import dot
from reclab.operators import search as S
from reclab.operators.ordering import global_index
from reclab.session import materialise

#: Nodes every query starts from (their vectors travel to the tasks).
ENTRIES = 32
#: Building ends when a smaller share of the edges is new.
SETTLED = 0.01


def _best(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key; a hot key is cut in every task before
    its rows meet (Spark limits the groups of a ranked window on both sides)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k).drop("place")


def _meet(degree: int):
    """For each group of nodes: every member's ``degree`` best others in it."""
    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            at = lists.offsets.to_numpy()
            members = lists.values
            ids = members.field(0).to_numpy()
            out = []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                if hi - lo < 2:
                    continue
                a = members.field(1).slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, -1)
                own = ids[lo:hi]
                near = a @ a.T
                np.fill_diagonal(near, -np.inf)
                k = min(degree, hi - lo - 1)
                top = np.argsort(-near, axis=1, kind="stable")[:, :k]
                out.append((np.repeat(own, k), own[top].ravel(), np.take_along_axis(near, top, axis=1).ravel()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 names=["pos", "to", "near"])

    return run


class NeighbourGraph:
    """Graph over ``items(id, v)``: out-degree at most ``2 * degree + 2``.

    ``nodes(pos, id, v, rest)``: one row per distinct vector, id the least of
    its items.  ``edges(pos, to)``: an array of positions.  An empty table
    gives a graph that finds nothing."""

    def __init__(self, items: DataFrame, degree: int = 16, rounds: int = 8, seed: int = 0):
        if degree < 1:
            raise ValueError("degree must be positive")
        self.spark, self.degree, self.seed = items.sparkSession, degree, seed
        classes = materialise(items.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
        stats = classes.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("n"), F.max(dot("v", "v")).alias("m2")).first()
        self.n_nodes, self.n_items, radius2 = stats["nodes"], stats["n"] or 0, stats["m2"] or 0.0
        self.nodes = materialise(
            global_index(classes.select("id", "v"), [F.col("id")], "pos").select(
                "pos", "id", "v", F.sqrt(F.greatest(F.lit(radius2) - dot("v", "v"), F.lit(0.0))).alias("rest")), "nodes")
        # the items behind a node that stands for several
        self.members = materialise(items.join(classes.where("n > 1").select("v", F.col("id").alias("first")), "v")
                                   .select("first", "id"), "members")
        self.rounds, self.edges = self._build(rounds)

    def _random(self, count: int) -> DataFrame:
        """(pos, to): ``count`` random others of every node."""
        n = F.lit(max(1, self.n_nodes))
        drawn = F.transform(F.sequence(F.lit(1), F.lit(count)), lambda j: F.pmod(
            F.xxhash64(F.col("pos"), j, F.lit(self.seed)), n))
        return self.nodes.select("pos", F.explode(F.array_distinct(drawn)).alias("to")).where("pos <> to")

    def _both_ways(self, edges: DataFrame) -> DataFrame:
        """Edges and, of those that point to a node, ``degree`` by hash."""
        back = _best(edges.select(F.col("to").alias("pos"), F.col("pos").alias("to")), ["pos"],
                     [F.xxhash64("pos", "to"), F.col("to")], self.degree)
        return edges.select("pos", "to").unionByName(back).distinct()

    def _build(self, rounds: int):
        sides = self.nodes.select(F.col("pos").alias("to"), F.concat("v", F.array("rest")).alias("a"))
        edges, done = materialise(self._random(self.degree), "edges"), 0
        while done < rounds and self.n_nodes > 1:
            groups = self._both_ways(edges).unionByName(self.nodes.select("pos", F.col("pos").alias("to"))).join(
                sides, "to").groupBy("pos").agg(F.collect_list(F.struct("to", "a")).alias("g"))
            heard = groups.select("g").mapInArrow(_meet(self.degree), "pos long, to long, near double")
            better = materialise(
                _best(heard.groupBy("pos", "to").agg(F.max("near").alias("near")), ["pos"],
                      [F.desc("near"), F.col("to")], self.degree).select("pos", "to"), "edges")
            fresh = better.join(edges, ["pos", "to"], "left_anti").count()
            edges, done = better, done + 1
            if fresh <= SETTLED * self.degree * self.n_nodes:
                break
        ring = self.nodes.select("pos", F.pmod(F.col("pos") + 1, F.lit(max(1, self.n_nodes))).alias("to")).where("pos <> to")
        every = self._both_ways(edges).unionByName(ring).unionByName(self._random(1))
        return done, materialise(every.groupBy("pos").agg(F.collect_set("to").alias("to")), "graph")

    def _start(self, queries: DataFrame) -> DataFrame:
        """(qid, pos, score) of the entry nodes."""
        at = sorted({i * self.n_nodes // ENTRIES for i in range(ENTRIES)})
        found = self.nodes.where(F.col("pos").isin(at)).select("pos", "v").toArrow()  # at most ENTRIES rows
        vectors = np.array(found.column(1).to_pylist(), np.float64)
        sent = self.spark.sparkContext.broadcast((found.column(0).to_numpy(), vectors))

        def run(batches):
            pos, x = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                q = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(len(q)), len(pos)))),
                     pa.array(np.tile(pos, len(q))), pa.array((q @ x.T).ravel())], names=["qid", "pos", "score"])

        return queries.select("qid", "q").mapInArrow(run, "qid long, pos long, score double")

    def search(self, queries: DataFrame, k: int = 10, beam: int = 64, exclude_self: bool = False):
        """``(qid, id, score, rank)`` of ``queries(id, v)``, ties to smaller ids,
        and the share of all (query, node) pairs that were scored."""
        if beam <= k:
            raise ValueError("the beam must be wider than k")
        if not self.n_nodes:
            return self.spark.createDataFrame([], "qid long, id long, score double, rank int"), 0.0
        asked = queries.select(F.col("id").alias("qid"), F.col("v").alias("q"))
        order = [F.desc("score"), F.col("pos")]
        seen = [materialise(self._start(asked), "visited")]
        front = materialise(_best(seen[0].withColumn("expanded", F.lit(False)), ["qid"], order, beam), "beam")
        while not front.where("NOT expanded").isEmpty():
            visited = reduce(DataFrame.unionByName, seen).select("qid", "pos")
            met = (front.where("NOT expanded").join(self.edges, "pos").select("qid", F.explode("to").alias("pos")).distinct()
                   .join(visited, ["qid", "pos"], "left_anti"))
            scored = met.join(self.nodes.select("pos", "v"), "pos").join(asked, "qid").select(
                "qid", "pos", dot("q", "v").alias("score"))
            seen.append(materialise(scored, "visited"))
            front = materialise(_best(
                front.withColumn("expanded", F.lit(True)).unionByName(seen[-1].withColumn("expanded", F.lit(False))),
                ["qid"], order, beam), "beam")
        pairs = sum(part.count() for part in seen)
        firsts = front.join(self.nodes.select("pos", F.col("id").alias("first")), "pos").select("qid", "first", "score")
        # of equal vectors only the smallest ids can be among the best k
        ranked = _best(self.members, ["first"], [F.col("id")], k + 1)
        found = firsts.join(ranked, "first", "left").select("qid", F.coalesce("id", "first").alias("id"), "score")
        if exclude_self:
            found = found.where("qid <> id")
        share = pairs / max(1, self.n_nodes * queries.count())
        return S._topk(found, k, None), share

    def max_degree(self) -> int:
        return self.edges.agg(F.max(F.size("to"))).first()[0] or 0
