"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard.

Equal vectors, and those that differ by a power of two, are taken together first: one node stands for all copies and carries the smallest of their ids,
as many as an answer can need, so a vector that a third of the table shares is one node. Nodes are dealt to
shards by hash. Each shard's graph is built in one task and stored as flat arrays: for every level the nodes
on it and a fixed number of neighbours for each, -1 where there are fewer. A query is searched in every shard,
in blocks of queries; candidates are scored in double precision on the original vectors and the shards' best
are merged. Only vectors of the same length are compared.

Defined cases: null vectors, zero vectors and those with null or non-finite components take no part, neither
as queries nor as candidates; a query gets fewer rows where there are fewer candidates, none if there is none;
ties go to the smaller id; a repeated id is a candidate and a query once for each different vector it has; an
empty table gives an empty result. A row without an id takes no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut

NEIGHBOURS = 16
BUILD_WIDTH = 96
SEARCH_WIDTH = 160
SHARD_NODES = 4096
QUERY_BLOCK = 4096
INDEX = (
    "dim int, shard int, ids array<array<bigint>>, vectors array<double>, "
    "level_sizes array<int>, nodes array<int>, neighbours array<int>"
)
FOUND = "query_id long, query long, vec_id long, score double"


class Graph:
    """The graph over the rows of a matrix of unit vectors; level 0 holds every row and twice the neighbours."""

    def __init__(self, unit: np.ndarray, m: int = NEIGHBOURS):
        self.unit = unit
        self.m = m
        n = len(unit)
        self.base = np.full((n, 2 * m), -1, np.int32)
        self.upper: list[dict[int, np.ndarray]] = []
        self.seen = np.zeros(n, np.int32)
        self.tick = 0

    def links(self, level: int, node: int) -> np.ndarray:
        return self.base[node] if level == 0 else self.upper[level - 1][node]

    def nearest(self, q: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """Up to ``width`` (similarity, node) of a level, found by following links from the entries; nearest first."""
        self.tick += 1
        tick, seen, unit = self.tick, self.seen, self.unit
        for _, node in entries:
            seen[node] = tick
        best = entries[:]
        heapq.heapify(best)
        ahead = [(-s, node) for s, node in entries]
        heapq.heapify(ahead)
        while ahead:
            s, node = heapq.heappop(ahead)
            if len(best) >= width and -s < best[0][0]:
                break
            near = self.links(level, node)
            near = near[(near >= 0) & (seen[near] != tick)]
            if not len(near):
                continue
            seen[near] = tick
            close = unit[near] @ q
            if len(best) >= width:
                keep = close > best[0][0]
                near, close = near[keep], close[keep]
            for s, other in zip(close.tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, other))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, other))
                else:
                    continue
                heapq.heappush(ahead, (-s, other))
        return sorted(best, reverse=True)

    def spread(self, q: np.ndarray, nodes: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        """Of nodes in order of nearness, those nearer to q than to any one taken before; then the nearest others."""
        if len(nodes) <= most:
            return nodes
        vectors = self.unit[nodes]
        between = vectors @ vectors.T
        covered = np.full(len(nodes), -2.0, np.float32)
        taken = np.zeros(len(nodes), bool)
        count = 0
        for k, s in enumerate(close.tolist()):
            if s > covered[k]:
                taken[k] = True
                count += 1
                if count == most:
                    break
                np.maximum(covered, between[k], out=covered)
        if count < most:
            taken[np.flatnonzero(~taken)[: most - count]] = True
        return nodes[taken]

    def link(self, level: int, node: int, other: int, most: int) -> None:
        links = self.links(level, node)
        free = np.flatnonzero(links < 0)
        if len(free):
            links[free[0]] = other
            return
        nodes = np.append(links, np.int32(other))
        close = self.unit[nodes] @ self.unit[node]
        order = np.argsort(-close, kind="stable")
        kept = self.spread(self.unit[node], nodes[order], close[order], most)
        links[:] = -1
        links[: len(kept)] = kept

    def build(self, width: int = BUILD_WIDTH, seed: int = 7) -> Graph:
        n = len(self.unit)
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(self.m)).astype(int)
        self.entry, top = 0, -1
        for node in range(n):
            q, level = self.unit[node], int(levels[node])
            for high in range(1, level + 1):
                if len(self.upper) < high:
                    self.upper.append({})
                self.upper[high - 1][node] = np.full(self.m, -1, np.int32)
            if top < 0:
                self.entry, top = node, level
                continue
            entries = [(float(self.unit[self.entry] @ q), self.entry)]
            for high in range(top, level, -1):
                entries = self.nearest(q, entries, 1, high)
            for at in range(min(top, level), -1, -1):
                entries = self.nearest(q, entries, width, at)
                nodes = np.array([x for _, x in entries], np.int32)
                close = np.array([s for s, _ in entries], np.float32)
                kept = self.spread(q, nodes, close, self.m)
                self.links(at, node)[: len(kept)] = kept
                for other in kept.tolist():
                    self.link(at, other, node, self.m if at else 2 * self.m)
            if level > top:
                self.entry, top = node, level
        return self

    def flat(self) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Nodes per level from the top, the nodes, and all neighbours one after the other; the entry comes first."""
        sizes, nodes, links = [], [], []
        for level in reversed(self.upper):
            order = sorted(level, key=lambda x: (x != self.entry, x))
            sizes.append(len(order))
            nodes += order
            links += [level[x] for x in order]
        sizes.append(len(self.base))
        if not self.upper:
            nodes = [self.entry] if len(self.base) else []
        return sizes, np.array(nodes, np.int32), np.concatenate([*links, self.base.ravel()]).astype(np.int32)

    @classmethod
    def of(cls, unit: np.ndarray, sizes: list[int], nodes: np.ndarray, links: np.ndarray, m: int = NEIGHBOURS) -> Graph:
        graph = cls.__new__(cls)
        graph.unit, graph.m, graph.tick = unit, m, 0
        graph.seen = np.zeros(len(unit), np.int32)
        graph.entry = int(nodes[0])
        graph.upper, at = [], 0
        for size in sizes[:-1]:
            rows = links[at * m : (at + size) * m].reshape(size, m)
            graph.upper.insert(0, dict(zip(nodes[at : at + size].tolist(), rows)))
            at += size
        graph.base = links[at * m :].reshape(-1, 2 * m)
        return graph

    def search(self, q: np.ndarray, width: int) -> list[int]:
        entries = [(float(self.unit[self.entry] @ q), self.entry)]
        for level in range(len(self.upper), 0, -1):
            entries = self.nearest(q, entries, 1, level)
        return [node for _, node in self.nearest(q, entries, width, 0)]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine, so that no square overflows or vanishes."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponents)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    moderate = scaled(vectors)
    return (moderate / np.linalg.norm(moderate, axis=1, keepdims=True)).astype(np.float32)


def usable(vector: Column) -> Column:
    """A vector with only finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def to_one_exponent(vector: str) -> Column:
    """The vector times the power of two that moves its largest component to 1 or more and below 2."""
    largest = "array_max(transform({}, x -> abs(x)))"
    # Two steps, as no double holds the power for the smallest numbers; the logarithm may be off by one.
    moved = (
        f"transform({vector}, x -> x * pow(2D, -floor(floor(log2({largest.format(vector)})) / 2D)) "
        f"* pow(2D, -ceil(floor(log2({largest.format(vector)})) / 2D)))"
    )
    return F.expr(
        f"transform(array({moved}), v -> transform(v, x -> x * CASE WHEN {largest.format('v')} >= 2 THEN 0.5D "
        f"WHEN {largest.format('v')} < 1 THEN 2D ELSE 1D END + 0D))[0]"
    )


def build_index(vectors: DataFrame, copies: int, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per shard from (vec_id, vector): its nodes' ids, their vectors and the graph in flat arrays."""
    # The smallest ids of equal vectors. The rank limit is applied in every task before the shuffle.
    order = Window.partitionBy("vector").orderBy("vec_id")
    nodes = cut(
        vectors.withColumn("vector", to_one_exponent("vector"))
        .distinct()
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= copies)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("dim", F.size("vector"))
    )
    shards = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_nodes).cast("int").alias("_shards"))
    placed = nodes.join(F.broadcast(shards), "dim").withColumn(
        "shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("_shards")).cast("int")
    )

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        vectors = matrix(rows["vector"])
        sizes, nodes, links = Graph(unit_rows(vectors)).build().flat()
        return pd.DataFrame(
            {
                "dim": [key[0]],
                "shard": [key[1]],
                "ids": [list(rows["ids"])],
                "vectors": [vectors.ravel()],
                "level_sizes": [sizes],
                "nodes": [nodes],
                "neighbours": [links],
            }
        )

    return cut(
        placed.select("dim", "shard", "ids", F.col("ids")[0].alias("first"), "vector")
        .groupBy("dim", "shard")
        .applyInPandas(build, INDEX)
    )


def search_index(index: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, vec_id, score, rank) of the k nearest for every query (query_id, vector), itself left out."""
    queries = cut(queries.distinct().withColumn("dim", F.size("vector")))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = index.select("dim", "shard")
    asked = (
        queries.withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks)).cast("int"))
        .join(shards.withColumnRenamed("dim", "_dim"), F.col("dim") == F.col("_dim"))
        .select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), "query_id", F.xxhash64("vector").alias("query"), "vector")
    )
    searched = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(asked: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, float]] = []
        if len(asked) and len(searched):
            shard = searched.iloc[0]
            ids = list(shard["ids"])
            vectors = np.asarray(shard["vectors"], np.float64).reshape(len(ids), -1)
            units = unit_rows(vectors)
            vectors = scaled(vectors)
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            graph = Graph.of(
                units,
                list(shard["level_sizes"]),
                np.asarray(shard["nodes"], np.int32),
                np.asarray(shard["neighbours"], np.int32),
            )
            originals = matrix(asked["vector"])
            names = zip(asked["query_id"].tolist(), asked["query"].tolist())
            for (own, name), q, unit in zip(names, scaled(originals), unit_rows(originals)):
                found = np.array(graph.search(unit, width))
                score = (vectors[found] * q).sum(axis=1) / (norms[found] * np.sqrt((q * q).sum()))
                # Every node but the own gives an id, so k + 1 nodes and those that tie with the last give the best k.
                least = np.sort(score)[::-1][min(k, len(score) - 1)]
                best = [
                    (-s, i)
                    for s, node in zip(score.tolist(), found.tolist())
                    if s >= least
                    for i in ids[node]
                    if i != own
                ]
                out += [(own, name, i, -s) for s, i in heapq.nsmallest(k, best)]
        return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score"])

    found = (
        asked.groupBy("q_dim", "q_shard", "q_block")
        .cogroup(searched.groupBy("dim", "shard", "block"))
        .applyInPandas(search, FOUND)
    )
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest_neighbours(
    table: DataFrame,
    every: int = 50,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_nodes: int = SHARD_NODES,
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows for the rows whose id is divisible by ``every``."""
    rows = (
        table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        # So that 0 and -0 are one key.
        .withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    )
    index = build_index(rows, k + 1, shard_nodes)
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    return search_index(index, queries, k, width).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
