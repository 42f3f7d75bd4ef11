"""Approximate nearest neighbours: one navigable small-world graph per shard.

Vectors are made distinct first (copies have equal scores, and would link only to each
other), dealt into shards by a hash, and each shard's graph is built by one task: every
vector is on level 0, one in ``LINKS`` of a level is on the next. Nodes enter in batches: a
batch descends from the top, searches each of its levels with a beam, and links to diverse
near nodes, both ways. The index is a table with one row per shard, whose neighbours lie in
flat arrays. Queries go to every shard in blocks; each pair of shard and block is one task,
and shard results are merged with a rank limit that applies before the shuffle. Scores are
computed anew in double precision.

A query costs one descent per shard, so shards are as large as a task may hold
(``SHARD_BYTES`` of vectors and links; 80,000 vectors of 64 components). Small tables get
smaller shards, down to ``LEAST_ROWS``, while cores of the cluster would be idle. A shard is
read once per ``QUERY_BYTES`` of queries, in which time it answers tens of thousands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.shipping import ship_package
from ledgerline.sinks.files import Stage

#: Bytes of vectors and links in a shard, and of query vectors that meet a shard in one task.
SHARD_BYTES, QUERY_BYTES = 32 << 20, 16 << 20
#: Vectors below which a shard is not cut further to employ more cores.
LEAST_ROWS = 4096
LINKS, GROUND_LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 32, 96, 128
#: Nodes that enter together, queries that descend together, nodes expanded per step.
BATCH, EXPAND = 256, 4
TOP = 20
INDEX = (
    "dim int, shard int, n int, entry int, nodes array<array<int>>, links array<array<int>>, "
    "ids array<bigint>, vectors array<float>"
)
FOUND = "query_id bigint, rep bigint, score double"


class Graph:
    """``links[level]`` holds for each node its neighbours on that level, -1 where it has none."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        draw = np.random.default_rng(n).random(n)
        self.level = np.minimum((-np.log(1 - draw) / np.log(LINKS)).astype(int), 8)
        top = int(self.level.max(initial=0))
        self.links = [np.full((n, GROUND_LINKS if i == 0 else LINKS), -1, np.int32) for i in range(top + 1)]
        self.entry = int(self.level.argmax()) if n else -1

    def build(self) -> Graph:
        # Upper levels first, so that whoever enters finds them complete.
        order = np.argsort(-self.level, kind="stable")
        start = 1
        while start < len(order):
            end = min(len(order), start + min(BATCH, start))
            self.enter(order[start:end])
            start = end
        return self

    def enter(self, new: np.ndarray) -> None:
        vectors = self.vectors[new]
        at = np.full((len(new), 1), self.entry)
        among = vectors @ vectors.T
        for level in range(len(self.links) - 1, -1, -1):
            here = self.level[new] >= level
            ids, scores = self.beam(vectors, at, level, BUILD_BEAM if here.any() else 1)
            if here.any():
                # A batch does not find its own nodes in the graph yet, so they are added.
                peers = np.flatnonzero(here)
                own = among[np.ix_(peers, peers)].copy()
                np.fill_diagonal(own, -np.inf)
                near = np.concatenate([ids[peers], np.broadcast_to(new[peers], own.shape)], axis=1)
                score = np.concatenate([scores[peers], own], axis=1)
                width = self.links[level].shape[1]
                chosen = self.diverse(near, score, width, 2 * width)
                self.links[level][new[peers]] = chosen
                self.link_back(new[peers], chosen, level)
            at = ids[:, : max(1, min(4, ids.shape[1]))]

    def link_back(self, new: np.ndarray, chosen: np.ndarray, level: int) -> None:
        table = self.links[level]
        width = table.shape[1]
        there = chosen >= 0
        target, source = chosen[there], np.repeat(new, there.sum(axis=1))
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        added = np.full((len(nodes), int(count.max(initial=0))), -1, np.int32)
        column = np.arange(len(target)) - np.repeat(first, count)
        added[np.repeat(np.arange(len(nodes)), count), column] = source
        near = np.concatenate([table[nodes], added], axis=1)
        for at in range(0, len(nodes), BATCH):
            part = near[at : at + BATCH]
            own = np.einsum("ijk,ik->ij", self.vectors[part], self.vectors[nodes[at : at + BATCH]])
            own[part < 0] = -np.inf
            table[nodes[at : at + BATCH]] = self.diverse(part, own, width, 2 * width)

    def diverse(self, ids: np.ndarray, scores: np.ndarray, width: int, look_at: int) -> np.ndarray:
        """Of each row the nearest that are nearer to the row's node than to any chosen before;
        free places are filled with the nearest of the others. -1 pads."""
        order = np.argsort(-scores, axis=1, kind="stable")[:, :look_at]
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        real = np.isfinite(scores)
        for i in range(1, ids.shape[1]):
            real[:, i] &= ~((ids[:, :i] == ids[:, i : i + 1]) & real[:, :i]).any(axis=1)
        vectors = self.vectors[ids]
        mutual = np.einsum("ijk,ilk->ijl", vectors, vectors)
        taken = np.zeros(ids.shape, bool)
        for i in range(ids.shape[1]):
            close = np.where(taken, mutual[:, i], -np.inf).max(axis=1)
            taken[:, i] = real[:, i] & (scores[:, i] > close)
        # Chosen ones first, then the others; both by nearness.
        rank = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(real, rank, 1), np.take_along_axis(ids, rank, 1), -1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out.astype(np.int32)

    def beam(self, queries: np.ndarray, start: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes that a beam search from ``start`` finds, best first."""
        table, n = self.links[level], len(queries)
        row = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.vectors) + 1), bool)  # the last column stands for "none"
        seen[:, -1] = True
        ids = np.full((n, width), -1, np.int64)
        scores = np.full((n, width), -np.inf, np.float32)
        done = np.ones((n, width), bool)
        fresh = start
        while True:
            fresh = np.where(fresh < 0, len(self.vectors), fresh)
            fresh = np.sort(fresh, axis=1)
            known = seen[row, fresh]
            known[:, 1:] |= fresh[:, 1:] == fresh[:, :-1]
            seen[row, fresh] = True
            own = np.einsum("ijk,ik->ij", self.vectors[np.where(known, 0, fresh)], queries)
            own[known] = -np.inf
            ids = np.concatenate([ids, fresh], axis=1)
            scores = np.concatenate([scores, own], axis=1)
            done = np.concatenate([done, known], axis=1)
            best = np.argpartition(-scores, width - 1, axis=1)[:, :width]
            ids, scores, done = (np.take_along_axis(x, best, 1) for x in (ids, scores, done))
            todo = np.where(done, -np.inf, scores)
            k = min(EXPAND, width)
            pick = np.argpartition(-todo, k - 1, axis=1)[:, :k]
            open_ = np.isfinite(np.take_along_axis(todo, pick, 1))
            if not open_.any():
                order = np.argsort(-scores, axis=1, kind="stable")
                ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
                return np.where(np.isfinite(scores), ids, -1), scores
            np.put_along_axis(done, pick, True, 1)
            nodes = np.take_along_axis(ids, pick, 1)
            fresh = np.where(open_[:, :, None], table[np.where(open_, nodes, 0)], -1).reshape(n, -1)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.full((len(queries), 1), self.entry)
        for level in range(len(self.links) - 1, 0, -1):
            at = self.beam(queries, at, level, 8)[0][:, :4]
        ids, scores = self.beam(queries, at, 0, max(SEARCH_BEAM, k))
        return ids[:, :k], scores[:, :k]


def _stored(graph: Graph, dim: int, shard: int, ids: np.ndarray) -> pd.DataFrame:
    nodes = [np.flatnonzero(graph.level >= level).astype(np.int32) for level in range(len(graph.links))]
    links = [graph.links[level][own].ravel() for level, own in enumerate(nodes)]
    return pd.DataFrame({
        "dim": [dim], "shard": [shard], "n": [len(ids)], "entry": [graph.entry], "nodes": [nodes], "links": [links],
        "ids": [ids], "vectors": [graph.vectors.ravel()],
    })


def _restored(row: pd.Series) -> tuple[Graph, np.ndarray]:
    vectors = np.asarray(row["vectors"], np.float32).reshape(row["n"], row["dim"])
    graph = Graph.__new__(Graph)
    graph.vectors, graph.entry, graph.links = vectors, int(row["entry"]), []
    for level, (nodes, flat) in enumerate(zip(row["nodes"], row["links"])):
        table = np.full((len(vectors), LINKS if level else GROUND_LINKS), -1, np.int32)
        table[np.asarray(nodes)] = np.asarray(flat).reshape(len(nodes), -1)
        graph.links.append(table)
    return graph, np.asarray(row["ids"])


def usable(vectors: DataFrame) -> DataFrame:
    """``id`` and ``vector`` (float) of the rows that take part: with an id, and a vector that
    is not empty, not all zero, and holds neither NULL nor a non-finite component."""
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(3.4028234663852886e38)) & ~F.isnan(x))
    some = F.exists("vector", lambda x: x != 0)
    return vectors.where("id IS NOT NULL AND vector IS NOT NULL").where(sound & some)


def distinct_vectors(rows: DataFrame, k: int, stage: Stage) -> DataFrame:
    """``rep`` (smallest id of equal vectors), ``vector``, and ``id`` of its k + 1 first rows.

    More rows of one vector can never be among the k nearest of a query, as ties go to
    smaller ids. Repeated rows fold, and the limit applies, before the shuffles, so neither a
    very common row nor a very common vector is a burden."""
    first = Window.partitionBy("vector").orderBy("id")
    ranked = rows.distinct().withColumn("n", F.row_number().over(first)).where(f"n <= {k + 1}")
    return stage.save(ranked.withColumn("rep", F.first("id").over(first)).select("rep", "id", "vector"), "vectors")


def build_index(known: DataFrame, stage: Stage, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index table of distinct vectors (``rep``, ``vector``): one row per shard and length
    of vectors, each of about ``shard_bytes`` or less."""
    spark = known.sparkSession
    ship_package(spark)
    rows, size = known.agg(F.count("*"), F.sum(4 * (F.size("vector") + GROUND_LINKS + 3))).first()
    wanted = min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS))
    n_shards = max(1, wanted, -(-(size or 0) // shard_bytes))
    keyed = known.select("rep", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(n_shards)).cast("int").alias("shard"))

    def built(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        graph = Graph(np.stack(rows["vector"].to_numpy()).astype(np.float32)).build()
        return _stored(graph, int(key[0]), int(key[1]), rows["rep"].to_numpy())

    spread = keyed.repartition(n_shards, "dim", "shard")
    return stage.save(spread.groupBy("dim", "shard").applyInPandas(built, INDEX), "index")


def search(index: DataFrame, queries: DataFrame, k: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best found in each shard for each query (``query_id``, ``vector``)."""
    ship_package(index.sparkSession)
    n_shards = index.agg(F.max("shard") + 1).first()[0] or 0
    size = queries.agg(F.sum(4 * F.size("vector") + 8)).first()[0] or 0
    n_blocks = max(1, -(-size // query_bytes))
    asked = queries.select(
        "query_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(max(0, n_shards - 1)))).alias("shard"),
    )
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def found(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(asked):
            graph, reps = _restored(shard.iloc[0])
            for at in range(0, len(asked), BATCH):
                part = asked.iloc[at : at + BATCH]
                vectors = np.stack(part["vector"].to_numpy())
                ids, _ = graph.search(vectors.astype(np.float32), min(k, len(reps)))
                scores = np.einsum("ijk,ik->ij", graph.vectors[ids].astype(np.float64), vectors.astype(np.float64))
                kept = ids >= 0
                query = np.broadcast_to(part["query_id"].to_numpy()[:, None], ids.shape)
                out.append(pd.DataFrame({"query_id": query[kept], "rep": reps[ids[kept]], "score": scores[kept]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "rep": [], "score": []}).astype({"query_id": "int64", "rep": "int64", "score": "float64"})

    keys = ["dim", "shard", "block"]
    return shards.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(found, FOUND)


def nearest(vectors: DataFrame, is_query, stage: Stage, k: int = TOP, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """For each query row of ``vectors`` (``id`` long, ``vector`` array<float>) the ``k``
    nearest other ids: ``query_id``, ``rank`` (from 1), ``id``, ``score`` (inner product in
    double precision). Ties go to the smaller id; fewer candidates give fewer rows.

    Rows that are not usable take no part. Vectors of another length than the query's are no
    candidates. An id that comes with several vectors asks with each, and counts with the best
    score. An empty table gives no rows."""
    rows = usable(vectors)
    known = distinct_vectors(rows.select("id", "vector"), k, stage)
    index = build_index(known.where("id = rep"), stage, shard_bytes)
    queries = stage.save(rows.where(is_query).select(F.col("id").alias("query_id"), "vector").distinct(), "queries")
    # The query's own vector may be the best: one more distinct vector, and copies of each.
    hits = stage.save(search(index, queries, k + 1, query_bytes), "hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    best = hits.withColumn("n", F.row_number().over(order)).where(f"n <= {k + 1}")
    wide = best.join(known.select("rep", "id"), "rep").where("id <> query_id")
    wide = wide.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return wide.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", "id", "score")
