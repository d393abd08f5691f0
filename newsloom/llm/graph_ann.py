"""Approximate nearest neighbours with robust-pruned directed graphs.

Vectors are dealt to shards of bounded size by a hash. In every shard a
graph is built by insertion in growing batches: a greedy beam search from
the shard's medoid proposes neighbours, and pruning keeps a candidate only
if no kept one is closer to it, by the factor ``ALPHA``, than the point
itself, so edges stay diverse. Edges are linked back and overfull lists
pruned again. A query's beam search runs in every shard and the results are
merged by exact distance.

Equal vectors are one node that carries its smallest ids, as many as a
query can need, so one very common vector is no large group and doesn't
fill the graph with edges of length zero.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import shared_table

DEGREE = 32
SLACK = 48
BUILD_BEAM = 64
QUERY_BEAM = 96
ALPHA = 1.2
#: Nodes of a shard (2 MB of 64 floats) and queries searched by one task.
SHARD_ROWS = 8192
QUERY_ROWS = 4096
EXPAND = 4


class Graph:
    """The graph of one shard. ``edges`` has -1 in unused places."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, slack: int = SLACK, alpha: float = ALPHA,
                 edges: np.ndarray | None = None, entry: int | None = None):
        self.x = np.ascontiguousarray(x, np.float32)
        self.norm = np.einsum("nd,nd->n", self.x, self.x)
        self.degree, self.slack, self.alpha = degree, slack, alpha
        self.edges = np.full((len(x), slack), -1, np.int32) if edges is None else edges
        self.entry = int(np.argmin(self._near(self.x.mean(axis=0)[None])[0])) if entry is None else entry

    def _near(self, q: np.ndarray) -> np.ndarray:
        """Squared distances of queries to all nodes."""
        return self.norm[None] - 2 * q @ self.x.T + np.einsum("nd,nd->n", q, q)[:, None]

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beam search of all queries at once: ids (-1: none) and
        squared distances, nearest first."""
        b = len(q)
        q = np.ascontiguousarray(q, np.float32)
        qn = np.einsum("nd,nd->n", q, q)
        ids = np.full((b, beam), -1, np.int32)
        dist = np.full((b, beam), np.inf, np.float32)
        done = np.ones((b, beam), bool)
        seen = np.zeros((b, len(self.x) + 1), bool)
        seen[:, -1] = True  # the place of -1
        ids[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = self.norm[self.entry] - 2 * q @ self.x[self.entry] + qn
        seen[:, self.entry] = True
        active = np.arange(b)
        while len(active):
            a_ids, a_done = ids[active], done[active]
            order = np.argsort(a_done, axis=1, kind="stable")[:, :EXPAND]  # nearest not yet expanded
            pick = np.take_along_axis(a_ids, order, axis=1)
            pick[np.take_along_axis(a_done, order, axis=1)] = -1
            np.put_along_axis(a_done, order, True, axis=1)
            nb = np.where(pick[:, :, None] >= 0, self.edges[pick], -1).reshape(len(active), -1)
            nb = np.sort(nb, axis=1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            rows = np.broadcast_to(active[:, None], nb.shape)
            nb = np.where(seen[rows, nb], -1, nb)
            seen[rows, nb] = True
            width = int((nb >= 0).sum(axis=1).max())
            nb = -np.sort(-nb, axis=1)[:, :width]
            d = self.norm[nb] - 2 * np.matmul(self.x[nb], q[active][:, :, None])[:, :, 0] + qn[active][:, None]
            d[nb < 0] = np.inf
            all_d = np.concatenate([dist[active], d], axis=1)
            all_i = np.concatenate([a_ids, nb], axis=1)
            all_e = np.concatenate([a_done, nb < 0], axis=1)
            best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist[active] = np.take_along_axis(all_d, best, axis=1)
            ids[active] = np.take_along_axis(all_i, best, axis=1)
            done[active] = np.take_along_axis(all_e, best, axis=1)
            active = active[~done[active].all(axis=1)]
        ids[~np.isfinite(dist)] = -1
        return ids, dist

    def prune(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Robust pruning of the candidates (-1: none) of every point."""
        cand = np.sort(np.where(cand == points[:, None], -1, cand), axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        v = self.x[cand]
        p = self.x[points]
        to_p = self.norm[cand] - 2 * np.matmul(v, p[:, :, None])[:, :, 0] + self.norm[points][:, None]
        to_p[cand < 0] = np.inf
        order = np.argsort(to_p, axis=1, kind="stable")
        cand, to_p = np.take_along_axis(cand, order, axis=1), np.take_along_axis(to_p, order, axis=1)
        v = np.take_along_axis(v, order[:, :, None], axis=1)
        n = self.norm[cand]
        between = n[:, :, None] + n[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        alive = cand >= 0
        out = np.full((len(points), self.slack), -1, np.int32)
        at = np.arange(len(points))
        for k in range(self.degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            out[:, k] = np.where(some, cand[at, pick], -1)
            near = self.alpha ** 2 * between[at, pick] <= to_p
            alive &= ~(near & some[:, None])
            alive[at, pick] = False
        return out

    def build(self, beam: int = BUILD_BEAM, seed: int = 7) -> "Graph":
        """Insert all nodes, the medoid first, then in doubling batches of a
        sixteenth of what is there, 256 at most."""
        order = np.random.default_rng(seed).permutation(len(self.x)).astype(np.int32)
        order = np.concatenate([[self.entry], order[order != self.entry]]).astype(np.int32)
        at = 1
        while at < len(order):
            batch = order[at:at + max(1, min(256, at // 16 + 1))]
            at += len(batch)
            found, _ = self.search(self.x[batch], beam)
            self.edges[batch] = self.prune(batch, found)
            self._link_back(batch)
        return self

    def _link_back(self, batch: np.ndarray) -> None:
        target = self.edges[batch]
        src = np.repeat(batch, target.shape[1])
        dst = target.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        d = self.norm[src] + self.norm[dst] - 2 * np.einsum("nd,nd->n", self.x[src], self.x[dst])
        order = np.lexsort((d, dst))
        src, dst = src[order], dst[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        rank = np.arange(len(dst)) - np.repeat(first, count)
        new = np.full((len(nodes), int(count.max())), -1, np.int32)
        new[np.repeat(np.arange(len(nodes)), count), rank] = src
        both = np.concatenate([self.edges[nodes], new], axis=1)
        both = -np.sort(-both, axis=1)  # unused places last
        full = (both >= 0).sum(axis=1) > self.slack
        easy = both[~full][:, :self.slack]
        self.edges[nodes[~full]] = easy
        for part in np.array_split(np.flatnonzero(full), max(1, -(-int(full.sum()) // 512))):
            if len(part):
                self.edges[nodes[part]] = self.prune(nodes[part], both[part])


def _scale(x: np.ndarray) -> float:
    """Factor that brings a shard's vectors into the range in which the
    graph's single precision neither overflows nor loses them."""
    top = float(np.abs(x).max())
    return 1.0 if 1e-12 < top < 1e12 else 1.0 / top


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision of each query to its own row
    of candidates ``x``."""
    diff = x - q[:, None]
    with np.errstate(over="ignore"):
        out = np.sqrt((diff ** 2).sum(axis=2))
    if np.isinf(out).any():  # squares above the range of doubles
        top = np.abs(diff).max(axis=2, initial=0.0)
        scaled = diff / np.where(top > 0, top, 1.0)[:, :, None]
        out = np.where(np.isinf(out), top * np.sqrt((scaled ** 2).sum(axis=2)), out)
    return out


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node", ignore_index=True)
    x = np.stack(pdf.v.to_numpy())
    graph = Graph(x * _scale(x)).build()
    return pdf.assign(entry=graph.entry, edges=[e[e >= 0] for e in graph.edges])


def _search_shard(k: int, beam: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "node": pd.Series(dtype="int64"),
                              "ids": pd.Series(dtype="object"), "score": pd.Series(dtype="float64")})
        if not len(index) or not len(queries):
            return empty
        index = index.sort_values("node", ignore_index=True)
        edges = np.full((len(index), SLACK), -1, np.int32)
        for i, e in enumerate(index.edges):
            edges[i, :len(e)] = e
        x = np.stack(index.v.to_numpy())
        scale = _scale(x)
        graph = Graph(x * scale, edges=edges, entry=int(index.entry.iloc[0]))
        node, names, out = index.node.to_numpy(), index.ids.to_numpy(), []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at:at + 256]
            q = np.stack(part.v.to_numpy())
            ids, _ = graph.search(np.clip(q * scale, -1e15, 1e15), max(beam, k))
            exact = _distances(x[ids], q)
            exact[ids < 0] = np.inf
            order = np.argsort(node[ids], axis=1, kind="stable")
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(exact, order, axis=1), axis=1, kind="stable"), axis=1)[:, :k]
            best, score = np.take_along_axis(ids, order, axis=1), np.take_along_axis(exact, order, axis=1)
            found = best >= 0
            out.append(pd.DataFrame({"query_id": np.repeat(part.query_id.to_numpy(), found.sum(axis=1)), "node": node[best[found]],
                                     "ids": names[best[found]], "score": score[found]}))
        return pd.concat(out, ignore_index=True) if out else empty
    return run


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: not null, not all zero, every
    component a finite number; repeated rows once. The graph is searched in
    single precision; validity and scores are those of the original numbers."""
    ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
                  .filter("vec_id is not null and v is not null").filter(ok)


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index, one row per different vector: ``dim, shard, node, ids, v,
    entry, edges``; every row of ``vectors`` is in it. ``ids`` are the k + 1
    smallest ids of the vector, ``node`` the smallest. A shard is one group
    of about ``shard_rows`` rows whatever the data are."""
    rows = valid_vectors(vectors, id_col, vec_col)
    # Equal vectors: the smallest ids are picked per task before the shuffle.
    w = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("_n", F.dense_rank().over(w)).filter(F.col("_n") <= k + 1)
    nodes = shared_table(few.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
                         .withColumn("node", F.col("ids")[0]))
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"),
                         "node", "ids", "v")
    return shared_table(dealt.groupBy("dim", "shard").applyInPandas(
        _build_shard, "dim int, shard int, node long, ids array<long>, v array<double>, entry int, edges array<int>"))


def nearest(queries: DataFrame, index: DataFrame, k: int, beam: int = QUERY_BEAM,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query
    (vec_id, v), by Euclidean distance in double precision, ties to the
    smaller id, the query's own id left out. Queries are dealt to blocks of
    bounded size; every block meets every shard of its dimension once."""
    blocks = max(1, -(-queries.count() // query_rows))
    shards = index.select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard")).distinct()
    q = queries.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"),
                       F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("_block")).join(shards, F.col("dim") == F.col("_dim")).drop("dim")
    i = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = i.groupBy("dim", "shard", "block").cogroup(q.groupBy("_dim", "_shard", "_block")).applyInPandas(
        _search_shard(k + 1, beam), "query_id long, node long, ids array<long>, score double")
    best = found.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "node"))) \
                .filter(F.col("_r") <= k + 1)
    each = best.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id") \
               .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))) \
               .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_all(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
               vec_col: str = "embedding", shard_rows: int = SHARD_ROWS, beam: int = QUERY_BEAM) -> DataFrame:
    """Nearest neighbours of the rows whose id is divisible by ``every``.

    Vectors that are null, zero or hold a null or non-finite component take
    no part, nor do rows with a null id. A query that occurs with several
    vectors is answered by the nearest to any of them. Vectors of another
    length are in other shards. With k or fewer candidates all are returned;
    an empty table gives an empty result; other columns are not read.
    """
    index = build_index(vectors, k, id_col, vec_col, shard_rows)
    queries = valid_vectors(vectors, id_col, vec_col).filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    return nearest(queries, index, k, beam)
