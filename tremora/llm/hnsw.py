"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one node that lists its smallest ids (a search for k can return no others, as
ties go to the smaller id), so copies of one vector neither crowd a shard nor part its graph.
Nodes are dealt into shards of about ``SHARD_ROWS`` by a hash of the vector; a task builds a shard's
graph and stores it as flat arrays: vectors, and for each layer its nodes and a fixed number of
neighbours each. Queries, in blocks, meet every shard, all of a block at once; candidates are measured again in double
precision on the original vectors, and the shards' results are merged. No row is left out of the
index.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component take no
part, neither do rows without id; vectors of different dimensions never meet; repeated rows count
once; fewer candidates than k give fewer rows; other columns are not read; an empty table gives an
empty one.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tremora.session import written

SHARD_ROWS = 4096
#: Queries of a block.
BLOCK_ROWS = 1024
#: Neighbours in the upper layers, and in the lowest.
M, M0 = 12, 24
BUILD_WIDTH, SEARCH_WIDTH = 80, 128
#: Nodes inserted at once, nodes of a beam expanded at once, and numbers held by a step of either.
BATCH, EXPAND, CELLS = 512, 4, 1 << 19


class Graph:
    """Flat arrays: ``links[l][row]`` are neighbours (-1: none); ``nodes[l][row]`` its node.

    Nodes are inserted in batches that double up to ``BATCH``: a batch takes its candidates from all
    nodes up to its own end by one distance matrix, chooses diverse ones, and links back.
    """

    def __init__(self, vectors: np.ndarray, nodes=None, links=None, entry: int = 0) -> None:
        # by the largest component, so that no square overflows or vanishes
        most = np.abs(vectors).max() if vectors.size else 1.0
        self.vectors, self.scale, self.entry = vectors / most, most, entry
        self.squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.nodes, self.links = nodes or [], links or []
        self.place = []
        for layer in self.nodes:
            rows = np.full(len(vectors), -1, np.int32)
            rows[layer] = np.arange(len(layer))
            self.place.append(rows)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 11) -> "Graph":
        rng = np.random.default_rng(seed)
        n = len(vectors)
        tops = np.minimum((-np.log(1 - rng.random(n)) / np.log(M)).astype(int), 8)
        layers = int(tops.max()) + 1 if n else 0
        nodes = [np.flatnonzero(tops >= k).astype(np.int32) for k in range(layers)]
        links = [np.full((len(layer), M if k else M0), -1, np.int32)
                 for k, layer in enumerate(nodes)]
        graph = cls(vectors, nodes, links, int(nodes[-1][0]) if n else 0)
        first = 0
        while first < n:
            last = min(n, first + min(max(first, 1), BATCH))
            for layer in range(layers):
                graph._insert(first, last, layer)
            first = last
        return graph

    def _insert(self, first: int, last: int, layer: int) -> None:
        lo, hi = np.searchsorted(self.nodes[layer], [first, last])
        new, all_ = self.nodes[layer][lo:hi], self.nodes[layer][:hi]
        if not len(new) or len(all_) < 2:
            return
        gap = (self.squares[new][:, None] + self.squares[all_]
               - 2 * self.vectors[new] @ self.vectors[all_].T)
        gap[np.arange(len(new)), np.arange(lo, hi)] = np.inf
        width = min(BUILD_WIDTH, len(all_) - 1)
        near = np.argpartition(gap, width - 1, axis=1)[:, :width]
        gap = np.take_along_axis(gap, near, 1)
        links = self.links[layer]
        links[lo:hi] = self._diverse(all_[near], gap, links.shape[1])
        # back from the chosen ones, where they do not point here already
        source, target = np.repeat(new, links.shape[1]), links[lo:hi].ravel()
        real = target >= 0
        source, target = source[real], target[real]
        rows = self.place[layer][target]
        fresh = ~(links[rows] == source[:, None]).any(1)
        self._link_back(layer, rows[fresh], source[fresh])

    def _link_back(self, layer: int, rows: np.ndarray, sources: np.ndarray) -> None:
        links = self.links[layer]
        order = np.lexsort((self._gaps(self.nodes[layer][rows], sources), rows))
        rows, sources = rows[order], sources[order]
        changed, start, count = np.unique(rows, return_index=True, return_counts=True)
        at = np.arange(len(rows)) - np.repeat(start, count)
        kept = at < BUILD_WIDTH
        wide = np.full((len(changed), links.shape[1] + min(int(count.max(initial=0)), BUILD_WIDTH)),
                       -1, np.int32)
        wide[:, :links.shape[1]] = links[changed]
        wide[np.repeat(np.arange(len(changed)), count)[kept], links.shape[1] + at[kept]] = (
            sources[kept])
        gap = np.full(wide.shape, np.inf)
        row, column = np.nonzero(wide >= 0)
        gap[row, column] = self._gaps(self.nodes[layer][changed[row]], wide[row, column])
        links[changed] = self._diverse(wide, gap, links.shape[1])

    def _gaps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Squared distances of the pairs, some at a time."""
        step, out = max(1, CELLS // max(1, self.vectors.shape[1])), np.empty(len(a))
        for k in range(0, len(a), step):
            gap = self.vectors[a[k:k + step]] - self.vectors[b[k:k + step]]
            out[k:k + step] = np.einsum("ij,ij->i", gap, gap)
        return out

    def _diverse(self, ids: np.ndarray, gap: np.ndarray, most: int) -> np.ndarray:
        """Per row ``most`` of the candidates, nearest first: those nearer to a chosen one than to
        the row's point only to fill up. No candidate: an infinite gap."""
        out = np.full((len(ids), most), -1, np.int32)
        width = ids.shape[1]
        step = max(1, CELLS // (width * max(width, self.vectors.shape[1])))
        for k in range(0, len(ids), step):
            order = np.argsort(gap[k:k + step], axis=1, kind="stable")
            some = np.take_along_axis(ids[k:k + step], order, 1)
            far = np.take_along_axis(gap[k:k + step], order, 1)
            points, squares = self.vectors[some], self.squares[some]
            among = (squares[:, :, None] + squares[:, None, :]
                     - 2 * points @ points.transpose(0, 2, 1))
            nearest = np.full(some.shape, np.inf)
            chosen = np.zeros(some.shape, bool)
            for j in range(width):
                take = ((nearest[:, j] >= far[:, j]) & np.isfinite(far[:, j])
                        & (chosen.sum(1) < most))
                chosen[take, j] = True
                nearest[take] = np.minimum(nearest[take], among[take, j])
            first = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
            first.sort(axis=1)
            picked = np.take_along_axis(some, first, 1)
            picked[np.isinf(np.take_along_axis(far, first, 1))] = -1
            out[k:k + step, :picked.shape[1]] = picked
        return out

    def search(self, points: np.ndarray, width: int) -> np.ndarray:
        """Per point about the ``width`` nearest nodes (-1: no more), nearest first; all nodes, if
        there are no more. All points walk at once."""
        n = len(self.vectors)
        if n <= width:
            return np.tile(np.arange(n, dtype=np.int32), (len(points), 1))
        step = max(1, (4 * CELLS) // n)
        return np.concatenate([self._walk(points[k:k + step] / self.scale, width)
                               for k in range(0, len(points), step)])

    def _to(self, points: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        gap = self.vectors[ids] - points[rows]
        return np.einsum("ij,ij->i", gap, gap)

    def _walk(self, points: np.ndarray, width: int) -> np.ndarray:
        count = len(points)
        all_rows = np.arange(count)
        here = np.full(count, self.entry, np.int32)
        gap = self._to(points, all_rows, here)
        for layer in range(len(self.links) - 1, 0, -1):
            moving = all_rows
            while len(moving):  # downhill to the nearest node of the layer
                near = self.links[layer][self.place[layer][here[moving]]]
                far = np.full(near.shape, np.inf)
                row, column = np.nonzero(near >= 0)
                far[row, column] = self._to(points, moving[row], near[row, column])
                best = far.argmin(1)
                far = far[np.arange(len(moving)), best]
                closer = far < gap[moving]
                here[moving[closer]] = near[np.arange(len(moving)), best][closer]
                gap[moving[closer]] = far[closer]
                moving = moving[closer]
        ids = np.full((count, width), -1, np.int32)
        far = np.full((count, width), np.inf)
        ids[:, 0], far[:, 0] = here, gap
        done = ids < 0
        seen = np.zeros((count, len(self.vectors)), bool)
        seen[all_rows, here] = True
        links, place = self.links[0], self.place[0]
        active = all_rows
        while len(active):
            # the nearest ones of each beam that were not yet expanded
            order = np.argsort(done[active], axis=1, kind="stable")[:, :EXPAND]
            picked = ids[active[:, None], order]
            fit = ~done[active[:, None], order]
            done[active[:, None], order] = True
            found_row, found_id = [], []
            for k in range(picked.shape[1]):
                row = np.flatnonzero(fit[:, k])
                near = links[place[picked[row, k]]]
                at = np.repeat(row, near.shape[1])
                near = near.ravel()
                fresh = (near >= 0) & ~seen[active[at], near]
                at, near = at[fresh], near[fresh]
                seen[active[at], near] = True
                found_row.append(at)
                found_id.append(near)
            at, near = np.concatenate(found_row), np.concatenate(found_id)
            gaps = self._to(points, active[at], near)
            # only what beats the end of a beam enters it
            better = gaps < far[active[at], -1]
            at, near, gaps = at[better], near[better], gaps[better]
            if len(at):
                order = np.argsort(at, kind="stable")
                at, near, gaps = at[order], near[order], gaps[order]
                rows, start, size = np.unique(at, return_index=True, return_counts=True)
                slot = np.arange(len(at)) - np.repeat(start, size)
                line = np.repeat(np.arange(len(rows)), size)
                shape = (len(rows), int(size.max()))
                new_ids, new_far = np.full(shape, -1, np.int32), np.full(shape, np.inf)
                new_ids[line, slot], new_far[line, slot] = near, gaps
                changed = active[rows]
                both = np.concatenate([far[changed], new_far], 1)
                order = np.argsort(both, axis=1, kind="stable")[:, :width]
                far[changed] = np.take_along_axis(both, order, 1)
                ids[changed] = np.take_along_axis(
                    np.concatenate([ids[changed], new_ids], 1), order, 1)
                done[changed] = np.take_along_axis(
                    np.concatenate([done[changed], new_ids < 0], 1), order, 1)
            active = active[~done[active].all(1)]
        return ids


def usable(vectors: DataFrame, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part."""
    infinite = float("inf")
    vector = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
        & F.exists(vector, lambda x: x != 0))


INDEX = ("dim int, shard bigint, vectors binary, members array<array<bigint>>, entry int, "
         "nodes array<binary>, links array<binary>")


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all shards as a written table of flat arrays, one row per shard."""
    order = W.partitionBy("vector").orderBy("vec_id")
    nodes = (rows.distinct().withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_list(
            "vec_id")).alias("ids")))
    nodes = written(nodes, "vectors")
    shards = max(1, -(-nodes.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vector"), F.lit(shards))

    def run(key, group):
        dim, number = (v.as_py() for v in key)
        flat = group.column("vector").combine_chunks()
        exact = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        members = group.column("ids").to_pylist()
        # mixed, the same way in every attempt: neighbours often have ids in a row
        order = np.argsort([m[0] for m in members], kind="stable")
        order = order[np.random.default_rng(7).permutation(len(order))]
        exact = exact[order]
        graph = Graph.build(exact)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([number], pa.int64()),
            "vectors": pa.array([exact.tobytes()], pa.binary()),
            "members": pa.array([[members[i] for i in order]], pa.list_(pa.list_(pa.int64()))),
            "entry": pa.array([graph.entry], pa.int32()),
            "nodes": pa.array([[x.tobytes() for x in graph.nodes]], pa.list_(pa.binary())),
            "links": pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary()))})

    built = nodes.select(F.size("vector").alias("dim"), shard.alias("shard"), "vector", "ids")
    return written(built.groupBy("dim", "shard").applyInArrow(run, INDEX), "hnsw")


def load(row: dict) -> Graph:
    dim = row["g_dim"]
    exact = np.frombuffer(row["vectors"]).reshape(-1, dim)
    nodes = [np.frombuffer(x, np.int32) for x in row["nodes"]]
    links = [np.frombuffer(x, np.int32).reshape(len(n), -1) for n, x in zip(nodes, row["links"])]
    graph = Graph(exact, nodes, links, row["entry"])
    graph.exact, graph.members = exact, row["members"]
    return graph


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
            width: int = SEARCH_WIDTH, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest other rows found."""
    index = build_index(usable(vectors, id_col, vector_col), k, shard_rows)
    asked = usable(queries, id_col, vector_col).distinct().select(
        F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("dim"))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    graphs = index.select(F.col("dim").alias("g_dim"), "shard", each.alias("g_block"), "vectors",
                          "members", "entry", "nodes", "links")
    # every block of queries goes to every shard of its dimension
    wanted = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).join(
        index.select("dim", F.col("shard").alias("to_shard")), "dim")

    def run(key, questions, shard):
        found: tuple[list, list, list] = ([], [], [])
        asked_ids = questions.column("query_id").to_pylist()
        points = np.array(questions.column("vector").to_pylist(), float)
        for row in shard.to_pylist():
            graph = load(row)
            if not len(asked_ids):
                continue
            for question, exact, hits in zip(asked_ids, points,
                                             graph.search(points, max(width, k + 1))):
                hits = hits[hits >= 0]
                gap = graph.exact[hits] - exact
                scores = np.sqrt((gap * gap).sum(1)).tolist()
                best = heapq.nsmallest(k, ((s, i) for s, h in zip(scores, hits)
                                           for i in graph.members[h] if i != question))
                for score, vec_id in best:
                    for column, value in zip(found, (question, vec_id, score)):
                        column.append(value)
        return pa.table({"query_id": pa.array(found[0], pa.int64()),
                         "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    hits = wanted.groupBy("dim", "to_shard", "block").cogroup(
        graphs.groupBy("g_dim", "shard", "g_block")).applyInArrow(
        run, "query_id bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
