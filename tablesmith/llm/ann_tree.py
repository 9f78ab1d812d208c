"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is trained on a bounded sample (``SAMPLE`` vectors by the hash of
their id) and sent to the tasks; every vector goes to a leaf by the nearest
centre on each level. A query visits leaves best-bin-first: a priority queue
holds the nodes seen so far by their distance, the nearest is opened next, and
an opened leaf is a visit. How many visits are needed is calibrated: sample
vectors search the sample exactly, and visits widen until ``RECALL`` of their
true neighbours lie in visited leaves. All vectors are denser than the sample,
so their neighbours are nearer and the calibration is on the safe side.

Equal vectors are one entry with its ``k + 1`` smallest ids (a query leaves out
its own), found by a window whose partial form runs before the shuffle. Leaves
are packed into chunks of at most about ``CHUNK`` entries, and the visits of a
leaf into blocks of queries, so a leaf or a group of equal queries of any size
is spread over tasks. A task keeps the k best of each of its queries; the last
step ranks these. Distances are computed in double precision from the original
vectors; only candidates within the rounding error of a product form are.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows with a null id, take no part; ties go to the smaller id;
equal ids of different vectors are separate candidates; with fewer than k
candidates all are returned; vectors of different dimensions are not compared;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesmith.llm.common import Scratch
from tablesmith.llm.embedding_dedup import usable

K = 10
SAMPLE = 16_384
BRANCHES = 8
LEAF = 128  # sample vectors in a leaf
CHUNK = 2048
QUERY_BLOCK = 512
RECALL = 0.96
CALIBRATION_QUERIES = 256


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * (x @ y.T), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(12):
        owner = _squares(x, centres).argmin(axis=1)
        for c in range(k):
            if (owner == c).any():
                centres[c] = x[owner == c].mean(axis=0)
    return centres


class Tree:
    """Centres of all nodes; ``children`` of a node, ``leaf`` number or -1."""

    def __init__(self, sample: np.ndarray):
        self.centres: list[np.ndarray] = [sample.mean(axis=0)]
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        self.leaves = 0
        rng = np.random.default_rng(7)
        todo = [(0, sample)]
        while todo:
            node, x = todo.pop()
            k = min(BRANCHES, len(x) // LEAF)
            owner = None
            if k > 1:
                centres = _kmeans(x, k, rng)
                owner = _squares(x, centres).argmin(axis=1)
            if owner is None or (owner == owner[0]).all():
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for c in range(k):
                if (owner == c).any():
                    self.children[node].append(len(self.centres))
                    todo.append((len(self.centres), x[owner == c]))
                    self.centres.append(centres[c])
                    self.children.append([])
                    self.leaf.append(-1)
        self.matrix = np.stack(self.centres)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            children = np.array(self.children[node])
            owner = _squares(x[rows], self.matrix[children]).argmin(axis=1)
            todo += [(int(c), rows[owner == i]) for i, c in enumerate(children) if (owner == i).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order, at most ``most``."""
        distance = ((self.matrix - query) ** 2).sum(axis=1).tolist()
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for c in self.children[node]:
                heapq.heappush(queue, (distance[c], c))
        return out


def calibrated_visits(tree: Tree, sample: np.ndarray, k: int = K, recall: float = RECALL) -> int:
    """The smallest number of visits that finds ``recall`` of the true neighbours."""
    queries = np.linspace(0, len(sample) - 1, min(CALIBRATION_QUERIES, len(sample))).astype(int)
    leaf = tree.assign(sample)
    found = np.zeros(tree.leaves + 1)
    for q in queries.tolist():
        d = ((sample - sample[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        place = {x: i + 1 for i, x in enumerate(tree.visits(sample[q], tree.leaves))}
        for x in leaf[near].tolist():
            found[place[x]] += 1
    if not found.sum():
        return tree.leaves
    return int(np.searchsorted(np.cumsum(found) / found.sum(), recall)) or 1


def _best(qids: np.ndarray, queries: np.ndarray, ids: list[np.ndarray], vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k nearest candidates of each query in one chunk, ties to the smaller id."""
    product = _squares(queries, vectors)
    keep = min(k, product.shape[1])
    # a row for each vector, though its ids may be several: k vectors hold k candidates at least (one id may be the query's own)
    bound = np.partition(product, min(keep, product.shape[1] - 1), axis=1)[:, min(keep, product.shape[1] - 1)]
    size = (queries * queries).sum(axis=1) + (vectors * vectors).sum(axis=1).max()
    out = []
    for r in range(len(qids)):
        near = np.flatnonzero(product[r] <= bound[r] + 1e-12 * vectors.shape[1] * size[r])
        exact = np.sqrt(((vectors[near] - queries[r]) ** 2).sum(axis=1))
        found = sorted((d, i) for d, n in zip(exact.tolist(), near.tolist()) for i in ids[n].tolist() if i != qids[r])
        out += [(int(qids[r]), i, d) for d, i in found[:k]]
    return out


def _packed(df: DataFrame, keys: list[str], ids: str) -> DataFrame:
    """Rows of a group as one row: the lists of ids, their lengths and the vectors."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    n = len(keys)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.atleast_1d(x).astype(np.int64) for x in rows[ids]]
        vectors = np.stack(rows["embedding"].to_numpy())
        return pd.DataFrame(
            {k: [v] for k, v in zip(keys, key[:n])}
            | {
                "lengths": [np.array([len(x) for x in lists], dtype=np.int64).tobytes()], "ids": [np.concatenate(lists).tobytes()],
                "vectors": [vectors.tobytes()], "width": [vectors.itemsize],
            }
        )

    return df.groupBy(*keys).applyInPandas(pack, f"{fields}, lengths binary, ids binary, vectors binary, width int")


def _unpack(lengths: bytes, ids: bytes, vectors: bytes, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    n = np.frombuffer(lengths, dtype=np.int64)
    x = np.frombuffer(vectors, dtype=np.float32 if width == 4 else np.float64).astype(np.float64).reshape(len(n), -1)
    return np.split(np.frombuffer(ids, dtype=np.int64), np.cumsum(n)[:-1]), x


def _search(rows: DataFrame, queries: DataFrame, k: int, recall: float, scratch: Scratch) -> DataFrame:
    """``query_id, vec_id, score``: candidates that hold the k best found."""
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    entries = scratch.keep(
        rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most k + 1
    )
    first = entries.select("embedding", F.xxhash64(F.col("ids")[0]).alias("h"), F.col("ids")[0].alias("i")).orderBy("h", "i").limit(SAMPLE)
    sample = np.array([r[0] for r in first.select("embedding").collect()], dtype=np.float64)
    tree = Tree(sample)
    visits = calibrated_visits(tree, sample, k, recall)
    shared = rows.sparkSession.sparkContext.broadcast(tree)  # bounded by SAMPLE
    kind = rows.schema["embedding"].dataType.simpleString()

    def to_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=shared.value.assign(np.stack(b["embedding"].to_numpy()).astype(np.float64)))

    def to_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=[shared.value.visits(np.asarray(x, dtype=np.float64), visits) for x in b["embedding"]])

    placed = scratch.keep(entries.mapInPandas(to_leaf, f"embedding {kind}, ids array<long>, leaf long"))
    asked = scratch.keep(queries.mapInPandas(to_visits, f"query_id long, embedding {kind}, leaf array<long>").withColumn("leaf", F.explode("leaf")))

    def dealt(df: DataFrame, size: int, name: str, id_column: str) -> DataFrame:
        # chunks of a leaf by hash, as many as its rows need
        need = df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).alias("need"))  # one row per leaf, at most SAMPLE
        salt = F.pmod(F.xxhash64(id_column), F.col("need")).alias(name)
        return df.join(F.broadcast(need), "leaf").select("*", salt).drop("need")

    chunks = _packed(dealt(placed, CHUNK, "chunk", "ids"), ["leaf", "chunk"], "ids").drop("chunk")
    blocks = _packed(dealt(asked, QUERY_BLOCK, "block", "query_id"), ["leaf", "block"], "query_id").drop("block")
    blocks = blocks.select("leaf", *(F.col(c).alias(f"q_{c}") for c in ("lengths", "ids", "vectors", "width")))
    pairs = chunks.join(blocks, "leaf")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, vectors = _unpack(row["lengths"], row["ids"], row["vectors"], row["width"])
                names, asking = _unpack(row["q_lengths"], row["q_ids"], row["q_vectors"], row["q_width"])
                found = _best(np.concatenate(names), asking, ids, vectors, k)
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()),
                        "score": pa.array([f[2] for f in found], pa.float64()),
                    }
                )

    return pairs.drop("leaf").mapInArrow(compare, "query_id long, vec_id long, score double")


def nearest(table: DataFrame, is_query, k: int = K, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row that ``is_query`` holds for."""
    scratch = Scratch(table.sparkSession)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    # usually there is one dimension; each has an index of its own
    dims = [r[0] for r in rows.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect()]
    found = None
    for d in dims:
        own = rows.where(F.size("embedding") == d)
        queries = own.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "embedding")
        part = _search(own, queries, k, recall, scratch)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = table.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
