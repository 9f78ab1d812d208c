"""Near-duplicate embeddings by int8 tile products with error bounds.

Equal vectors of a label are one class. The classes of a label are dealt to
tiles of about ``TILE`` vectors: to the nearest of some pivot vectors, and by
hash within a pivot. A tile is one packed row: ids, the vectors and their int8
quantisation. Pairs of tiles of a label are multiplied; a pair of tiles is
left out when the angles of their vectors to the two pivots and the angle of
the pivots show that no cosine reaches the threshold.

A unit vector ``u`` is stored as ``s * q`` with int8 ``q`` and the rest ``e``.
Then ``|u.v - s_u s_v q_u.q_v| <= |e_u| |s_v q_v| + |e_v|``, with all norms
known per vector, so the int8 product (exact in float32) tells which pairs may
reach the threshold; only these are computed in double precision from the
original vectors.

A tile product returns no pairs: it returns, per vector, the number of vectors
linked to it and one edge of a spanning forest of the links, so a group of
thousands of near copies costs rows in proportion to its size.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and vectors with a null label or id, link with nothing; vectors of
different dimensions do not link; repeated rows are vectors of their own (with
equal ids they are one node); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesmith.llm.common import Scratch, components, join_forest, own_exchange

THRESHOLD = 0.98
TILE = 2048
PIVOTS = 64
STRIPE = 512  # rows of a tile that are multiplied at once
_EXACT_DIMENSIONS = 1024  # 127 * 127 * 1024 < 2^24: sums of products are exact in float32
_SLACK = 1e-9


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, norms of ``s * q`` and of the rest, for unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


class Tile:
    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.ids, self.copies, self.vectors = ids, copies, vectors.astype(np.float64)
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.q, self.scale, self.back, self.rest = quantise(self.vectors / self.norms[:, None])
        self.floats = self.q.astype(np.float32 if vectors.shape[1] <= _EXACT_DIMENSIONS else np.float64)


def links(a: Tile, b: Tile, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the linked pairs, a stripe of ``a`` at a time; each pair once."""
    for at in range(0, len(a.ids), STRIPE):
        rows = slice(at, at + STRIPE)
        product = (a.floats[rows] @ b.floats.T).astype(np.float64) * a.scale[rows, None] * b.scale[None]
        product += a.rest[rows, None] * b.back[None] + b.rest[None]
        i, j = np.nonzero(product >= threshold - _SLACK)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        near = np.zeros(len(i), dtype=bool)
        for s in range(0, len(i), 65536):
            x, y = i[s : s + 65536], j[s : s + 65536]
            dot = np.einsum("ij,ij->i", a.vectors[x], b.vectors[y])
            near[s : s + 65536] = dot / (a.norms[x] * b.norms[y]) >= threshold
        yield i[near], j[near]


def _product(x: Tile, y: Tile, same: bool, threshold: float) -> pd.DataFrame:
    n = len(x.ids)
    counts = np.zeros(n + (0 if same else len(y.ids)), dtype=np.int64)
    parent = np.arange(len(counts))
    shift = 0 if same else n
    for i, j in links(x, y, same, threshold):
        np.add.at(counts, i, y.copies[j])
        np.add.at(counts, j + shift, x.copies[i])
        join_forest(parent, i, j + shift)
    ids = x.ids if same else np.concatenate([x.ids, y.ids])
    some = np.flatnonzero(counts)
    return pd.DataFrame({"rep": ids[some], "links": counts[some], "root": ids[parent[some]]})


def _pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(rows["embedding"].to_numpy())  # float32 or float64, as in the table
    return pd.DataFrame(
        {
            "group": [key[0]], "dim": [key[1]], "tile": [key[2]], "ids": [rows["rep"].to_numpy(np.int64).tobytes()],
            "copies": [rows["n"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()], "width": [vectors.itemsize],
        }
    )


def _unpack(ids: bytes, copies: bytes, vectors: bytes, width: int) -> Tile:
    names = np.frombuffer(ids, dtype=np.int64)
    values = np.frombuffer(vectors, dtype=np.float32 if width == 4 else np.float64)
    return Tile(names, np.frombuffer(copies, dtype=np.int64), values.reshape(len(names), -1))


def _nearest_pivot(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``pivot`` (its number, below ``parts``) and ``angle`` to it, for each class."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)  # at most PIVOTS vectors of each dimension

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            number, angle = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows))
            dims, parts = rows["dim"].to_numpy(), rows["parts"].to_numpy()
            for d in np.unique(dims):
                some = np.flatnonzero(dims == d)
                x = np.stack(rows["embedding"].iloc[some].to_numpy()).astype(np.float64)
                cosine = x @ shared.value[int(d)].T / np.linalg.norm(x, axis=1)[:, None]
                cosine[np.arange(cosine.shape[1])[None] >= parts[some, None]] = -2
                number[some] = cosine.argmax(axis=1)
                angle[some] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
            yield rows.drop(columns="parts").assign(pivot=number, angle=angle)

    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.select("rep", "n", "group", "dim", "embedding", "parts").mapInPandas(
        run, f"rep long, n long, group long, dim int, embedding {kind}, pivot long, angle double"
    )


def _pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors far apart from each other, from a small sample of each dimension."""
    w = Window.partitionBy("dim").orderBy(F.xxhash64("rep"), "rep")
    sample = classes.select("dim", "rep", "embedding").withColumn("r", F.row_number().over(w)).where(F.col("r") <= 8 * PIVOTS)
    by_dim: dict[int, list] = {}
    for row in sample.orderBy("dim", "r").collect():
        by_dim.setdefault(row["dim"], []).append(row["embedding"])
    out = {}
    for dim, rows in by_dim.items():
        x = np.array(rows, dtype=np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        chosen, nearest = [0], x @ x[0]
        while len(chosen) < min(PIVOTS, len(x)):
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    scratch = Scratch(table.sparkSession)
    ok = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("group"),
        "embedding", ok.alias("ok"),
    ).withColumn("hash", F.xxhash64("embedding"))
    valid = rows.where("ok")
    classes = scratch.keep(
        valid.groupBy("group", "hash", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
        .withColumn("dim", F.size("embedding"))
    )
    pivots = _pivots(classes)
    # a label uses as many pivots as it fills tiles, up to PIVOTS
    parts = classes.groupBy("group", "dim").agg(F.least(F.lit(PIVOTS), F.ceil(F.count(F.lit(1)) / TILE)).cast("long").alias("parts"))
    parts = parts.select(own_exchange("group").alias("group"), "dim", "parts")
    placed = scratch.keep(_nearest_pivot(classes.join(parts, ["group", "dim"]), pivots))
    cells = placed.groupBy("group", "dim", "pivot").agg(F.count(F.lit(1)).alias("size"), F.max("angle").alias("radius"))
    in_label = Window.partitionBy("group", "dim").orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)
    cells = scratch.keep(
        cells.withColumn("tiles", F.ceil(F.col("size") / TILE)).withColumn("first", F.coalesce(F.sum("tiles").over(in_label), F.lit(0)))
        .withColumn("last", F.sum("tiles").over(Window.partitionBy("group", "dim")) - 1)
    )
    on = ["group", "dim", "pivot"]
    split = cells.select(own_exchange("group").alias("group"), "dim", "pivot", "tiles", "first")
    tiled = placed.join(split, on).withColumn("tile", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("tiles")))
    packed = scratch.keep(
        tiled.select("group", "dim", "tile", "rep", "n", "embedding").groupBy("group", "dim", "tile")
        .applyInPandas(_pack, "group long, dim int, tile long, ids binary, copies binary, vectors binary, width int")
    )
    angles = _pivot_angles(table, pivots)
    tiles = cells.select(*on, "radius", "last", F.explode(F.expr("sequence(first, first + tiles - 1)")).alias("tile"))
    pairs = tiles.withColumn("other", F.explode(F.expr("sequence(tile, last)")))
    right = tiles.select("group", "dim", F.col("tile").alias("other"), F.col("pivot").alias("pivot2"), F.col("radius").alias("radius2"))
    pairs = pairs.join(right, ["group", "dim", "other"])
    reach = float(np.arccos(min(1.0, threshold))) + 1e-6
    pairs = (
        pairs.join(angles, ["dim", "pivot", "pivot2"])
        .where(F.col("between") <= F.col("radius") + F.col("radius2") + reach)
        .select("group", "dim", "tile", "other")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = _unpack(row["ids"], row["copies"], row["vectors"], row["width"])
                same = row["tile"] == row["other"]
                y = x if same else _unpack(row["ids2"], row["copies2"], row["vectors2"], row["width"])
                yield pa.RecordBatch.from_pandas(_product(x, y, same, threshold), preserve_index=False)

    second = packed.select("group", "dim", F.col("tile").alias("other"), *(F.col(c).alias(f"{c}2") for c in ("ids", "copies", "vectors")))
    both = pairs.join(packed, ["group", "dim", "tile"]).join(second, ["group", "dim", "other"])
    both = both.select("tile", "other", "width", "ids", "copies", "vectors", *(F.when(F.col("tile") != F.col("other"), F.col(f"{c}2")).alias(f"{c}2") for c in ("ids", "copies", "vectors")))
    found = scratch.keep(both.mapInArrow(run, "rep long, links long, root long"))

    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "root", scratch)
    classes = classes.join(linked, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left").select(
        "group", own_exchange("hash").alias("hash"), "embedding", F.lit(True).alias("ok"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component_id", "rep").alias("component_id"),
    )
    out = rows.join(classes, ["group", "hash", "embedding", "ok"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _pivot_angles(table: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    rows = [
        (int(d), i, j, float(np.arccos(np.clip(p[i] @ p[j], -1, 1))))
        for d, p in pivots.items() for i in range(len(p)) for j in range(len(p))
    ]
    return table.sparkSession.createDataFrame(rows, "dim int, pivot long, pivot2 long, between double")
