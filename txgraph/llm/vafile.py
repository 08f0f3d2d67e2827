"""Centroid clustering over a vector-approximation file.

Building: each task writes the whole vectors, fixed width and row after row, to a file of its
own in the shared folder, and returns blocks: for every dimension the cell of each vector, a few
bits in vertical bit planes, over a grid of the block's own range. A block names only the file
that its own attempt finished, so a lost or repeated attempt leaves nothing that anybody reads.

Rounds: a table of (dimension, cell, centroid) gives the least and the largest squared
difference, and their sums over the dimensions an interval for the distance to each centroid. A
vector whose intervals leave one centroid is assigned by its cells alone. The others, and those
that change their centroid, are fetched from the file: the former for exact distances, the latter
for the exact sums, which are kept up to date by what moved. The first round moves every vector,
and the last assignment reports distances; both read the file once from end to end. No vector is
ever shuffled; what leaves a task per round is its blocks and one sum per centroid and dimension.

A component x counts as the exact integer floor(64 * x). Vectors that are null, of another
length, or hold null or non-finite components take no part and give no row. Null ids take part
(for the draw of the seeds they count as an empty text). Each repeated row is a vector of its own
and gives a row of its own; seeds of equal hash are drawn by their components. With fewer vectors
than ``k`` there are as many centroids as vectors. Values of any size stay exact (blocks with
values of 2^27 or more, at 64 dimensions, are fetched whole); distances and sums beyond a long saturate.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import discard, freeze, scratch_uri

LIMB = 1 << 62
BIG_BYTES = 136  # of an integer of any finite double
NOWHERE = 0xFFFF
LONG_MAX = (1 << 63) - 1
SEED = "1:"

_BLOCK = [
    ("file", pa.string()),
    ("start", pa.int64()),
    ("n", pa.int32()),
    ("kind", pa.string()),
    ("ids", pa.list_(pa.int64())),
    ("low", pa.binary()),
    ("width", pa.binary()),
    ("cells", pa.binary()),
    ("assigned", pa.binary()),
    ("fetched", pa.int64()),
    ("sums", pa.list_(pa.struct([("place", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))),
]
_SCHEMA = pa.schema(_BLOCK)
BLOCK_SCHEMA = (
    "file string, start long, n int, kind string, ids array<long>, low binary, width binary, cells binary, "
    "assigned binary, fetched long, sums array<struct<place: int, limb: int, value: long>>"
)


def usable(vectors: DataFrame, dim: int, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    found = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return found.where(F.col("v").isNotNull() & (F.size("v") == dim) & finite)


def integers(rows: list) -> tuple[np.ndarray, str]:
    """floor(64 * x), and the narrowest kind that holds all values."""
    scaled = np.asarray(rows, dtype=np.float64)
    with np.errstate(over="ignore"):
        floored = np.floor(64.0 * scaled)
    top = float(np.abs(floored).max(initial=0.0))
    for kind, bound in (("<i2", 2.0**15 - 1), ("<i4", 2.0**31 - 1), ("<i8", 2.0**62)):
        if top < bound:
            return floored.astype(kind), kind
    exact = [[math.floor(x * 64) if abs(x) < 1e300 else int(x) * 64 for x in row] for row in scaled.tolist()]
    return np.array(exact, dtype=object).reshape(scaled.shape), "big"


def _to_bytes(matrix: np.ndarray, kind: str) -> bytes:
    if kind != "big":
        return np.ascontiguousarray(matrix, dtype=kind).tobytes()
    return b"".join(int(x).to_bytes(BIG_BYTES, "little", signed=True) for x in matrix.ravel())


def _from_bytes(data: bytes, kind: str, dim: int) -> np.ndarray:
    if kind != "big":
        return np.frombuffer(data, dtype=kind).reshape(-1, dim)
    cut = [int.from_bytes(data[i : i + BIG_BYTES], "little", signed=True) for i in range(0, len(data), BIG_BYTES)]
    return np.array(cut, dtype=object).reshape(-1, dim)


def _item(kind: str) -> int:
    return BIG_BYTES if kind == "big" else np.dtype(kind).itemsize


def pack(cells: np.ndarray, bits: int) -> bytes:
    """(vectors, dimensions) of small numbers as bit planes, dimension by dimension."""
    planes = (cells.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2).tobytes()


def unpack(data: bytes, n: int, dim: int, bits: int) -> np.ndarray:
    """The cells as (dimensions, vectors)."""
    planes = np.unpackbits(np.frombuffer(data, np.uint8).reshape(dim, bits, -1), axis=2)[:, :, :n]
    return (planes.astype(np.int64) << np.arange(bits)[None, :, None]).sum(axis=1)


def build(found: DataFrame, folder: str, dim: int, bits: int, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors; the whole vectors go to files below ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{uuid.uuid4().hex}"
        fs, path = pafs.FileSystem.from_uri(name)
        sink, at, blocks, ids, held = None, 0, [], [], []

        def close_block() -> None:
            nonlocal sink, at
            matrix, kind = integers(held)
            if sink is None:
                with suppress(NotImplementedError):
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                sink = fs.open_output_stream(path)
            sink.write(data := _to_bytes(matrix, kind))
            block = {"file": name, "start": at, "n": len(ids), "kind": kind, "ids": list(ids)}
            if kind != "big":
                low, high = matrix.min(axis=0).astype(np.int64), matrix.max(axis=0).astype(np.int64)
                width = np.maximum(1, -((low - high - 1) >> bits))
                block |= {"low": low.tobytes(), "width": width.tobytes()}
                block["cells"] = pack((matrix.astype(np.int64) - low) // width, bits)
            block["assigned"] = np.full(len(ids), NOWHERE, "<u2").tobytes()
            blocks.append(block)
            at += len(data)
            ids.clear(), held.clear()

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(vec_id)
                held.append(vector)
                if len(ids) == rows:
                    close_block()
        if ids:
            close_block()
        if sink is not None:
            sink.close()  # only then do the blocks that name the file go out
        for block in blocks:
            yield pa.RecordBatch.from_pylist([block], _SCHEMA)

    return found.mapInArrow(run, BLOCK_SCHEMA)


class Store:
    """The files of one task's blocks, opened once each."""

    def __init__(self, dim: int):
        self.dim, self.name, self.file = dim, None, None

    def rows(self, block: dict, wanted: np.ndarray) -> np.ndarray:
        """The vectors at the places ``wanted`` (ascending); near ones are read in one go."""
        if block["file"] != self.name:
            fs, path = pafs.FileSystem.from_uri(block["file"])
            self.name, self.file = block["file"], fs.open_input_file(path)
        size = self.dim * _item(block["kind"])
        cuts = np.flatnonzero(np.diff(wanted) > 16) + 1
        parts = []
        for run in np.split(wanted, cuts):
            first, last = int(run[0]), int(run[-1])
            data = self.file.read_at((last - first + 1) * size, block["start"] + first * size)
            parts.append(_from_bytes(data, block["kind"], self.dim)[run - first])
        return np.concatenate(parts)


def intervals(block: dict, centroids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance of each vector (by its cells) to each centroid."""
    dim = centroids.shape[1]
    cells = unpack(block["cells"], block["n"], dim, bits)
    low, width = np.frombuffer(block["low"], np.int64), np.frombuffer(block["width"], np.int64)
    left = low[:, None] + np.arange(1 << bits) * width[:, None]
    right = left + width[:, None] - 1
    below, above = left[:, :, None] - centroids.T[:, None, :], right[:, :, None] - centroids.T[:, None, :]
    least = np.maximum(np.maximum(below, -above), 0) ** 2
    most = np.maximum(below**2, above**2)
    lower = np.zeros((block["n"], len(centroids)), np.int64)
    upper = np.zeros_like(lower)
    for d in range(dim):
        lower += least[d][cells[d]]
        upper += most[d][cells[d]]
    return lower, upper


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances; as Python integers where a long might not hold them."""
    if rows.dtype == object or centroids.dtype == object or max(_reach(rows), _reach(centroids)) >= _exact(rows.shape[1]):
        rows, centroids = rows.astype(object), centroids.astype(object)
        return np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    rows = rows.astype(np.int64)
    return np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1)


def _exact(dim: int) -> int:
    """Below it, the squared differences of ``dim`` components add up within a long."""
    return math.isqrt((1 << 62) // dim) // 2


def _reach(values: np.ndarray) -> int:
    return int(np.abs(values.astype(np.int64)).max(initial=0))


def assign(block: dict, centroids: np.ndarray, bits: int, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, and the places that had to be fetched for it."""
    n = block["n"]
    nearest = np.zeros(n, np.int64)
    small = block["cells"] is not None and centroids.dtype != object and _reach(centroids) < _exact(centroids.shape[1])
    if small:
        edges = np.frombuffer(block["low"], np.int64), np.frombuffer(block["width"], np.int64) << bits
        small = max(_reach(edges[0]), _reach(edges[0] + edges[1])) < _exact(centroids.shape[1])
    if small:
        lower, upper = intervals(block, centroids, bits)
        open_ = lower <= upper.min(axis=1, keepdims=True)
        nearest = open_.argmax(axis=1)
        wanted = np.flatnonzero(open_.sum(axis=1) > 1)
    else:
        wanted = np.arange(n)
    for at in range(0, len(wanted), 4096):
        some = wanted[at : at + 4096]
        # The smallest distance is among the open ones; argmin takes the smaller number on a tie.
        nearest[some] = np.array(distances(store.rows(block, some), centroids).argmin(axis=1), np.int64)
    return nearest, wanted


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """An integer as longs: (place, digit) of base 2^62, with its sign on every digit."""
    sign, value, place = (1 if value >= 0 else -1), abs(value), 0
    while value:
        value, digit = divmod(value, LIMB)
        yield place, sign * digit
        place += 1


def _centroids(rows: list[list[int]], dim: int) -> np.ndarray:
    wide = any(abs(x) >= LIMB for row in rows for x in row)
    return np.array(rows, dtype=object if wide else np.int64).reshape(-1, dim)


def refine(blocks: DataFrame, centroids: list[list[int]], dim: int, bits: int) -> DataFrame:
    """Blocks with their vectors assigned anew, and per task the change of all sums."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = _centroids(centroids, dim)
        store, change, sized = Store(dim), np.zeros((k, dim), dtype=object), np.zeros(k, np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                if block["file"] is None:
                    continue
                nearest, wanted = assign(block, at, bits, store)
                before = np.frombuffer(block["assigned"], "<u2").astype(np.int64)
                moved = np.flatnonzero(nearest != before)
                for cut in range(0, len(moved), 4096):
                    some = moved[cut : cut + 4096]
                    rows = store.rows(block, some)
                    rows = rows.astype(object if rows.dtype == object or _reach(rows) >= 1 << 50 else np.int64)
                    for side, sign in ((nearest[some], 1), (before[some], -1)):
                        for c in np.unique(side[side != NOWHERE]):
                            change[c] += sign * rows[side == c].sum(axis=0).astype(object)
                            sized[c] += sign * int((side == c).sum())
                block["assigned"], block["sums"] = nearest.astype("<u2").tobytes(), None
                block["fetched"] = len(np.union1d(wanted, moved))
                yield pa.RecordBatch.from_pylist([block], _SCHEMA)
        flat = [*(int(x) for x in change.ravel()), *(int(x) for x in sized)]
        sums = [{"place": i, "limb": j, "value": v} for i, x in enumerate(flat) for j, v in limbs(x)]
        yield pa.RecordBatch.from_pylist([{"sums": sums}], _SCHEMA)

    return freeze(blocks.mapInArrow(run, BLOCK_SCHEMA))


def changes(blocks: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int]]:
    """What all tasks add to the sums and sizes of the centroids: k * (dim + 1) numbers."""
    told = blocks.where("sums IS NOT NULL").select(F.explode("sums").alias("s")).groupBy("s.place", "s.limb")
    flat = [0] * (k * dim + k)
    for place, limb, value in told.agg(F.sum(F.col("s.value").cast("decimal(38,0)"))).collect():
        flat[place] += int(value) * LIMB**limb
    return [flat[c * dim : (c + 1) * dim] for c in range(k)], flat[k * dim :]


def measure(blocks: DataFrame, centroids: list[list[int]], dim: int, bits: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, store = _centroids(centroids, dim), Store(dim)
        for batch in batches:
            for block in batch.to_pylist():
                if block["file"] is None:
                    continue
                nearest, _ = assign(block, at, bits, store)
                far = []
                for cut in range(0, block["n"], 4096):
                    some = np.arange(cut, min(block["n"], cut + 4096))
                    exact = distances(store.rows(block, some), at)[np.arange(len(some)), nearest[some]]
                    far += [min(LONG_MAX, int(x)) for x in exact]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["ids"], pa.int64()), pa.array(nearest, pa.int32()), pa.array(far, pa.int64())],
                    names=["id", "cluster", "distance"],
                )

    return blocks.mapInArrow(run, "id long, cluster int, distance long")


def seeds(found: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors of least hash of their id, as integers, in that order."""
    text = F.concat(F.lit(SEED), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = found.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return [[int(x) for x in integers([row.v])[0][0]] for row in drawn]


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    bits: int = 6,
    block_rows: int = 4096,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    report: list | None = None,
) -> DataFrame:
    """Assign every vector to one of ``k`` centroids after ``rounds`` rounds.

    Returns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. ``report``
    receives, per round, (vectors, fetched vectors).
    """
    if k >= NOWHERE:
        raise ValueError(f"at most {NOWHERE - 1} centroids")
    found = usable(vectors, dim, id_column, vector_column)
    centroids = seeds(found, k)
    spark = vectors.sparkSession
    if not centroids:
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    folder = scratch_uri(spark, "vafile")
    blocks = freeze(build(found, folder, dim, bits, block_rows))
    k = len(centroids)
    total, sized = [[0] * dim for _ in range(k)], [0] * k
    for _ in range(rounds):
        blocks = refine(blocks, centroids, dim, bits)
        if report is not None:
            report.append(tuple(blocks.agg(F.sum(F.col("n").cast("long")), F.sum("fetched")).first()))
        added, grown = changes(blocks, k, dim)
        total = [[x + y for x, y in zip(a, b, strict=True)] for a, b in zip(total, added, strict=True)]
        sized = [x + y for x, y in zip(sized, grown, strict=True)]
        centroids = [[x // n for x in s] if n else c for s, n, c in zip(total, sized, centroids, strict=True)]
    told = freeze(measure(blocks, centroids, dim, bits))
    discard(folder)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {row[0]: int(row[1]) for row in told.groupBy("cluster").agg(wide).collect()}
    every = min(LONG_MAX, sum(by_cluster.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, min(LONG_MAX, by_cluster[c]), every, digest[c]) for c in sorted(by_cluster)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid: at most k.
    return told.withColumnRenamed("id", "vec_id").join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
