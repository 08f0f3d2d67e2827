"""Exact top-k by integer inner product: columnar branch-and-bound over blocks of vectors.

Vectors become blocks of rows, stored by dimension. A block of queries meets a block of
candidates; scores grow by a few dimensions at a time. What the remaining dimensions can still
add is bounded by the product of the remaining norms (Cauchy-Schwarz). A query's bar is the k-th
best score it has met: the candidates that lead after a step are scored in full at once, and a
task hands its bars on from block to block. After each step a query drops the candidates
whose bound stays below its bar, and few survivors are compacted. A task merges what its blocks
give (at most HELD_ROWS rows; beyond that a block's rows leave as they are), and a window keeps
the best k of all tasks.

The queries are a stated set. Candidate blocks stay where one shuffle put them; query blocks
are dealt to each slot, and a slot holds about one candidate block.

A component x counts as floor(64 * x). Vectors that are null, or hold null or non-finite
components, take no part; vectors of different length are never compared. Rows with the id of
the query are the query's own. A repeated query row is a query of its own, with rows of its
own; repeated candidates each count. Null ids take no part. Scores beyond a long saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txgraph.llm.common import freeze

EXACT_FLOAT, EXACT_INT = 2.0**53, 2.0**63
HELD_ROWS = 2_000_000  # rows of (id, score) that a task merges before they leave
BLOCK_SCHEMA = "block string, n int, dim int, dtype string, ids binary, data binary"


def quantise(rows: list) -> tuple[np.ndarray, str]:
    """floor(64 * x) as the narrowest type that holds all values."""
    scaled = np.floor(64.0 * np.asarray(rows, dtype=np.float64))
    top = float(np.abs(scaled).max(initial=0.0))
    for kind in ("<i2", "<i4"):
        if top < np.iinfo(kind).max:
            return scaled.astype(kind), kind
    return scaled, "<f8"


def blocks(vectors: DataFrame, rows: int, id_column: str, vector_column: str) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one length, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def emit(dim: int, ids: list, data: list) -> pa.RecordBatch:
            nonlocal count
            matrix, kind = quantise(data)
            matrix = matrix.reshape(len(ids), dim)
            count += 1
            row = {"block": f"{part}-{count}", "n": len(ids), "dim": dim, "dtype": kind}
            row |= {"ids": np.asarray(ids, "<i8").tobytes(), "data": np.ascontiguousarray(matrix.T).tobytes()}
            types = [("block", pa.string()), ("n", pa.int32()), ("dim", pa.int32()), ("dtype", pa.string())]
            types += [("ids", pa.binary()), ("data", pa.binary())]
            return pa.RecordBatch.from_pylist([row], pa.schema(types))

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, data = held.setdefault(len(vector), ([], []))
                ids.append(vec_id)
                data.append(vector)
                if len(ids) == rows:
                    yield emit(len(vector), *held.pop(len(vector)))
        for dim, (ids, data) in held.items():
            yield emit(dim, ids, data)

    vector = F.col(vector_column).cast("array<double>")
    usable = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("v")).where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    return usable.mapInArrow(run, BLOCK_SCHEMA)


def _matrix(data: bytes, kind: str, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(dim, n)


def _leading(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n highest scores, in no order."""
    return np.argpartition(scores, len(scores) - n)[len(scores) - n :] if n < len(scores) else np.arange(len(scores))


def _survivors(
    left: np.ndarray, right: np.ndarray, own: np.ndarray, k: int, bars: np.ndarray, step: int
) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(alive, score) of every pair; scores are whole where a pair is alive.

    ``bars`` are scores that k candidates of a query are known to reach. Also the share of pairs
    alive before each step but the first.
    """
    dim, n = right.shape
    # The dimensions of most mass come first, so that the remaining norms fall quickly.
    mass = np.argsort(-(right**2).sum(axis=1), kind="stable")
    left, right = left[mass], right[mass]
    cuts = list(range(0, dim, step))
    alive, scores, shares = ~own, np.zeros(own.shape), []
    bars = bars.astype(np.float64)
    for cut in cuts:
        if cut:
            shares.append(float(alive.mean()) if alive.size else 0.0)
        part = right[cut : cut + step]
        if not cut or shares[-1] > 0.5:
            scores += left[cut : cut + step].T @ part
        else:
            for row in range(len(scores)):
                at = np.flatnonzero(alive[row])
                scores[row, at] += left[cut : cut + step, row] @ part[:, at]
        if cut + step >= dim:
            break
        for row in range(len(scores)):
            lead = _leading(np.where(alive[row], scores[row], -np.inf), 4 * k)
            lead = lead[alive[row, lead]]
            if len(lead) >= k:
                whole = left[:, row] @ right[:, lead]
                bars[row] = max(bars[row], np.partition(whole, len(whole) - k)[len(whole) - k])
        rest_left = np.sqrt((left[cut + step :] ** 2).sum(axis=0))
        rest_right = np.sqrt((right[cut + step :] ** 2).sum(axis=0))
        slack = np.outer(rest_left * (1 + 1e-9), rest_right) + 1e-6
        alive &= scores + slack >= bars[:, None]
    return alive & (scores >= bars[:, None]), scores, shares


def search(
    queries: np.ndarray,
    query_ids: np.ndarray,
    candidates: np.ndarray,
    candidate_ids: np.ndarray,
    k: int,
    step: int = 16,
    bars: np.ndarray | None = None,
    shares: list[list[float]] | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, candidate ids, scores) of the best k, both sides given by dimension.

    Candidates below a query's bar (a score that k others reach) may be left out. ``shares``
    receives the shares of pairs alive before each step.
    """
    dim, n = candidates.shape
    reach = max(1, dim) * float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
    kind = np.float64 if reach < EXACT_FLOAT else np.int64 if reach < EXACT_INT else object
    own = query_ids[:, None] == candidate_ids[None, :]
    if kind is np.float64:
        bars = np.full(len(query_ids), -np.inf) if bars is None else bars
        alive, scores, found = _survivors(queries.astype(kind), candidates.astype(kind), own, k, bars, step)
        if shares is not None:
            shares.append(found)
    else:
        # Whole numbers beyond a double's are scored in full.
        whole = np.vectorize(int, otypes=[object]) if kind is object else lambda x: x.astype(kind)
        left, right = (whole(x) if x.size else x.astype(kind) for x in (queries, candidates))
        alive, scores = ~own, left.T.dot(right)
    for row in range(queries.shape[1]):
        at = np.flatnonzero(alive[row])
        values = scores[row, at]
        if kind is object:
            best = sorted(range(len(at)), key=lambda i: (-values[i], candidate_ids[at[i]]))[:k]
            clipped = [max(-(2**63), min(2**63 - 1, values[i])) for i in best]
            yield row, candidate_ids[at[best]], np.array(clipped, dtype=np.int64)
            continue
        if len(at) > k:
            near = values >= np.partition(values, len(at) - k)[len(at) - k]
            at, values = at[near], values[near]
        best = np.lexsort((candidate_ids[at], -values))[:k]
        yield row, candidate_ids[at[best]], values[best].astype(np.int64)


class Best:
    """The best k of each query of a block, over the candidate blocks met so far."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.ids = [np.zeros(0, np.int64)] * len(query_ids)
        self.scores = [np.zeros(0, np.int64)] * len(query_ids)

    def bars(self) -> np.ndarray:
        full = [float(s[-1]) if len(s) == self.k else -np.inf for s in self.scores]
        return np.array(full, dtype=np.float64)

    def add(self, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.ids[row], ids])
        scores = np.concatenate([self.scores[row], scores])
        # The complement orders descending without overflow.
        order = np.lexsort((ids, ~scores))[: self.k]
        self.ids[row], self.scores[row] = ids[order], scores[order]

    def batch(self, block: str) -> pa.RecordBatch:
        rows = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        columns = [
            pa.array([block] * len(rows), pa.string()),
            pa.array(rows, pa.int32()),
            pa.array(self.query_ids[rows], pa.int64()),
            pa.array(np.concatenate([*self.ids, np.zeros(0, np.int64)]), pa.int64()),
            pa.array(np.concatenate([*self.scores, np.zeros(0, np.int64)]), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["q_block", "q_row", "query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_rows: int = 256,
    candidate_rows: int = 8192,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row."""
    held = freeze(blocks(vectors, candidate_rows, id_column, vector_column))
    asked = freeze(blocks(queries, query_rows, id_column, vector_column))
    slots = max(1, held.count())
    left = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        *[F.col(c).alias(f"q_{c}") for c in asked.columns],
    )
    right = held.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    pairs = left.join(right, (left.slot == right.slot) & (left.q_dim == right.dim))
    columns = ["q_block", "q_n", "q_dtype", "q_ids", "q_data", "n", "dim", "dtype", "ids", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Best] = {}
        room = held_rows
        for batch in batches:
            for at in range(batch.num_rows):
                x = {name: batch.column(i)[at].as_py() for i, name in enumerate(columns)}
                q_ids = np.frombuffer(x["q_ids"], "<i8")
                best = held.get(x["q_block"]) or Best(q_ids, k)
                if x["q_block"] not in held and room >= len(q_ids) * k:
                    held[x["q_block"]] = best
                    room -= len(q_ids) * k
                found = search(
                    _matrix(x["q_data"], x["q_dtype"], x["dim"], x["q_n"]),
                    q_ids,
                    _matrix(x["data"], x["dtype"], x["dim"], x["n"]),
                    np.frombuffer(x["ids"], "<i8"),
                    k,
                    bars=best.bars(),
                )
                for row, ids, scores in found:
                    best.add(row, ids, scores)
                if x["q_block"] not in held:
                    yield best.batch(x["q_block"])
        for block, best in held.items():
            yield best.batch(block)

    local = pairs.select(*columns).mapInArrow(
        run, "q_block string, q_row int, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
