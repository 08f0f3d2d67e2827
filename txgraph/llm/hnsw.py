"""Near-duplicate embeddings by navigable small-world graphs, one per shard.

Vectors of one label are dealt to shards of bounded size; each shard gets a hierarchical
navigable small-world graph. Every vector is looked up in every shard of its label. A search
keeps a beam of candidates and goes on from all of them that lie close to the threshold. Before
a shard's vectors are looked up in a shard, its own or another, the lookups of a sample of them
are audited by brute force: for all links of a vector, and for its nearest vector if it has
none. The beam is doubled until the audit passes; where it does not pass within a bound, the
two shards are compared by brute force. Links are verified by cosine in double precision; each pair of shards hands on link counts and a spanning forest of its links,
so the output stays linear in the vectors; the forests are united into components.

Equal vectors of a label are one class, collapsed before and counted with their number.
Vectors that are null, zero, or hold null or non-finite components, and those of null label or
id, link with nothing: 0 links, a component of their own. Vectors of different length never
link. Rows of one id are one node of the components; links count rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import freeze, partitions_for
from txgraph.llm.components import components


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    margin: float = 0.02  # below the threshold, over which a search goes on
    shard_rows: int = 8192
    links: int = 12  # per node on the upper levels; twice as many on the ground level
    build_beam: int = 48
    beam: int = 24
    audit_rows: int = 512
    audit_recall: float = 0.98
    most_beam: int = 192  # up to which an audit doubles the beam


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, s: Settings):
        self.v, self.s = vectors, s
        n = len(vectors)
        draws = np.random.default_rng(11).random(n)
        self.level = np.minimum(12, (-np.log(np.maximum(draws, 1e-12)) / np.log(s.links)).astype(int))
        self.near: list[dict[int, list[int]]] = [{} for _ in range(int(self.level.max(initial=0)) + 1)]
        self.entry, self.top = -1, -1
        self.beam = s.beam
        self._ground: tuple | None = None

    def build(self) -> "Graph":
        for node in range(len(self.v)):
            self._insert(node)
        return self

    def _walk(self, q: np.ndarray, starts: list[tuple[float, int]], beam: int, level: int) -> list[tuple[float, int]]:
        """The best ``beam`` nodes found from ``starts``, as (similarity, node), best first."""
        near, v = self.near[level], self.v
        seen = {node for _, node in starts}
        ahead = [(-sim, node) for sim, node in starts]
        best = list(starts)
        heapq.heapify(ahead)
        heapq.heapify(best)
        while ahead:
            sim, node = heapq.heappop(ahead)
            if -sim < best[0][0] and len(best) >= beam:
                break
            fresh = [x for x in near[node] if x not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            floor = best[0][0] if len(best) >= beam else -2.0
            for sim, x in zip((v[fresh] @ q).tolist(), fresh, strict=True):
                if sim > floor or len(best) < beam:
                    heapq.heappush(ahead, (-sim, x))
                    heapq.heappush(best, (sim, x))
                    if len(best) > beam:
                        heapq.heappop(best)
                    floor = best[0][0] if len(best) >= beam else -2.0
        return sorted(best, reverse=True)

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours that are nearer to the node than to each other first, then the nearest."""
        nodes = [node for _, node in found]
        if len(nodes) <= most:
            return nodes
        among = self.v[nodes] @ self.v[nodes].T
        sims = np.array([sim for sim, _ in found])
        chosen: list[int] = []
        closest = np.full(len(nodes), -2.0)
        for i in range(len(nodes)):
            if closest[i] < sims[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[i], out=closest)
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [i for i in range(len(nodes)) if i not in taken][: most - len(chosen)]
        return [nodes[i] for i in chosen]

    def _insert(self, node: int) -> None:
        q, own = self.v[node], int(self.level[node])
        if self.entry < 0:
            for level in range(own + 1):
                self.near[level][node] = []
            self.entry, self.top = node, own
            return
        starts = [(float(self.v[self.entry] @ q), self.entry)]
        for level in range(self.top, own, -1):
            starts = self._walk(q, starts, 1, level)
        for level in range(min(self.top, own), -1, -1):
            starts = self._walk(q, starts, self.s.build_beam, level)
            most = self.s.links * (2 if level == 0 else 1)
            chosen = self._spread(starts, self.s.links)
            near = self.near[level]
            near[node] = list(chosen)
            for x in chosen:
                near[x].append(node)
                if len(near[x]) > most + 8:  # shortened a few at a time
                    sims = self.v[near[x]] @ self.v[x]
                    order = np.argsort(-sims, kind="stable")
                    near[x] = self._spread([(float(sims[i]), near[x][i]) for i in order], most)
        for level in range(self.top + 1, own + 1):
            self.near[level][node] = []
        if own > self.top:
            self.entry, self.top = node, own

    def search(self, q: np.ndarray) -> list[int]:
        """Nodes at or above the threshold: a beam, widened over all that lies close to it."""
        found = self._from_top(q)
        bar = self.s.threshold - self.s.margin
        frontier = [node for sim, node in found if sim >= bar]
        out = [node for sim, node in found if sim >= self.s.threshold]
        seen, near = {node for _, node in found}, self.near[0]
        while frontier:
            fresh = list({x for node in frontier for x in near[node]} - seen)
            if not fresh:
                break
            seen.update(fresh)
            sims = self.v[fresh] @ q
            out += [fresh[i] for i in np.flatnonzero(sims >= self.s.threshold)]
            frontier = [fresh[i] for i in np.flatnonzero(sims >= bar)]
        return out

    def audit(self, queries: np.ndarray | None = None) -> float:
        """Double the beam until a sample's lookups find what brute force finds; the recall.

        The sample is taken from ``queries`` of another shard, or else from the graph's own
        vectors, which are asked for the others. The recall is the lesser of two: of links, and
        of the nearest vector for samples without links. A beam that is to be doubled is told by the
        misses so far; the rest of the sample is not asked then.
        """
        own = queries is None
        asked = self.v if own else queries
        rows = np.unique(np.linspace(0, len(asked) - 1, min(len(asked), self.s.audit_rows)).astype(int))
        sims = asked[rows] @ self.v.T
        if own:
            sims[np.arange(len(rows)), rows] = -2.0
        links = [set(np.flatnonzero(x >= self.s.threshold).tolist()) for x in sims]
        nearest = sims.max(axis=1)
        all_links = sum(len(x) for x in links)
        all_alone = sum(not known and best > -2.0 for known, best in zip(links, nearest, strict=True))
        while True:
            hits = wanted = close = alone = 0
            last = self.beam >= min(len(self.v), self.s.most_beam)
            for row, known, best in zip(rows, links, nearest, strict=True):
                if known:
                    hits += len(known & set(self.search(asked[row])))
                    wanted += len(known)
                elif best > -2.0:
                    walked = self._from_top(asked[row])
                    close += best <= max((sim for sim, x in walked if not own or x != row), default=-2.0) + 1e-12
                    alone += 1
                lost = max(
                    (wanted - hits) / all_links if all_links else 0.0, (alone - close) / all_alone if all_alone else 0.0
                )
                if not last and 1.0 - lost < self.s.audit_recall - 1e-9:
                    break
            recall = min(hits / wanted if wanted else 1.0, close / alone if alone else 1.0)
            if last or recall >= self.s.audit_recall:
                return recall
            self.beam *= 2

    def compare(self, queries: np.ndarray) -> Iterator[list[int]]:
        """What ``search`` is to find for each query, by brute force."""
        for at in range(0, len(queries), 256):
            for sims in queries[at : at + 256] @ self.v.T:
                yield np.flatnonzero(sims >= self.s.threshold).tolist()

    def _from_top(self, q: np.ndarray) -> list[tuple[float, int]]:
        starts = [(float(self.v[self.entry] @ q), self.entry)]
        for level in range(self.top, 0, -1):
            starts = self._walk(q, starts, 1, level)
        return self._on_ground(q, starts[0], self.beam)

    def _on_ground(self, q: np.ndarray, start: tuple[float, int], beam: int) -> list[tuple[float, int]]:
        """``_walk`` on the finished ground level, which asks the neighbours of several nodes at once.

        It ends as that does, when no node of the beam is left to go on from.
        """
        if self._ground is None or self._ground[0] is not self.near[0]:
            size = max(1, max(map(len, self.near[0].values())))
            table = np.repeat(np.arange(len(self.v), dtype=np.int32)[:, None], size, axis=1)  # filled up with the node
            for node, near in self.near[0].items():
                table[node, : len(near)] = near
            self._ground = (self.near[0], table, np.zeros(len(self.v), dtype=bool), np.zeros(len(self.v), dtype=np.int32))
        _, table, seen, last = self._ground
        seen[start[1]] = True
        met = [np.array([start[1]])]
        nodes, sims = met[0], np.array([start[0]])
        fresh_from = np.ones(1, dtype=bool)
        width = max(2, beam // 8)
        while True:
            ahead = np.flatnonzero(fresh_from)[:width]
            if not len(ahead):
                break
            fresh_from[ahead] = False
            near = table[nodes[ahead]].ravel()
            near = near[~seen[near]]
            if not len(near):
                continue
            place = np.arange(len(near), dtype=np.int32)
            last[near] = place
            near = near[last[near] == place]  # each node once
            seen[near] = True
            met.append(near)
            found = (self.v.take(near, axis=0) @ q)
            if len(nodes) >= beam:
                better = found > sims[-1]
                near, found = near[better], found[better]
                if not len(near):
                    continue
            sims = np.concatenate([sims, found])
            order = np.argsort(-sims, kind="stable")[:beam]
            sims, nodes = sims[order], np.concatenate([nodes, near])[order]
            fresh_from = np.concatenate([fresh_from, np.ones(len(near), dtype=bool)])[order]
        seen[np.concatenate(met)] = False
        return list(zip(sims.tolist(), nodes.tolist(), strict=True))

    def pack(self) -> tuple[bytes, bytes]:
        """Neighbour lists as numbers: per level the nodes, the lengths and the lists."""
        parts = [np.array([self.entry, self.top, self.beam, len(self.near)], dtype="<i4")]
        for near in self.near:
            nodes = np.array(list(near), dtype="<i4")
            sizes = np.array([len(x) for x in near.values()], dtype="<i4")
            flat = np.array([y for x in near.values() for y in x], dtype="<i4")
            parts += [np.array([len(nodes), len(flat)], dtype="<i4"), nodes, sizes, flat]
        return np.concatenate(parts).tobytes(), self.v.astype("<f8").tobytes()

    @classmethod
    def unpack(cls, links: bytes, vectors: bytes, dim: int, s: Settings) -> "Graph":
        graph = cls.__new__(cls)
        graph.s, graph.v, graph._ground = s, np.frombuffer(vectors, "<f8").reshape(-1, dim), None
        numbers = np.frombuffer(links, "<i4")
        graph.entry, graph.top, graph.beam, levels = (int(x) for x in numbers[:4])
        at, graph.near = 4, []
        for _ in range(levels):
            n, total = int(numbers[at]), int(numbers[at + 1])
            nodes = numbers[at + 2 : at + 2 + n].tolist()
            sizes = numbers[at + 2 + n : at + 2 + 2 * n]
            flat = numbers[at + 2 + 2 * n : at + 2 + 2 * n + total].tolist()
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            graph.near.append({node: flat[cuts[i] : cuts[i + 1]] for i, node in enumerate(nodes)})
            at += 2 + 2 * n + total
        return graph


class Forest:
    """Union of nodes; ``add`` tells whether two trees became one."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def add(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def unit(rows: list) -> np.ndarray:
    v = np.asarray(rows, dtype=np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame) -> DataFrame:
    """(label, v, dim, rep, n): equal vectors of a label, with smallest id and number of rows."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = _given(vectors).where(
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("v", lambda x: x != 0)
    )
    return usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("v"))


def _given(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )


def shards(found: DataFrame, s: Settings) -> DataFrame:
    """One row per shard: its ids, counts, unit vectors and graph."""
    sizes = found.groupBy("label", "dim").count()
    sizes = freeze(sizes.select("label", "dim", F.ceil(F.col("count") / s.shard_rows).cast("long").alias("of")))
    tasks = partitions_for(found.sparkSession, found.count(), s.shard_rows)
    dealt = (
        found.join(sizes, ["label", "dim"])
        .withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("of")))
        .select("label", "dim", "of", "shard", "rep", "n", "v")
        .repartition(tasks, "label", "dim", "shard")
        .sortWithinPartitions("label", "dim", "shard", "rep")
    )
    names = ["label", "dim", "of", "shard", "ids", "counts", "vectors", "graph"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 4

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, counts, rows = None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if ids:
                links, vectors = Graph(unit(rows), s).build().pack()
                row = (*current, np.array(ids, "<i8").tobytes(), np.array(counts, "<i8").tobytes(), vectors, links)
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for label, dim, of, shard, rep, n, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (label, dim, of, shard) != current:
                    yield from done()
                    current, ids, counts, rows = (label, dim, of, shard), [], [], []
                ids.append(rep)
                counts.append(n)
                rows.append(v)
        yield from done()

    schema = "label long, dim int, of long, shard long, ids binary, counts binary, vectors binary, graph binary"
    return freeze(dealt.mapInArrow(build, schema))


def search(held: DataFrame, s: Settings) -> DataFrame:
    """(label, rep, links, a, b): links of each vector per shard, and forest edges (a, b)."""
    asked = held.select(
        "label", "dim", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("shard"),
        F.col("shard").alias("from_shard"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
    )
    pairs = asked.join(held, ["label", "dim", "shard"])
    names = ["label", "rep", "links", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                graph = Graph.unpack(x["graph"], x["vectors"], x["dim"], s)
                ids, counts = np.frombuffer(x["ids"], "<i8"), np.frombuffer(x["counts"], "<i8")
                queries = np.frombuffer(x["q_vectors"], "<f8").reshape(-1, x["dim"])
                own = x["from_shard"] == x["shard"]
                passed = graph.audit(None if own else queries) >= s.audit_recall
                answers = map(graph.search, queries) if passed else graph.compare(queries)
                forest, reps, links, a, b = Forest(), [], [], [], []
                for rep, nodes in zip(np.frombuffer(x["q_ids"], "<i8").tolist(), answers, strict=True):
                    total = 0
                    for node in nodes:
                        other = int(ids[node])
                        if other == rep and own:
                            continue
                        total += int(counts[node])
                        if forest.add(rep, other):
                            a.append(rep)
                            b.append(other)
                    if total:
                        reps.append(rep)
                        links.append(total)
                n, m = len(reps), len(a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["label"]] * (n + m), pa.int64()),
                        pa.array(reps + [None] * m, pa.int64()),
                        pa.array(links + [None] * m, pa.int64()),
                        pa.array([None] * n + a, pa.int64()),
                        pa.array([None] * n + b, pa.int64()),
                    ],
                    names=names,
                )

    columns = ["label", "dim", "shard", "from_shard", "q_ids", "q_vectors", "ids", "counts", "vectors", "graph"]
    return pairs.select(*columns).mapInArrow(run, "label long, rep long, links long, a long, b long")


def near_duplicates(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    found = freeze(classes(vectors))
    links = freeze(search(shards(found, s), s))
    linked = links.where("rep IS NOT NULL").groupBy("label", "rep").agg(F.sum("links").alias("links"))
    united = components(links.where("a IS NOT NULL").select("a", "b"))
    known = (
        found.join(linked, ["label", "rep"], "left")
        .join(united.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    rows = _given(vectors).join(freeze(known), ["label", "v"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return rows.select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
