"""N-gram Jaccard join by parity sketches.

A document is its set of five-word shingles, as 64-bit hashes. Two sets of sizes s <= t with
Jaccard similarity of 3/4 or more have t <= 4s/3 and differ in D = (s + t) / 7 elements at most.
In each size band the hash space is cut into P parts, and a part's sketch is the XOR of its
elements. An element of the difference disturbs one part, so of P sketches at least P - D agree
(pigeonhole). Ordered from rare to frequent, the same order everywhere, it is enough to look up
the D + 1 rarest sketches of each set: two that agree in P - D share one of these. The order
takes shingles that many documents share last, and empty parts after all, so boilerplate does
not bring documents together. Every shingle is counted over all documents; the FREQUENT most
frequent ones (by powers of two of their count, from 4 on) are told to all tasks.

Documents that share a looked-up sketch are a group. Where the first sketch that two sets share
is at place i of one and j of the other, the sketches before it differ, so they are only linked if
max(i, j) <= (s + t) / 7. A document without such a partner of fitting size leaves the group; so
unlike documents that have nothing but a passage in common are no group, however many they are, and
no pair of them is made. The other groups are resolved by stars: the smallest
member is compared with the others. Members outside its component are then compared with a few
inside it, other ones each turn, as long as that brings many of them in; those left take turns as
centres, compared with all others inside a task by their parities, CENTRES of them first and CENTRES times
as many each round; pairs of one component are done. So a group of near copies costs about as
many comparisons as it has members, and yet every link between different sets is either found
or implied by components. Compared are the Hamming distance of one-bit parities, a lower bound
of the difference, then the sets themselves.

Equal sets are one class; the groups hold one document per class and task at most. Null texts
count as empty. A text with fewer words than five has its whole sequence as its only shingle, one
without words an empty set, linked with nothing. Ids that are null or shared by different texts
are numbered first; equal rows get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import (
    TEXTS_PER_BATCH, chunks, discard, freeze, frugal, numbered, partitions_for, scratch_uri, small, written,
)
from txgraph.llm.components import components
from txgraph.llm.words import block_hashes, mix, shingles
from txgraph.session import session_conf

WORDS = 5
FREQUENT = 500_000  # shingles whose frequency is told to all tasks
COUNTED_BITS = 42  # of a shingle's hash; what agrees in them is counted together, which only moves the order
LEAST_LEVEL = 2  # log2 of the count from which a shingle may be frequent
FLUSH = 1_000_000
CHUNK = 4096
LEAST_PARTS = 64
RUN_BYTES = 512 << 10  # of texts that are hashed together
FILTER_BITS = 22
ROWS_PER_PART = 20_000  # of tables of numbers that the rounds join again and again
HELPED_TURNS = 8  # at most; what is left then is compared in full
STAR_ROWS = 20_000  # that leave a task together
CENTRES = 64  # of a group in the first round that compares in full

# A whole number for each of several texts, from their bytes and the offsets of the texts in these.
Measure = Callable[[np.ndarray, np.ndarray], np.ndarray]


def shingles_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text in turn, and where those of each begin and the last end."""
    words, before = block_hashes(data, offsets)
    hashes, upto = shingles(words, before, WORDS)
    for row in range(len(offsets) - 1):
        hashes[upto[row] : upto[row + 1]].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[upto[:-1][upto[:-1] < len(hashes)]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[upto]


def shingle_runs(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, then as ``shingles_of``) of runs of texts of a batch."""
    for first, _, data, offsets in chunks(batch.column(column), RUN_BYTES):
        yield first, *shingles_of(data, offsets)


def shingle_sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each text of a batch."""
    for first, own, upto in shingle_runs(batch, column):
        for row in range(len(upto) - 1):
            yield first + row, own[upto[row] : upto[row + 1]]


def parities(own: np.ndarray) -> np.ndarray:
    """One parity bit for each of m parts, m the power of two from twice the size on."""
    m = 1 << max(6, int(2 * len(own) - 1).bit_length())
    bits = np.bincount((own >> np.uint64(20) & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(bits.astype(np.uint8))


def parities_of(own: np.ndarray, upto: np.ndarray) -> list[bytes]:
    """The packed ``parities`` of each of several sets; none for an empty set."""
    sizes = np.diff(upto)
    m = np.where(sizes > 0, 1 << np.maximum(6, np.frexp(np.maximum(1, 2 * sizes - 1).astype(float))[1]).astype(np.int64), 0)
    base = np.concatenate([[0], np.cumsum(m)])
    at = (own >> np.uint64(20)).astype(np.int64) & (np.repeat(m, sizes) - 1)
    bits = np.bincount(np.repeat(base[:-1], sizes) + at, minlength=base[-1]) & 1
    packed = np.packbits(bits.astype(np.uint8)).tobytes()
    return [packed[a:b] for a, b in zip((base[:-1] // 8).tolist(), (base[1:] // 8).tolist(), strict=True)]


def hamming(a: np.ndarray, b: np.ndarray) -> int:
    """Hamming distance of two parity sketches; the longer one is folded to the shorter."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def linked(inter: int, s: int, t: int) -> bool:
    return 100 * inter >= 75 * (s + t - inter)


def _parts(band: int) -> int:
    """Parts of the hash space in a band: four and more for each element, so that few share one."""
    return max(LEAST_PARTS, 4 ** (band + 2))


def _part_of(own: np.ndarray, parts: int) -> np.ndarray:
    """The part of each shingle by its first bits, so that those of a sorted set are sorted."""
    return own >> np.uint64(65 - parts.bit_length())


def _key(sketch: np.ndarray, part: np.ndarray, band: int) -> np.ndarray:
    """A sketch as a key of 58 bits; the last six are zero and leave room for a rank."""
    return mix(sketch ^ (part * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(band + 1)) & ~np.uint64(63)


def _looked_up(own: np.ndarray, often: np.ndarray, band: int, most: int) -> np.ndarray:
    """The ``most`` + 1 first sketches of a sorted set in the order of one band, as 64-bit keys."""
    parts = _parts(band)
    part = _part_of(own, parts)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    rank = np.minimum.reduceat(often, starts)
    used = part[starts]
    keys = _key(np.bitwise_xor.reduceat(mix(own), starts), used, band)
    keys = keys[np.lexsort((keys, rank))]
    if len(keys) <= most:  # empty parts come last
        rest = np.setdiff1d(np.arange(parts, dtype=np.uint64), used)
        empty = np.sort(_key(np.uint64(0), rest, band))[: most + 1 - len(keys)]
        return np.concatenate([keys, empty])
    return keys[: most + 1]


def _looked_up_many(
    own: np.ndarray, upto: np.ndarray, often: np.ndarray, rows: np.ndarray, band: int, most: np.ndarray
) -> np.ndarray:
    """``_looked_up`` of some of several sets, one after another."""
    lengths = upto[rows + 1] - upto[rows]
    before = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.arange(before[-1]) + np.repeat(upto[rows] - before[:-1], lengths)
    taken, rank = own[flat], often[flat]
    part = _part_of(taken, _parts(band))
    new = np.ones(len(part), dtype=bool)
    new[1:] = part[1:] != part[:-1]
    new[before[:-1]] = True
    starts = np.flatnonzero(new)
    rank = np.minimum.reduceat(rank, starts)
    keys = _key(np.bitwise_xor.reduceat(mix(taken), starts), part[starts], band)
    # Rank and key in one number, which is sorted as it is.
    lot = (rank.astype(np.uint64) << np.uint64(58)) | (keys >> np.uint64(6))
    bounds = np.searchsorted(starts, before)
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        lot[a:b].sort()
    wanted = most + 1
    place = np.arange(wanted.sum()) - np.repeat(np.cumsum(wanted) - wanted, wanted)
    at = np.repeat(bounds[:-1], wanted) + place
    out = lot[np.minimum(at, len(lot) - 1)] << np.uint64(6)
    upto_out = np.concatenate([[0], np.cumsum(wanted)])
    for i in np.flatnonzero(np.diff(bounds) <= most).tolist():  # with empty parts
        one = slice(upto[rows[i]], upto[rows[i] + 1])
        out[upto_out[i] : upto_out[i + 1]] = _looked_up(own[one], often[one], band, int(most[i]))
    return out


def keys_of(own: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a set, and their places in the order: in the band of its size, and in the one
    below if a partner may be there.

    ``often`` has the known frequency of each shingle, 0 if it is not among the frequent ones.
    """
    s = len(own)
    band = (s.bit_length() - 1) // 2
    low = 4**band
    keys = [_looked_up(own, often, band, s // 3)]
    if band and -(-3 * s // 4) < low:
        keys.append(_looked_up(own, often, band - 1, (s + low - 1) // 7))
    return np.concatenate(keys), np.concatenate([np.arange(len(k)) for k in keys])


def keys_of_many(own: np.ndarray, upto: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``keys_of`` of several sets that are not empty: keys, places, and the number of keys of each."""
    s = np.diff(upto)
    band = (np.frexp(s.astype(float))[1].astype(np.int64) - 1) // 2
    low = 4**band
    below = (band > 0) & (-(-3 * s // 4) < low)
    keys, most, who = [], [], []
    for wanted, at, limit in ((np.ones(len(s), bool), band, s // 3), (below, band - 1, (s + low - 1) // 7)):
        for level in np.unique(at[wanted]).tolist():
            rows = np.flatnonzero(wanted & (at == level))
            keys.append(_looked_up_many(own, upto, often, rows, level, limit[rows]))
            most.append(limit[rows] + 1)
            who.append(rows)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n, rows = np.concatenate(most), np.concatenate(who)
    starts = np.cumsum(n) - n
    order = np.argsort(rows, kind="stable")  # keys of one set together
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n[order]) - n[order], n[order])
    key = np.concatenate(keys)[place + np.repeat(starts[order], n[order])]
    return key, place, np.bincount(rows, weights=n, minlength=len(s)).astype(np.int64)


def with_partner(s: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which members of a group, given by size and place, have one that they may be linked with.

    That is one of 3/4 to 4/3 of the size with 7 * max(places) <= sum of sizes. Small groups are
    compared in full; in others, sorted by size, the least ``7 * place - s`` of a range tells.
    """
    s, place = s.astype(np.int64), place.astype(np.int64)
    n, need = len(s), 7 * place - s
    if n <= 32:
        fits = (4 * s[:, None] >= 3 * s) & (4 * s >= 3 * s[:, None]) & (s >= need[:, None]) & (s[:, None] >= need)
        np.fill_diagonal(fits, False)
        return fits.any(axis=1)
    order = np.argsort(s, kind="stable")
    size, own = s[order], need[order]
    left = np.searchsorted(size, np.maximum(-(-3 * size // 4), own), side="left")
    right = np.searchsorted(size, 4 * size // 3, side="right")
    table = [own]
    while 2 << (len(table) - 1) <= n:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least need of the places from a to before b; a large number where there are none."""
        out = np.full(n, np.iinfo(np.int64).max)
        some = np.flatnonzero(b > a)
        level = np.frexp((b - a)[some].astype(float))[1] - 1
        for k in np.unique(level):
            at = some[level == k]
            out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << int(k))])
        return out

    me = np.arange(n)
    best = np.minimum(least(left, np.minimum(me, right)), least(np.maximum(me + 1, left), right))
    keep = np.zeros(n, dtype=bool)
    keep[order] = best <= size
    return keep


# --- the distributed part ----------------------------------------------------


def _counted_bits(tasks: int) -> int:
    """Bits of a counted shingle that name its bucket; the others fit 32 bits."""
    return max(COUNTED_BITS - 32, (4 * tasks).bit_length())


def profiles(
    given: DataFrame, folder: str, measure: Measure | None = None
) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """(uid, n, digest, bits, measured) of every document, and the frequent shingles with their level.

    Both come out of one pass: the counts of a bucket meet in one task and leave it as levels, the
    rows of documents pass through. ``measured`` is what ``measure`` tells of the text, else null.
    """
    spark = given.sparkSession
    bits = _counted_bits(given.rdd.getNumPartitions())
    low = COUNTED_BITS - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "n", "digest", "bits", "measured", "bucket", "low", "times"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            each = np.concatenate(held) >> np.uint64(64 - COUNTED_BITS)
            each.sort()
            starts = np.flatnonzero(np.concatenate([[True], each[1:] != each[:-1]]))
            found, times = each[starts], np.diff(np.append(starts, len(each)))
            bucket = (found >> np.uint64(low)).astype(np.int64)
            bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            rest = (found & np.uint64((1 << low) - 1)).astype("<u4")
            rows = []
            for i, j in zip(bounds, np.append(bounds[1:], len(found)), strict=True):
                # Most occur once: only the others' places and counts are told.
                often = np.flatnonzero(times[i:j] > 1)
                told = np.stack([often, times[i:j][often]]).astype("<u4").tobytes()
                rows.append((None, None, None, None, None, int(bucket[i]), rest[i:j].tobytes(), told))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            uids = batch.column(0).to_pylist()
            rows = []
            for first, end, data, offsets in chunks(batch.column(1), RUN_BYTES):
                all_, upto = shingles_of(data, offsets)
                measured = measure(data, offsets).tolist() if measure else [None] * (end - first)
                for row, packed in enumerate(parities_of(all_, upto)):
                    own = all_[upto[row] : upto[row + 1]]
                    digest = hashlib.blake2b(own, digest_size=16).digest()
                    rows.append((uids[first + row], len(own), digest, packed, measured[row], None, None, None))
                if len(all_):
                    held.append(all_)
                size += len(all_)
                if size >= 2 * FLUSH:
                    yield counted()
                    held, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )
        if held:
            yield counted()

    both = given.mapInArrow(
        frugal(run), "uid long, n long, digest binary, bits binary, measured long, bucket long, low binary, times binary"
    )
    key = F.coalesce("bucket", F.xxhash64("uid"))
    dealt = both.repartition(partitions_for(spark, given.rdd.getNumPartitions(), 1), key)
    both = written(
        dealt.sortWithinPartitions("bucket").mapInArrow(
            frugal(lambda batches: _levels(batches, low)),
            "uid long, n long, digest binary, bits binary, measured long, level int, names binary",
        ),
        f"{folder}/profiles",
    )
    told = both.where("level IS NULL").select("uid", "n", "digest", "bits", "measured").dropDuplicates(["uid"])
    levels = both.where("level IS NOT NULL").select("level", "n", "names")
    # From the most frequent level down as many levels as have FREQUENT shingles in all.
    chosen, total = [], 0
    for level, n in levels.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        total += n
        if total > FREQUENT:
            break
        chosen.append(level)
    rows = levels.where(F.col("level").isin(chosen)).select("level", "names").collect() if chosen else []  # bounded
    found = [np.frombuffer(r.names, "<u8") for r in rows]
    names = np.concatenate([np.zeros(0, "<u8"), *found])
    level = np.repeat(np.array([r.level for r in rows], np.int64), [len(x) for x in found])
    order = np.argsort(names)
    return told, (names[order], level[order])


def _levels(batches: Iterator[pa.RecordBatch], low: int) -> Iterator[pa.RecordBatch]:
    """(level, n, names) of the shingles of each bucket that occur often, by log2 of the count.

    Rows of documents, which come first, stay as they are.
    """
    out = ["uid", "n", "digest", "bits", "measured", "level", "names"]
    names: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def close(bucket: int) -> pa.RecordBatch:
        name, each = np.concatenate(names), np.concatenate(times)
        order = np.argsort(name, kind="stable")
        name, each = name[order], each[order]
        starts = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        each = np.add.reduceat(each, starts)
        often = np.flatnonzero(each >= 1 << LEAST_LEVEL)
        level = np.frexp(each[often].astype(float))[1] - 1
        name = name[starts[often]].astype("<u8") + np.uint64(bucket << low)
        found = np.unique(level).tolist()
        parts = [name[level == x] for x in found]
        return pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(found), pa.int64()),
                pa.array([len(x) for x in parts], pa.int64()),
                *[pa.nulls(len(found), pa.binary())] * 2,
                pa.nulls(len(found), pa.int64()),
                pa.array(found, pa.int32()),
                pa.array([x.tobytes() for x in parts], pa.binary()),
            ],
            names=out,
        )

    at = None
    for batch in batches:
        documents = batch.filter(batch.column(5).is_null())
        if documents.num_rows:
            n = documents.num_rows
            yield pa.RecordBatch.from_arrays(
                [*documents.columns[:5], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=out
            )
        counted = batch.filter(batch.column(5).is_valid())
        for bucket, rest, told in zip(*(c.to_pylist() for c in counted.columns[5:]), strict=True):
            if bucket != at and at is not None:
                yield close(at)
                names, times = [], []
            at = bucket
            name = np.frombuffer(rest, "<u4")
            each = np.ones(len(name), np.int64)
            place, n = np.frombuffer(told, "<u4").reshape(2, -1)
            each[place] = n
            names.append(name)
            times.append(each)
    if at is not None:
        yield close(at)


class Frequent:
    """The level of each shingle, 0 if it is not among the frequent ones."""

    def __init__(self, frequent: tuple[np.ndarray, np.ndarray]):
        self.names, self.levels = frequent
        self.last = np.uint64((1 << FILTER_BITS) - 1)
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)  # by the last bits, so that few are looked up
        self.maybe[self.names & self.last] = True

    def __call__(self, own: np.ndarray) -> np.ndarray:
        out = np.zeros(len(own), dtype=np.int64)
        if not len(self.names):
            return out
        own = own >> np.uint64(64 - COUNTED_BITS)
        some = np.flatnonzero(self.maybe[own & self.last])
        at = np.minimum(np.searchsorted(self.names, own[some]), len(self.names) - 1)
        out[some] = np.where(self.names[at] == own[some], self.levels[at], 0)
        return out


def groups(given: DataFrame, frequent: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(gid, hub, cuts, chunk, members) of documents that share a key: different ones per bucket.

    The members of a large group are dealt to ``cuts`` chunks by their uid modulo that number;
    each row has the hub, the smallest member.
    """
    shared = given.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT pairs

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        uids: list[int] = []
        sizes: list[int] = []
        owned: list[np.ndarray] = []
        size, often = 0, Frequent(shared.value)

        def deal() -> pa.RecordBatch:
            key = np.concatenate(keys)
            place = np.concatenate(places)
            document = np.repeat(np.arange(len(uids)), np.concatenate(owned))
            uid, s = np.array(uids, dtype=np.int64), np.array(sizes, dtype="<i8")
            bucket = ((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(bounds)):
                part = order[bounds[b] : bounds[b + 1]]
                owner = document[part]  # in runs, as documents come one after another
                cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                times = np.diff(np.append(cut, len(owner))).astype("<i4")
                whose = owner[cut]
                # Six bytes of a key beside the bucket; a chance match is a pair more to verify.
                short = key[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 1:7]
                columns = (short, place[part], uid[whose], s[whose], times)
                rows.append((int(b), *(c.tobytes() for c in columns)))
            kinds = [pa.int64()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["bucket", "key", "place", "uid", "size", "times"],
            )

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, own, upto in shingle_runs(batch, 1):
                new = []
                for row in np.flatnonzero(np.diff(upto)).tolist():
                    digest = hashlib.blake2b(own[upto[row] : upto[row + 1]], digest_size=16).digest()
                    if len(seen) > 200_000:
                        seen.clear()
                    if digest in seen:  # any copy stands for its class
                        continue
                    seen[digest] = 1
                    new.append(row)
                if not new:
                    continue
                n = np.diff(upto)[new]
                if len(new) < len(upto) - 1:
                    own = np.concatenate([own[upto[row] : upto[row + 1]] for row in new])
                    upto = np.concatenate([[0], np.cumsum(n)])
                key, place, times = keys_of_many(own, upto, often(own))
                keys.append(key)
                # A lower place than the true one only keeps a document in its group.
                places.append(np.minimum(place, 0xFFFF).astype("<u2"))
                uids += [names[first + row] for row in new]
                sizes += n.tolist()
                owned.append(times)
                size += len(key)
                if size >= FLUSH:
                    yield deal()
                    keys, places, uids, sizes, owned, size = [], [], [], [], [], 0
        if size:
            yield deal()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    yield from _grouped(held)
                    current, held = row["bucket"], []
                held.append(row)
        yield from _grouped(held)

    packed = given.mapInArrow(
        frugal(pack), "bucket long, key binary, place binary, uid binary, size binary, times binary"
    )
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(frugal(compare), "gid long, hub long, cuts long, chunk long, members binary")


def _grouped(held: list[dict]) -> Iterator[pa.RecordBatch]:
    """Groups of one bucket; equal member lists once."""
    if not held:
        return
    short = np.concatenate([np.frombuffer(r["key"], np.uint8).reshape(-1, 6) for r in held])
    key = np.concatenate([short, np.zeros((len(short), 2), np.uint8)], axis=1).view("<u8").ravel()
    # Key and row in one number, which is sorted as it is: a key loses its first bits where there are many.
    bits = np.uint64(len(key).bit_length())
    lot = (key << bits) | np.arange(len(key), dtype=np.uint64)
    lot.sort()
    key = lot >> bits
    same = key[1:] == key[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    if not shared.any():
        return
    at, key = (lot[shared] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), key[shared]
    uid, size, times = (
        np.concatenate([np.frombuffer(r[c], kind) for r in held]) for c, kind in (("uid", "<i8"), ("size", "<i8"), ("times", "<i4"))
    )
    whose = np.repeat(np.arange(len(times)), times)[at]
    uid, size = uid[whose], size[whose]
    place = np.concatenate([np.frombuffer(r["place"], "<u2") for r in held])[at].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    rows: list[tuple[int, int, int, int, bytes]] = []

    def add(members: np.ndarray) -> None:
        name = members.astype("<i8").tobytes()
        gid = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True)
        hub, rest = int(members[0]), members[1:]
        # The number of chunks follows the size's power of two, so that groups of one hub mostly
        # agree on it and repeated members meet.
        cuts = 1 if len(rest) <= CHUNK else 1 + (1 << (len(rest) // CHUNK).bit_length())
        place = rest % cuts
        for chunk in range(cuts):
            part = rest[place == chunk] if cuts > 1 else rest
            if len(part):
                rows.append((gid, hub, cuts, chunk, part.astype("<i8").tobytes()))

    two = starts[sizes == 2]
    s, t = size[two], size[two + 1]
    near = (4 * s >= 3 * t) & (4 * t >= 3 * s) & (s + t >= 7 * np.maximum(place[two], place[two + 1]))
    two = two[near & (uid[two] != uid[two + 1])]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["gid", "hub", "cuts", "chunk", "members"]
    a, b = np.minimum(uid[two], uid[two + 1]), np.maximum(uid[two], uid[two + 1])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b = a[new], b[new]
    for at in range(0, len(a), 10_000):  # pairs have one chunk, and no round asks for their group
        hub, other = a[at : at + 10_000], b[at : at + 10_000]
        gid = mix(mix(hub.view(np.uint64)) ^ other.view(np.uint64)).view(np.int64)
        one = [np.full(len(hub), x, dtype=np.int64) for x in (1, 0)]
        members = pa.array([x.tobytes() for x in other], pa.binary())
        yield pa.RecordBatch.from_arrays([*map(pa.array, (gid, hub, *one)), members], names=names)
    # Where all members fit each other, all stay; near copies have many such groups of the same members.
    low, high = np.minimum.reduceat(size, starts), np.maximum.reduceat(size, starts)
    fit = (sizes > 2) & (4 * low >= 3 * high) & (7 * np.maximum.reduceat(place, starts) <= 2 * low)
    alike = np.add.reduceat(mix(uid.astype(np.uint64)), starts)
    kept = (sizes > 2) & ~fit
    kept[np.flatnonzero(fit)[np.unique(alike[fit], return_index=True)[1]]] = True
    seen: set[bytes] = set()
    for start, n, whole in zip(starts[kept].tolist(), sizes[kept].tolist(), fit[kept].tolist(), strict=True):
        own = slice(start, start + n)
        members = np.unique(uid[own] if whole else uid[own][with_partner(size[own], place[own])])
        if len(members) < 2:
            continue
        name = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
        if name not in seen:
            seen.add(name)
            add(members)
    for at in range(0, len(rows), 10_000):
        columns = zip(*rows[at : at + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _gathered(df: DataFrame) -> DataFrame:
    """The checkpointed rows in no more partitions than their number needs.

    Each partition of a table is a task and three files in every exchange that reads it, however
    few its rows are, and the rounds make many exchanges.
    """
    kept = freeze(df)
    return kept.coalesce(max(1, -(-kept.count() // ROWS_PER_PART)))


def _stars(found: DataFrame) -> DataFrame:
    """(hub, x): the hub of each group with each other member, once per hub and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        hubs: list[int] = []
        lists: list[np.ndarray] = []
        size = 0

        def close() -> int:
            """Notes the members of the hub and chunk at hand; their number."""
            members = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            hubs.append(current[0])
            lists.append(members)
            return len(members)

        def pairs() -> pa.RecordBatch:
            hub = np.repeat(np.array(hubs, dtype=np.int64), [len(x) for x in lists])
            return pa.RecordBatch.from_arrays([pa.array(hub), pa.array(np.concatenate(lists))], names=["hub", "x"])

        for batch in batches:
            for hub, chunk, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, chunk) != current:
                    if held:
                        size += close()
                    if size >= STAR_ROWS:
                        yield pairs()
                        hubs, lists, size = [], [], 0
                    current, held = (hub, chunk), []
                held.append(np.frombuffer(members, "<i8"))
        if held:
            close()
            yield pairs()

    dealt = found.select("hub", "chunk", "members").repartition("hub", "chunk")
    return dealt.sortWithinPartitions("hub", "chunk").mapInArrow(run, "hub long, x long").distinct()


def _classes(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents as pairs of different classes, a < b, once each."""
    to = told.select(F.col("uid").alias("a"), F.col("first").alias("p"))
    at = told.select(F.col("uid").alias("b"), F.col("first").alias("q"))
    named = pairs.join(to, "a").join(at, "b").where("p <> q")
    return named.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _links(pairs: DataFrame, told: DataFrame, given: DataFrame) -> DataFrame:
    """Pairs of classes whose sets are similar: bounds first, then the sets."""
    pairs = _gathered(pairs)
    asked = _gathered(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct())
    own = told.where("uid = first").join(small(asked, asked.count()), "uid", "left_semi")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            s, t = (batch.column(i).to_numpy() for i in (2, 3))
            fits = 4 * np.minimum(s, t) >= 3 * np.maximum(s, t)
            for i in np.flatnonzero(fits):
                a, b = (np.frombuffer(batch.column(j)[int(i)].as_py(), np.uint8) for j in (4, 5))
                keep[i] = 7 * hamming(a, b) <= s[i] + t[i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep)) for i in range(2)], names=["a", "b"]
            )

    left = own.select(F.col("uid").alias("a"), F.col("n").alias("s"), F.col("bits").alias("u"))
    right = own.select(F.col("uid").alias("b"), F.col("n").alias("t"), F.col("bits").alias("v"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t", "u", "v")
    with session_conf(given.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="2000"):
        near = _gathered(near.mapInArrow(bound, "a long, b long"))
    return _verified(near, given)


def _verified(near: DataFrame, given: DataFrame) -> DataFrame:
    """Those pairs of classes whose sets are similar."""
    wanted = near.select(F.col("a").alias("uid")).union(near.select("b")).distinct()
    wanted = _gathered(wanted)
    texts = given.join(small(wanted, wanted.count()), "uid", "left_semi").dropDuplicates(["uid"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [own_.tobytes() for _, own_ in shingle_sets(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["uid", "shingles"])

    held = freeze(texts.select("uid", "text").mapInArrow(frugal(sets), "uid long, shingles binary"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(j)[i].as_py(), "<u8") for j in (2, 3))
                inter = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(linked(inter, len(a), len(b)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(j).filter(pa.array(keep, pa.bool_())) for j in range(2)], names=["a", "b"]
            )

    u = held.select(F.col("uid").alias("a"), F.col("shingles").alias("u"))
    v = held.select(F.col("uid").alias("b"), F.col("shingles").alias("v"))
    joined = near.join(u, "a").join(v, "b").select("a", "b", "u", "v")
    # Two whole sets a row: small batches bound the memory of a task.
    with session_conf(given.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        return _gathered(joined.mapInArrow(frugal(verify), "a long, b long"))


def _centres(open_: DataFrame, stray: DataFrame, most: int) -> DataFrame:
    """(gid, centres): the next strays of each group, ``most`` at most, above those done before."""
    kinds = open_.select("hub", "cuts").distinct()
    lists = (
        stray.join(kinds, "hub")
        .withColumn("chunk", F.pmod("x", "cuts"))
        .groupBy("hub", "cuts", "chunk")
        .agg(F.collect_set("x").alias("strays"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gids, found = [], []
            for gid, members, upto, strays in zip(*batch.columns, strict=True):
                own = np.frombuffer(members.as_py(), "<i8")
                mine = np.intersect1d(strays.values.to_numpy(), own)
                mine = mine[mine > upto.as_py()][:most]
                gids += [gid.as_py()] * len(mine)
                found += mine.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(gids, pa.int64()), pa.array(found, pa.int64())], names=["gid", "x"]
            )

    joined = open_.join(lists, ["hub", "cuts", "chunk"]).select("gid", "members", "upto", "strays")
    mine = joined.mapInArrow(run, "gid long, x long")
    return mine.groupBy("gid").agg(F.slice(F.array_sort(F.collect_set("x")), 1, most).alias("centres"))


def _helped(open_: DataFrame, stray: DataFrame, turn: int, most: int = 2) -> DataFrame:
    """(a, b): the strays of each group with a few members that are in the hub's component.

    Another few each turn, the same ones in groups that overlap.
    """
    kinds = open_.select("hub", "cuts").distinct()
    lists = (
        stray.join(kinds, "hub")
        .withColumn("chunk", F.pmod("x", "cuts"))
        .groupBy("hub", "cuts", "chunk")
        .agg(F.collect_set("x").alias("strays"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for members, strays in zip(*batch.columns, strict=True):
                own = np.frombuffer(members.as_py(), "<i8")
                mine = np.intersect1d(strays.values.to_numpy(), own)
                rest = np.setdiff1d(own, mine, assume_unique=True)
                lot = mix(rest.astype(np.uint64) + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15))
                for helper in rest[np.argsort(lot, kind="stable")[:most]]:
                    a.append(np.minimum(mine, helper))
                    b.append(np.maximum(mine, helper))
            columns = [pa.array(np.concatenate(x)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    joined = open_.join(lists, ["hub", "cuts", "chunk"]).select("members", "strays")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _around(open_: DataFrame, told: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): classes of each centre of a group and of those members that the bounds leave.

    The parities of a chunk's members, of which there are CHUNK at most, meet those of the
    group's centres in one task; only pairs within the bounds leave it, and none of one component.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, chunk, members, centres in zip(*batch.columns, strict=True):
                own, at = np.frombuffer(members.as_py(), "<i8"), centres.values.to_numpy()
                uid = np.concatenate([at, own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(uid), gid.as_py())),
                        pa.array(np.full(len(uid), chunk.as_py())),
                        pa.array(np.arange(len(uid)) < len(at)),
                        pa.array(uid),
                    ],
                    names=["gid", "chunk", "centre", "uid"],
                )

    def near(held: list[pa.RecordBatch]) -> np.ndarray:
        """The pairs of one group and chunk, from rows (centre, first, n, bits, component)."""
        table = pa.Table.from_batches(held)
        centre, name, n, within = (table.column(i).to_numpy() for i in (0, 1, 2, 4))
        bits = table.column(3).to_pylist()
        once = [np.flatnonzero(x)[np.unique(name[x], return_index=True)[1]] for x in (~centre, centre)]  # per class
        members, centres = (x.tolist() for x in once)
        by_length: dict[int, list[int]] = {}
        for i in members:
            by_length.setdefault(len(bits[i]), []).append(i)
        blocks = [
            (np.array(at), np.frombuffer(b"".join([bits[i] for i in at]), "<u8").reshape(-1, k // 8))
            for k, at in by_length.items()
        ]
        found = [np.zeros((2, 0), np.int64)]
        for c in centres:
            mine, s = np.frombuffer(bits[c], "<u8"), n[c]
            for at, block in blocks:
                t = n[at]
                some = np.flatnonzero((4 * np.minimum(t, s) >= 3 * np.maximum(t, s)) & (within[at] != within[c]))
                if not len(some):
                    continue
                left, right = mine, block[some]
                while len(left) > right.shape[1]:
                    left = left[: len(left) // 2] ^ left[len(left) // 2 :]
                while right.shape[1] > len(left):
                    half = right.shape[1] // 2
                    right = right[:, :half] ^ right[:, half:]
                apart = np.bitwise_count(right ^ left).sum(axis=1, dtype=np.int64)
                other = name[at[some[7 * apart <= s + t[some]]]]
                found.append(np.stack([np.minimum(other, name[c]), np.maximum(other, name[c])]))
        return np.concatenate(found, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            gid, chunk = (batch.column(i).to_numpy() for i in range(2))
            cuts = np.flatnonzero((gid[1:] != gid[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            found = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(gid)], strict=True):
                if (gid[a], chunk[a]) != current:
                    if held:
                        found.append(near(held))
                    current, held = (gid[a], chunk[a]), []
                part = batch.slice(a, b - a)
                held.append(pa.RecordBatch.from_arrays(part.columns[2:], names=part.schema.names[2:]))
            if found:
                pairs = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in near(held)], names=["a", "b"])

    rows = open_.select("gid", "chunk", "members", "centres").mapInArrow(
        listed, "gid long, chunk long, centre boolean, uid long"
    )
    names = labels.select(F.col("node").alias("first"), "component")
    known = told.where("n > 0").join(small(names, names.count()), "first", "left")
    known = known.select("uid", "first", "n", "bits", F.coalesce("component", "first").alias("component"))
    sketched = rows.join(known, "uid").select("gid", "chunk", "centre", "first", "n", "bits", "component")
    dealt = sketched.repartition("gid", "chunk")
    return dealt.sortWithinPartitions("gid", "chunk").mapInArrow(frugal(run), "a long, b long").distinct()


def _resolve(
    found: DataFrame, stars: DataFrame, labels: DataFrame, told: DataFrame, given: DataFrame
) -> DataFrame:
    """Labels once every group is within one component or fully compared."""
    stray = _gathered(_strays(stars, told, labels))
    sizes = F.length("members") > 8  # a hub with one other member is compared already
    whole = freeze(found.where(sizes | (F.col("cuts") > 1)).dropDuplicates(["gid", "chunk"]))
    # In a family of copies most strays are near one of the members that the hub is near to.
    for turn in range(HELPED_TURNS):
        left = stray.count()
        if not left:
            return labels
        open_ = whole.join(stray.select("hub").distinct(), "hub", "left_semi")
        links = _links(_classes(_helped(open_, stray, turn), told), told, given)
        edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
        labels = components(edges)
        stray = _gathered(_strays(stars, told, labels))
        if 4 * stray.count() > 3 * left:
            break
    open_ = whole.join(stray.select("hub").distinct(), "hub", "left_semi")
    open_ = open_.withColumn("upto", F.lit(-(2**63)).cast("long"))
    most = CENTRES
    while not stray.isEmpty():
        centres = _gathered(_centres(open_, stray, most))
        if centres.isEmpty():
            break
        open_ = freeze(
            open_.drop("upto", "centres").join(centres, "gid").withColumn("upto", F.element_at("centres", -1))
        )
        links = _verified(_gathered(_around(open_, told, labels)), given)
        edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
        labels = components(edges)
        stray = _gathered(_strays(stars, told, labels))
        most *= CENTRES
    return labels


def _strays(stars: DataFrame, told: DataFrame, labels: DataFrame) -> DataFrame:
    """Star pairs whose two documents are in different components."""
    names = labels.select(F.col("node").alias("first"), "component")
    name = told.join(names, "first", "left").select("uid", F.coalesce("component", "first").alias("component"))
    hub = name.select(F.col("uid").alias("hub"), F.col("component").alias("c"))
    x = name.select(F.col("uid").alias("x"), F.col("component").alias("d"))
    return stars.join(hub, "hub").join(x, "x").where("c <> d").select("hub", "x")


def clusters(docs: DataFrame, measure: Measure | None = None) -> DataFrame:
    """(doc_id, text_hash, uid, n_shingles, component, component_id) of each document, once.

    ``doc_id`` (which may be null) and ``text_hash`` are the key of a document; ``uid`` is its number,
    ``component`` the one of its representative and ``component_id`` the representative's id. Where ids
    tell all documents apart, they are the numbers. With ``measure`` there is a column ``measured``, so
    that who needs a number of every text need not read them again.
    """
    given, numbers, keys = numbered(docs)
    folder = scratch_uri(docs.sparkSession, "parity")
    with session_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        told, frequent = profiles(given, folder, measure)
    first = freeze(told.groupBy("digest").agg(F.min("uid").alias("first")))
    first = told.join(first, "digest").withColumn(
        "first", F.when(F.col("n") == 0, F.col("uid")).otherwise(F.col("first"))
    )
    told = _gathered(first.select("uid", "n", "bits", "first", "measured"))
    discard(folder)
    buckets = partitions_for(docs.sparkSession, given.rdd.getNumPartitions(), 1)
    with session_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        found = freeze(groups(given, frequent, buckets))
    stars = _gathered(_stars(found))
    links = _links(_classes(stars.select(F.col("hub").alias("a"), F.col("x").alias("b")), told), told, given)
    labels = _resolve(found, stars, components(links), told, given)
    names = labels.select(F.col("node").alias("first"), "component")
    rows = told.join(names, "first", "left").select(
        "uid", F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component"), "measured"
    )
    rows = rows.join(keys, "uid")
    if numbers is None:
        rows = rows.withColumn("component_id", F.col("component"))
    else:
        named = numbers.select(F.col("uid").alias("component"), F.col("d").alias("component_id"))
        rows = rows.join(named, "component")
    out = ["doc_id", "text_hash", "uid", "n_shingles", "component", "component_id"]
    return freeze(rows.select(*out, *(["measured"] if measure else [])))


def row_key() -> list[Column]:
    """The key of ``clusters`` for a row of documents: its id and the hash of its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id").cast("long"), F.xxhash64(text)]


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = clusters(docs)
    if rows.count() < docs.count():  # equal rows: each gets the result
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
        doc_id, text_hash = row_key()
        rows = docs.select(doc_id.alias("d"), text_hash.alias("h")).join(rows, same)
    return rows.select("doc_id", "n_shingles", "component_id")
