"""Removal of repeated passages by two-stage suffix sorting.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier (in a
document of smaller id, or earlier in the same one). Texts are UTF-8; strings never cross texts
and are judged on the input.

How the work is spread. Every string of ``length`` bytes gets a key from its own bytes: the
least hash of its 32-byte substrings. Equal strings have equal keys, and neighbouring strings
mostly share one, so a text falls into runs of about 35 starts. Keys that occur once are done.
The other runs travel as segments to the task of their key, where a suffix array over all
segments of a block finds the equal strings:

* two-stage sorting: suffixes smaller than their successors are sorted directly, by 8 bytes at a
  time while they tie; all others are induced by one scan over the buckets of first bytes;
* common prefixes of neighbours in that order, up to ``length``: a group of neighbours with
  ``length`` bytes in common holds equal strings, and all but its first occurrence are marked.

Before a shuffle equal segments of one task are collapsed: only the earliest goes on, the others
are marked whole. Keys above a bound of occurrences (counted over all documents beforehand) are
split into one key per string, so nobody gathers a hot passage. Copies of a whole text are
decided by a digest and never searched.

Null texts count as empty. Rows of one id with equal texts are one document (each row gets its
result); ids that are null or shared by different texts are numbered first, null ids after all
others. Texts shorter than ``length`` lose nothing within themselves or to others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import chunks, freeze, frugal, new_texts, numbered, partitions_for
from txgraph.llm.words import mix

GRAM = 32
LENGTH = 100
RUN = 1024  # starts in a segment at most
HOT_ROWS = 20_000  # occurrences above which a key is split, if it is also a 100,000th of all runs
BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 1 << 20
FLUSH_RUNS = 200_000
MEMORY = 100_000  # digests that a task remembers


# --- keys and runs of one chunk of texts ------------------------------------


def string_keys(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start, the least hash of the substrings of GRAM bytes in its string, and the
    hash of the substring at the start itself."""
    h = data[:-1].astype(np.uint16) << 8 | data[1:]
    h = h[:-2].astype(np.uint32) << np.uint32(16) | h[2:]
    h = mix(h[:-4].astype(np.uint64) << np.uint64(32) | h[4:])
    width = 8
    while width < GRAM:
        h = mix(h[:-width] + h[width:] * np.uint64(0xC2B2AE3D27D4EB4F))
        width *= 2
    own = h
    window, reach = length - GRAM + 1, 1
    while reach * 2 <= window:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    if reach < window:
        h = np.minimum(h[: len(h) - (window - reach)], h[window - reach :])
    return h, own[: len(h)]


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(key, row, first start in the chunk, number of starts) of each run of equal keys.

    A run also ends where the leftmost substring of least hash falls out, so equal strings
    never share a run.
    """
    if len(data) < length:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    keys, own = string_keys(data, length)
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[1 : len(keys)] = (keys[1:] != keys[:-1]) | (own[:-1] == keys[:-1])
    stops = np.maximum(offsets[:-1], offsets[1:] - length + 1)
    opens[offsets] = True
    opens[stops] = True
    at = np.flatnonzero(opens)
    first, end = at[:-1], at[1:]
    row = np.searchsorted(offsets, first, side="right") - 1
    kept = first < stops[row]
    first, count, row = first[kept], (end - first)[kept], row[kept]
    if len(count) and count.max() > RUN:
        pieces = -(-count // RUN)
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, count, row = (np.repeat(x, pieces) for x in (first, count, row))
        count = np.minimum(RUN, count - place * RUN)
        first = first + place * RUN
    return keys[first], row, first, count


def _flushes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple]]:
    """Chunks of (uids, data, offsets, runs) whose texts are new in this task, some at a time."""
    seen: dict[bytes, int] = {}
    held, size = [], 0
    for batch in batches:
        uid = np.asarray(batch.column(0).to_pylist(), dtype=np.int64)
        for first, end, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
            texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(end - first)]
            new = np.array([len(t) >= length for t in texts], dtype=bool)
            kept = [t for t, n in zip(texts, new, strict=True) if n]
            new[new] = new_texts(kept, uid[first:end][new].tolist(), seen)
            if not new.any():
                continue
            kept = [t for t, n in zip(texts, new, strict=True) if n]
            joined = np.frombuffer(b"".join(kept), dtype=np.uint8)
            cuts = np.concatenate([[0], np.cumsum([len(t) for t in kept])]).astype(np.int64)
            found = runs(joined, cuts, length)
            held.append((uid[first:end][new], joined, cuts, found))
            size += len(found[0])
            if size >= FLUSH_RUNS:
                yield held
                held, size = [], 0
    if held:
        yield held


# --- two-stage suffix sorting of one block ----------------------------------


def _words(padded: np.ndarray) -> np.ndarray:
    """A view: at each position the next 8 bytes as a big-endian number."""
    return np.ndarray((len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))


def _sort_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` bytes at least; only ties are compared on."""
    words = _words(text)
    key = words[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(at) else key.astype(np.int64)
    for step in range(8, depth, 8):
        same = np.zeros(len(at), dtype=bool)
        equal = group[1:] == group[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        tied = np.flatnonzero(same)
        if not len(tied):
            break
        key = words[at[tied] + step].astype(np.uint64)
        order = np.lexsort((key, group[tied]))
        at[tied], key, members = at[tied][order], key[order], group[tied][order]
        new = np.concatenate([[False], (members[1:] != members[:-1]) | (key[1:] != key[:-1])])
        fresh = np.zeros(len(at), dtype=bool)
        fresh[tied] = new
        opens = np.zeros(len(at), dtype=bool)
        opens[1:] = group[1:] != group[:-1]
        group = np.cumsum(opens | fresh)
    return at


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions (a mask) in the order of their next ``depth`` bytes.

    Two stages: a suffix smaller than its successor is sorted directly; one that is larger is
    induced from its successor, which the bucket scan has met before. Larger suffixes precede
    the smaller ones in the bucket of their first byte. To induce, the successors of a wanted
    larger suffix are needed up to the next smaller one, so those are added for the scan.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 16, dtype=np.uint8)])
    differs = np.flatnonzero(text[1:] != text[:-1])
    nearest = np.searchsorted(differs, np.arange(n))
    larger = np.ones(n, dtype=bool)  # the end counts as smaller than any byte
    decided = nearest < len(differs)
    place = differs[nearest[decided]]
    larger[decided] = text[place] > text[place + 1]
    needed = wanted.copy()
    # A needed larger position needs its successor: carry on along each stretch of larger ones.
    stretch = np.concatenate([[0], np.cumsum(~larger)[:-1]])
    first_needed = np.full(int(stretch[-1]) + 1 if n else 1, n, dtype=np.int64)
    at = np.flatnonzero(wanted & larger)
    np.minimum.at(first_needed, stretch[at], at)
    needed |= np.arange(n) >= first_needed[stretch]
    direct = _sort_directly(padded, np.flatnonzero(needed & ~larger), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and needed[n - 1]:
        queues[text[n - 1]].append(np.array([n - 1]))  # larger than the empty end
    out = []

    def before(suffixes: np.ndarray) -> np.ndarray:
        """Needed larger predecessors of sorted suffixes, in order."""
        p = suffixes - 1
        p = p[p >= 0]
        return p[larger[p] & needed[p]]

    for byte in range(256):
        done, step = [], queues[byte]
        while step:
            part = np.concatenate(step)
            done.append(part)
            ahead = before(part)
            same = text[ahead] == byte
            step = [ahead[same]] if same.any() else []
        done.append(direct[bounds[byte] : bounds[byte + 1]])
        bucket = np.concatenate(done)
        if not len(bucket):
            continue
        out.append(bucket)
        ahead = before(bucket)
        ahead = ahead[text[ahead] != byte]
        target = text[ahead]
        order = np.argsort(target, kind="stable")
        ahead, target = ahead[order], target[order]
        cuts = np.flatnonzero(np.diff(target)) + 1
        for piece in np.split(ahead, cuts) if len(ahead) else []:
            queues[text[piece[0]]].append(piece)
    ordered = np.concatenate(out) if out else np.zeros(0, np.int64)
    return ordered[wanted[ordered]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each position with the one before it in the order, at most ``depth``."""
    padded = np.concatenate([text, np.zeros(depth + 16, dtype=np.uint8)])
    words = _words(padded)
    lcp = np.zeros(len(order), dtype=np.int64)
    open_ = np.arange(1, len(order))
    for step in range(0, depth, 8):
        if not len(open_):
            break
        apart = (words[order[open_] + step] ^ words[order[open_ - 1] + step]).astype(np.uint64)
        equal = np.full(len(open_), 8, dtype=np.int64)
        some = apart != 0
        # Leading equal bytes: the place of the highest byte that differs.
        top = np.zeros(int(some.sum()), dtype=np.int64)
        rest = apart[some]
        for i in range(8):
            top += (rest >> np.uint64(8 * (7 - i)) == 0).astype(np.int64)
        equal[some] = top
        lcp[open_] += equal
        open_ = open_[~some]
    return np.minimum(lcp, depth)


def repeated_starts(segments: list[bytes], counts: np.ndarray, ranks: np.ndarray, depth: int) -> np.ndarray:
    """Marks the starts whose string also starts earlier, over the starts of all segments.

    ``counts`` has the number of starts of each segment (it is ``depth`` - 1 bytes longer),
    ``ranks`` the order of the segments by (document, first start) with (rank, start within the
    segment) the order of occurrences. Returns a mask over all starts, segment by segment.
    """
    text = np.frombuffer(b"".join(segments), dtype=np.uint8)
    sizes = np.array([len(x) for x in segments], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    upto = np.cumsum(counts) - counts
    segment = np.repeat(np.arange(len(segments)), counts)
    starts = np.arange(counts.sum()) - upto[segment] + begins[segment]
    wanted = np.zeros(len(text), dtype=bool)
    wanted[starts] = True
    number = np.full(len(text), -1, dtype=np.int64)
    number[starts] = np.arange(len(starts))
    order = suffix_order(text, wanted, depth)
    lcp = common_prefixes(text, order, depth)
    which = number[order]
    group = np.cumsum(lcp < depth)
    occurrence = ranks[segment[which]] * (RUN * 2) + (which - upto[segment[which]])
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, occurrence)
    marked = np.zeros(len(starts), dtype=bool)
    marked[which] = occurrence > least[group]
    return marked


# --- the distributed part ----------------------------------------------------


def digests(given: DataFrame, length: int) -> DataFrame:
    """(uid, n_bytes, sha256, first): first is the smallest uid of an equal text."""
    rows = freeze(
        given.select(
            "uid",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        ).distinct()
    )
    first = freeze(rows.groupBy("sha256").agg(F.min("uid").alias("first")))
    return rows.join(first, "sha256")


def hot_keys(given: DataFrame, length: int, hot_rows: int) -> np.ndarray:
    """Keys of more than ``hot_rows`` runs and a 100,000th of all runs: at most 100,000 keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for held in _flushes(batches, length):
            keys = np.concatenate([found[0] for *_, found in held])
            total += len(keys)
            keys, counts = np.unique(keys, return_counts=True)
            often = counts >= max(2, min(64, hot_rows // 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[often].astype(np.int64)), pa.array(counts[often])], names=["key", "n"]
            )
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], names=["key", "n"])

    counted = given.mapInArrow(frugal(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counted = freeze(counted)
    total = counted.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    bar = max(hot_rows, total // 100_000)
    found = [r.key for r in counted.where((F.col("n") > bar) & F.col("key").isNotNull()).collect()]
    return np.sort(np.array(found, dtype=np.int64).astype(np.uint64))


def _single_keys(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A key per string, from all its bytes."""
    view = memoryview(data)
    return np.array(
        [int.from_bytes(hashlib.blake2b(view[s : s + length], digest_size=8).digest(), "little") for s in starts],
        dtype=np.uint64,
    )


def _split_hot(data: np.ndarray, found: tuple[np.ndarray, ...], hot: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of hot keys become one run per start, keyed by the whole string."""
    keys, row, first, count = found
    if not len(hot) or not len(keys):
        return found
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    is_hot = hot[at] == keys
    if not is_hot.any():
        return found
    sizes = count[is_hot]
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = np.repeat(first[is_hot], sizes) + place
    rows = np.repeat(row[is_hot], sizes)
    rest = ~is_hot
    return (
        np.concatenate([keys[rest], _single_keys(data, starts, length)]),
        np.concatenate([row[rest], rows]),
        np.concatenate([first[rest], starts]),
        np.concatenate([count[rest], np.ones(len(starts), dtype=np.int64)]),
    )


def _candidates(given: DataFrame, length: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """(uid, start, n, key, marked): runs whose key occurs again, and runs marked already.

    Packed runs are dealt by key, a few arrays per task and bucket, and compared there.
    """
    shared = given.sparkSession.sparkContext.broadcast(hot)  # at most 100,000 numbers

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _flushes(batches, length):
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            contents: dict[tuple[int, bytes], tuple[int, int]] = {}
            split = [(u, d, c, _split_hot(d, f, shared.value, length)) for u, d, c, f in held]
            keys = np.concatenate([f[0] for *_, f in split])
            again = _repeated(keys)
            at = 0
            for uids, data, cuts, (key, row, first, count) in split:
                order = np.lexsort((first, uids[row]))
                own = again[at : at + len(key)]
                at += len(key)
                marks = np.zeros(len(key), dtype=bool)
                view = memoryview(data)
                # Equal segments within a flush: only the earliest is kept as a candidate.
                for i in order[own[order]]:
                    content = (int(key[i]), hashlib.blake2b(view[first[i] : first[i] + count[i] + length - 1], digest_size=16).digest())
                    place = (int(uids[row[i]]), int(first[i] - cuts[row[i]]))
                    earlier = contents.get(content)
                    if earlier is None:
                        contents[content] = place
                    elif earlier < place:
                        marks[i] = True
                for column, values in zip(
                    columns, (key, uids[row], first - cuts[row], count, marks), strict=True
                ):
                    column.append(values)
            key, uid, start, count, marks = (np.concatenate(c) for c in columns)
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(bounds)):
                part = order[bounds[b] : bounds[b + 1]]
                rows.append(
                    (int(b), key[part].tobytes(), uid[part].tobytes(), start[part].astype("<i4").tobytes())
                    + (count[part].astype("<i2").tobytes(), marks[part].tobytes())
                )
            names = ["bucket", "key", "uid", "start", "n", "marked"]
            kinds = [pa.int64()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket's runs are compared in one go."""
        current, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    yield from _compared(held)
                    current, held = row["bucket"], []
                held.append(row)
        yield from _compared(held)

    packed = given.mapInArrow(
        frugal(pack), "bucket long, key binary, uid binary, start binary, n binary, marked binary"
    )
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(frugal(compare), "uid long, start int, n int, key long, marked boolean")


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have a key that occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    equal = ordered[1:] == ordered[:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    return again


def _compared(held: list[dict]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    key, uid, start, count, marked = (
        np.concatenate([np.frombuffer(r[name], kind) for r in held])
        for name, kind in (("key", "<u8"), ("uid", "<i8"), ("start", "<i4"), ("n", "<i2"), ("marked", "?"))
    )
    at = np.flatnonzero(_repeated(key))
    for cut in range(0, len(at), 100_000):
        part = at[cut : cut + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(uid[part]), pa.array(start[part]), pa.array(count[part].astype(np.int32))]
            + [pa.array(key[part].astype(np.int64)), pa.array(marked[part])],
            names=["uid", "start", "n", "key", "marked"],
        )


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """(key, uid, start, n, content) of candidate runs; content is null for marked runs.

    Equal segments of one task are collapsed once more, as a task now sees other documents.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents: dict[bytes, tuple[int, int]] = {}
        names = ["key", "uid", "start", "n", "content"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            rows, size = [], 0
            for uid, text, found in zip(*(batch.column(i) for i in range(3)), strict=True):
                data, uid = text.as_py().encode("utf-8"), uid.as_py()
                for run in found.as_py():
                    start, n, key = run["start"], run["n"], run["key"]
                    content = data[start : start + n + length - 1]
                    digest = hashlib.blake2b(content, digest_size=16, salt=key.to_bytes(8, "little", signed=True)).digest()
                    if len(contents) > MEMORY:
                        contents.clear()
                    earlier = contents.get(digest)
                    if earlier is not None and earlier < (uid, start):
                        rows.append((key, uid, start, n, None))
                    else:
                        contents[digest] = (uid, start)
                        rows.append((key, uid, start, n, content))
                        size += len(content)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return texts.mapInArrow(frugal(cut), "key long, uid long, start int, n int, content binary")


def _mark(segments: DataFrame, length: int, tasks: int) -> DataFrame:
    """(uid, begin, end): bytes to remove, one interval per stretch of marked starts."""

    def block(rows: list[tuple]) -> pd.DataFrame:
        """Equal segments first, then the suffix array of the different ones."""
        rows.sort(key=lambda r: (r[1], r[2]))
        first: dict[tuple[int, bytes], int] = {}
        out, kept = [], []
        for key, uid, start, n, content in rows:
            if (key, content) in first:
                out.append((uid, start, start + n + length - 1))
            else:
                first[key, content] = 1
                kept.append((uid, start, n, content))
        counts = np.array([r[2] for r in kept], dtype=np.int64)
        marked = repeated_starts([r[3] for r in kept], counts, np.arange(len(kept)), length)
        upto = np.cumsum(counts) - counts
        edge = np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            at = b
            while at < e:  # a stretch may run over several segments
                i = int(np.searchsorted(upto, at, side="right")) - 1
                stop = min(e, int(upto[i] + counts[i]))
                uid, start = kept[i][0], kept[i][1]
                out.append((uid, start + at - int(upto[i]), start + stop - int(upto[i]) + length - 1))
                at = stop
        return pd.DataFrame(out, columns=["uid", "begin", "end"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key; whole keys are gathered up to a block."""
        held, size, last = [], 0, None
        for pdf in batches:
            done = pdf["content"].isna()
            if done.any():
                part = pdf[done]
                yield pd.DataFrame({"uid": part["uid"], "begin": part["start"], "end": part["start"] + part["n"] + length - 1})
                pdf = pdf[~done]
            for row in pdf.itertuples(index=False, name=None):
                if size > BLOCK_BYTES and row[0] != last:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield block(held)

    dealt = segments.repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInPandas(frugal(run), "uid long, begin int, end int")


def _merged(intervals: list) -> list[tuple[int, int]]:
    """Disjoint, non-touching intervals that cover the same bytes."""
    out: list[list[int]] = []
    for begin, end in sorted((x["begin"], x["end"]) for x in intervals):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


def _search(given: DataFrame, length: int, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Digests of all documents, and (uid, text, spans) of those that lose bytes but are no copy."""
    spark = given.sparkSession
    told = freeze(digests(given, length))
    hot = hot_keys(given, length, hot_rows)
    buckets = partitions_for(spark, given.rdd.getNumPartitions(), 1)
    found = freeze(_candidates(given, length, hot, buckets))
    own = told.where("uid = first").select("uid")
    texts = given.dropDuplicates(["uid"]) if told.count() < given.count() else given
    run = F.struct("start", "n", "key")
    per_text = found.where("NOT marked").groupBy("uid").agg(F.collect_list(run).alias("runs"))
    searched = texts.join(per_text.hint("shuffle_hash"), "uid").select("uid", "text", "runs")
    late = _mark(_segments(searched, length), length, buckets)
    early = found.where("marked").select(
        "uid", F.col("start").alias("begin"), (F.col("start") + F.col("n") + F.lit(length - 1)).alias("end")
    )
    spans = (
        early.unionByName(late)
        .join(own, "uid", "left_semi")
        .groupBy("uid")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    )
    return told, texts.join(spans.hint("shuffle_hash"), "uid").select("uid", "text", "spans")


def remove(docs: DataFrame, length: int = LENGTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, sha256, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) of every row.

    sha256 is that of the whole text. kept (the remaining text, without characters that were cut
    through) and spans (begin, end in bytes) are null where nothing is removed; a text that is a
    copy of an earlier one goes whole, as one span.
    """
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    given, numbers, _ = numbered(docs)
    told, cut = _search(given, length, hot_rows)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uid, text, spans in zip(*(batch.column(i) for i in range(3)), strict=True):
                data, at, kept = text.as_py().encode("utf-8"), 0, []
                merged = _merged(spans.as_py())
                for begin, end in merged:
                    kept.append(data[at:begin])
                    at = end
                kept = b"".join([*kept, data[at:]])
                rows.append(
                    {"uid": uid.as_py(), "n_removed": len(data) - len(kept), "n_spans": len(merged)}
                    | {"kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode("utf-8", "ignore")}
                    | {"spans": [{"begin": b, "end": e} for b, e in merged]}
                )
            span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            fields = [("uid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*fields, ("kept", pa.string()), ("spans", pa.list_(span))]))

    part = cut.mapInArrow(
        frugal(strip),
        "uid long, n_removed long, n_spans long, kept_sha256 string, kept string, spans array<struct<begin:long,end:long>>",
    )
    copy = (F.col("uid") != F.col("first")) & (F.col("n_bytes") >= length)
    nothing = F.sha2(F.lit(b""), 256)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    rows = told.join(part, "uid", "left").select(
        "uid",
        "sha256",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(copy, "").otherwise(F.col("kept")).alias("kept"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
    )
    if numbers is not None:
        rows = rows.join(numbers, "uid")
        text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
        wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("th"))
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))
        return wanted.join(rows, same).select(
            "doc_id", "sha256", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"
        )
    rows = rows.withColumnRenamed("uid", "doc_id")
    if told.count() < docs.count():  # equal rows: each gets the result
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(rows, "doc_id")
    return rows


def strip(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of ``docs``, with what ``remove`` removes taken out of the text."""
    cut = remove(docs, length).where("n_removed > 0").select(
        F.col("doc_id").alias("_d"), F.col("sha256").alias("_h"), F.col("kept").alias("_kept")
    )
    cut = cut.dropDuplicates(["_d", "_h"])
    own = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    given = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_own": own})
    joined = given.join(cut, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_own") == F.col("_h")), "left")
    return joined.withColumn("text", F.coalesce("_kept", F.col("text").cast("string"))).select(docs.columns)
