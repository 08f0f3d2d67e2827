"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

The vocabulary is a rank file (base64 token, rank). A token sequence is the BPE encoding of a
piece exactly if each token is the encoding of its own bytes and each neighbouring pair is the
encoding of its joint bytes. So each prefix of a piece has one last token, and the encoding of
a longer prefix continues that of a shorter one. The transducer reads a piece byte by byte and
keeps one thread for each earlier position from which a vocabulary entry may still be read:
(tokens not yet emitted up to there, trie node since then). What all threads share is emitted;
a thread lives for at most the length of the longest entry, which bounds the lookahead.
States are built when first reached, and the table is emptied when it grows past a bound.

Null texts count as empty. Empty texts have no tokens. Text that a piece pattern leaves
unmatched has no tokens, as in the usual libraries.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, UNUSED = -1, -2
LONG_TEXT = 4 << 20  # characters; longer texts are split into pieces one at a time


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in data.splitlines() if line.strip())
    }


class State(dict):
    """One state: byte to (next state, emitted tokens), filled as bytes are met."""

    __slots__ = ("key",)


class Transducer:
    """Bytes of one piece in, token ids out; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000):
        self.ranks = ranks
        self.max_states = max_states
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.children: dict[int, int] = {}
        self.token_at: list[int] = [UNUSED]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                nxt = self.children.get(key)
                if nxt is None:
                    nxt = self.children[key] = len(self.token_at)
                    self.token_at.append(UNUSED)
                    self.inner.append(False)
                    self.inner[node] = True
                node = nxt
            self.token_at[node] = rank
        self.parts_cache: dict[int, tuple[int, int] | None] = {}
        self.spines: tuple[dict[int, tuple], dict[int, tuple]] = ({}, {})
        self.pair_cache: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.first = self._state((START, (((), 0),)))

    def _state(self, key: tuple) -> State:
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = State()
            state.key = key
        return state

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge ends the building of ``token``; None for single bytes and
        for entries that merging their own bytes does not give."""
        if token in self.parts_cache:
            return self.parts_cache[token]
        piece, found = self.token_bytes[token], None
        if len(piece) > 1:
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if (
                    left is not None
                    and right is not None
                    and left < token > right
                    and self._sound(left)
                    and self._sound(right)
                    and self._apart(left, right, token)
                ):
                    found = (left, right)
                    break
        self.parts_cache[token] = found
        return found

    def _sound(self, token: int) -> bool:
        return len(self.token_bytes[token]) == 1 or self._parts(token) is not None

    def _spine(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        """The parts at one edge while ``token`` is built, each with the rank that ends it."""
        known = self.spines[side].get(token)
        if known is None:
            parts = self._parts(token) if len(self.token_bytes[token]) > 1 else None
            inner = ()
            if parts:
                below = self._spine(parts[side], side)
                inner = (*below[:-1], (parts[side], token))
            known = self.spines[side][token] = (*inner, (token, 1 << 62))
        return known

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether building ``left`` and ``right`` side by side never merges across, up to rank
        ``until``. A part lives from its own rank until that of the merge which takes it in; of
        equal ranks the merge further left comes first."""
        ends, starts = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = ends[i], starts[j]
            across = self.ranks.get(self.token_bytes[a] + self.token_bytes[b])
            if across is not None and across < a_ends and across <= b_ends and across < until:
                return False
            if a_ends >= until and b_ends >= until:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _fits(self, left: int, right: int) -> bool:
        known = self.pair_cache.get((left, right))
        if known is None:
            if len(self.pair_cache) > 2 * self.max_states:
                self.pair_cache.clear()
            known = self.pair_cache[left, right] = self._apart(left, right, 1 << 62)
        return known

    def _advance(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        last, threads = state.key
        alive, whole, step_to, token_at = [], None, self.children, self.token_at
        for pending, node in threads:
            child = step_to.get(node << 8 | byte)
            if child is None:
                continue
            if whole is None:
                token = token_at[child]
                if token >= 0 and self._sound(token):
                    before = pending[-1] if pending else last
                    if before == START or self._fits(before, token):
                        whole = (*pending, token)
            if self.inner[child]:
                alive.append((pending, child))
        if whole is None:
            raise ValueError(f"no token for byte {byte}")
        alive.append((whole, 0))
        # The oldest thread has the fewest tokens before it; what all agree on leaves.
        oldest = alive[0][0]
        shared = len(oldest)
        for pending, _ in alive:
            while pending[:shared] != oldest[:shared]:
                shared -= 1
            if not shared:
                break
        emitted = whole[:shared]
        if emitted:
            last = emitted[-1]
            rest = tuple([(pending[shared:], node) for pending, node in alive])
        else:
            rest = tuple(alive)
        if oldest[shared:] and all(pending for pending, _ in rest):
            last = UNUSED
        step = state[byte] = (self._state((last, rest)), emitted)
        return step

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one piece; a piece that is an entry itself is that entry."""
        entry = self.ranks.get(piece)
        if entry is not None:
            return (entry,)
        if len(self.states) > self.max_states:
            self._reset()
        state, out = self.first, []
        for byte in piece:
            step = state.get(byte) or self._advance(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
                if len(out) & 0xFFF == 0 and len(self.states) > self.max_states:
                    key = state.key
                    self._reset()
                    state = self._state(key)
        out += state.key[1][-1][0]
        return tuple(out)


class _Pieces(dict):
    """Packed ids of pieces seen before, in two generations; the older one goes when this is full.

    Ids are kept as little-endian 32-bit integers: no object per id, none the collector visits.
    """

    def __init__(self, machine: Transducer, most: int = 150_000, longest: int = 64):
        super().__init__()
        self.machine, self.most, self.longest = machine, most, longest
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            tokens = self.machine.encode(piece.encode("utf-8"))
            ids = b"".join([token.to_bytes(4, "little") for token in tokens])
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Texts to ids: pieces by pattern, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        self.pieces = _Pieces(self.machine)
        self.pattern = regex.compile(pattern)

    def encode(self, text: str) -> np.ndarray:
        get = self.pieces.__getitem__
        if len(text) > LONG_TEXT:
            found: Iterable[str] = (m.group() for m in self.pattern.finditer(text))
        else:
            found = self.pattern.findall(text)
        return np.frombuffer(b"".join(map(get, found)), dtype="<u4")


class Utf8Machine:
    """Incremental UTF-8: bytes in any cuts, text out; its state is the open sequence.

    Invalid bytes become U+FFFD as in a decoding of the whole; ``bytes`` of valid text survive.
    """

    def __init__(self) -> None:
        self.open = b""

    @staticmethod
    def _open_tail(data: bytes) -> int:
        """Length of the unfinished sequence at the end (0 to 3 bytes)."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                if back >= need or byte in (0xC0, 0xC1) or byte > 0xF4:
                    return 0
                if back > 1:
                    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
                    if not low <= data[-back + 1] <= high:
                        return 0
                return back
        return 0

    def push(self, data: bytes) -> str:
        data = self.open + data
        tail = self._open_tail(data)
        self.open = data[len(data) - tail :] if tail else b""
        return data[: len(data) - tail].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    """Ids to text, a block of ids at a time; unknown ids raise."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.table: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.table[rank] = token

    def stream(self, ids: np.ndarray, block: int = 1 << 14) -> Iterator[str]:
        machine, get = Utf8Machine(), self.table.__getitem__
        for at in range(0, len(ids), block):
            yield machine.push(b"".join(map(get, ids[at : at + block].tolist())))
        yield machine.close()


_WORKER: dict[tuple[int, str], tuple[Encoder, Decoder]] = {}


def _tools(data: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder for each worker process and vocabulary."""
    key = (hash(data), pattern)
    if key not in _WORKER:
        ranks = parse_ranks(data)
        _WORKER.clear()
        _WORKER[key] = (Encoder(ranks, pattern), Decoder(ranks))
    return _WORKER[key]


def _vocabulary(spark: SparkSession, ranks_path: str):
    """The rank file, fixed in size (about 1 MB), as a broadcast."""
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, ids array<int>) of every row; no shuffle."""
    data = _vocabulary(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _tools(data.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [encoder.encode(x or "").astype(np.int32) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"]
                )

    out = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return out.mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)


def decode(
    tokens: DataFrame, ranks_path: str, pattern: str = "", key: str = "doc_id"
) -> DataFrame:
    """(key, text) from (key, ids); null ids give an empty text."""
    data = _vocabulary(tokens.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(data.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [
                    "".join(decoder.stream(np.asarray(x or [], dtype=np.int64)))
                    for x in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], names=["key", "text"]
                )

    out = tokens.select(F.col(key).cast("long").alias("key"), "ids")
    return out.mapInArrow(run, "key long, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode each text in one task, and keep counts and digests of both."""
    data = _vocabulary(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(data.value, pattern)
        for batch in batches:
            counts, id_hashes, text_hashes = [], [], []
            for value in batch.column(1):
                ids = encoder.encode(value.as_py() or "")
                digest = hashlib.sha256()
                for piece in decoder.stream(ids):
                    digest.update(piece.encode("utf-8"))
                counts.append(len(ids))
                id_hashes.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return out.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
