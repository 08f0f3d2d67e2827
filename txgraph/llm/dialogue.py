"""Cheapest repair of conversations: an integer-minimum path over rows and role states.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows are kept (0), get another role
(3) or are deleted (4, required for blank rows and repeats of an earlier role and text); turns of
empty text are inserted (3); a truncated row that is not deleted adds 3. Among the cheapest edits
those count whose initials (D, I, K, R in the order of the conversation) are the least text.

The edges of the graph carry whole numbers and nothing else is compared. Cost takes the high
digits. Below it each row owns a fixed place of two base-8 digits for its letters: the row's own
letter, or I and the letter, with a zero at the end where there is one letter only; a last place
holds the inserts at the end. No step (D, K, R, IK, IR) begins another one, so at the first place
where two paths differ their digits decide as the texts do. Two inserts in a row before a kept row
never pay, and an insert before a deleted row is as cheap, and a smaller text, after it; so these
steps are all that is needed.

Conversations of up to ``rows`` rows and ``text_bytes`` bytes are one path in one task. Longer
ones are cut by range into chunks: a chunk's path weights between all pairs of states are ranked,
and the ranks become the digits of a second graph of one place per chunk, decided by the same
minimum. Only the SHA-256 of a repaired text must see a conversation in one go; its rows stream
through a task in order and are not held.

Order: by turn (null first), then role, then the MD5 of the text. Null roles and texts count as
one space; a null conv_id is a conversation. Repeated rows are rows (the later ones are
duplicates). A role counts by its first character; one that is not s, u or a can not be kept. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import freeze, partitions_for, small
from txgraph.operators.prefix import running

START, SYSTEM, USER, ASSISTANT = range(4)
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
PLACE = 6  # bits of two base-8 digits
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
LONG_MAX = (1 << 63) - 1
# The initial that comes next, the name of that role, and the state it leads to.
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
END = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

CONTENT = "[^\\x20\\x09-\\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def _place(letters: str) -> int:
    return sum(DIGIT[c] << (PLACE - 3 * (i + 1)) for i, c in enumerate(letters))


def _letters(place: int) -> str:
    return "".join(LETTER[d] for d in (place >> 3, place & 7) if d)


def _steps(initial: str, forced: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """(state before, state after, cost, letters' digits) of all that may be done to a row."""
    out = []
    for state in range(4):
        out.append((state, state, DELETE, _place("D")))
        if forced:
            continue
        for inserted in ("", "I"):
            at = AFTER[NEXT[state]] if inserted else state
            extra = INSERT * len(inserted) + TRUNCATED * truncated
            if initial == NEXT[at] or (initial == "s" and at == START):
                out.append((state, AFTER[initial], extra + KEEP, _place(inserted + "K")))
            out.append((state, AFTER[NEXT[at]], extra + REROLE, _place(inserted + "R")))
    return out


STEPS = {(c, f, t): _steps(c, f, t) for c in ("s", "u", "a", "") for f in (False, True) for t in (False, True)}


def paths(kinds: list[tuple[str, bool, bool]], entry: int) -> list[int | None]:
    """Least weight from ``entry`` before the first row to each state after the last one."""
    n = len(kinds)
    at: list[int | None] = [None] * 4
    at[entry] = 0
    for i, kind in enumerate(kinds):
        shift = PLACE * (n - 1 - i)
        after: list[int | None] = [None] * 4
        for before, state, cost, digits in STEPS[kind]:
            if at[before] is None:
                continue
            weight = at[before] + (((cost << (PLACE * (i + 1))) | digits) << shift)
            if after[state] is None or weight < after[state]:
                after[state] = weight
        at = after
    return at


def split(weight: int, n: int) -> tuple[int, list[str]]:
    """Cost and the letters of each of ``n`` places."""
    code = (weight & ((1 << (PLACE * n)) - 1)).to_bytes(-(-PLACE * n // 8) or 1, "big")
    bits = int.from_bytes(code, "big")
    if n <= 64:
        places = [(bits >> (PLACE * (n - 1 - i))) & 63 for i in range(n)]
    else:  # two octal digits a place
        digits = f"{bits:0{2 * n}o}"
        places = [int(digits[2 * i : 2 * i + 2], 8) for i in range(n)]
    return weight >> (PLACE * n), [_letters(p) for p in places]


def cheapest(kinds: list[tuple[str, bool, bool]]) -> tuple[int, list[str]]:
    """Cost and letters of each row, and of the end, of one conversation."""
    n = len(kinds)
    ends = []
    for state, weight in enumerate(paths(kinds, START)):
        if weight is not None:
            last = END[state]
            ends.append((weight << PLACE) + ((INSERT * len(last)) << (PLACE * (n + 1))) + _place(last))
    return split(min(ends), n + 1)


def replay(roles: list[str], letters: list[str], state: int = START) -> Iterator[tuple[int | None, str, str]]:
    """(row or None, action, role) of every edit, in order; the state is followed."""
    for row, step in enumerate(letters):
        for action in step:
            if action == "D":
                yield row, "D", roles[row]
                continue
            initial = roles[row][:1] if action == "K" else NEXT[state]
            state = AFTER[initial]
            yield (None if action == "I" else row), action, (roles[row] if action == "K" else ROLE[initial])


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each (role, text) of a conversation: blank, duplicate, truncated."""
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        if not last:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def kinds_of(roles: list[str], told: list[str | None]) -> list[tuple[str, bool, bool]]:
    initials = [r[:1] if r[:1] in ("s", "u", "a") else "" for r in roles]
    return [(c, f in ("blank", "duplicate"), f == "truncated") for c, f in zip(initials, told, strict=True)]


REPORT = [
    ("conv_id", "long"), ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
    ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"),
]
REPORT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in REPORT)
EDIT_SCHEMA = "conv_id long, position long, action string, turn long, role string, text string"


KEY_BACK = "cast(nullif(conv_id, '') as long)"


def _gaps(turns: list[int | None]) -> int:
    known = [t for t in turns if t is not None]
    return min(LONG_MAX, max(known) - min(known) + 1 - len(set(known))) if known else 0


def _solve(conv_id: int | None, rows: list[tuple[int | None, str, str]]) -> tuple[tuple, list[tuple]]:
    """The report and the edits of one conversation in order."""
    roles, told = [r for _, r, _ in rows], faults([(r, t) for _, r, t in rows])
    cost, letters = cheapest(kinds_of(roles, told))
    edits = []
    for place, (row, action, role) in enumerate(replay(roles, letters)):
        turn, text = (None, "") if row is None else (rows[row][0], rows[row][2])
        edits.append((conv_id, place, action, turn, role, text))
    kept = "\n".join(f"{e[4]}:{e[5]}" for e in edits if e[2] != "D")
    illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
    counted = [sum(f == name for f in told) for name in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
    return (conv_id, _gaps([t for t, _, _ in rows]), *counted, illegal, cost, "".join(letters), digest), edits


def damage(turns: DataFrame) -> DataFrame:
    """Rows with faults put in by the CRC-32 of ``conv_id:turn``; a dropped row stays, ``gone``."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    lot = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    given = _plain(turns).drop("gone").withColumn("lot", lot)
    text = F.when(F.col("lot") == 1, F.lit("")).when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", ""))
    return given.select(
        "conv_id",
        "turn",
        F.when(F.col("lot") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("lot") == 0).alias("gone"),
        F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _plain(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """conv_id, turn, role, text without nulls in the latter two, and ``gone``."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    gone = F.col(dropped) if dropped else F.lit(False)
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *given, gone.alias("gone")
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("conv_id").alias("of")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    )


def _together(rows: DataFrame, n_rows: int, edits: bool) -> DataFrame:
    """Conversations of bounded size, each in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64() if k == "long" else pa.string()) for n, k in REPORT]
            if not edits
            else [(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string()) for c in EDIT_SCHEMA.split(", ")]
        )
        out, held, at, weight = [], [], (), 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal weight
            if at != ():
                told, changed = _solve(at[0], held)
                out.extend(changed if edits else [told])
                weight += sum(len(e[5]) for e in changed) if edits else 500
                held.clear()
            if weight > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()
                weight = 0

        for batch in batches:
            for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (conv_id,):
                    yield from close()
                    at = (conv_id,)
                if not gone:
                    held.append((turn, role, text))
        yield from close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    parts = partitions_for(rows.sparkSession, n_rows, 200_000)
    ordered = rows.withColumn("digest", F.md5("text")).repartition(parts, "conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", *_order()).select("conv_id", "turn", "role", "text", "gone")
    return ordered.mapInArrow(run, EDIT_SCHEMA if edits else REPORT_SCHEMA)


CHUNK_SCHEMA = (
    "conv_id string, chunk long, entry int, exit int, cost long, rank int, letters array<string>, roles array<string>, "
    "times array<long>, places array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string"
)


def _chunk(rows: pd.DataFrame) -> pd.DataFrame:
    """Least weights through a chunk between all pairs of states, ranked; and the chunk's counts."""
    rows = rows.sort_values("place")
    roles, times = rows.role.tolist(), rows.times.tolist()
    told = [
        "blank" if b else "duplicate" if e else "truncated" if t else None
        for b, e, t in zip(rows.blank, rows.earlier, rows.cut, strict=True)
    ]
    kinds, n = kinds_of(roles, told), len(roles)
    # Further copies of a row always go: they add to the cost and to the audit of every path.
    copies = DELETE * (sum(times) - n)
    found = [(s, t, w) for s in range(4) for t, w in enumerate(paths(kinds, s)) if w is not None]
    codes = sorted({w & ((1 << (PLACE * n)) - 1) for _, _, w in found})
    pairs = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False)) + sum(times) - n
    facts = {
        "conv_id": rows.conv_id.iloc[0],
        "chunk": rows.chunk.iloc[0],
        "roles": roles,
        "times": times,
        "places": rows.place.tolist(),
        "blank": sum(m for m, f in zip(times, told, strict=True) if f == "blank"),
        "duplicate": sum(m if f == "duplicate" else 0 if f == "blank" else m - 1 for m, f in zip(times, told, strict=True)),
        "truncated": told.count("truncated"),
        "illegal": pairs,
        "first": roles[0][:1],
        "last": roles[-1][:1],
    }
    out = []
    for entry, leave, weight in found:
        cost, letters = split(weight, n)
        rank = codes.index(weight & ((1 << (PLACE * n)) - 1))
        out.append(facts | {"entry": entry, "exit": leave, "cost": cost + copies, "rank": rank, "letters": letters})
    return pd.DataFrame(out, columns=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])


CHOICE_SCHEMA = (
    "conv_id string, chunk long, entry int, exit int, cost long, blank long, duplicate long, truncated long, "
    "illegal long, ending string"
)


def _choose(rows: pd.DataFrame) -> pd.DataFrame:
    """The chunks' way through their states: the same minimum, one place of five bits a chunk."""
    rows = rows.sort_values(["chunk", "entry", "exit"])
    per = [part for _, part in rows.groupby("chunk", sort=True)]
    n, bits = len(per), 5
    at: dict[int, tuple[int, tuple]] = {START: (0, ())}
    for i, part in enumerate(per):
        after: dict[int, tuple[int, tuple]] = {}
        for entry, leave, cost, rank in zip(part.entry, part.exit, part.cost, part["rank"], strict=True):
            if entry in at:
                weight = at[entry][0] + (int(cost) << (bits * n)) + (int(rank) << (bits * (n - 1 - i)))
                if leave not in after or weight < after[leave][0]:
                    after[leave] = (weight, (int(entry), int(leave), at[entry][1]))
        at = after
    ends = [((w + (INSERT * len(END[s]) << (bits * n)), END[s]), s) for s, (w, _) in at.items()]
    (weight, ending), state = min(ends)
    chosen, trail = [], at[state][1]
    while trail:
        chosen.append(trail[:2])
        trail = trail[2]
    chosen.reverse()
    one = [part.iloc[0] for part in per]
    across = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(one, one[1:], strict=False))
    totals = {c: int(sum(x[c] for x in one)) for c in ("blank", "duplicate", "truncated", "illegal")}
    totals["illegal"] += across
    conv = rows.conv_id.iloc[0]
    out = [
        {"conv_id": conv, "chunk": x["chunk"], "entry": e, "exit": t, "cost": weight >> (bits * n), "ending": ending} | totals
        for x, (e, t) in zip(one, chosen, strict=True)
    ]
    return pd.DataFrame(out, columns=[c.split()[0] for c in CHOICE_SCHEMA.split(", ")])


def _actions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (conv_id, place, part, action, role) of the chosen chunks; parts order what shares a place."""
    columns = ["conv_id", "place", "part", "action", "role"]
    for rows in batches:
        for row in rows.itertuples(index=False):
            out, part = [], 0
            steps = [letter for step in row.letters for letter in step]
            at = [i for i, step in enumerate(row.letters) for _ in step]
            for (i, action), (_, _, role) in zip(
                zip(at, steps, strict=True), replay(list(row.roles), list(row.letters), row.entry), strict=True
            ):
                out.append((row.conv_id, row.places[i], 0 if action == "I" else 1, action, role))
                if action != "I" and row.times[i] > 1:
                    out.append((row.conv_id, row.places[i], 2, f"D{row.times[i] - 1}", row.roles[i]))
            if row.is_last and row.ending:
                for part, role in enumerate([ROLE[NEXT[row.exit]], "assistant"][: len(row.ending)]):
                    out.append((row.conv_id, row.places[-1], 3 + part, "I", role))
            yield pd.DataFrame(out, columns=columns)


def _apart(rows: DataFrame, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Conversations of any size: counts per conversation, and their actions row by row."""
    blank = ~F.col("text").rlike(CONTENT)
    cut = ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    facts = rows.where("NOT gone").groupBy("conv_id", "turn", "role", F.md5("text").alias("digest"))
    facts = facts.agg(F.count("*").alias("times"), F.first(blank).alias("blank"), F.first(cut).alias("cut"))
    placed = freeze(running(facts, _order(), ["conv_id"], position="place"))
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first"))
    keys = ["conv_id", "role", "digest"]
    same = [F.col(f"p.{k}") == F.col(f"f.{k}") for k in keys]
    told = placed.alias("p").join(firsts.alias("f"), same).select(
        "p.*", (F.col("first") < F.col("place")).alias("earlier"), F.floor((F.col("place") - 1) / chunk_rows).alias("chunk")
    )
    chunks = freeze(told.groupBy("conv_id", "chunk").applyInPandas(_chunk, CHUNK_SCHEMA))
    narrow = [c for c in chunks.columns if c not in ("letters", "roles", "times", "places")]
    chosen = freeze(chunks.select(narrow).groupBy("conv_id").applyInPandas(_choose, CHOICE_SCHEMA))
    last = chosen.groupBy(F.col("conv_id").alias("of")).agg(F.max("chunk").alias("last_chunk"))
    named = chosen.join(last, F.col("conv_id") == F.col("of")).selectExpr(
        "conv_id as of", "chunk as at", "entry as came", "exit as went", "ending", "chunk = last_chunk as is_last"
    )
    here = (F.col("conv_id") == F.col("of")) & (F.col("chunk") == F.col("at"))
    here &= (F.col("entry") == F.col("came")) & (F.col("exit") == F.col("went"))
    way = chunks.join(named, here).select(
        "conv_id", "entry", "exit", "letters", "roles", "times", "places", "ending", "is_last"
    )
    schema = "conv_id string, place long, part int, action string, role string"
    steps = way.mapInPandas(_actions, schema).alias("s")
    at = (F.col("s.conv_id") == F.col("p.conv_id")) & (F.col("s.place") == F.col("p.place"))
    steps = steps.join(placed.alias("p"), at).selectExpr(
        "s.conv_id", "s.place", "s.part", "s.action", "s.role as role", "p.turn", "p.role as was", "p.digest"
    )
    return chosen, steps


def _texts(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """The actions with the text of the rows that stay."""
    held = rows.where("NOT gone").groupBy("conv_id", "turn", "role", F.md5("text").alias("digest"))
    held = held.agg(F.first("text").alias("text")).alias("h")
    names = {"conv_id": "conv_id", "turn": "turn", "role": "was", "digest": "digest"}
    same = [F.col(f"h.{a}").eqNullSafe(F.col(f"s.{b}")) for a, b in names.items()]
    joined = steps.alias("s").join(held, same)
    text = F.when(F.col("action") == "I", F.lit("")).otherwise(F.col("h.text"))
    turn = F.when(F.col("action") != "I", F.col("s.turn"))
    return joined.select("s.conv_id", "place", "part", "action", turn.alias("turn"), "s.role", text.alias("text"))


def _streamed(told: DataFrame) -> DataFrame:
    """SHA-256 and audit of each conversation; its rows pass through a task in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, audit, empty = (), hashlib.sha256(), [], True

        def close() -> pa.RecordBatch:
            found = [[at[0]], ["".join(audit)], [digest.hexdigest()]]
            names = ["conv_id", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in found], names=names)

        for batch in batches:
            for conv_id, action, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (conv_id,):
                    if at:
                        yield close()
                    at, digest, audit, empty = (conv_id,), hashlib.sha256(), [], True
                audit.append("D" * int(action[1:]) if len(action) > 1 else action)
                if action[0] != "D":
                    digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    empty = False
        if at:
            yield close()

    text = F.when(F.col("action").startswith("D"), F.lit("")).otherwise(F.col("text"))
    ordered = told.withColumn("text", text).repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")
    return ordered.select("conv_id", "action", "role", "text").mapInArrow(
        run, "conv_id string, audit string, repaired_sha256 string"
    )


def _cut(
    turns: DataFrame, rows: int, text_bytes: int, dropped: str | None
) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of bounded conversations, rows of the others (None without any), rows in all.

    The others have their conv_id as text, empty for null, so that it groups and joins alike.
    """
    given = _plain(turns, dropped)
    sizes = freeze(_sizes(given))
    n_rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    long_ones = sizes.where((F.col("n") > rows) | (F.col("bytes") > text_bytes)).select("of")
    n_long = long_ones.count()
    if not n_long:
        return given, None, n_rows
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    chosen = small(long_ones, n_long)
    named = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    far = given.join(chosen, same, "left_semi").withColumn("conv_id", named)
    return given.join(chosen, same, "left_anti"), far, n_rows


def report(
    turns: DataFrame, rows: int = 4096, text_bytes: int = 64 << 20, dropped: str | None = None
) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit, digest of the repaired text.

    ``dropped`` names a flag of rows that are not there but whose conversation is reported.
    """
    near, far, n_rows = _cut(turns, rows, text_bytes, dropped)
    found = _together(near, n_rows, edits=False)
    if far is None:
        return found
    chosen, steps = _apart(far, rows)
    streamed = _streamed(_texts(far, steps))
    names = [c for c, _ in REPORT]
    numbers = chosen.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in names[2:7]])
    turn, most = F.when(~F.col("gone"), F.col("turn")), F.lit(LONG_MAX).cast("decimal(38,0)")
    wide = F.max(turn).cast("decimal(38,0)") - F.min(turn).cast("decimal(38,0)") + 1 - F.countDistinct(turn)
    gaps = far.groupBy("conv_id").agg(F.when(F.count(turn) > 0, F.least(wide, most)).otherwise(F.lit(0)).cast("long").alias("gaps"))
    joined = gaps.join(numbers, "conv_id", "left").join(streamed, "conv_id", "left")
    joined = joined.na.fill(0).na.fill({"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})
    return found.unionByName(joined.withColumn("conv_id", F.expr(KEY_BACK)).select(*names))


def repair(
    turns: DataFrame, rows: int = 4096, text_bytes: int = 64 << 20, dropped: str | None = None
) -> DataFrame:
    """Every edit in order: conv_id, position, action (D, I, K, R), turn, role, text.

    The rows that are not deleted are the repaired conversation. Positions grow within a
    conversation. Each copy of a repeated row has its row here.
    """
    near, far, n_rows = _cut(turns, rows, text_bytes, dropped)
    found = _together(near, n_rows, edits=True)
    if far is None:
        return found
    _, steps = _apart(far, rows)
    told = _texts(far, steps)
    many = F.when(F.length("action") > 1, F.expr("int(substr(action, 2))")).otherwise(1)
    told = told.withColumn("copy", F.explode(F.sequence(F.lit(1), many)))
    placed = running(told, ["place", "part", "copy"], ["conv_id"], position="nth")
    return found.unionByName(
        placed.select(
            F.expr(KEY_BACK).alias("conv_id"), (F.col("nth") - 1).alias("position"), F.substring("action", 1, 1).alias("action"), "turn", "role", "text"
        )
    )
