"""Personal data: base patterns, and terms that disclose a protected value.

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone numbers: leftmost
non-overlapping matches of each kind, of which those failing a check (octets, Luhn, number of
digits) are dropped. On top, corpus co-occurrence tells which terms give a protected value
away: for a value e and a term t anywhere in the same documents,

    disclosure(t, e) = PMI(t, e) / IC(e),   PMI = ln(N n(t, e) / (n(t) n(e))),  IC = ln(N / n(e)),

with document counts over whole texts; 1 means that whoever reads t knows e. Terms are runs of at
least three letters and digits, and names of two (a capital, or a letter without case, first);
parts of e itself are none. Of documents in which the same ``context`` characters stand before
(or behind) e, one is evidence: a term needs ``support`` of them on both counts, so copies of one
text are none, nor are near copies that differ elsewhere. In documents that hold e, terms at or above ``remove``
vanish, those at or above ``generalise`` become a placeholder, base spans become their kind.

Everything is DataFrame functions. Only matches are shuffled for the positions. A term in more
than n(e) (N / n(e))^(1 - generalise) documents can not reach the threshold, so words that are
common throughout meet no values. Patterns start at a run's edge or where the last match ended, so long runs cost linear time.

Null texts count as empty: no spans, an empty result. Equal rows (document and text) give equal
results; rows of one id and different texts are told apart by a hash of the text. Null ids are
kept. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txgraph.llm.common import freeze, small
from txgraph.operators.skew import heavy_threshold, salted_join
from txgraph.session import MAX_BROADCAST_ROWS

# --- fixed values -----------------------------------------------------------
KINDS = ["email", "ip", "card", "phone"]
# The patterns of the contract, possessive and anchored at the edge of a run (same matches).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# --- end of fixed values ----------------------------------------------------

HAS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no match
WORD = r"(?<![\p{L}\p{M}\p{N}])(?:[\p{L}\p{M}\p{N}]{3,}+|[\p{Lu}\p{Lo}][\p{L}\p{M}\p{N}](?![\p{L}\p{M}\p{N}]))"


@dataclass(frozen=True)
class Settings:
    context: int = 64  # characters on either side of a value that tell copies of a text
    support: int = 3  # documents of different contexts that a term must share with a value
    remove: float = 0.95
    generalise: float = 0.8


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum over the digits from the right, every second one doubled (9 off above 9)."""
    cells = F.split(F.reverse(digits), "")
    weighted = F.transform(
        F.filter(cells, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighted, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    small = F.forall(
        F.split(value, r"\."),
        lambda part: F.length(F.regexp_replace(part, "^0+", "")) <= 3,
    ) & F.forall(
        F.split(value, r"\."),
        lambda part: F.right(F.concat(F.lit("000"), part), F.lit(3)).cast("int") <= 255,
    )
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.length(digits).between(12, 19) & _luhn(digits))
        .otherwise(F.length(digits).between(9, 15))
    )


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) with nulls as empty texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def located(given: DataFrame, kind: str, pattern: str, where: Column, context: int) -> DataFrame:
    """Matches of one pattern with positions: gap and match lengths, summed along the text."""
    gaps, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    rows = (
        given.where(where)
        .select("doc_id", "text_hash", gaps.alias("gaps"), found.alias("found"))
        .where(F.size("found") > 0)
        .select(
            "doc_id",
            "text_hash",
            F.posexplode(
                F.transform(
                    "found",
                    lambda value, i: F.struct(
                        value.alias("value"),
                        F.length(F.get("gaps", i)).alias("gap"),
                        F.right(F.get("gaps", i), F.lit(context)).alias("before"),
                        F.left(F.get("gaps", i + 1), F.lit(context)).alias("after"),
                    ),
                )
            ).alias("i", "m"),
        )
    )
    return rows.select("doc_id", "text_hash", F.lit(kind).alias("kind"), "i", "m.*")


def _positions(rows: DataFrame) -> DataFrame:
    """start and end from the running sum of gaps and matches; equal rows count once."""
    once = rows.dropDuplicates(["doc_id", "text_hash", "kind", "i"])
    upto = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return once.select(
        "doc_id", "text_hash", "kind", "value", "before", "after",
        (end - F.length("value")).alias("start"), end.alias("end"),
    )


def base_spans(docs: DataFrame, context: int = Settings.context) -> DataFrame:
    """(doc_id, text_hash, kind, value, before, after, start, end) of every valid match."""
    given = keyed(docs)
    parts = []
    for kind in KINDS:
        where = F.col("text").contains(HAS[kind]) if kind in HAS else F.lit(True)
        if kind != "email":
            where = where & F.col("text").rlike("[0-9]")
        parts.append(located(given, kind, PATTERNS[kind], where, context))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _positions(rows).where(_valid(F.col("kind"), F.col("value")))


def words(text: Column) -> Column:
    """Distinct terms of a text outside its e-mail addresses, in lower case."""
    outside = F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(outside, F.lit(WORD), F.lit(0)), F.lower))


def evidence(base: DataFrame, context: int = Settings.context) -> DataFrame:
    """(kind, value, doc_id, text_hash, first_before, first_after): one row per document and value.

    The two marks tell the one document of each text before the value, and of each behind it. A
    side of fewer than ``context`` characters says little: there both sides together count.
    """
    of = ["kind", "value"]

    def side(name: str) -> Column:
        alone = F.length(name) >= context
        return F.min(F.when(alone, F.xxhash64(name)).otherwise(F.xxhash64("before", "after")))

    held = base.withColumn("value", F.lower("value")).groupBy(*of, "doc_id", "text_hash").agg(
        side("before").alias("b"), side("after").alias("a")
    )
    document = F.struct("doc_id", "text_hash")

    def first(side: str, before: int) -> DataFrame:
        least = held.groupBy(*of, side).agg(F.min(document).alias("d"))
        marks = [F.lit(before).alias("first_before"), F.lit(1 - before).alias("first_after")]
        return least.select(*of, "d.*", *marks)

    plain = held.select(*of, "doc_id", "text_hash", F.lit(0).alias("first_before"), F.lit(0).alias("first_after"))
    marked = plain.unionByName(first("b", 1)).unionByName(first("a", 0))
    return marked.groupBy(*of, "doc_id", "text_hash").agg(
        F.max("first_before").alias("first_before"), F.max("first_after").alias("first_after")
    )


def disclosing_terms(docs: DataFrame, base: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(kind, value, term, disclosure, action) of terms at or above the lower threshold."""
    given = keyed(docs)
    n = F.lit(float(max(1, given.count())))
    independent = F.least(F.sum("first_before"), F.sum("first_after"))
    held = freeze(evidence(base, s.context))
    values = (
        held.groupBy("kind", "value")
        .agg(F.count("*").alias("n_value"), independent.alias("contexts"))
        .where((F.col("contexts") >= s.support) & (F.col("n_value") < n))
        .withColumn("most", F.col("n_value") * F.pow(n / F.col("n_value"), 1 - s.generalise) * (1 + 1e-9))
        .drop("contexts")
    )
    values = freeze(values)
    count, most = values.agg(F.count("*"), F.max("most")).first()
    holders = freeze(held.join(small(values, count), ["kind", "value"]))
    # Document frequencies of the whole corpus, added up before anything is joined to them.
    counts = given.select(F.explode(words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    counts = freeze(counts.where(F.col("n_term").between(s.support, most or 0)))
    documents = holders.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    texts = given.join(small(documents, holders.count()), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    terms = texts.select("doc_id", "text_hash", F.explode(words(F.col("text"))).alias("term"))
    n_counts, total = counts.agg(F.count("*"), F.sum("n_term")).first()
    if n_counts <= MAX_BROADCAST_ROWS:
        rare = terms.join(F.broadcast(counts), "term")
    else:
        # A term of many documents is dealt over several tasks; n_term bounds its rows.
        limit = heavy_threshold(total)
        frequent = counts.where(F.col("n_term") >= limit).withColumnRenamed("n_term", "n")
        rare = salted_join(terms, counts, ["term"], frequent, limit)
    holding = holders.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"),
        "kind", "value", "n_value", "most", "first_before", "first_after",
    )
    part = (F.col("kind") != "email") & (F.col("value").contains(F.col("term")))
    pairs = (
        rare.join(holding, same & (F.col("n_term") <= F.col("most")))
        .where(~part)
        .groupBy("kind", "value", "term", "n_value", "n_term")
        .agg(F.count("*").alias("n_both"), independent.alias("contexts"))
        .where(F.col("contexts") >= s.support)
    )
    mutual = F.log(n * F.col("n_both") / (F.col("n_term") * F.col("n_value")))
    scored = pairs.withColumn("disclosure", mutual / F.log(n / F.col("n_value"))).where(
        F.col("disclosure") >= s.generalise
    )
    action = F.when(F.col("disclosure") >= s.remove, "remove").otherwise("generalise")
    return scored.select("kind", "value", "term", "disclosure", action.alias("action"))


def term_spans(docs: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, action, start, end) of disclosing terms where their value occurs."""
    held = (
        base.select("doc_id", "text_hash", "kind", F.lower("value").alias("value"))
        .join(terms, ["kind", "value"])
        .groupBy("doc_id", "text_hash", "term")
        .agg(F.max("action").alias("action"))  # 'remove' after 'generalise'
    )
    held = freeze(held)
    held = small(held, held.count()).select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("term").alias("t"), "action"
    )
    given = keyed(docs)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    words = located(given.join(held, same, "left_semi"), "term", WORD, F.lit(True), 0)
    found = _positions(words).withColumn("term", F.lower("value"))
    spans = found.join(held, same & (F.col("term") == F.col("t"))).select(
        "doc_id", "text_hash", "action", "start", "end"
    )
    # What lies within a base span is covered by that.
    covers = base.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("start").alias("s"), F.col("end").alias("e")
    )
    inside = same & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))
    return spans.join(covers, inside, "left_anti")


def spans(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, kind, order, start, end): all base spans, and those of the method."""
    base = freeze(base_spans(docs, s.context))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    own = base.select("doc_id", "text_hash", "kind", order.alias("order"), "start", "end")
    terms = freeze(disclosing_terms(docs, base, s))
    added = term_spans(docs, base, terms)
    kind = F.when(F.col("action") == "remove", "term_removed").otherwise("term_generalised")
    return own.unionByName(
        added.select("doc_id", "text_hash", kind.alias("kind"), F.lit(len(KINDS) + 1).alias("order"), "start", "end")
    )


def _by_document(found: DataFrame) -> DataFrame:
    row = F.struct("start", "order", "end", "kind")
    return found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(row)).alias("spans"))


def _attach(given: DataFrame, lists: DataFrame) -> DataFrame:
    lists = lists.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    return given.join(lists, same, "left").withColumn("spans", F.coalesce("spans", none)).drop("d", "h")


def report(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Counts, base digest and all spans of every row."""
    given = keyed(docs).drop("text")
    rows = _attach(given, _by_document(spans(docs, s)))

    def listed(items: Column) -> Column:
        return F.array_join(
            F.transform(
                items,
                lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
            ),
            ",",
        )

    base = F.filter("spans", lambda x: x["order"] <= len(KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return rows.select(
        "doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def sanitise(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """All columns of ``docs``, with the text sanitised: overlapping spans become one.

    Base spans and generalised terms become a placeholder of their kind in brackets (the kind
    of the first of overlapping spans); terms to remove go.
    """
    found = spans(docs, s)
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "order", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0)
    merged = (
        found.withColumn("opens", opens)
        .withColumn("block", F.sum("opens").over(before))
        .groupBy("doc_id", "text_hash", "block")
        .agg(F.min(F.struct("start", "order", "kind")).alias("first"), F.max("end").alias("end"))
        .select("doc_id", "text_hash", "first.start", "first.order", "end", "first.kind")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The given columns travel as one struct, so that none of them can clash.
    given = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("d"), F.xxhash64(text).alias("h")
    )
    lists = _by_document(merged).select("doc_id", "text_hash", "spans")
    joined = given.join(lists, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")), "left")
    label = (
        lambda x: F.when(x["kind"] == "term_removed", "")
        .when(x["kind"] == "term_generalised", "[TERM]")
        .otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
    )
    source = F.col("row.text").cast("string")
    cut = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, x: F.struct(
            F.concat(
                acc["out"],
                F.substr(source, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")),
                label(x),
            ).alias("out"),
            x["end"].alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substr(source, (acc["at"] + 1).cast("int"), F.length(source))),
    )
    clean = F.when(F.col("spans").isNull(), source).otherwise(cut)
    return joined.select(*[clean.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
