"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from txgraph.llm import (
    bpe,
    dialogue,
    hnsw,
    langid,
    packing,
    parity,
    pii,
    quality,
    rules,
    suffix,
    topk,
    vafile,
    warc,
)
from txgraph.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; counts and digests of ids and of the decoded bytes."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text covered by a string of 100 bytes that starts earlier, removed."""
    found = suffix.remove(read_table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the labelled documents outside the held-out fold."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


@query
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of each vector whose id is divisible by 20."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


ORACLE["op4_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in bins of 2048 words: no two near copies, four of a source at most."""
    return packing.pack_apart(read_table(spark, sf_dir, "documents"), capacity=2048, per_source=4)


@query
def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label by cosine of 0.98 or more, and their components."""
    return hnsw.near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE["op6_hnsw"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
  least.component_id, e.vec_id = least.component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.node
"""


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, merge the capture index, read all records back."""
    found = warc.archive(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op7_warc"] = """
WITH given AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), hashed AS (
  SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS hash FROM given
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY hash) AS keeper FROM hashed
), bits AS (
  SELECT *, list_reduce(
      list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', hash[i + 1]) - 1), 4, '0')),
      lambda x, y: x || y) AS bits
  FROM kept
)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_reduce(
    list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (list_sum(list_transform(range(5), lambda j: (substr(bits, (i * 5 + j + 1)::INT, 1) = '1')::INT * (16 >> j::INT))) + 1)::INT, 1)),
    lambda x, y: x || y) AS payload_digest,
  CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper = page_id THEN NULL ELSE keeper END AS refers_to
FROM bits
"""


@query
def op8_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with five-word shingles of Jaccard similarity 0.75 or more, as components."""
    return parity.join(read_table(spark, sf_dir, "documents"))


ORACLE["op8_parity_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END) AS s
  FROM words
), sets AS (SELECT DISTINCT doc_id, hash(s) AS s FROM shingled
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * inter >= 75 * (x.n + y.n - inter)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT node AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = node GROUP BY node
"""


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text: base patterns and disclosing terms."""
    return pii.report(read_table(spark, sf_dir, "documents"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from co-trained views of text and metadata."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.classify(docs, read_table(spark, sf_dir, "labels"))


@query
def op11_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors around 16 centroids after three rounds over a VA-file."""
    return vafile.cluster(read_table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64)


def _kmeans_round(n: int) -> str:
    return f"""
near{n} AS (
  SELECT v.row, v.vec_id, v.v, arg_min(c.c, {{'d': list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c}}) AS c,
    min(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
  FROM kept v CROSS JOIN cent{n} c GROUP BY v.row, v.vec_id, v.v
), sums{n} AS (
  SELECT c, list(s ORDER BY i) AS v FROM (
    SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS s
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{n}) GROUP BY c, i) GROUP BY c
), cent{n + 1} AS (
  SELECT c.c, coalesce(s.v, c.v)::HUGEINT[] AS v FROM cent{n} c LEFT JOIN sums{n} s ON s.c = c.c
)"""


ORACLE["op11_vafile"] = f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), cent0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INTEGER AS c, v
  FROM kept ORDER BY c LIMIT 16
), {", ".join(_kmeans_round(n) for n in range(4))}
SELECT vec_id, c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia,
  (SELECT sha256(array_to_string(f.v, ',')) FROM cent3 f WHERE f.c = near3.c) AS centroid_sha256
FROM near3
"""


@query
def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line counts, base rules, and rules with cutoffs certified per language."""
    judged = rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


_GRID = "\n  UNION ALL ".join(
    f"SELECT '{r.name}' AS rule, unnest(generate_series({r.cutoffs[0]}, {r.cutoffs[-1]}, {r.cutoffs.step}))::BIGINT AS cutoff"
    for r in rules.RULES
)
_VALUES = "\n  UNION ALL ".join(
    f"SELECT row, doc_id, stratum, base_failed, {', '.join(rules.COUNTS)}, '{r.name}' AS rule, "
    f"least(1000 * {r.over} // greatest({r.under}, 1), {max(r.cutoffs) + 1}) AS value FROM counted"
    for r in rules.RULES
)

ORACLE["op12_rules"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT row, i, w[i:i + 2] AS s FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2)
), twice AS (
  SELECT row, unnest([i, i + 1, i + 2]) AS pos
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, s) AS n FROM windows) WHERE n > 1
), repeated AS (SELECT row, count(DISTINCT pos) AS n FROM twice GROUP BY row
), counted AS (
  SELECT s.row, doc_id, stratum, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS base_failed
  FROM split s LEFT JOIN repeated r ON r.row = s.row
), valued AS ({_VALUES}
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1
), held AS (
  SELECT DISTINCT doc_id, stratum, rule, value, {', '.join(rules.COUNTS)}
  FROM valued WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)
), grid AS ({_GRID}
), tests AS (
  SELECT stratum, h.rule, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
  FROM held h JOIN grid g ON g.rule = h.rule GROUP BY ALL
), tails AS (
  SELECT stratum, rule, cutoff, CASE WHEN k >= 0.02 * n THEN 1 ELSE
    list_sum(list_transform(generate_series(0, k), lambda j:
      exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.02) + (n - j) * ln(0.98)))) END AS p
  FROM tests
), chosen AS (
  SELECT stratum, rule, min(cutoff) AS cutoff FROM tails
  WHERE p <= 0.05 / (SELECT count(*) * {len(rules.RULES)} FROM (SELECT DISTINCT stratum FROM held)) GROUP BY ALL
), verdict AS (
  SELECT v.row, coalesce(bool_or(value > cutoff), false) AS rejected
  FROM valued v LEFT JOIN chosen c ON c.rule = v.rule AND c.stratum IS NOT DISTINCT FROM v.stratum GROUP BY v.row
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM counted JOIN verdict ON verdict.row = counted.row
"""


@query
def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of the damaged conversations and the cheapest repair of each."""
    damaged = dialogue.damage(read_table(spark, sf_dir, "conversations"))
    return dialogue.report(damaged, dropped="gone")


def _steps_sql() -> str:
    rows = [
        f"('{initial}', {forced}, {before}, {after}, {cost}, '{dialogue._letters(digits):<2}')"
        for (initial, forced, cut), steps in dialogue.STEPS.items()
        if not cut
        for before, after, cost, digits in steps
    ]
    return ", ".join(rows)


ORACLE["op13_dialogue"] = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 20 AS lot
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
    CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE lot WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM given WHERE lot <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM damaged
), told AS (
  SELECT *, left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), rows AS (
  SELECT conv_id, pos, turn, role, text, before || initial AS pair,
    CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE '' END AS initial,
    body = '' AS blank, body <> '' AND again AS duplicate,
    body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated
  FROM told
), steps(initial, forced, before, after, cost, letters) AS (VALUES {_steps_sql()}
), every AS (SELECT DISTINCT conv_id FROM conversations
), way AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS letters FROM every
  UNION ALL
  SELECT conv_id, pos, state, best.cost, best.letters FROM (
    SELECT w.conv_id, r.pos, s.after AS state,
      min({{'cost': w.cost + s.cost + CASE WHEN r.truncated AND trim(s.letters) <> 'D' THEN 3 ELSE 0 END,
           'letters': w.letters || s.letters}}) AS best
    FROM way w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
      JOIN steps s ON s.initial = r.initial AND s.forced = (r.blank OR r.duplicate) AND s.before = w.state
    GROUP BY w.conv_id, r.pos, s.after)
), ended AS (
  SELECT e.conv_id, min({{'cost': w.cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
    'letters': w.letters || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I ' ELSE '  ' END}}) AS best, max(w.pos) AS n
  FROM every e JOIN way w ON w.conv_id IS NOT DISTINCT FROM e.conv_id
    AND w.pos = (SELECT count(*) FROM rows r WHERE r.conv_id IS NOT DISTINCT FROM e.conv_id)
  GROUP BY e.conv_id
), actions AS (
  SELECT conv_id, slot, half, substr(letters, 2 * slot - 1 + half, 1) AS action
  FROM (SELECT conv_id, best.letters AS letters, unnest(range(1, n + 2)) AS slot FROM ended) CROSS JOIN (VALUES (0), (1)) h(half)
), kept AS (
  SELECT a.conv_id, slot, half, action, role, text,
    row_number() OVER (PARTITION BY a.conv_id ORDER BY slot, half) AS nth
  FROM actions a LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM a.conv_id AND r.pos = a.slot
  WHERE action IN ('I', 'K', 'R')
), named AS (
  SELECT *, nth - CASE WHEN first_value(action || left(coalesce(role, ''), 1)) OVER (PARTITION BY conv_id ORDER BY nth) = 'Ks'
    THEN 1 ELSE 0 END AS turn_no
  FROM kept
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN action = 'K' THEN role WHEN turn_no % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN action = 'I' THEN '' ELSE text END, chr(10) ORDER BY nth) AS t
  FROM named GROUP BY conv_id
), counts AS (
  SELECT conv_id, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.best.cost AS cost,
  replace(e.best.letters, ' ', '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents; its last stage's rows."""
    return corpus_pipeline.run(spark, sf_dir)
