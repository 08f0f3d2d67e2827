import hashlib
import random

import numpy as np
import pytest

from txgraph.llm import suffix


def brute(rows, length=100):
    """Result per (doc_id, text): earlier means smaller id (null last), or earlier start."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        covered = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                covered[i : i + length] = True
            seen.add(string)
        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out[doc_id, text] = (len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = suffix.remove(docs, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        ((doc_id, *want[doc_id, text]) for doc_id, text in rows), key=key
    )


def test_block_equals_brute_force():
    rng = random.Random(5)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    for _ in range(120):
        depth, segments, counts = rng.choice([5, 12, 33, 100]), [], []
        for _ in range(rng.randint(1, 12)):
            n = rng.randint(1, 60)
            if rng.random() < 0.6:
                at = rng.randint(0, 40)
                text = bytearray((base * 3)[at : at + n + depth - 1])
                if rng.random() < 0.5:
                    text[rng.randrange(len(text))] = rng.choice(b"abc\x00")
            else:
                text = bytes(rng.choice(rng.choice([b"a", b"ab", b"abc\x00\xff"])) for _ in range(n + depth - 1))
            segments.append(bytes(text))
            counts.append(n)
        seen, want = set(), []
        for text, n in zip(segments, counts):
            for i in range(n):
                want.append(text[i : i + depth] in seen)
                seen.add(text[i : i + depth])
        got = suffix.repeated_starts(segments, np.array(counts), np.arange(len(segments)), depth)
        assert got.tolist() == want


def test_two_stage_order_and_prefixes():
    rng = np.random.default_rng(3)
    for signs in (1, 2, 5, 256):
        text = rng.integers(0, signs, 700).astype(np.uint8)
        wanted = np.zeros(len(text), dtype=bool)
        wanted[:590] = rng.random(590) < 0.7
        order = suffix.suffix_order(text, wanted, 100)
        data = text.tobytes()
        keys = [data[i : i + 100] for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        lcp = suffix.common_prefixes(text, order, 100)
        for k in range(1, len(order)):
            a, b = keys[k - 1], keys[k]
            assert lcp[k] == next((i for i in range(100) if a[i] != b[i]), 100)


@pytest.mark.parametrize("hot", [20_000, 4])
def test_documents_equal_brute_force(spark, make_docs, hot):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 120)))
        if i % 3 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + passage + text[at:]
        rows.append((i, text))
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 2)] + [(200, "ab" * 300), (201, "é" * 90)]
    rng.shuffle(rows)
    check(make_docs(rows).repartition(4), hot_rows=hot)


def test_odd_rows(spark, make_docs, odd_rows):
    check(make_docs(odd_rows))
    check(make_docs([(1, "x" * 150), (1, "y" * 150), (None, "x" * 120), (None, "x" * 150), (1, "x" * 150)]))
    assert suffix.remove(make_docs(odd_rows).where("false")).count() == 0


def test_strip_keeps_columns_and_rows(spark, make_docs, odd_rows):
    docs = make_docs([*odd_rows, (50, "q" * 200 + "é"), (51, "é" + "q" * 200)])
    out = suffix.strip(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[4] == "a" and kept[51] == "é"
