import random
import re
from fractions import Fraction
from math import comb

import pytest

from txgraph.llm import rules
from txgraph.llm.common import read_table


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t\x0b", "a", "a b c", "a b c a b c", "a a a a", "A a A a A", "x\n\nx\n x\nx", "# * $%&|<>", "é漢🙂 é漢🙂 é漢🙂 z",
    "one two three\r\none two three\r\n", "a\x1cb\x85c d a\x1cb\x85c d", "a b c " * 200_000, "w" * 1_500_000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert rules.count(text) == brute(text)


def test_counts_of_random_texts():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab \n\t#<é") for _ in range(rng.randrange(80)))
        assert rules.count(text) == brute(text), text


@pytest.mark.parametrize("n,limit", [(1, 0.02), (30, 0.1), (400, 0.02), (997, 0.05)])
def test_binomial_tail(n, limit):
    p = Fraction(limit)
    total = Fraction(0)
    for k in range(n + 1):
        total += comb(n, k) * p**k * (1 - p) ** (n - k)
        got = rules.binomial_tail(k, n, limit)
        assert got == 1.0 if k >= n * limit else abs(got - float(total)) <= 1e-9 * float(total)
        if k > n * limit + 2:
            break


def test_cutoffs_are_the_strictest_that_the_bound_allows(spark):
    rng = random.Random(5)
    rule = rules.Rule("symbols", "n_symbols", "n_words", range(1000, 9, -10))
    rows = [("en", 100, 500, rng.randrange(20), 1, 0, 0) for _ in range(900)] + [("de", 100, 500, 3, 1, 0, 0)] * 20
    rows += [(None, 100, 500, 5, 1, 0, 0)] * 700
    held = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{c} long" for c in rules.COUNTS))
    got = {r.stratum: r for r in rules.certify(held, [rule], limit=0.1, alpha=0.05).collect()}
    values = [1000 * r[3] // 100 for r in rows if r[0] == "en"]
    for cutoff in rule.cutoffs:
        k = sum(v > cutoff for v in values)
        if rules.binomial_tail(k, 900, 0.1) > 0.05 / 3:
            break
        strict = (cutoff, k)
    assert (got["en"].cutoff, got["en"].k) == strict and got["en"].n == 900
    assert got[None].cutoff == 50 and "de" not in got  # 20 documents certify nothing


def test_false_rejections_on_documents_not_used(spark):
    """Certified on one half of the labels; the other half's good documents stay within the limit."""
    docs, labels = (read_table(spark, "/root/testdata/check_s", t) for t in ("documents", "labels"))
    judged = rules.judge(docs, labels.where("doc_id % 2 = 0"), limit=0.02)
    rest = judged.join(labels.where("doc_id % 2 = 1 AND quality = 1"), "doc_id").where("NOT base_failed")
    for row in rest.groupBy("stratum").agg({"*": "count", "kept": "count"}).collect():
        n = row[1]
        gone = rest.where(f"stratum <=> '{row.stratum}'").where("NOT kept").count()
        assert gone <= 0.02 * len(rules.RULES) * n
    assert judged.where("NOT kept AND NOT base_failed").count() > 0


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows).withColumnRenamed("key", "kept")
    labels = spark.createDataFrame([(1, 1), (8, 1), (8, 0), (9, None), (None, 1)], "doc_id long, quality int")
    got = rules.judge(docs, labels).collect()
    assert len(got) == len(odd_rows)
    want = sorted((i, *brute(t)) for i, t in odd_rows if i is not None)
    assert sorted((r.doc_id, *(r[c] for c in rules.COUNTS)) for r in got if r.doc_id is not None) == want
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in got)
    assert all(r.kept != r.base_failed for r in got)  # too few labels for a rule
    assert rules.judge(docs.where("false"), labels).count() == 0
    assert rules.judge(docs, labels.where("false")).count() == len(odd_rows)
