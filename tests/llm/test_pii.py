import hashlib
import math
import random
import re

from txgraph.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fits(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (1 + i % 2)
            total += d - 9 if d > 9 else d
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "") if fits(kind, m.group())]
    found.sort()
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)
    return (*(sum(x[2] == k for x in found) for k in PLAIN), hashlib.sha256(joined.encode()).hexdigest(), joined)


def test_base_spans_equal_brute_force(spark, make_docs, odd_rows):
    rng = random.Random(3)
    signs = "ab.@-+ 0123456789()%_é🙂\n."
    rows = [(100 + i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 80)))) for i in range(1500)]
    rows += [*odd_rows, (20, "x" * 1500 + "@" + "1" * 1500), (21, "4041894974608795 and 4041-8949-7460-8795, 4041894974608796")]
    rows += [(22, "a@b.c_d@e.f a@b.co_x@d.com a@@b.c 000000001.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 +1 (386) 555-3733")]
    got = pii.report(make_docs(rows)).collect()
    key = lambda r: (r[0] or -1, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert pii.report(make_docs(rows).where("false")).count() == 0


def test_disclosing_terms(spark, make_docs):
    rows = [(i, f"note{i} alpha beta word{i % 7} some common text here") for i in range(80)]
    rows += [(100 + i, f"common text w{i} of Zorblax at jo.doe@mail.com here some {i}") for i in range(6)]
    rows += [(200 + i, "copied text by Qwrt to me@mail.com and no more") for i in range(9)]  # one context
    rows += [(300, "zorblax alone in a clean document")]
    docs = make_docs(rows)
    terms = {(r.value, r.term): r.action for r in pii.disclosing_terms(docs, pii.base_spans(docs)).collect()}
    assert terms == {("jo.doe@mail.com", "zorblax"): "generalise"}
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert texts[100] == "common text w0 of [TERM] at [EMAIL] here some 0"
    assert texts[200] == "copied text by Qwrt to [EMAIL] and no more"
    assert texts[300] == rows[-1][1] and all(texts[i] == t for i, t in rows[:80])
    spans = {r.doc_id: r.spans for r in pii.report(docs).where("doc_id = 100").collect()}
    assert spans == {100: "term_generalised:18:25,email:29:44"}


def test_a_term_known_by_its_value_only_goes(spark, make_docs):
    rows = [(i, f"x{i} plain words") for i in range(40)]
    rows += [(100 + i, f"plain x{i} Zorblax: jo.doe@mail.com words") for i in range(5)]
    texts = {r.doc_id: r.text for r in pii.sanitise(make_docs(rows)).collect()}
    assert texts[100] == "plain x0 : [EMAIL] words"


def test_overlaps_become_one_and_columns_stay(spark, make_docs, odd_rows):
    docs = make_docs([(1, "a 1.2.3.4@x.com b +1.2.3.4.5.6.7.8.9 c"), *odd_rows[1:]])
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("doc_id = 1").first().text == "a [EMAIL] b [PHONE] c"


def test_no_python_in_the_plan(spark, make_docs):
    plan = pii.report(make_docs([(1, "a@b.cd")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_terms_of_whole_documents_equal_brute_force(spark, make_docs):
    """Far terms, names of two letters, identifiers with digits; scores by counting texts."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "kmt" for b in "aeio" for c in ("ra", "ns", "")]
    plain = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(150)]
    far = " ".join(["filler"] * 90)
    holds = [
        f"{rng.choice(vocabulary)} w{i}a Bo wrote {far} {'x' * i} jane.roe@site.org y{i}yy. {far} Key QX77Z1, card {rng.choice(vocabulary)}"
        for i in range(8)
    ]
    rows = [(i, t) for i, t in enumerate([*plain, *holds, far, "the key qx77z1 and more", ""])]
    docs = make_docs([*rows, (900, None)])
    got = {
        (r.value, r.term): round(r.disclosure, 9)
        for r in pii.disclosing_terms(docs, pii.base_spans(docs)).collect()
    }
    terms = []
    for _, text in [*rows, (900, "")]:
        outside = re.sub(PLAIN["email"], " ", text)
        runs = re.findall(r"[^\W_]+", outside)
        terms.append({x.lower() for x in runs if len(x) >= 3 or (len(x) == 2 and x[0].isupper())})
    held = [i for i, (_, t) in enumerate(rows) if "jane.roe@site.org" in t]
    n, expected = len(rows) + 1, {}
    for term in set().union(*(terms[i] for i in held)):
        both, every = sum(term in terms[i] for i in held), sum(term in t for t in terms)
        score = math.log(n * both / (every * len(held))) / math.log(n / len(held))
        if both >= 3 and score >= 0.8:
            expected["jane.roe@site.org", term] = round(score, 9)
    assert got == expected
    assert {"bo", "wrote", "qx77z1", "key", "card", "filler"} <= {t for _, t in got}
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "QX77Z1" not in texts[len(plain)] and "Bo" not in texts[len(plain)]
    assert texts[900] is None and texts[len(rows) - 2] == rows[-2][1]


def test_near_copies_are_no_evidence(spark, make_docs):
    rows = [(i, f"x{i} plain words of the corpus") for i in range(60)]
    same = "that goes on about this and that for some time without a change"
    rows += [(100 + i, f"version{i} of a long Qwrtz text {same} to me@mail.com and end{i}") for i in range(5)]
    docs = make_docs(rows)
    assert pii.disclosing_terms(docs, pii.base_spans(docs)).count() == 0


def test_columns_of_any_name_stay(spark, make_docs):
    docs = make_docs([(1, "to a@b.cd now"), (2, None)])
    for name in ["_d", "_h", "_spans", "d", "h", "row", "spans", "text_hash", "start"]:
        docs = docs.withColumn(name, docs.doc_id + 5)
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert out[1].text == "to [EMAIL] now" and out[2].text is None
    assert list(out[1].asDict()) == docs.columns and out[1]["_spans"] == out[2]["_d"] - 1 == 6
