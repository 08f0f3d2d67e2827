import corpus_pipeline
from tests.llm.test_parity import brute
from txgraph.llm import langid, suffix

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    """Each stage against a plain statement of what it may keep and change."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    rows = [{r.doc_id: r.text for r in t.collect()} if "text" in t.columns else None for t in tables]
    assert all(t.columns == columns for t in tables[:-1])
    told = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert set(rows[1]) == {i for i, r in told.items() if r.lang_pred != "und" and r.score >= 0.5}
    assert set(rows[2]) == {c for _, _, c in brute(list(rows[1].items()))}
    assert set(rows[3]) == set(rows[2]) == set(rows[4])
    kept = {r.doc_id: r.kept for r in suffix.remove(tables[2]).collect()}
    assert all(rows[3][i] == (rows[2][i] if kept[i] is None else kept[i]) for i in rows[2])
    import re

    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(mail.search(t) for t in rows[3].values()) and not any(mail.search(t) for t in rows[4].values())
    assert {r.doc_id for r in tables[5].collect()} == set(rows[4])
    assert all(r.n_chars == len(r.text) for r in tables[4].collect())


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "jaccard_join", "suffix_dedup", "pii", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_copies_of_shared_and_null_ids(spark, make_docs):
    """A clean text stays though its id is also that of a near copy; near copies of one id or none go."""

    def text(name, end):
        return " ".join([f"{name}{i}" for i in range(60)] + [end])

    rows = [(3, text("b", "x")), (7, text("a", "x")), (7, text("b", "y")), (9, text("c", "x")), (9, text("c", "y"))]
    rows += [(None, text("d", "x")), (None, text("d", "y")), (None, text("e", "x")), (None, text("b", "z"))]
    rows += [(11, text("f", "x")), (11, text("f", "x")), (12, None), (13, "")]
    kept = corpus_pipeline.jaccard_join(spark, make_docs(rows), SF)
    got = [(r.doc_id, (r.text or "-")[0]) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(
        [(3, "b"), (7, "a"), (9, "c"), (None, "d"), (None, "e"), (11, "f"), (12, "-"), (13, "-")], key=repr
    )


def test_other_columns_and_null_languages(spark):
    """Columns that clash with names inside the stages stay as they are; without languages all stay."""
    names = ["gone", "gone_hash", "score", "lang_pred", "_id", "_own", "_kept", "_d", "_h", "_spans"]
    rows = [(i, f"{w} {w} mail me at a{i}@b.org and say so again", None, "s", 40, *[f"v{i}"] * 10) for i, w in enumerate("abc")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        if name == "jaccard_join":
            continue  # covered by the whole run; takes a minute here
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 3, name
        assert all(r[c] == f"v{r.doc_id}" for r in out.collect() for c in names), name
        assert stage(spark, docs.where("false"), "").count() == 0
