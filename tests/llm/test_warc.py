import base64
import gzip
import hashlib
import random
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from txgraph.llm import warc

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)


def test_loser_tree_merges_in_order():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("https://www.Example.com:8080/A?b=1") == "com,example:8080)/a?b=1"
    assert warc.url_key("http://a.b.org") == "org,b,a)/"
    assert warc.url_key("no url") == "no url" and warc.url_key("http://[x") == "http://[x"


def test_archives(spark, tmp_path, monkeypatch):
    rows = [(1, "http://a.org/x", "same", "h", 1), (2, "http://b.org/", "same", "h", 1), (9, None, "same", "h", 1)]
    rows += [(3, "http://a.org/x\r\nEvil: 1", "é🙂 other\r\n\r\nmore", "h", 1), (4, "http://c.org", None, "h", 1)]
    rows += [(5, "http://c.org", "", "h", 1), (None, "http://d.org", "no id", "h", 1), (6, "x", "twice", "h", 1), (6, "x", "twice", "h", 1)]
    rows += [(100 + i, f"http://site{i % 3}.net/{i}", "page " + "z" * i, "h", 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    uri = f"file://{tmp_path}/archives"
    runs = warc.write_archives(warc.with_roles(df), uri)
    index = warc.merge_index(runs, rows_per_range=20)
    order = [(r.range_no, r.position, r.urlkey, r.ts, r.page_id) for r in index.collect()]
    keys = [(o[2], o[3], o[4] is not None, o[4] or 0) for o in sorted(order)]
    assert keys == sorted(keys) and len(keys) == len(rows)
    found = warc.read_archives(index, uri, payload=True).collect()
    least = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            least[html or ""] = max(least.get(html or "", page_id), page_id)
    want = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        keeper = least.get(html or "", page_id)
        revisit = page_id != keeper
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page_id, len(data), digest, "revisit" if revisit else "response", keeper if revisit else None, b"" if revisit else data))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "archives").iterdir())
    assert whole.count(b"WARC/1.1\r\n") == len(rows) and b"\r\nEvil: 1" not in whole


def test_short_payloads_are_no_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab", "", 0), (2, "u", "ab", "", 0), (3, "u", "abcd", "", 0), (4, "u", "abcd", "", 0)], SCHEMA)
    got = {r.page_id: r.refers_to for r in warc.archive(df, min_bytes=3, uri=f"file://{tmp_path}/x").collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}
    assert warc.archive(df.where("false"), uri=f"file://{tmp_path}/y").count() == 0


def test_read_back_is_dealt_by_bytes(spark):
    """One long archive is read by tasks in proportion to its bytes, every record once."""
    rows = [(i, f"http://h{i % 7}.org/p{i}", f"<p>{i}</p>" * 20, "en") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang string").coalesce(1)
    uri = warc.scratch_uri(spark, "warc-test")
    runs = warc.write_archives(warc.with_roles(pages), uri)
    index = warc.merge_index(runs)
    total = sum(r.length for r in index.collect())
    read = warc.read_archives(index, uri, task_bytes=total // 40)
    sizes = read.groupBy(F.spark_partition_id()).count().collect()
    assert read.rdd.getNumPartitions() >= 40 and max(r["count"] for r in sizes) < 60
    assert sorted(r.page_id for r in read.collect()) == list(range(300))
