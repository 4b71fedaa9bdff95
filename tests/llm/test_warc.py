import base64
import hashlib

import pyarrow.fs as fs
import pytest
import zstandard
from pyspark.sql import functions as F

from ordinalis.llm import queries, warc
from ordinalis.storage import fresh_path


def archived(spark, df, least=0, **sizes):
    records = warc.with_revisits(df, "page_id", F.col("html"), least)
    manifest = warc.write_bundles(records, fresh_path(spark, "warc-test"), id_col="page_id", url_col="url", **sizes)
    return manifest, warc.read_records(manifest, id_col="page_id")


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


ROWS = [(5, "http://a/1", "same"), (3, "http://a/2", "same"), (3, "http://a/2", "same"), (9, None, "other é😀"), (8, "x\r\ny z", None),
        (7, "http://b", ""), (None, "http://c", "same"), (11, "http://d", "long " * 200_000), (12, "http://e", "WARC/1.1\r\n\r\n")]


@pytest.mark.parametrize("frame,bundle", [(warc.FRAME_BYTES, warc.BUNDLE_BYTES), (1, 1000)])
def test_round_trip(spark, frame, bundle):
    df = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, frame string, payload int").repartition(2)
    manifest, read = archived(spark, df, frame_bytes=frame, bundle_bytes=bundle)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect())
    first = {"same": 3, "": 7}
    expected = []
    for key, _, html in ROWS:
        data = (html or "").encode()
        leader = first.get(html or "", key)
        again = key != leader
        expected.append((str(key), len(data), sha(data), "revisit" if again else "response", leader if again else None))
    assert got == sorted(expected)
    payloads = {r.page_id: bytes(r.payload) for r in read.where("payload is not null").collect()}
    assert payloads[9] == "other é😀".encode() and payloads[11] == b"long " * 200_000
    assert manifest.columns == ["page_id", "bundle", "frame", "offset", "length"]


def test_small_payloads_are_never_revisited(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    kinds = {r.page_id: r.refers_to for r in archived(spark, df, least=3)[1].collect()}
    assert kinds == {1: None, 2: None, 3: None, 4: 3}


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    manifest, _ = archived(spark, df, frame_bytes=2000)
    rows = manifest.collect()
    system, path = fs.FileSystem.from_uri(rows[0].bundle)
    with system.open_input_stream(path, compression=None) as file:
        data = file.read()
    text = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == 40 and max(r.frame for r in rows) > 3
    reader = warc.BundleReader(system.open_input_file(path))
    one = rows[17]
    assert warc.parse(reader.frame(one.frame)[one.offset:one.offset + one.length])["_key"] == str(one.page_id)


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest())
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n\r\n", b"pay1oad\r\n\r\n"))


def test_empty_table(spark):
    assert archived(spark, spark.createDataFrame([], "page_id long, url string, html string"))[1].collect() == []


def test_query_over_all_pages(spark, sf_dir):
    html = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op2_warc_bundles(spark, sf_dir).collect()}
    first = {}
    for key in sorted(html):
        first.setdefault(html[key], key)
    assert found == {k: (len(v), sha(v), "response" if first[v] == k else "revisit", None if first[v] == k else first[v]) for k, v in html.items()}


def test_hot_payloads_are_split_and_columns_may_have_working_names(spark):
    """A third of the pages share a payload: the join by digest has an exchange on both sides."""
    rows = [(i, "same" if i % 3 == 0 else f"own {i}", "x", "y") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, html string, _page string, _digest string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = warc.with_revisits(pages, "page_id", F.col("html"))
        plan = made._jdf.queryExecution().executedPlan().toString()
        found = made.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "FileScan parquet [_same" in plan and "hashpartitioning(_same" in plan  # written, and with an exchange of its own
    assert {(r.page_id, r.refers_to) for r in found} == {(i, 0 if i % 3 == 0 and i else None) for i in range(3000)}
    assert all((r._page, r._digest) == ("x", "y") for r in found)
