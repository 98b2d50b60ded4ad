import base64
import gzip
import hashlib
import io
import random
import struct

import duckdb
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from strata.llm import warc as w
from strata.llm.common import new_folder
from strata.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    """Unique pages, copies, empty and null payloads, odd URLs, null ids, a repeated row, a very long page; clashing columns."""
    rng = random.Random(2)
    text = lambda k: "".join(rng.choice("ab<>é日\r\n: \0") for _ in range(k))
    rows = [(i, f"http://h/{i}", text(rng.randint(1, 400))) for i in range(60)]
    rows += [(100 + i, f"http://copy/{i}", "the same page") for i in range(90)]
    rows += [(300, "u", ""), (301, None, None), (302, "u", ""), (303, "a\r\nb: c\x7f", "x\r\n\r\ny"), (-5, " spaced ", "the same page"), (None, "n", "the same page"),
             (None, "n1", "no id"), (None, "n2", "no id"), (400, "big", text(2000) * 600), (401, "t", "twice"), (401, "t", "twice"), (402, "WARC/1.1", "WARC/1.1\r\n\r\n")]
    return rows, spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("key", "to", "payload", "count", "_key", "_hot", "revisit")}).repartition(5)


def expected(rows, least=0):
    groups = {}
    for i, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((i is not None, i or 0, url or ""))
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        top = max(groups[data])
        revisit = len(data) >= least and top != (i is not None, i or 0, url or "")
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    top[1] if revisit and top[0] else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,frame", [(0, 1 << 20), (0, 1), (5, 700), (14, 5000)])
def test_round_trip(spark, pages, least, frame):
    rows, df = pages
    path = new_folder(spark, "warc-test")
    index = w.write(df, path, min_payload=least, frame_bytes=frame, bundle_bytes=3000 if frame == 700 else 1 << 30)
    back = w.read(spark, path, index)
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, least)
    whole = {(i, (h or "").encode()) for i, _, h in rows}
    for r in back.where("record_type = 'response'").collect():
        assert (r["page_id"], bytes(r["payload"])) in whole
    # every revisit refers to a response that is in the archive, with the same digest
    own = {r["record_id"]: r for r in back.collect()}
    assert all(own[r["refers_to_record"]]["payload_digest"] == r["payload_digest"] and own[r["refers_to_record"]]["record_type"] == "response"
               for r in own.values() if r["record_type"] == "revisit")
    # the index leads to each record
    assert index.count() == len(rows)
    wanted = index.where("crc32(cast(record_id as binary)) % 3 = 0").select("record_id")
    ids = {r["record_id"] for r in wanted.collect()}
    found = w.lookup(path, wanted, index).collect()
    assert ids and {r["record_id"] for r in found} == ids
    assert all(r["payload"] == own[r["record_id"]]["payload"] for r in found)


def test_any_reader_reads_a_bundle(spark, pages, tmp_path):
    """Plain decompression passes over the seek table; the records follow each other by the standard's rules."""
    path = str(tmp_path / "w")
    names = [r["bundle"] for r in w.write(pages[1], path, frame_bytes=900).select("bundle").distinct().collect()]
    n = 0
    for name in names:
        raw = (tmp_path / "w" / "bundles" / name).read_bytes()
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        at, kinds = 0, []
        while at < len(data):
            head, block, at = w.parse(data, at)
            kinds.append(head["warc-type"])
        assert kinds[0] == "warcinfo" and set(kinds[1:]) <= {"response", "revisit"}
        n += len(kinds) - 1
        count, descriptor, magic = struct.unpack("<IBI", raw[-9:])
        assert magic == 0x8F92EAB1 and descriptor == 0
        bundle = w.BundleReader(pa.BufferReader(raw))
        assert len(bundle) == count and b"".join(bundle.frame(i) for i in range(count)) == data
        assert bundle.frame(count - 1) == data[-len(bundle.frame(count - 1)):]  # a frame needs no other
    assert n == len(pages[0])
    with pytest.raises(ValueError, match="no seek table"):
        w.BundleReader(pa.BufferReader(gzip.compress(b"not a bundle, but long enough")))


def test_damage_is_found(tmp_path):
    out = io.BytesIO()
    out.close, value = lambda: None, w.page_record(1, "u", b"payload", b"k", b"2026-01-01T00:00:00Z", None)[1]
    writer = w.BundleWriter(out)
    writer.add(value)
    writer.close()
    raw = bytearray(out.getvalue())
    raw[20] ^= 1
    with pytest.raises((zstandard.ZstdError, ValueError)):
        w.page_row(*w.parse(w.BundleReader(pa.BufferReader(bytes(raw))).frame(0))[:2])
    with pytest.raises(ValueError):
        w.page_row(*w.parse(value.replace(b"payload\r", b"paylaod\r"))[:2])
    with pytest.raises(ValueError):
        w.parse(value[:-1] + b"x")


@pytest.mark.parametrize("page", [None, 0, 1, -1, 2 ** 63 - 1, -2 ** 63, 0x123456789ABCDEF])
def test_record_identifiers(page):
    a, b = w.record_id(page, "u", b"k"), w.record_id(page, "v", b"k")
    assert w.page_of(a) == w.page_of(b) == page and a != b and a[23] == "8"


def test_hot_groups_are_spread(spark):
    """A third of all rows in one group: no task of the join gets them together, and no row is lost."""
    df = spark.range(30_000, numPartitions=6).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = w.join_groups(df, groups, "k", "n", ["most"])
        sizes = [r["c"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("c")).collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / len(sizes)
        assert joined.where("most != if(k = 'hot', 29997, id) or most is null").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_table_and_oracle(spark):
    path = new_folder(spark, "warc-test")
    index = w.write(spark.createDataFrame([], SCHEMA), path)
    assert index.count() == 0 and w.read(spark, path, index).count() == 0
    got = sorted(map(tuple, queries()["op13_warc"](spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    assert got == sorted(con.execute(oracle_sql()["op13_warc"]).fetchall()) and got
