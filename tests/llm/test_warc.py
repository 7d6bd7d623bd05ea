import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from tabmine.llm import warc
from tabmine.llm.warc import digest, members, parse, record, round_trip

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        f = first.get(h or "") if len(data) >= least else None
        revisit = f is not None and i != f
        out.append((i, len(data), digest(data), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r)[:5] for r in round_trip(df, **kw).collect()), key=str)


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip(spark, least):
    rng = random.Random(2)
    pool = ["", "<p>é</p>", "\r\n\r\nWARC/1.1\r\n", "x" * 400_000, "hot page that a third of rows share"]
    rows = [(i, f"http://h/{i} é", rng.choice([*pool, pool[4], pool[4], f"<html>{i} 😀</html>", None])) for i in range(300)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4), least=least) == expected(rows, least)


def test_edges(spark):
    rows = [(3, None, "a"), (3, None, "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "alone"), (5, "u v", None), (4, "u", "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.lit(1)).withColumn("_h", F.lit("x")).withColumn("refers_to", F.lit(2))
    assert run(df) == expected(rows)
    assert run(df.limit(0)) == []


def test_archives_roll_and_payloads_return(spark, tmpdir_path):
    rows = [(f"urn:x-page:{i}", "u", f"body {i}".encode() * 50, None) for i in range(40)]
    df = spark.createDataFrame(rows, "record_id string, url string, payload binary, refers_to string").coalesce(1)
    manifest = warc.write_archives(df, f"{tmpdir_path}/a", archive_bytes=2000)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == 40
    back = {r.record_id: bytes(r.payload) for r in warc.read_archives(manifest, f"{tmpdir_path}/a").collect()}
    assert back == {r[0]: r[2] for r in rows}


def test_members_are_plain_gzip_and_framing_is_checked():
    data = record("urn:a", "u", b"one", None) + record("urn:b", "u", b"one", "urn:a")
    plain = gzip.decompress(data)
    got = list(members(io.BytesIO(data), step=7))
    assert b"".join(got) == plain and [parse(m)["warc-type"] for m in got] == ["response", "revisit"]
    with pytest.raises(ValueError, match="ends inside"):
        list(members(io.BytesIO(data[:-9]), step=7))
    with pytest.raises(ValueError, match="digest"):
        parse(got[0].replace(b"one", b"two"))
    with pytest.raises(ValueError, match="framing"):
        parse(got[0][:-2])


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert run(pages) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
