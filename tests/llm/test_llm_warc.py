"""Archives written and read back, and the SQL twins of the queries."""

import base64
import gzip
import hashlib
import io

import pytest

import llm_cases as C
from conftest import SF_SMALL
from oracle_check import compare


def b32(x):
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


PAGES = [(1, "http://a/x y", "<p>one</p>"), (2, None, "<p>two</p>"), (3, "u\r\nWARC-Type: fake", "<p>one</p>"), (4, "d", None), (5, "e", ""),
         (5, "e", ""), (7, "g", "é\r\n\r\n" * 90_000), (8, "h", "é\r\n\r\n" * 90_000), (9, "i", "x" * 300_001),
         (None, "n", "<p>one</p>"), (None, "n", "<p>null</p>"), (None, "m", "<p>null</p>"), (11, "k", "same"), (11, "k", "other")]


@pytest.mark.parametrize("min_bytes, file_bytes, chunk", [(0, 1 << 28, 65536), (5, 2000, 1000)])
def test_archives_round_trip(spark, tmp_path, min_bytes, file_bytes, chunk):
    from churnlab.llm import warc
    pages = spark.createDataFrame([(*p, 1, "z") for p in PAGES], "page_id long, url string, html string, row int, data string")
    m = warc.write(pages, str(tmp_path / "w"), min_bytes=min_bytes, file_bytes=file_bytes, chunk=chunk)
    rows = warc.read(spark, m, chunk=chunk).cache()
    out = C.multiset(warc.report(rows).collect())
    want, groups = [], {}
    for i, _, h in PAGES:
        groups.setdefault((h or "").encode(), []).append(i)
    for p, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is None, x or 0))
        for k, i in enumerate(ids):
            first = k == 0 or len(p) < min_bytes
            want.append((i, len(p), b32(p), "response" if first else "revisit", None if first else ids[0]))
    assert out == C.multiset(want)
    # the payloads come back byte for byte, in bounded chunks
    back = C.defaultdict(list)
    for r in rows.filter("type = 'response'").collect():
        back[r.record].append((r.chunk, bytes(r.data), r.running))
        assert r.size <= chunk
    for parts in back.values():
        parts.sort()
        sofar = b""
        for _, data, running in parts:
            sofar += data
            assert running == b32(sofar)
        assert sofar in groups


def test_archives_are_readable_gzip(spark, tmp_path):
    from churnlab.llm import warc
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for r in warc.write(pages, str(tmp_path / "w")).collect():
        raw = gzip.GzipFile(fileobj=io.BytesIO(open(r.path, "rb").read())).read()
        assert raw.startswith(b"WARC/1.1\r\n") and raw.count(b"WARC-Record-ID:") == r.records and b"\nWARC-Type: fake" not in raw


def test_a_broken_archive_is_refused(tmp_path):
    from churnlab.llm import warc
    data = warc.header("<urn:page:1/AA/0>", "u", hashlib.sha1(b"abc").hexdigest(), 3, None) + b"abd\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(data))))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(data[:-6]))))


def test_no_pages(spark, tmp_path):
    from churnlab.llm import warc
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.report(warc.read(spark, warc.write(pages, str(tmp_path / "w")))).collect() == []


def _queries():
    from churnlab.llm.queries import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _queries())
def test_query_equals_its_sql(spark, name):
    from churnlab.llm.queries import ORACLE, QUERIES
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], SF_SMALL)
    assert ok, msg


def test_every_operator_has_its_query():
    from churnlab.llm.queries import QUERIES
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
