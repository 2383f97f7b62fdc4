"""Operators 5 and 10 against their SQL and brute force."""

import base64
import hashlib
import re

import duckdb
import pytest
from pyspark.errors import PySparkException

from lodestar.llm import decontam, q_decontam, q_warc, warc_store
from lodestar.llm.registry import ORACLE
from lodestar.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.edge import PASSAGE, ROWS, documents, folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(UPPER))


def brute(rows, bench, n=10):
    win = {}
    for item, t, *_ in bench:
        w = words(t)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            win.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    out = []
    for doc, t, *_ in rows:
        w, hit, items = words(t), set(), set()
        for k in {len(x) for x in win}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in win:
                    hit.update(range(i, i + k))
                    items |= win[tuple(w[i:i + k])]
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


BENCH = [(1, PASSAGE.upper(), "x"), (2, PASSAGE, "x"), (10, "three, words; ONLY", None), (3, None, "y"), (4, "--- !!", "z"),
         (5, "a b c a b c a b c a b c", "z"), (None, "no id here", "z"), (7, "Ünïcödé 𝄞", "q")]


@pytest.mark.parametrize("max_set", [decontam.MAX_SET, 0])
def test_decontaminate_awkward_rows(spark, tmp_path, max_set, monkeypatch):
    bench = [b for b in BENCH if b[0] is not None]
    monkeypatch.setattr(decontam.scan, "__defaults__", (10, "doc_id", "text", max_set))
    got = q_decontam.op5_decontaminate(spark, folder(spark, tmp_path, benchmark=bench)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, bench)


def test_item_without_id_hits_but_is_not_listed(spark, tmp_path):
    got = {r["doc_id"]: r for r in q_decontam.op5_decontaminate(
        spark, folder(spark, tmp_path, benchmark=BENCH)).collect()}
    assert got[None]["contaminated"] and got[None]["n_items"] == 0


def test_decontaminate_empty_tables(spark, tmp_path):
    assert not any(r["contaminated"] for r in q_decontam.op5_decontaminate(
        spark, folder(spark, tmp_path / "a")).collect())
    assert q_decontam.op5_decontaminate(spark, folder(spark, tmp_path / "b", [], BENCH)).count() == 0


def test_remove_documents_and_spans(spark):
    docs = documents(spark)
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    left = decontam.remove_documents(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted(
        (r[0] for r in ROWS if r[0] not in (0, 5)), key=str)
    assert decontam.remove_documents(docs, bench, max_ratio=0.99).count() == len(ROWS)
    clean = {r["id"]: r["clean"] for r in decontam.remove_spans(docs, bench).collect()}
    assert clean[0] == "an ordinary text and more of it" and clean[1] == "" and clean[8] == "three words only"


@pytest.mark.parametrize("key", ["op5_decontaminate", "op10_warc_archive"])
def test_oracle(spark, duck, key):
    fn = {"op5_decontaminate": q_decontam.op5_decontaminate, "op10_warc_archive": q_warc.op10_warc_archive}[key]
    df = fn(spark, SF_SMALL)
    cur = duck.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    want = sorted(repr(tuple(r[cols.index(c)] for c in df.columns)) for r in cur.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want


PAGES = [(1, "http://a", "same", "x"), (2, None, "same", "x"), (3, "http://c d\r\nX-Page-ID: 9", "same", None),
         (4, "u", None, "x"), (5, "u", "", "x"), (None, "u", "same", "x"), (6, "u", "é𝄞\r\n\r\n\0", "x"),
         (7, "u", "y" * 300_000, "x"), (7, "u", "y" * 300_000, "x"), (8, "u", "only one", "x"), (None, "v", "alone", "x")]


def test_archive_awkward_pages(spark, tmp_path):
    d = folder(spark, tmp_path, pages=PAGES)
    got = sorted((tuple(r) for r in q_warc.op10_warc_archive(spark, d).collect()), key=str)
    want = []
    for i, _, h, _ in PAGES:
        body = (h or "").encode()
        same = [x[0] for x in PAGES if (x[2] or "") == (h or "") and x[0] is not None]
        last = max(same, default=None)
        rev = last is not None and i != last
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                     "revisit" if rev else "response", last if rev else None))
    assert got == sorted(want, key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet/*.parquet')")
    cur = con.execute(ORACLE["op10_warc_archive"])
    cols = [c[0] for c in cur.description]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[cols.index(c)] for c in names) for r in cur.fetchall()), key=str) == got


def test_archive_records_are_warc(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, blob string")
    path = scratch_path(spark, "t-warc")
    warc_store.write_archive(pages, path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({x[2] or "" for x in PAGES})
    ids = set()
    for r in warc_store.read_archive(spark, path).collect():
        raw = bytes(r["record"])
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[:int(fields["Content-Length"])]
        assert raw == head + b"\r\n\r\n" + block + b"\r\n\r\n"
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "response":
            assert body == bytes(r["payload"])
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            ids.add(fields["WARC-Record-ID"])
        else:
            assert body == b"" and fields["WARC-Profile"].endswith("identical-payload-digest")
    for r in warc_store.read_archive(spark, path).filter("record_type = 'revisit'").collect():
        assert re.search(r"WARC-Refers-To: (\S+)", bytes(r["header"]).decode())[1] in ids


def test_min_bytes_and_damage(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, blob string")
    path = scratch_path(spark, "t-warc")
    warc_store.write_archive(pages, path, min_bytes=5)
    kinds = {r["page_id"]: r["record_type"] for r in warc_store.read_archive(spark, path).collect()}
    assert kinds[1] == "response" and kinds[7] == "response" and set(kinds.values()) == {"response"}
    bad = scratch_path(spark, "t-warc")
    warc_store.write_archive(pages.limit(1), bad)
    spark.createDataFrame([("0" * 64, b"damaged")], "blob string, payload binary").write.mode("append").parquet(
        f"{bad}/payloads")
    with pytest.raises(PySparkException, match="does not match its digest"):
        spark.createDataFrame([(b"h", "0" * 64)], "header binary, blob string").write.mode("append").parquet(
            f"{bad}/headers")
        warc_store.read_archive(spark, bad).select("payload").collect()


@pytest.mark.parametrize("column", ["payload_bytes", "payload_digest", "payload", "record"])
def test_a_lost_payload_raises(spark, column):
    path = scratch_path(spark, "t-warc")
    warc_store.write_archive(spark.createDataFrame([(1, "u", "html")], "page_id long, url string, html string"), path)
    spark.createDataFrame([(b"WARC/1.1\r\n\r\n", "a" * 64)], "header binary, blob string").write.mode("append").parquet(
        f"{path}/headers")
    with pytest.raises(PySparkException, match="no payload with digest"):
        warc_store.read_archive(spark, path).select(column).collect()


def test_urls_read_back_as_they_were(spark):
    urls = ["http://a/\x01b", "http://a/\x02b", "http://a/%00b", "http://a/%01b", "http://a/ b", "http://a/%20b", "a+b", "a +b",
            "http://ä/日本?x=1&y=%C3%A4", "\r\nX-Page-ID: 9", "", "http://plain/path", "\x7f", None, "yes", "%", " "]
    pages = spark.createDataFrame([(k, u, "same") for k, u in enumerate(urls)], "page_id long, url string, html string")
    path = scratch_path(spark, "t-warc")
    warc_store.write_archive(pages, path)
    rows = warc_store.read_archive(spark, path).collect()
    assert {r["page_id"]: r["url"] for r in rows} == dict(enumerate(urls))
    heads = {r["page_id"]: bytes(r["header"]).decode().split("\r\n") for r in rows}
    assert "WARC-Target-URI: http://a/%20b" in heads[5] and all(not re.search("[\x00-\x1f\x7f]", x) for h in heads.values() for x in h)


def test_empty_pages(spark, tmp_path):
    assert q_warc.op10_warc_archive(spark, folder(spark, tmp_path)).count() == 0
