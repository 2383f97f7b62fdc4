"""Secret scan against Python's re on whole texts, and the ledger's increments."""

import hashlib
import re

from pyspark.sql import functions as F

from lodestar.llm import q_secrets, secrets
from lodestar.session import scratch_path
from tests.conftest import SF_SMALL

ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def brute(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest()


TEXTS = [None, "", "plain words", "token=password: abcdefghijklmnop", "PassWord = 'abcdefghijkl' x",
         "é€𝄞 secret: " + "Z" * 12 + " token:" + "q" * 11, "AKIA" + "A" * 13, "AKIA" + "B" * 14 + " AKIAAKIA" + "C" * 20,
         "token=secret=abcdefghijkl", "0123456789abcdef" * 3, "x" * 5000 + " api_key:" + "0123456789abcdef",
         "apikey=\"" + "a/b+c=d_e.f-" * 2, "\n".join(f"token={i:020d}" for i in range(300)),
         "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18]


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "clash"), (None, TEXTS[4], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, blob string")
    ledger = scratch_path(spark, "t-ledger")
    secrets.scan(df, ledger)
    got = secrets.findings_by_path(df, ledger).collect()
    assert len(got) == len(rows)
    for r in got:
        base = [f for f in r["findings"] if f["kind"] in ("assign", "access", "hex")]
        assert [(f["start"], f["no"], f["kind"], f["end"]) for f in base] == brute(r["text"])
    more = {r["doc_id"]: [f["kind"] for f in r["findings"]] for r in got}
    assert more[13] == ["pem"] and "github" in more[14]


def test_query_on_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = q_secrets.op7_secret_scan(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r["doc_id"]])
        assert r["base_sha256"] == digest(want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(x[2] == k for x in want) for k in ("assign", "access", "hex"))


def test_ledger_scans_only_unseen_blobs(spark):
    ledger = scratch_path(spark, "t-ledger")
    a = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one")], "doc_id long, text string")
    secrets.scan(a, ledger)
    b = spark.createDataFrame([(1, "two"), (2, "three token=abcdefghijklmn")], "doc_id long, text string")
    secrets.scan(b, ledger)
    led = spark.read.parquet(ledger)
    assert led.count() == 3 and led.select("blob").distinct().count() == 3
    other = secrets.RULES[:1]
    secrets.scan(b, ledger, rules=other)
    assert spark.read.parquet(ledger).count() == 5
    got = {r["doc_id"]: r["findings"] for r in secrets.findings_by_path(b, ledger).collect()}
    assert not got[1] and len(got[2]) == 1


def test_redaction_merges_overlaps(spark):
    text = "é token=0123456789abcdef0123 end AKIA" + "Q" * 16
    df = spark.createDataFrame([(1, text), (2, None), (3, "clean"), (4, "0" * 16)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in secrets.redact_documents(df, scratch_path(spark, "t-ledger")).collect()}
    assert out == {1: "é [SECRET] end [SECRET]", 2: None, 3: "clean", 4: "[SECRET]"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    ledger = scratch_path(spark, "t-ledger")
    secrets.scan(df, ledger)
    assert secrets.findings_by_path(df, ledger).count() == 0
    assert secrets.redact_documents(df, ledger).select(F.count("*")).first()[0] == 0
