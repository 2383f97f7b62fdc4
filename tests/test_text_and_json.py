"""String functions against Python semantics, JSONL strictness."""

import json

from lodestar.functions import text as T
from lodestar.plans import fixtures as fx
from lodestar.session import scratch_path
from lodestar.sources.jsonl import parse_pair_lines, read_pair_rejects, read_pairs_jsonl


def test_strip_and_split_match_python(spark):
    chars = [chr(c) for c in range(1, 0x3100) if not (0xD800 <= c <= 0xDFFF)]
    samples = [f"{c}a{c}b {c}" for c in chars] + [f"{c}{c}" for c in chars] + ["", "   ", "a  b\tc\n"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i long, s string")
    got = {r.i: (r.st, list(r.sp)) for r in df.select("i", T.strip("s").alias("st"), T.split_words("s").alias("sp")).collect()}
    bad = [i for i, s in enumerate(samples) if got[i] != (s.strip(), s.split())]
    assert bad == []


def test_rank_default_and_weight(spark):
    vals = [None, "1", "3", "0", "-1", "2.9", "-2.9", "x", " 4 ", "1e3"]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    got = [r.k for r in df.select(T.rank_or_default("r").alias("k")).collect()]
    assert got == [1, 1, 3, 0, -1, 2, -2, 1, 4, 1000]
    w = [r.w for r in spark.createDataFrame([(1,), (0,), (-3,), (3,), (None,)], "r int")
         .select(T.rank_weight("r").alias("w")).collect()]
    assert w[0] == 1.0 and w[1] == 1.0 and w[2] == 1.0 and w[4] == 1.0 and abs(w[3] - 0.5) < 1e-15


def _python_accepts(line: str):
    s = line.strip()
    if not s:
        return None
    try:
        obj = json.loads(s)
    except json.JSONDecodeError:
        return "invalid_json"
    if not isinstance(obj, dict):
        return "invalid_json"
    if not obj.get("query"):
        return "missing_query"
    if not obj.get("document"):
        return "missing_document"
    return "ok"


def test_json_lines_follow_python(spark):
    lines = [v for v, _ in fx.X1J_EXTRA_LINES] + [
        '{"query": "a", "document": "b"}', '{"query": "a", "document": "b"}]', '{"query": "a", "document": "b"} ]x[',
        '{"query": "a", "query": "", "document": "b"}', '{"query": "a", "document": "b", "rank": 3}',
        '{"query": "é", "document": "\\u00e9"}', 'null', '"text"', '{}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {r.line: r.reason or "ok" for r in parse_pair_lines(df).collect()}
    for v in lines:
        exp = _python_accepts(v)
        if exp is None:
            assert v.strip() not in got
        else:
            assert got[v.strip()] == exp, v


def test_jsonl_reader_and_rejects(spark):
    path = scratch_path(spark, "test-jsonl")
    lines = ['{"query": "q", "document": "d", "rank": 2}', "", "oops", '{"query": "q2", "document": ""}']
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    pairs = [tuple(r) for r in read_pairs_jsonl(spark, path).collect()]
    assert pairs == [("q", "d", 2)]
    rej = sorted(r.reason for r in read_pair_rejects(spark, path).collect())
    assert rej == ["invalid_json", "missing_document"]


def test_decode_lenient(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xc3!\xffcd"),), (bytearray("é".encode()),)], "b binary")
    got = [r.s for r in df.select(T.decode_lenient("b").alias("s")).collect()]
    assert got == [b"ab\xc3!\xffcd".decode("utf-8", errors="ignore"), "é"]


def test_missing_jsonl_is_empty_with_warning(spark):
    import warnings as w

    with w.catch_warnings(record=True) as caught:
        w.simplefilter("always")
        df = read_pairs_jsonl(spark, "/nonexistent/lodestar/pairs.jsonl")
    assert df.count() == 0 and df.columns == ["query", "positive", "rank"]
    assert any("not found" in str(c.message) for c in caught)
