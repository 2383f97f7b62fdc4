"""Property tests: Spark string functions agree with Python on random text."""

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.functions import text as T

ALPHABET = st.sampled_from(list("ab é😀\t\n\r\x0b\x0c\x1c\x1f\x85\xa0    　,.<>"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_split_and_strip_match_python(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i long, s string")
    got = {r.i: (r.a, list(r.b)) for r in
           df.select("i", T.strip("s").alias("a"), T.split_words("s").alias("b")).collect()}
    for i, s in enumerate(texts):
        assert got[i] == (s.strip(), s.split()), repr(s)
