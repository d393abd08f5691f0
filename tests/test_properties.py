"""Property tests against plain Python models."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import text as X

ALPHABET = st.sampled_from(list("ab ,\t\n\r　 、，x") + [" ", "\x1c"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=25)


def squeeze_model(s):
    for ch in ["\n", "\t", "\r", " "]:
        s = s.replace(ch, "")
    return s.strip()


def split_model(s):
    return [t.strip() for t in s.split(",") if t.strip()]


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_squeeze_and_split_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: (r.q, r.t) for r in df.select("i", X.squeeze("s").alias("q"),
                                              X.split_tags("s").alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (squeeze_model(t), split_model(t)), repr(t)


def test_whitespace_set_matches_python():
    assert set(X.WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_strip_matches_python(spark):
    samples = ["　a b　", "\x1c\x1dz\x1e", "  x ", "", "  "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.o for r in df.select(X.strip_unicode(F.col("s")).alias("o")).collect()]
    assert got == [s.strip() for s in samples]
