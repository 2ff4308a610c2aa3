"""T1-T6 scalar goldens: the Catalyst chain equals Python ``re`` on Unicode text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.functions import text as tx

CLOCK = re.compile(r"\b\d{1,2}\.\d{2}[apmAPM]+\s+[GMTgmt]+\b")
BOILER = re.compile(r"© \d+ BBC\. The BBC is not responsible for the content of external sites\. "
                    r"Read about our approach to external linking\.")


def py_remove_tags(s):
    s = re.sub("<.*?>", "", s)
    s = CLOCK.sub("", s)
    s = re.sub(r"\s+", " ", s)
    s = s.replace("\n", " ")
    return BOILER.sub("", s)


ALPHABET = list("ab<>/p \n\r\t\x0b\x0c\x1c\x1f\x85\xa0  　.0123456789amAPMGTgt©é") + ["BBC"]
TRICKY = [
    "a<b\nc>d", "x<b\rc>y", "at 3.15pm GMT today", "a\xa0\x0b\x1c \x85b", " lead  trail ",
    "© 2024 BBC. The BBC is not responsible for the content of external sites. Read about our approach "
    "to external linking. end", "a<p>b</p>c 12.30am\xa0gmt", "", "x 9.05PM  GmT　y", "é3.15pm GMT",
    "<<a>>", "tab\tnl\nnl", "٣.١٥pm GMT", "10.30 pm GMT",
]


def _spark_clean(spark, values, fn=tx.remove_tags):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", fn("s")).collect())]


def test_tricky_strings(spark):
    assert _spark_clean(spark, TRICKY) == [py_remove_tags(s) for s in TRICKY]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join), min_size=1, max_size=30))
def test_random_strings(spark, values):
    assert _spark_clean(spark, values) == [py_remove_tags(s) for s in values]


def test_trim_and_squeeze(spark):
    vals = ["\xa0 a  b  ", "", "x"]
    assert _spark_clean(spark, vals, tx.trim_ws) == [v.strip() for v in vals]
    assert _spark_clean(spark, vals, tx.squeeze) == [" ".join(v.split()) for v in vals]


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(tx.remove_tags("s")).first()[0] is None


def test_preview_and_host(spark):
    df = spark.createDataFrame([("q" * 60, "https://m.ex.example.net/a?b#c")], "q string, u string")
    r = df.select(tx.preview("q").alias("p"), tx.host_of("u").alias("h")).first()
    assert r.p == "q" * 50 + "..." and r.h == "m.ex.example.net"
