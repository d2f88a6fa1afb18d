"""Text functions against Python's own string and number rules."""

import random

import pytest
from pyspark.sql import functions as F

from formsift import constants as K
from formsift.functions import checks as V, lines as L, text as T

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"
TEXTS = [None, "", "   ", "a", " a  b ", "\ta  b\x1f", "None", "nan", "not_verifiable", "NULL ",
         "J. Cox", "James A. Cox", "A. B.", "a b", "Ünal É Cox", "x\r\ny\n\n z w\x85v\x0bu", "É. Cox", ".. Cox"]


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row.r for row in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def squeeze(text):
    return " ".join((text or "").split()) or None


def initials(text):
    words = (squeeze(text) or "").split()
    kept = [w for w in words if not (len(w.strip(". ")) == 1 and w.strip(". ").isalpha())]
    return " ".join(kept or words) or None


def test_squeeze(spark):
    random.seed(1)
    noise = ["".join(random.choice("ab" + SPACES) for _ in range(12)) for _ in range(300)]
    assert apply(spark, TEXTS + noise, T.squeeze) == [squeeze(t) for t in TEXTS + noise]


def test_null_words(spark):
    expected = [None if (squeeze(t) or "").lower() in ("none", "null", "nan", "not_verifiable") else squeeze(t) for t in TEXTS]
    assert apply(spark, TEXTS, T.squeeze_or_null_word) == expected


def test_split_lines(spark):
    random.seed(2)
    noise = ["".join(random.choice("ab" + SPACES) for _ in range(20)) for _ in range(300)]
    expected = [[line.strip() for line in (t or "").splitlines() if line.strip()] for t in TEXTS + noise]
    assert apply(spark, TEXTS + noise, T.split_lines) == expected


def test_drop_initials_and_swap(spark):
    assert apply(spark, TEXTS, T.drop_initials) == [initials(t) for t in TEXTS]

    def swapped(text):
        words = (initials(text) or "").split()
        return f"{words[1]} {words[0]}" if len(words) == 2 else initials(text)

    assert apply(spark, TEXTS, T.swap_two_words) == [swapped(t) for t in TEXTS]


@pytest.mark.parametrize("context, expected", [
    ("last name x employee's first name", "Cox James"),
    ("employee's first name x last name", "James Cox"),
    ("last name", "James Cox"),
    ("", "James Cox"),
])
def test_order_name(spark, context, expected):
    assert apply(spark, ["James Cox"], lambda v: T.order_name(v, F.lit(context))) == [expected]


def test_lenient_double(spark):
    values = [None, "", " ", "1", " 2.5 ", "1e3", "-.5", "5.", "1_000", "1__0", "x", "1d", "0x1", "inf", "1,5", "+7"]

    def lenient(v):
        try:
            return float(v or 0)
        except ValueError:
            return 0.0

    assert apply(spark, values, T.lenient_double) == [lenient(v) for v in values]


def test_rounding_and_percent_follow_python(spark):
    random.seed(3)
    values = [0.125, 2.675, 1.005, 1.015, 53.125, 0.0, 100.0] + [random.random() * 100 for _ in range(500)]
    values += [a * 100 / b for a in range(1, 40) for b in (7, 80, 160, 20000)]
    assert apply(spark, values, lambda v: T.round_exact(v, 2), "double") == [round(v, 2) for v in values]
    shares = [v / 100 for v in values]
    assert apply(spark, shares, T.percent_text, "double") == [f"{v:.2%}" for v in shares]


def test_street_key(spark):
    values = ["12 Elm St", "12", "-- 7b / OAK!", "É 5", None]
    assert apply(spark, values, T.street_key) == ["12_elm", None, "7b_oak", None, None]


def test_counts(spark):
    df = spark.createDataFrame([("ab ab aba", "ab"), ("aaaa", "aa"), ("x", ""), (None, "a"), ("a+b a+b", "a+b")], "t string, n string")
    rows = df.select(T.count_text(F.col("t"), F.col("n")).alias("literal"), T.count_word(F.col("t"), F.col("n")).alias("word")).collect()
    assert [r.literal for r in rows] == [3, 2, 0, 0, 2]
    assert [rows[0].word, rows[1].word, rows[4].word] == [2, 0, 2]


def test_shape_of_names_is_what_valid_names_have(spark):
    gaps = ["", " ", "  ", "\t", "  ", " ", "\n", "\x1f"]
    values = [f"{a}James{b}Ox{c}{d}" for a in gaps for b in gaps for c in gaps for d in ("", "Q.", "Lee B. C", "null")] + ["", None, "a b c d e"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    own = df.select("v", V.has_name_shape(F.col("v")).alias("shape"), V.is_valid_name(T.squeeze_or_null_word(F.col("v"))).alias("valid")).collect()
    assert all(r.shape == (r.v is not None and 2 <= len(r.v.split()) <= 4) for r in own)
    assert any(r.valid for r in own) and all(r.shape for r in own if r.valid)
    squeezed = df.select("v", T.squeeze(F.col("v")).alias("s")).collect()
    assert all(r.s == (" ".join((r.v or "").split()) or None) for r in squeezed)


def test_labels_in_lower_case_are_the_same(spark):
    words = [*K.IGNORED_WORDS[:9], *K.LABEL_KEYWORDS, "Kirsten", "Crowther", "plain", "state of", ""]
    df = spark.createDataFrame([(f"{a}{w.title()}{b}",) for w in words for a in ("", "x ") for b in ("", "s", " 1")], "line string")
    low = df.withColumn("low", F.lower("line"))
    assert low.filter(L.is_label(F.col("line")) != L.is_label_in_lower(F.col("low"))).count() == 0
    assert 0 < low.filter(L.is_label_in_lower(F.col("low"))).count() < low.count()
