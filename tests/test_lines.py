"""One line and its counterpart for every predicate."""

import pytest

from pyspark.sql import functions as F

from formsift import constants as K
from formsift.functions import lines as L, text as T
from formsift.operators.flags import BITS, flag_counts, has_flag, with_flags
from tests.test_text import apply

CASES = {
    "l1_number_line": (["12", "1.50", "12345"], ["1.", "a1", "1,5", "-1"]),
    "l2_code_line": (["X", "x", "G", "D", "12", "12a"], ["Y", "12ab", "a12", "XX"]),
    "l3_state_line": (["NY", "DC"], ["ny", "NY,", "New York", "XX"]),
    "l4_contains_state": (["Tarnwick NY", "NY", "a TX b"], ["Tarnwick NY,", "SUNNY", "ny"]),
    "l5_zip_line": (["12345", "12345-6789"], ["1234", "12345-678", "123456", "x12345"]),
    "l6_contains_zip": (["NY 12345", "a 12345-6789 b", "(12345)", "12345-"], ["12345-678", "123456", "12345x", "12345-6789-1"]),
    "l7_has_address_word": (["12 Elm ST.", "plaza", "x/way/y"], ["strong", "ways", ""]),
    "l8_company_like": (["Elm Co", "A LLC.", "Cox and Sons"], ["Coco", "Cox and son", "Incan"]),
    "l9_street_line": (["12 Elm St", "123456 A way", "1 Elm  Road"], ["1234567 Elm St", "Elm St", "12 Elm", "12Elm St"]),
    "l10_city_state_zip_line": (["Tarnwick NY 12345"], ["Tarnwick NY", "Tarnwick 12345", "Tarnwick NY 12345-678"]),
    "l11_ignored_word": (["Employee", "PLAN", "third-party"], ["plans", "the plan"]),
    "l12_label_line": (["1 Wages", "Kirsten", "plan", "Estates", "Form W-2"], ["plans", "James Cox"]),
    "l13_title_case_word": (["Cox", "McDonald", "O'Brien", "Cox.", ".Cox", "Ab-c"], ["COX", "cox", "C", "Cox1", "'Cox"]),
    "l14_possible_name_line": (["James Cox", "COX", "a"], ["Cox1", "NY", "X", "Plan", "Ünal"]),
    "l15_single_name_part": (["Cox", "..Cox", "McDonald"], ["COX", "James Cox", "Plan", "Kirsten", "C"]),
    "l16_full_name_line": (["James Cox", "James   Cox.", "Jo O'Brien"], ["James A Cox", "James", "J. Cox", "The Cox", "JAMES COX", "Cut  Here", "Kirsten Cox"]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_predicate(spark, name):
    hits, misses = CASES[name]
    found = apply(spark, hits + misses, lambda v: L.LINE_PREDICATES[name](T.strip(v)))
    assert found == [True] * len(hits) + [False] * len(misses)


def test_facts_agree_with_predicates(spark):
    lines = sorted({line for hits, misses in CASES.values() for line in hits + misses if line})
    facts = apply(spark, lines, L.line_facts)
    same = {"number": "l1_number_line", "code": "l2_code_line", "state": "l3_state_line", "has_state": "l4_contains_state",
            "street": "l9_street_line", "label": "l12_label_line", "single_name": "l15_single_name_part",
            "full_name": "l16_full_name_line"}
    for field, name in same.items():
        assert [f[field] for f in facts] == apply(spark, lines, L.LINE_PREDICATES[name]), field
    assert [f["zip"] is not None for f in facts] == apply(spark, lines, L.contains_zip)


def test_bits_agree_with_predicates(spark):
    lines = sorted({line.strip() for hits, misses in CASES.values() for line in hits + misses} - {""})
    lines += ["\u0661\u0662", "James\u00a0Cox", "James \tCox", "12 Elm St NY 12345", "\u0661 Elm St", "Cut \u2003 Here"]
    df = spark.createDataFrame([(v,) for v in lines], "line string")
    found = {r.line: r for r in with_flags(df).select("line", *(has_flag(F.col("flags"), p).alias(p) for p in BITS)).collect()}
    wanted = df.select("line", *(predicate(F.col("line")).alias(name) for name, predicate in L.LINE_PREDICATES.items()))
    assert list(BITS) == list(L.LINE_PREDICATES) and len(found) == len(lines)
    for r in wanted.collect():
        assert found[r.line] == r, r.line


def test_flags_keep_columns_and_take_nulls(spark):
    df = spark.createDataFrame([("12", 1, True), (None, 2, False)], "line string, low int, is_label boolean")
    flagged = with_flags(df)
    assert flagged.columns == ["line", "low", "is_label", "flags"]
    assert [tuple(r) for r in flagged.orderBy("low").collect()] == [("12", 1, True, BITS["l1_number_line"] + BITS["l2_code_line"]), (None, 2, False, 0)]
    assert with_flags(df.limit(0)).count() == 0
    counts = {r.predicate: r.n_lines for r in flag_counts(flagged, ["is_label"]).where("is_label").collect()}
    assert counts == {name: int(name[:3] in ("l1_", "l2_")) for name in BITS}


def test_flags_are_one_scan_without_shuffle_or_python(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    lines = documents.select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "line"))
    plan = with_flags(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.count("FileScan") == 1


def test_fact_searches_agree_with_the_plain_patterns(spark):
    words = [*K.LABEL_KEYWORDS, *(w[:-1] for w in K.LABEL_KEYWORDS), *(f"x{w.title()}y" for w in K.LABEL_KEYWORDS), *K.IGNORED_WORDS,
             *(f"my {w}" for w in K.IGNORED_WORDS), *K.EMPLOYER_STOPS, "Employee's  first name", "employ ee", "LAST NAME", "w", "sa", ""]
    states = ["NY", "NYC", "NY NY", "NY,", "xNY", "x NY", "\U0001f600NY", "\U0001f600 NY", "NÝ", "XX NY", "XXNY", "ny", "A NY 1", "NY  12345", "Né WY"]
    zips = ["12345", "1234", "x 12345-6789", "١٢٣٤٥", "12 345", "123456", "a  b 12345"]
    lines = [w for w in [*words, *states, *zips] if w]
    facts = apply(spark, lines, L.line_facts)
    squeezed = apply(spark, lines, T.single_blanks)
    assert [f["line"] for f in facts] == squeezed
    assert [f["label"] for f in facts] == apply(spark, lines, L.is_label)
    assert [f["has_state"] for f in facts] == apply(spark, squeezed, L.contains_state)
    assert [f["zip"] for f in facts] == apply(spark, squeezed, lambda v: T.first_group(K.ZIP, v))
    assert [f["employee"] for f in facts] == apply(spark, lines, lambda v: T.any_phrase(F.lower(v), ["employee", K.LAST_NAME_LABEL]))
    assert [f["employer_stop"] for f in facts] == apply(spark, lines, lambda v: T.any_phrase(v, K.EMPLOYER_STOPS))
    assert any(f["has_state"] for f in facts) and any(f["zip"] for f in facts) and any(f["employer_stop"] for f in facts)
    assert apply(spark, words, lambda v: F.lower(v).rlike(T.phrase_search(K.LABEL_KEYWORDS))) == apply(
        spark, words, lambda v: T.any_phrase(F.lower(v), K.LABEL_KEYWORDS)
    )
