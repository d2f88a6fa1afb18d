"""Evidence for many names by an index of the text, against a search for each name."""

import random
import time

from pyspark.sql import functions as F

from formsift.functions import names as N

WORDS = "ann bob cox lee ray_x o'neil st.john j. 42 mary-jo zed".split()
GAPS = [" ", " ", " ", "  ", "\n", ", ", ".", " - ", "\t"]
NAMES = ["Ann Cox", "Ann Ann", "Bob", "Lee  Cox", "Ray_x Zed", "J. Cox", "St.john Lee", "Cox 42", "Ann Bob Cox", "Zed Nobody",
         "No Body", "", " ", "Mary-jo Ann", "Bob ", "Ça Va", "Ann Lee", "Lee Ann", "42 42"]


def counts(spark, texts, names, few):
    df = spark.createDataFrame([(i, t, names) for i, t in enumerate(texts)], "i int, t string, names array<string>")
    return {r.i: r.n for r in df.select("i", N.evidence_of_all(F.col("names"), F.lower("t"), few).alias("n")).collect()}


def test_index_gives_the_counts_of_the_search(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.choice([0, 1, 2, 5, 300]))) for _ in range(40)]
    texts += ["", "ann", "ann cox", "ann ann ann ann", "annécox ann cox", "ann cox́ cox", "ann cox — bob", "•ann cox•", "x" * 5000, "Ann Cox"]
    indexed, searched = counts(spark, texts, NAMES, 0), counts(spark, texts, NAMES, 1000)
    assert indexed == searched and any(n for r in searched.values() for n in r.values())
    df = spark.createDataFrame([(t, n) for t in texts for n in NAMES], "t string, name string")
    plain = df.select("t", "name", N.evidence(F.col("name"), F.lower("t")).alias("n")).collect()
    at = {t: i for i, t in enumerate(texts)}
    assert all(indexed[at[r.t]][r.name] == r.n for r in plain)


def test_no_names_and_null_text(spark):
    assert counts(spark, ["ann cox"], [], 0) == {0: {}}
    assert counts(spark, [None], NAMES, 0) == counts(spark, [None], NAMES, 1000)


def test_many_names_in_a_long_text(spark):
    names = [f"Fore{i} Sur{i % 977}" for i in range(2000)]
    text = "\n".join(f"{i} {n} paid {n}" for i, n in enumerate(names))[:80_000]
    counts(spark, [text[:2000]], names[:50], 8)
    start = time.perf_counter()
    found = counts(spark, [text], names, 8)[0]
    seconds = time.perf_counter() - start
    start = time.perf_counter()
    wanted = counts(spark, [text], names, 10_000)[0]
    assert found == wanted and seconds < time.perf_counter() - start
