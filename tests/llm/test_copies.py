"""Exact copies, near copies and components against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from formsift.llm.components import components, forest
from formsift.llm import exact_dedup
from formsift.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, further_duplicates
from formsift.llm.ngram_join import bands, bound, ngram_components, one_of_each_group
from tests.llm.conftest import prose, table

LOWER = {i: i + 32 for i in range(65, 91)}


def test_exact_copies_of_odd_rows(odd, odd_rows):
    rows = table(exact_duplicates(odd))
    assert len(rows) == len(odd_rows)
    groups: dict = {}
    for i, t in odd_rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept: dict = {}
    for r in rows:
        ids = by_digest[r["digest"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept.setdefault(r["digest"], []).append((r["kept"], r["doc_id"]))
    for digest, own in kept.items():
        (stays,) = [i for k, i in own if k]
        assert stays == max((i for i in by_digest[digest] if i is not None), default=None)


@pytest.mark.parametrize("digest", [lambda t: F.lit("0" * 64), lambda t: F.rpad(F.length(t).cast("string"), 8, "_")])
def test_texts_that_share_a_digest_are_told_apart(spark, digest):
    rows = [(i, f"text {i % 3}" + "x" * (i % 2)) for i in range(12)]
    found = table(exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), digest=digest))
    texts = dict(rows)
    for r in found:
        same = [i for i, t in rows if t == texts[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(same), len(same), r["doc_id"] == max(same))


def test_drop_exact_keeps_one_of_each_and_all_columns(odd, odd_rows):
    left = drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    texts = [(r["text"] or "").translate(LOWER) for r in table(left)]
    assert sorted(texts) == sorted({(t or "").translate(LOWER) for _, t in odd_rows})


def test_empty_tables(empty):
    assert exact_duplicates(empty).count() == 0
    assert ngram_components(empty).count() == 0
    assert one_of_each_group(empty).count() == 0


def shingles(text, size):
    words = (text or "").translate(LOWER).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    links = []
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and i < j and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    stars = forest(iter(links))
    return {i: stars.get(i, i) for i, _ in sets if i is not None}


def edited(text: str, n: int, rng) -> str:
    words = text.split()
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"w{rng.randint(0, 99)}"], [words[at], "more"]])
        words = words or ["x"]
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_near_copies_are_those_of_brute_force(spark, size, percent):
    rng = random.Random(size)
    rows = []
    for family in range(30):
        first = prose(1000 + family, rng.choice([2, 4, 5, 7, 12, 30, 80, 300]))
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((len(rows), edited(first, rng.choice([0, 0, 1, 1, 2, 4]), rng)))
    first = prose(7, 200)
    rows += [(len(rows) + k, edited(first, 1 + k % 4, rng)) for k in range(60)]
    rng.shuffle(rows)
    found = {r["doc_id"]: r for r in table(ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), size, percent))}
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(rows, size, percent)
    assert all(found[i]["n_shingles"] == len(shingles(t, size)) for i, t in rows)


def test_blocks_of_a_large_cluster_find_the_same(spark, monkeypatch):
    monkeypatch.setattr("formsift.llm.ngram_join.BLOCK_SHINGLES", 500)
    rng = random.Random(3)
    first = prose(7, 120)
    rows = [(k, edited(first, 1 + k % 6, rng)) for k in range(50)]
    found = {r["doc_id"]: r["component_id"] for r in table(ngram_components(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert found == brute_components(rows, 4, 85)


def test_near_copies_of_odd_rows(odd, odd_rows):
    rows = table(ngram_components(odd))
    wanted = brute_components(odd_rows, 4, 85)
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r["component_id"] == (None if r["doc_id"] is None else wanted[r["doc_id"]])
    left = one_of_each_group(odd, 4, 85)
    assert left.columns == odd.columns
    assert {r["doc_id"] for r in table(left)} == {i for i, c in wanted.items() if i == c} | {None}


def test_bands_leave_no_gap_and_enough_units():
    all_bands = bands(85)
    for before, band in zip(all_bands, all_bands[1:], strict=False):
        assert band.low == before.high + 1
    assert all(b.units >= bound(85, b.high) + 1 and b.double * 2 <= b.units for b in all_bands)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (500, 499), (499, 500)]
    random.Random(1).shuffle(edges)
    found = {r["node"]: r["component"] for r in table(components(spark.createDataFrame(edges, "a long, b long").repartition(7)))}
    assert all(found[i] == 1 for i in range(1, 61)) and all(found[200 + i] == 100 for i in range(50)) and found[500] == 499
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# state that outlives the call


def told(df):
    return {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in table(df)}


def test_further_tables_meet_the_state_of_those_before(spark, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    tmp_path = tmp_path / "a folder"

    def rows(pairs, name):
        spark.createDataFrame(pairs, "doc_id long, body string").repartition(2).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    first = rows([(1, "Aa"), (2, "aa"), (3, "b"), (4, None)], "one")
    second = rows([(5, "AA"), (6, "c"), (7, ""), (0, "B")], "two")
    third = spark.createDataFrame([(8, "c"), (9, "d")], "doc_id long, body string")  # from no file

    def call(df, batch, session=spark):
        return told(further_duplicates(df, state, batch, text="body"))

    assert call(first, "one") == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True)}
    # interrupted after its digests were written: given again, it counts once
    run = exact_dedup.dedup_state
    monkeypatch.setattr(exact_dedup, "dedup_state", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        call(second, "two")
    monkeypatch.setattr(exact_dedup, "dedup_state", run)
    wanted = {(5, 5, 3, True), (6, 6, 1, True), (7, 7, 2, True), (0, 3, 2, False)}
    assert call(second, "two") == wanted and call(second, "two") == wanted
    # another session takes up the same folder
    again = spark.newSession().read.parquet(str(tmp_path / "one"))
    assert call(again, "one") == {(1, 5, 3, False), (2, 5, 3, False), (3, 3, 2, True), (4, 7, 2, False)}
    assert call(third, "three") == {(8, 8, 2, True), (9, 9, 1, True)}
    assert call(first.limit(0), "none") == set()


def test_further_tables_with_a_digest_shared_by_other_texts(spark, tmp_path):
    def weak(text):
        return F.concat(F.lit("digest"), F.length(text).cast("string"))

    def call(pairs, batch):
        df = spark.createDataFrame(pairs, "doc_id long, text string")
        return told(further_duplicates(df, str(tmp_path / "s"), batch, digest=weak))

    assert call([(1, "ab"), (2, "cd"), (3, "xyz")], "1") == {(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True)}
    assert call([(4, "CD"), (5, "ef"), (6, "xyz")], "2") == {(4, 4, 2, True), (5, 5, 1, True), (6, 6, 2, True)}


def test_an_empty_table_first(spark, empty, tmp_path):
    assert further_duplicates(empty, str(tmp_path / "s"), "0").count() == 0
