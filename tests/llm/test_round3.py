"""Line dedup, hard negatives and centroid clustering against brute force, and on odd rows."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formsift.llm import base, line_dedup
from formsift.llm.centroids import centroid_clusters
from formsift.llm.exact_dedup import drop_exact_duplicates
from formsift.llm.hard_negatives import hard_negatives
from formsift.llm.line_dedup import LineRuns, dedup_lines, line_keys
from formsift.llm.html_main import main_text
from formsift.llm.pii import KINDS, PiiModel, redact
from formsift.llm.queries import op12_hard_negatives, op13_centroids
from formsift.llm.wordbpe import Remembered
from tests.llm.conftest import ODD, prose, table

LOWER = {i: i + 32 for i in range(65, 91)}


# lines


def plain_lines(rows, points=20, least=3):
    """(doc_id, n_lines, n_dropped, kept) row by row, as the docstring says."""
    def key(line):
        own = line.strip(" \t\n\v\f\r").translate(LOWER)
        return own if len(own) >= points else None

    less = lambda i: -1 if i is None else i
    holders = collections.defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if key(x) is None or len(holders[key(x)]) < least or less(doc) == max(map(less, holders[key(x)]))
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found_lines(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in table(df)), key=repr)


SHARED = [f"  Shared line number {i} of the house\t" for i in range(6)] + ["É" * 20, "é" * 19, "a" * 20, "A" * 20, "x" * 19]


def lined(seed: int) -> str:
    rng = random.Random(seed)
    lines = [rng.choice(SHARED) if rng.random() < 0.6 else prose(rng.randint(0, 99), 6) for _ in range(rng.randint(0, 12))]
    return "\n".join(lines)


def test_lines_agree_with_brute_force(spark):
    rows = [(i, lined(i)) for i in range(150)] + [(7, lined(7)), (149, lined(3)), (None, lined(4)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_lines(dedup_lines(docs)) == plain_lines(rows)
    assert found_lines(dedup_lines(docs, points=5, least=2, batches=2)) == plain_lines(rows, 5, 2)


def test_line_shared_by_a_third_of_all_rows_among_heavy_and_light_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY", 4)
    monkeypatch.setattr(line_dedup, "SAMPLED", 1)
    rows = [(i, f"{SHARED[0]}\n{SHARED[i % 5 + 1]}\nline of its own {prose(i, 8)}" if i % 3 else prose(i, 9)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_lines(dedup_lines(docs, batches=2)) == plain_lines(rows)


def test_keys_of_lines():
    assert line_keys(b"", 1) == [None] and line_keys(b"\n A \n", 1) == [None, b"a", None]
    assert line_keys("É  ".encode(), 2) == ["É ".encode()] and line_keys("É".encode(), 2) == [None]


def test_lines_of_odd_rows(odd, odd_rows, empty):
    assert found_lines(dedup_lines(odd, batches=2)) == plain_lines(odd_rows)
    assert dedup_lines(empty, batches=1).collect() == []
    assert dedup_lines(empty, batches=1).columns == ["doc_id", "n_lines", "n_dropped", "kept"]


def hashes(spark, rows):
    return spark.createDataFrame(rows, "id long, h1 long, h2 long")


def test_runs_stay_over_batches_a_restart_and_a_repeated_batch(spark):
    folder = base.shared_folder(spark, "runs")
    rng = random.Random(5)
    batches = [sorted({(rng.randint(0, 60), rng.randint(0, 9), 1) for _ in range(40)}) for _ in range(5)]
    runs = LineRuns(spark, folder, least=3, fan=2)
    for i, rows in enumerate(batches):
        runs.add(str(i), hashes(spark, rows))
        if i == 2:  # a new session finds what the one before left
            for run in runs.runs():
                run.forget()
            runs = LineRuns(spark, folder, least=3, fan=2)
        runs.add(str(i), hashes(spark, rows))  # done already
        assert all(len(level) < 2 for level in runs.levels) and runs.done == [str(b) for b in range(i + 1)]
    every = collections.defaultdict(list)
    for rows in batches:
        for doc, h1, _ in rows:
            every[h1].append(doc)
    found = {r["h1"]: r["top"] for r in table(runs.keys())}
    assert found == {h: max(docs) for h, docs in every.items() if len(docs) >= 3}
    runs.discard()


def test_settled_keys_are_not_added_again(spark):
    runs = LineRuns(spark, base.shared_folder(spark, "runs"), least=2, fan=9)
    runs.add("a", hashes(spark, [(9, 1, 1), (8, 1, 1), (7, 2, 2)]))
    runs.add("b", hashes(spark, [(5, 1, 1), (6, 2, 2), (5, 3, 3)]))
    runs.add("c", hashes(spark, [(10, 1, 1), (None, 1, 1), (None, 2, 2)]))
    assert [sorted(r["h1"] for r in table(run.read())) for run in runs.levels[0]] == [[1, 2], [2, 3], [1, 2]]
    assert {(r["h1"], r["top"]) for r in table(runs.keys())} == {(1, 10), (2, 7)}
    runs.discard()


def test_the_anti_join_of_a_batch_does_not_shuffle_the_runs(spark):
    runs = LineRuns(spark, base.shared_folder(spark, "runs"))
    runs.add("a", hashes(spark, [(i, i, i) for i in range(50)]))
    had = runs.levels[0][0].read()
    own = hashes(spark, [(1, 2, 3)]).groupBy("h1", "h2").count()
    plan = own.join(had.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    runs.discard()


def test_later_tables_meet_the_runs_of_earlier_ones(spark):
    runs = LineRuns(spark, base.shared_folder(spark, "runs"))
    first = spark.createDataFrame([(i, SHARED[0]) for i in (5, 6)], "doc_id long, text string")
    later = spark.createDataFrame([(1, SHARED[0]), (2, "short")], "doc_id long, text string")
    assert [r["n_dropped"] for r in table(dedup_lines(first, runs=runs, batches=1))] == [0, 0]
    assert {r["doc_id"]: r["n_dropped"] for r in table(dedup_lines(later, runs=runs, batches=1))} == {1: 1, 2: 0}


# hard negatives


def plain_negatives(rows, every=4, scale=256, n=5, k=5):
    """Every anchor's windows one after the other, from all its scores."""
    def ok(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])

    rows = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in filter(ok, rows)]
    out = []
    for a, va, ya in rows:
        if a % every:
            continue
        score = [
            (-sum(x * y for x, y in zip(va, v, strict=True)), i, label)
            for i, v, label in rows if i != a and len(v) == len(va)
        ]
        for p, pid, _ in sorted(s for s in score if s[2] == ya)[:n]:
            inside = sorted(s for s in score if s[2] != ya and 80 * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out += [(a, pid, r + 1, nid, -p, -ns) for r, (ns, nid, _) in enumerate(inside)]
    return sorted(out)


def vectors(seed, n, dims=3, levels=5):
    """Few levels make ties and shared limits."""
    rng = random.Random(seed)
    return [(i, [rng.randint(-1, levels) / 4 for _ in range(dims)], rng.randint(0, 2)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int"
STRANGE = [
    (None, [1.0, 1.0, 1.0], 1), (200, None, 1), (204, [], 1), (208, [1.0, None, 1.0], 1), (212, [float("nan"), 1.0, 1.0], 0),
    (216, [float("inf"), 1.0, 1.0], 0), (220, [1.0, 1.0, 1.0], None), (224, [1.0, 1.0], 1), (225, [1.0, 1.0], 0),
    (226, [1.0, 1.0], 1), (4, [1.0, 1.0, 1.0], 1), (4, [1.0, 1.0, 1.0], 1), (228, [-1.0, -1.0, -1.0], 2),
]


def found_negatives(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1])
def test_negatives_agree_with_brute_force(spark, seed):
    rows = vectors(seed, 150) + STRANGE
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    wanted = plain_negatives(rows)
    assert len(wanted) > 200
    assert found_negatives(hard_negatives(df, every=4)) == wanted
    assert found_negatives(hard_negatives(df, every=4, wave_bytes=24 * 20)) == wanted  # several waves


def test_negatives_of_tables_without_result(spark):
    df = spark.createDataFrame(vectors(3, 40), SCHEMA)
    assert hard_negatives(df.limit(0)).collect() == []
    assert hard_negatives(df.where("vec_id % 100 <> 0")).collect() == []
    assert hard_negatives(df.where("label = 1")).collect() == []
    more = df.withColumns({"row": F.lit("x"), "id": F.lit(1), "slot": F.lit(2), "v": F.lit(3), "score": F.lit(4)})
    assert found_negatives(hard_negatives(more, every=4)) == plain_negatives(vectors(3, 40))


def test_components_out_of_range_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 1)], SCHEMA)
    for run in (hard_negatives, lambda d: centroid_clusters(d, dims=2)):
        with pytest.raises(Exception, match="not be exact"):
            run(df).collect()


def test_query_moves_labels_of_every_seventh_row(spark, tmp_path):
    rows = [(i, [1.0 + i / 1000, 1.0], 9 if i % 2 else 0) for i in range(120)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    assert found_negatives(op12_hard_negatives(spark, str(tmp_path))) == plain_negatives(moved, every=100)


# clusters


def plain_clusters(rows, k, rounds, dims, scale=256):
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows
        if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    own = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(own))

    for _ in range(rounds):
        of = collections.defaultdict(list)
        for _, v in kept:
            of[nearest(v)[1]].append(v)
        own = [[sum(x) // len(of[n]) for x in zip(*of[n], strict=True)] if n in of else c for n, c in enumerate(own)]
    last = [(i, nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, (d, c) in last:
        inertia[c] += d
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), ",".join(map(str, own[c]))) for i, (d, c) in last), key=repr
    )


def found_clusters(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_clusters_agree_with_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr("formsift.llm.centroids.CHUNK_ROWS", 7)
    rows = vectors(width, 120, dims=5) + [(None, [0.5] * 5, 1), (None, [0.25] * 5, 1), (500, [1.0] * 4, 0)]
    rows += [(501, None, 0), (502, [], 0), (503, [None] * 5, 0), (504, [float("nan")] * 5, 0), (5, [9.0] * 5, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit("b"), "v": F.lit(1), "id": F.lit(2)}).repartition(3)
    found = centroid_clusters(df, k=9, rounds=4, dims=5, width=width)
    assert found_clusters(found) == plain_clusters(rows, 9, 4, 5)


def test_clusters_of_few_equal_and_no_vectors(spark):
    few = [(i, [float(i % 2), 1.0], 0) for i in range(6)]
    df = spark.createDataFrame(few, SCHEMA)
    assert found_clusters(centroid_clusters(df, k=40, dims=2, width=1)) == plain_clusters(few, 40, 5, 2)
    assert centroid_clusters(df.limit(0), dims=2).collect() == [] and centroid_clusters(df, dims=64).collect() == []


def test_wide_numbers_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-5e5, 5e5) for _ in range(4)], 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found_clusters(centroid_clusters(df, k=5, dims=4, width=2)) == plain_clusters(rows, 5, 5, 4)


def test_query_hashes_the_centroids(spark, small):
    rows = table(op13_centroids(spark, small))
    own = table(centroid_clusters(spark.read.parquet(f"{small}/embeddings.parquet")))
    assert {r["centroid_sha256"] for r in rows} == {hashlib.sha256(r["centroid"].encode()).hexdigest() for r in own}


def test_odd_texts_have_lines(spark):
    rows = list(enumerate(ODD)) * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_lines(dedup_lines(docs, points=1, least=2, batches=1)) == plain_lines(rows, 1, 2)


# columns and workers


def test_stages_keep_columns_of_any_name(spark):
    names = ["__file", "__place", "__bucket", "__gone0", "__known", "bucket", "known"]
    rows = [(i, f"Write to a.b{i % 3}@example.org today", *range(7)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    once = drop_exact_duplicates(docs)
    assert once.columns == docs.columns and sorted(r["doc_id"] for r in table(once)) == [3, 4, 5]
    assert all([r[n] for n in names] == list(range(7)) for r in table(once))
    shown = redact(docs, PiiModel(thresholds=dict.fromkeys(KINDS, 2.0)))
    assert shown.columns == docs.columns
    assert all("[EMAIL]" in r["text"] and [r[n] for n in names] == list(range(7)) for r in table(shown))
    left = base.without(docs, docs.where("doc_id < 2"), ["doc_id", "__bucket"])
    assert left.columns == docs.columns and left.count() == 4


def test_remembered_words_are_bounded_by_bytes():
    known = Remembered(most=2000)
    rng = np.random.default_rng(1)
    for _ in range(50):
        keys = np.unique(rng.integers(0, 500, 30).astype(np.uint64))
        new = keys[known.missing(keys)]
        sizes = (new % 4).astype(np.int32)
        known.put(new, sizes, np.repeat(new, sizes).astype(np.uint32))
        begin, size = known.places(keys)
        assert [known.pool[b : b + n].tolist() for b, n in zip(begin, size, strict=True)] == [[k] * (k % 4) for k in keys.tolist()]
        assert len(known.keys) < 200 and (np.diff(known.keys.astype(np.int64)) > 0).all()


# pages that lost text

LONG = "This is a sentence of the article that says something at length, and it goes on. " * 3


@pytest.mark.parametrize("cell", ["<table><tr><td>one cell of figures, and some more of them</td></tr></table>", "<blockquote>a quote of somebody who is well known here</blockquote>"])
@pytest.mark.parametrize("top", ["", "<html>", "<head><title>x</title></head>"])
def test_pages_without_a_body_keep_their_article(top, cell):
    text = main_text(f"{top}<title>x</title><h1>The heading</h1><p>{LONG}</p><p>{LONG}</p>{cell}", None)
    assert text.startswith("The heading") and text.count("at length") == 6


def test_names_of_running_text_count_as_a_whole_only():
    names = ["notice-period", "share-price", "ad-hoc", "login-guide", "menu-item-text"]
    inner = "".join(f'<h2 class="{n}">About {n}</h2><p class="{n}">{LONG}</p>' for n in names)
    text = main_text(f'<body><article><h1>T</h1>{inner}<p class="advert">buy this now</p></article></body>', None)
    assert all(f"About {n}" in text for n in names) and text.count("at length") == 15 and "buy" not in text


def test_buttons_go_without_a_trace():
    text = main_text(f"<body><article><p>Before <button class=x>Subscribe now</button> after it. {LONG}</p><p>{LONG}</p></article></body>", None)
    assert text.startswith("Before after it. This is") and "Subscribe" not in text


@pytest.mark.parametrize("tag", ["video", "object", "select", "canvas", "svg", "iframe", "button"])
def test_elements_left_open_take_nothing_with_them(tag):
    text = main_text(f"<body><article><p>{LONG}</p><{tag} x=1><p>{LONG}</p><{tag}><p>last one</p></article></body>", None)
    assert text.count("at length") == 6 and text.endswith("last one")


def test_an_open_script_takes_the_rest():
    assert "x = 1" not in main_text(f"<body><p>{LONG}</p><script>x = 1; <p>no</p>", None)
