"""Near copies in large clusters: what is written and which sets meet."""

import random

from formsift.llm import base, ngram_join
from formsift.llm.components import components
from formsift.llm.ngram_join import ngram_components
from tests.llm.conftest import prose, table
from tests.llm.test_copies import brute_components, edited


def rows_of_staged(monkeypatch) -> dict[str, int]:
    found, staged = {}, base.staged

    def counted(df, name):
        found[name] = (out := staged(df, name)).count()
        return out

    monkeypatch.setattr(base, "staged", counted)
    return found


def components_of(spark, rows: list[tuple]) -> dict[int, int]:
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in table(ngram_components(docs))}


def test_a_large_family_is_written_once(spark, monkeypatch):
    # 60 sets of 1,500 shingles are nine blocks, for each of which every set was written
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 10_000)
    staged, plans = rows_of_staged(monkeypatch), []

    def planned(edges):
        plans.append(edges._jdf.queryExecution().toString())
        return components(edges)

    monkeypatch.setattr(ngram_join, "components", planned)
    rng = random.Random(5)
    first = " ".join(f"{w}{i}" for i, w in enumerate(prose(11, 1500).split()))
    rows = [(k, edited(first, 1 + k % 9, rng)) for k in range(60)]
    assert components_of(spark, rows) == dict.fromkeys(range(60), 0)
    assert not [p for p in plans if "explode(" in p]  # of blocks
    assert staged["sets"] == 60


def test_waves_find_what_a_sample_does_not_join(spark, monkeypatch):
    # windows over one long text: each is alike to its neighbours only, so that few are of the sample's component
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 700)
    staged = rows_of_staged(monkeypatch)
    rng = random.Random(6)
    rows = []
    for start in (0, 10_000):
        words = [f"w{start + i}" for i in range(400)]
        rows += [" ".join(words[i : i + 100]) for i in range(0, 300, 6) if i not in (60, 66, 72, 78)]
    rows += [edited(rows[0], k % 3, rng) for k in range(6)] + [prose(k, 60) for k in range(5)]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    assert components_of(spark, rows) == brute_components(rows, 4, 85)
    assert staged["sets"] > 50


def test_shingles_common_among_large_clusters_do_not_join_them(spark, monkeypatch):
    # the windows know of no common shingle, as of one that few sets of each window and yet many of all have
    monkeypatch.setattr(ngram_join, "OFTEN", 1 << 40)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 2000)
    staged = rows_of_staged(monkeypatch)
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(k, " ".join(f"u{k}x{i}" for i in range(170)) + " " + passage) for k in range(1000)]
    rows += [(2000 + k, edited(rows[0][1], k % 4, rng)) for k in range(11)]
    found = components_of(spark, rows)
    assert staged["large"] == 0  # before: all that have the passage among their rarest shingles
    assert found == {i: 0 if i >= 2000 else i for i, _ in rows}
