"""Stored tables by key, running counters, and the stream's state."""

import pytest
from pyspark.sql import functions as F

from formsift import constants as K
from formsift.operators import report as R
from formsift.plans.documents import process_documents, run_batch
from formsift.sources import tables as S
from formsift.sources.store import KeyedTable, ResultStore
from formsift.streaming import ingest as I, state
from tests.test_io_runs import texts_of


def keyed(spark, folder, rows, buckets=16):
    df = spark.createDataFrame(rows, "file_name string, n int")
    table = KeyedTable.create(spark, folder, "file_name", df.schema, buckets)
    table.upsert(df, ["n"])
    return table


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in (folder / "rows").rglob("*.parquet")}


def test_upsert_reads_and_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    table = keyed(spark, str(tmp_path / "t"), [(f"f{i}", i) for i in range(400)])
    before = files_of(tmp_path / "t")
    new = spark.createDataFrame([("f1", -1), ("f2", -2), ("f2", -3), ("new", 5), (" ", 7), (None, 8)], "file_name string, n int")
    touched = table.upsert(new, ["n"])
    assert 1 <= len(touched) <= 3
    kept = {p: t for p, t in files_of(tmp_path / "t").items() if before.get(p) == t}
    gone = {p.parent.name for p in before if p not in kept}
    assert gone <= {f"bucket={b}" for b in touched} and len(kept) >= len(before) - 3
    rows = {r.file_name: r.n for r in table.read().collect()}
    assert rows == {f"f{i}": i for i in range(400)} | {"f1": -1, "f2": -2, "new": 5}
    again = KeyedTable(spark, str(tmp_path / "t"))  # the table knows its key and its buckets
    again.upsert(new, ["n"])
    assert {r.file_name: r.n for r in again.read().collect()} == rows


def test_texts_of_a_batch_come_from_pruned_partitions(spark, tmp_path):
    table = keyed(spark, str(tmp_path / "t"), [(f"f{i}", i) for i in range(200)])
    found = table.of_keys(spark.createDataFrame([("f7",), ("f8",), ("none",)], "file_name string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and len(table.touched(found)) <= 2
    assert sorted(tuple(r) for r in found.collect()) == [("f7", 7), ("f8", 8)]
    read = table.only(table.touched(found)).select(F.input_file_name()).distinct()
    assert 1 <= read.count() <= 2


def test_run_batch_prunes_texts_and_results(spark, tmp_path):
    texts = texts_of(spark, [(f"raw/d{i}.pdf", f"000-11-{i:04d}") for i in range(60)])
    stored = KeyedTable.create(spark, str(tmp_path / "texts"), "path", texts.schema, 32)
    stored.upsert(texts, ["path"])
    store = ResultStore.create(spark, str(tmp_path / "store"), 32)
    touched = run_batch(stored, texts.select("path"), store, 3)
    assert len(touched) <= 3
    assert [r.file_name for r in store.read().orderBy("file_name").collect()] == ["d0.pdf", "d1.pdf", "d10.pdf"]
    run_batch(stored, texts.select("path"), store, None)
    wanted = process_documents(texts)
    assert sorted(map(repr, store.read().collect())) == sorted(map(repr, wanted.select(K.RESULT_COLUMNS).collect()))


STATUSES = [*K.STATUSES, "OTHER", None]


def results_of(spark, number, n=25):
    """Rows of a batch: some keys again and again, some with other types and statuses, some without a time."""
    rows = [
        (f"d{(number * 7 + i * 3) % 60}.pdf", ["clean", "noisy", "unknown"][(number + i) % 3], STATUSES[(number * i) % 5],
         None if i % 6 == 0 else number + i / 8, number)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "file_name string, file_type string, status string, processing_time_seconds double, at int")
    missing = [c for c in K.RESULT_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(S.RESULT_TYPES.get(c, "string")) for c in missing})


def same(one, other):
    return sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


def test_counters_equal_the_full_recomputation_after_every_batch(spark, tmp_path):
    store = ResultStore.create(spark, str(tmp_path / "s"), 4)
    assert store.statistics().where("total > 0").count() == 0
    listed = spark.range(77)
    for number in range(1, 11):  # ten batches in a row
        store.upsert(results_of(spark, number), ["at", "status"], "run", number)
        if number in (1, 5, 10):
            assert same(store.statistics(), R.status_statistics(store.read()))
            assert same(store.summary(listed, batch_seconds=1.5), R.run_summary(store.read(), listed, batch_seconds=1.5))
    assert same(store.summary(found=80), R.run_summary(store.read(), found=80))
    assert len(list((tmp_path / "s" / "counters").iterdir())) <= 3
    assert all("/counters/version=10/" in path for path in store.statistics().inputFiles())
    store.write_reports(str(tmp_path / "out"), listed, updated_at="now")
    assert spark.read.parquet(str(tmp_path / "out" / "summary")).count() == 16


@pytest.mark.parametrize("when", ["before", "after"])
def test_an_interrupted_batch_is_counted_once(spark, tmp_path, monkeypatch, when):
    store = ResultStore.create(spark, str(tmp_path / "s"), 4)
    store.upsert(results_of(spark, 1), ["at", "status"], "run", 1)
    own = KeyedTable.upsert

    def broken(self, new, order, before=None):
        def interrupted(fresh, replaced):
            before(fresh, replaced)
            raise RuntimeError("lost")

        own(self, new, order, interrupted if when == "before" else before)
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "upsert", broken)
    with pytest.raises(RuntimeError):
        store.upsert(results_of(spark, 2), ["at", "status"], "run", 2)
    monkeypatch.undo()
    again = ResultStore(spark, str(tmp_path / "s"))
    assert again.next_number() == 2
    again.upsert(results_of(spark, 2), ["at", "status"], "run", 2)
    assert same(again.statistics(), R.status_statistics(again.read()))


def test_stream_state_survives_a_kill_between_batches(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "in")
    docs = [texts_of(spark, [(f"raw/{b}/d{i}.pdf", f"000-{b}1-{i:04d}") for i in range(b, b + 6)]) for b in (1, 3, 5)]
    for df in docs:  # files arrive one after the other
        df.coalesce(1).write.mode("append").parquet(source)
    store = ResultStore.create(spark, str(tmp_path / "s"), 4)
    calls, own = [], ResultStore.upsert

    def dying(self, new, order, source, number):
        calls.append(number)
        own(self, new, order, source, number)
        if len(calls) == 2:
            raise RuntimeError("killed")

    monkeypatch.setattr(ResultStore, "upsert", dying)
    args = (spark, source, docs[0].schema, store, str(tmp_path / "check"))
    with pytest.raises(Exception, match="killed"):
        state.ingest_latest(*args, max_files=1)
    state.ingest_latest(*args, max_files=1)
    assert calls == [0, 1, 1, 2]
    found = {r.file_name: r.employee_ssn for r in store.read().collect()}
    assert found == {f"d{i}.pdf": f"000-{b}1-{i:04d}" for b in (1, 3, 5) for i in range(b, b + 6)}
    assert same(store.statistics(), R.status_statistics(store.read()))
    state.ingest_latest(*args, max_files=1)  # nothing new
    assert len(calls) == 4


@pytest.mark.parametrize("batches", [1, 2])
def test_of_equal_base_names_the_later_path_stays(spark, tmp_path, batches):
    rows = [("raw/b/x.pdf", "000-33-4444"), ("raw/a/x.pdf", "000-11-2222"), ("raw/a/y.pdf", "none")]
    docs = texts_of(spark, rows)
    docs.repartition(3, "path").write.parquet(str(tmp_path / "in"))
    I.ingest(spark, str(tmp_path / "in"), docs.schema, str(tmp_path / "log"), str(tmp_path / "c1"))
    assert {r.file_name: r.employee_ssn for r in I.current_results(spark, str(tmp_path / "log")).collect()}["x.pdf"] == "000-33-4444"
    store = ResultStore.create(spark, str(tmp_path / "s"), 4)
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    state.ingest_latest(spark, str(tmp_path / "one"), docs.schema, store, str(tmp_path / "c2"))
    if batches == 2:  # a later file wins, whatever its path
        texts_of(spark, rows[1:2]).write.mode("append").parquet(str(tmp_path / "one"))
        state.ingest_latest(spark, str(tmp_path / "one"), docs.schema, store, str(tmp_path / "c2"))
    wanted = "000-33-4444" if batches == 1 else "000-11-2222"
    assert {r.file_name: r.employee_ssn for r in store.read().collect()} == {"x.pdf": wanted, "y.pdf": None}


def test_load_puts_rows_that_fail_a_cast_aside(spark, tmp_path):
    text = "file_name,processed_at,name_confidence,status\na.pdf,2024-01-02 03:04:05,0.95,OK\nb.pdf,soon,0.9,OK\nc.pdf,,x,OK\nd.pdf,never,1e,\ne.pdf,,,\n"
    (tmp_path / "r.csv").write_text(text)
    rows = S.read_results_csv(spark, str(tmp_path / "r.csv"))
    loaded, rejects, counts = S.load_with_rejects(rows, "checked_rows", str(tmp_path / "t"))
    assert counts == {"rows": 5, "rejects": 3} and loaded.columns == K.RESULT_COLUMNS
    assert {(r.file_name, r.name_confidence) for r in loaded.collect()} == {("a.pdf", 0.95), ("e.pdf", None)}
    found = {r.file_name: [(p.problem, p.value, p.reason) for p in r.problems] for r in rejects.collect()}
    assert found == {
        "b.pdf": [("processed_at", "soon", "not a timestamp")],
        "c.pdf": [("name_confidence", "x", "not a double")],
        "d.pdf": [("processed_at", "never", "not a timestamp"), ("name_confidence", "1e", "not a double")],
    }
    good = rows.where("file_name = 'a.pdf'")
    loaded, rejects, counts = S.load_with_rejects(good, "checked_rows", str(tmp_path / "t"))
    assert loaded.count() == 1 and rejects.count() == 0 and counts["rejects"] == 0
