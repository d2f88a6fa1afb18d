"""Files, stored results, batch runs and the stream."""

from pyspark.sql import functions as F

from formsift import constants as K
from formsift.operators import report as R, runs
from formsift.plans.catalog import QUERIES
from formsift.plans.documents import next_run, process_documents
from formsift.sources import files, tables as S
from formsift.sources.forms import forms, forms_of
from formsift.sources.store import ResultStore
from formsift.streaming import ingest as I, state


def test_list_documents(spark, tmp_path):
    for name in ["b.pdf", "sub/a.PDF", "c.txt"]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    listed = S.list_documents(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in listed.collect()] == ["b.pdf", "a.PDF"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_read_texts_replaces_bad_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\ntw\xffo")
    row = S.read_ocr_texts(spark, str(tmp_path)).collect()[0]
    assert (row.file_name, row.raw_text) == ("a.pdf", "one\ntw�o")


def test_text_files_of_all_forms_are_read_by_the_operator(spark, small, monkeypatch):
    read = []

    def reader(spark, root, own=S.read_ocr_texts):
        read.append(own(spark, root))
        return read[-1]

    monkeypatch.setattr(S, "read_ocr_texts", reader)
    found = QUERIES["s2_read_ocr_files"](spark, small)
    assert len(read) == 1
    wanted = {r.file_name: r.raw_text or "" for r in forms(spark, small).collect()}
    assert {r.file_name: r.raw_text for r in found.collect()} == wanted and "" in wanted.values()
    assert read[0].count() == len(wanted) > spark.read.parquet(f"{small}/supplier.parquet").count()


def test_empty_files_are_listed_and_read(spark, tmp_path):
    for name, text in {"a.txt": b"", "deep/er/b.txt": b"x\n", "deep/c.txt": b"\xff", "deep/er/d.PDF": b"", "e.pdf": b"", "_f.pdf": b"1"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(text)
    (tmp_path / "nothing").mkdir()
    listed = [r.path.removeprefix(f"{tmp_path}/") for r in S.list_documents(spark, str(tmp_path)).collect()]
    assert listed == ["_f.pdf", "deep/er/d.PDF", "e.pdf"]
    read = {r.file_name: r.raw_text for r in S.read_ocr_texts(spark, f"file://{tmp_path}").collect()}
    assert read == {"a.pdf": "", "b.pdf": "x\n", "c.pdf": "\ufffd", "d.PDF": "", "e.pdf": "", "_f.pdf": "1"}
    assert S.read_ocr_texts(spark, str(tmp_path / "nothing")).collect() == []


def test_small_files_are_packed_by_bytes_and_listed_by_folders(spark, tmp_path):
    for i in range(300):
        folder = tmp_path / f"{i % 70:02d}"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.txt").write_text("text" * (i % 5))
    reader = files.FolderReader(str(tmp_path), ".txt")
    parts = reader.partitions()
    assert len(parts) == 71 and sum(p.deep for p in parts) == 70
    assert sorted(p for part in parts for p, _ in reader.read(part)) == sorted(map(str, tmp_path.rglob("*.txt")))
    read = files.read_files(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() == 1  # 300 files of no size are a task's work
    assert files.read_files(spark, str(tmp_path), pack_bytes=1 << 20).rdd.getNumPartitions() == 19
    assert {r.path: len(r.content) for r in read.collect()} == {str(tmp_path / f"{i % 70:02d}" / f"{i}.txt"): 4 * (i % 5) for i in range(300)}


def test_results_csv_with_mark_quotes_and_repeats(spark, tmp_path):
    text = '﻿file_name,status,review_reason\r\n a.pdf ,OLD,x\r\n,LOST,y\r\na.pdf,NEW,"said ""no"",\ntwice"\r\n'
    (tmp_path / "r.csv").write_text(text, encoding="utf-8")
    rows = S.read_results_csv(spark, str(tmp_path / "r.csv"), ["file_name", "status", "review_reason"]).collect()
    assert [tuple(r) for r in rows] == [("a.pdf", "NEW", 'said "no",\ntwice')]


def test_csv_round_trip(spark, small, tmp_path):
    done = process_documents(forms(spark, small))
    S.write_results(done, str(tmp_path / "csv"), fmt="csv")
    back = S.typed(S.read_results_csv(spark, str(tmp_path / "csv")))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, done.select(K.RESULT_COLUMNS).collect()))


def test_batches_drain_the_folder_and_then_do_nothing(spark, small, tmp_path):
    texts = forms(spark, small).select("file_name", "path", "raw_text", "error", "processed_at", "processing_time_seconds")
    texts.write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    listed = texts.select("path")
    stored = process_documents(texts).limit(0)
    sizes = []
    for step in range(4):
        path = str(tmp_path / f"run{step}")
        # with retries a failed file would take a place in every batch
        next_run(texts, listed, stored, 60, retry_failed=False).write.parquet(path)
        stored = spark.read.parquet(path)
        sizes.append(stored.count())
    assert sizes == [60, 120, 150, 150]
    failed = stored.filter("status = 'FAILED'").count()
    assert failed > 0
    assert runs.pending(listed, runs.done_files(stored)).count() == failed
    assert runs.pending(listed, runs.done_files(stored, retry_failed=False)).count() == 0


def test_upsert_replaces(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "file_name string, n int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "file_name string, n int")
    assert sorted(tuple(r) for r in runs.upsert(old, new).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_stream_takes_new_files_only_and_last_batch_wins(spark, small, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    docs = forms(spark, small).select("k", "file_name", "raw_text", "error", "processed_at", "processing_time_seconds")
    docs.cache()
    docs.filter("k < 100").repartition(4).write.parquet(source)

    def run():
        I.ingest(spark, source, docs.schema, log, checkpoint, max_files=2)
        return I.current_results(spark, log)

    assert run().count() == 100
    batches = spark.read.option("basePath", log).parquet(log).select("batch_id").distinct().count()
    assert batches == 2
    assert run().count() == 100 and spark.read.option("basePath", log).parquet(log).count() == 100
    again = docs.filter("k >= 90").withColumn("raw_text", F.lit("nothing")).withColumn("error", F.lit(None).cast("string"))
    again.coalesce(1).write.mode("append").parquet(source)
    now = run()
    assert now.count() == 150
    assert now.filter("employee_name IS NULL").count() >= 60
    assert I.failed_files(spark, log).count() == now.filter("status = 'FAILED'").count()


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("file_name"), F.col("id").alias("n"))
    latest = R.latest_by_key(df, "file_name", ["n"])
    assert latest.filter("file_name = 'hot'").collect()[0].n == 19998
    assert "partial_max_by" in latest._jdf.queryExecution().executedPlan().toString()


def texts_of(spark, rows):
    """(path, text) as documents."""
    df = spark.createDataFrame(rows, "path string, raw_text string")
    return df.withColumns({
        "file_name": F.substring_index("path", "/", -1),
        "error": F.lit(None).cast("string"), "processed_at": F.lit(0).cast("timestamp"),
        "processing_time_seconds": F.lit(1.0),
    })


def test_paths_with_one_base_name_leave_one_result(spark):
    texts = texts_of(spark, [("raw/a/x.pdf", "000-11-2222"), ("raw/b/x.pdf", "000-33-4444")])
    none = process_documents(texts).limit(0)
    both = next_run(texts, texts.select("path"), none, None).collect()
    assert [(r.file_name, r.employee_ssn) for r in both] == [("x.pdf", "000-33-4444")]
    one = next_run(texts, texts.select("path"), none, 1).collect()
    assert [(r.file_name, r.employee_ssn) for r in one] == [("x.pdf", "000-11-2222")]


def test_pending_files_without_text_keep_their_result(spark):
    old = process_documents(texts_of(spark, [("raw/a.pdf", "x")]).withColumn("error", F.lit("away")))
    listed = spark.createDataFrame([("raw/a.pdf",), ("raw/b.pdf",)], "path string")
    texts = texts_of(spark, [("raw/b.pdf", "y")])
    rows = {r.file_name: r.status for r in next_run(texts, listed, old, None).collect()}
    assert rows == {"a.pdf": "FAILED", "b.pdf": "NEEDS_REVIEW"}


def test_upsert_keeps_one_row_of_a_key(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "file_name string, n int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("b", 3)], "file_name string, n int")
    assert sorted(tuple(r) for r in runs.upsert(old, new).collect()) == [("a", 1), ("b", 3)]
    assert sorted(tuple(r) for r in runs.upsert(old, new.limit(0)).collect()) == [("a", 1), ("b", 1)]


def test_csv_goes_by_the_header(spark, tmp_path):
    (tmp_path / "r.csv").write_text("status,file_name,more,review_reason\nOLD,a.pdf,1,x\n")
    rows = S.read_results_csv(spark, str(tmp_path / "r.csv"), ["file_name", "file_type", "status", "review_reason"]).collect()
    assert [tuple(r) for r in rows] == [("a.pdf", "", "OLD", "x")]
    (tmp_path / "t.csv").write_text("file_name,employee_name\na.pdf,James Cox\na.pdf,James Cox\n")
    rows = S.read_truth_csv(spark, str(tmp_path / "t.csv")).collect()
    assert len(rows) == 2 and rows[0].file_type == "" and rows[0].employee_name == "James Cox"


def test_outputs_leave_no_staging_folder(spark, small, tmp_path):
    done = process_documents(forms(spark, small))
    listed = S.select_documents(forms(spark, small).select("path"), "raw")
    S.write_all(done, listed, str(tmp_path), batch_seconds=3.5, updated_at="now")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["manual_review", "results", "status_statistics", "summary"]
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 17
    broken = done.withColumn("file_name", F.raise_error(F.lit("broken")))
    try:
        S.write_results(broken, str(tmp_path / "more"))
    except Exception as error:
        assert "broken" in str(error)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["manual_review", "results", "status_statistics", "summary"]


def test_absent_tables_have_no_rows(spark, tmp_path):
    batch = spark.createDataFrame([("a",)], "file_name string")
    for nowhere in ("no_such_table", str(tmp_path / "none")):
        assert runs.already_processed(batch, nowhere).count() == 0
        found = runs.fetch_results(nowhere, spark=spark)
        assert found.count() == 0 and found.columns == K.REPORT_COLUMNS
    S.append_results(spark.createDataFrame([("a", "OK")], "file_name string, status string"), str(tmp_path / "t"))
    assert runs.already_processed(batch, str(tmp_path / "t")).count() == 1
    assert spark.read.parquet(str(tmp_path / "t")).columns == list(K.TABLE_TYPES)
    assert len(K.TABLE_TYPES) == 16


def test_stream_with_a_new_checkpoint_retries_and_closes(spark, small, tmp_path):
    source, log, out = (str(tmp_path / n) for n in ("in", "log", "out"))
    docs = forms(spark, small).filter("k BETWEEN 1 AND 60").select(
        "k", "path", "file_name", "raw_text", "error", "processed_at", "processing_time_seconds"
    )
    docs.coalesce(1).write.parquet(source)
    I.ingest(spark, source, docs.schema, log, str(tmp_path / "check1"))
    docs.withColumns({"file_name": F.concat(F.lit("new_"), "file_name"), "error": F.lit("away")}).coalesce(1).write.mode("overwrite").parquet(source)
    I.ingest(spark, source, docs.schema, log, str(tmp_path / "check2"))
    assert I.current_results(spark, log).count() == 120  # the first stream's batch 0 is still there
    failed = I.failed_files(spark, log)
    assert failed.count() >= 60
    again = docs.withColumns({"file_name": F.concat(F.lit("new_"), "file_name")})
    I.retry(spark, again.join(failed, "file_name", "left_semi"), log)
    before = sorted(map(repr, I.current_results(spark, log).collect()))
    I.close_run(spark, log, docs.select("path"), out, batch_seconds=1.0, updated_at="now")
    assert sorted(map(repr, I.current_results(spark, log).collect())) == before
    assert len([p for p in (tmp_path / "log").iterdir() if p.name.startswith("run=")]) == 1
    assert spark.read.parquet(f"{out}/results").count() == 120


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_status_needs_no_employer_and_an_id_no_address(spark, small):
    few = forms(spark, small).select("k", "path", "file_name", "raw_text", "error", "processed_at", "processing_time_seconds")
    status = plan_of(R.status_summary(process_documents(few, ["file_name", "status"])))
    whole = plan_of(process_documents(few))
    assert "employer_address" in whole and "employer_address" not in status and "employer_name" not in status
    from formsift.plans.catalog import QUERIES

    for name in ("v9_id_evidence", "v13_id_confidence"):
        assert "is_street" not in plan_of(QUERIES[name](spark, small)) and "employee_address" not in plan_of(QUERIES[name](spark, small))


def test_dedupe_carries_what_is_read_only(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}, "w"), ("a", 2, {"y": 2}, "w")], "file_name string, n int, m map<string,int>, wide string")
    latest = R.latest_by_key(df, "file_name", ["n"])
    assert latest.collect()[0].m == {"y": 2}
    assert "max_by(wide" in plan_of(latest) and "max_by(wide" not in plan_of(latest.select("file_name", "n"))


def test_stream_takes_many_files_at_once_and_null_keys(spark, small, tmp_path, monkeypatch):
    customers = spark.read.parquet(f"{small}/customer.parquet")
    unknown = customers.limit(1).withColumn("c_custkey", F.lit(None).cast(customers.schema["c_custkey"].dataType))
    customers.unionByName(unknown).repartition(8).write.parquet(str(tmp_path / "customer.parquet"))
    spark.read.parquet(f"{small}/supplier.parquet").write.parquet(str(tmp_path / "supplier.parquet"))
    seen = []

    def ingest(spark, source, schema, *args, max_files, own=I.ingest):
        arrived = spark.read.schema(schema).parquet(source)
        seen.append((len(arrived.inputFiles()), max_files, arrived.count(), arrived.where("c_custkey IS NULL").count()))
        own(spark, source, schema, *args, max_files=max_files)

    monkeypatch.setattr(I, "ingest", ingest)
    found = QUERIES["c10_stream_ingest"](spark, str(tmp_path)).collect()
    files, at_once, rows, nulls = seen[0]
    assert files > 3 and 1 < at_once <= files // 3 + 1
    assert rows == customers.count() + 1 and nulls == 1
    wanted = process_documents(forms(spark, str(tmp_path)))
    assert {r.file_name for r in found} == {r.file_name for r in wanted.select("file_name").collect()}


def test_streams_deal_documents_of_one_file_over_all_cores(spark, small, tmp_path, monkeypatch):
    """A file that is one split, with one name over and over, keeps more than one task busy in both streams and in `retry`."""
    docs = forms(spark, small).filter("k BETWEEN 1 AND 60").select(
        "path", "file_name", "raw_text", "error", "processed_at", F.lit(0.0).alias("processing_time_seconds")
    )
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    one_name = docs.withColumn("path", F.concat(F.lit("raw/x/"), "file_name")).withColumn("file_name", F.lit("form_clean_one.pdf"))

    def seen(df, own=process_documents, **kept):
        own_task = F.spark_partition_id().cast("double")
        return own(df.withColumn("processing_time_seconds", own_task), **kept)

    for module in (I, state):
        monkeypatch.setattr(module, "process_documents", seen)

    def parts(results):
        return results.select("processing_time_seconds").distinct().count()

    log = str(tmp_path / "log")
    I.ingest(spark, str(tmp_path / "in"), docs.schema, log, str(tmp_path / "c1"))
    assert I.current_results(spark, log).count() == 60 and parts(I.current_results(spark, log)) > 4
    again = str(tmp_path / "again")
    I.retry(spark, spark.read.parquet(str(tmp_path / "in")), again)
    assert parts(spark.read.parquet(again)) > 4
    store = ResultStore.create(spark, str(tmp_path / "store"), 4)
    state.ingest_latest(spark, str(tmp_path / "in"), docs.schema, store, str(tmp_path / "c2"))
    assert store.read().count() == 60 and parts(store.read()) > 4
    one_name.coalesce(1).write.parquet(str(tmp_path / "same"))
    same = str(tmp_path / "same-log")
    I.ingest(spark, str(tmp_path / "same"), docs.schema, same, str(tmp_path / "c3"))
    assert parts(spark.read.parquet(same)) > 4 and I.current_results(spark, same).count() == 1


def test_forms_of_a_batch_are_built_from_keys_dealt_out(spark, small):
    one = spark.read.parquet(f"{small}/customer.parquet").coalesce(1)
    built = forms_of(one, small, "a_batch")
    assert sorted(built.select("k", "raw_text").collect()) == sorted(forms(spark, small).select("k", "raw_text").collect())
    assert "RepartitionByExpression [c_custkey" in plan_of(built)
