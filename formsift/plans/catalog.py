"""Every operator as a named query over a folder of tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formsift import constants as K
from formsift.functions import address as A, checks as V, compare as C, lines as L, names as N
from formsift.functions import text as T, windows as W
from formsift.operators import evaluate as E, extract as X, report as R, runs, validate as VA
from formsift.operators.flags import flag_counts, with_flags
from formsift.operators.stages import computed
from formsift.plans.documents import next_run, process_documents, run_batch
from formsift.sources import tables as S
from formsift.sources.forms import forms, forms_of, prior_results, truth
from formsift.sources.store import KeyedTable, ResultStore
from formsift.streaming import ingest as I, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- shared inputs -------------------------------------------------------------------------------


def form_facts(spark: SparkSession, sf: str) -> DataFrame:
    return X.with_facts(forms(spark, sf).select("k", "file_name", "raw_text"))


def form_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.split_lines(F.col("raw_text"))
    return forms(spark, sf).select("k", F.posexplode(lines).alias("line_no", "line"))


def all_lines(spark: SparkSession, sf: str) -> DataFrame:
    of_forms = form_lines(spark, sf).select(F.lit("form").alias("source"), F.col("k").alias("id"), "line_no", "line")
    of_documents = table(spark, sf, "documents").select(
        F.lit("document").alias("source"),
        F.col("doc_id").alias("id"),
        F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "line"),
    )
    return of_forms.unionByName(of_documents)


def latest_prior(spark: SparkSession, sf: str) -> DataFrame:
    return R.latest_by_key(prior_results(spark, sf), "file_name", ["seq"])


def results(spark: SparkSession, sf: str, columns: list[str] = K.RESULT_COLUMNS) -> DataFrame:
    return process_documents(forms(spark, sf), columns)


def fields(spark: SparkSession, sf: str, wanted: list[str] = K.FIELDS) -> DataFrame:
    """Extracted fields of the forms, the input of the validation queries."""
    return X.extract_fields(forms(spark, sf).select("k", "file_name", "raw_text"), fields=wanted)


def street_rows(facts: DataFrame) -> DataFrame:
    """One row per street line with its look-ahead; a narrow explode of a few rows per document."""
    found = F.filter(
        F.transform("facts", lambda f, i: F.when(f["street"], i)), lambda i: i.isNotNull()
    )
    return facts.select("k", "facts", "low_text", F.explode(found).alias("street_index")).withColumns(
        {
            "ahead": W.window(F.col("facts"), F.col("street_index"), 1, K.LOOK_AHEAD),
            "back": W.window(F.col("facts"), F.col("street_index"), -K.NAME_LOOK_BACK, -1),
        }
    )


def candidate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return form_facts(spark, sf).select("k", F.inline(X.candidates(F.col("facts"), F.col("low_text"))))


def seconds(df: DataFrame) -> DataFrame:
    """Timestamps as seconds, so that no session time zone shows."""
    return df.withColumn("processed_at", F.unix_seconds(F.col("processed_at").cast("timestamp")))


# --- sources, sinks, stored state ------------------------------------------------------------------


@query
def s1_list_documents(spark, sf):
    return S.select_documents(forms(spark, sf).select("path"), "raw")


@query
def s1_list_folder(spark, sf):
    """A file for every form at its path, every third one without a byte; what lies below raw/ is listed."""
    folder = S.scratch_folder(spark, "scans")
    files = forms(spark, sf).select(
        "k", F.regexp_replace("path", r"[^/]*\z", "").alias("below"), F.substring_index("path", "/", -1).alias("name"),
        F.when(F.col("k") % 3 > 0, F.lit("%PDF-1.7")).alias("raw_text"),
    )
    S.write_text_files(files.repartition(4 * spark.sparkContext.defaultParallelism, "k"), folder)
    listed = S.list_documents(spark, f"{folder}/raw")
    return listed.select(F.replace("path", F.lit(f"{folder}/")).alias("path"))


@query
def s2_read_ocr_text(spark, sf):
    """The texts of documents and forms are written as bytes, some of them invalid, and decoded after reading."""
    of_forms = forms(spark, sf).select("file_name", F.col("raw_text").cast("binary").alias("content"))
    bad = F.when(F.col("doc_id") % 7 == 3, F.to_binary(F.lit("ff"), F.lit("hex"))).otherwise(F.to_binary(F.lit(""), F.lit("hex")))
    of_documents = table(spark, sf, "documents").select(
        F.format_string("doc_%d.pdf", "doc_id").alias("file_name"), F.concat(F.col("text").cast("binary"), bad).alias("content")
    )
    texts = S.stored(
        of_forms.unionByName(of_documents).select(S.cached_text_name(F.col("file_name")).alias("text_name"), "content"), "texts"
    )
    return texts.select(S.document_name(F.col("text_name")).alias("file_name"), S.decode_text(F.col("content")).alias("raw_text"))


@query
def s2_read_ocr_files(spark, sf):
    """A text file for every form, empty where it has no text, under the name of its document, in the form's own folder."""
    folder = S.scratch_folder(spark, "ocr-files")
    texts = forms(spark, sf).select(
        "k", F.regexp_replace("path", r"[^/]*\z", "").alias("below"), S.cached_text_name(F.col("file_name")).alias("name"), "raw_text"
    )
    S.write_text_files(texts.repartition(4 * spark.sparkContext.defaultParallelism, "k"), folder)
    return S.read_ocr_texts(spark, folder)


@query
def s3_read_results_csv(spark, sf):
    path = S.scratch_folder(spark, "results-csv")
    S.write_csv(prior_results(spark, sf).orderBy("seq").select(K.RESULT_COLUMNS), path)
    return S.read_results_csv(spark, path).drop("processed_at")


@query
def s4_read_truth_csv(spark, sf):
    path = S.scratch_folder(spark, "truth-csv")
    S.write_csv(truth(spark, sf).select(S.TRUTH_COLUMNS), path)
    return S.read_truth_csv(spark, path)


@query
def s5_write_results(spark, sf):
    path = S.scratch_folder(spark, "results")
    S.write_results(results(spark, sf), path)
    return seconds(spark.read.parquet(path))


@query
def s6_write_manual_review(spark, sf):
    path = S.scratch_folder(spark, "review")
    S.write_manual_review(latest_prior(spark, sf), path)
    return seconds(spark.read.parquet(path))


@query
def s7_write_all(spark, sf):
    folder = S.scratch_folder(spark, "outputs")
    S.write_all(latest_prior(spark, sf), listing(spark, sf), folder, batch_seconds=12.5, updated_at="2024-01-01 00:00:00")

    def rows(name: str, key: Column, value: Column) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}").select(
            F.lit(name).alias("output"), key.alias("item"), value.cast("string").alias("value")
        )

    return (
        rows("results", F.col("file_name"), F.col("status"))
        .unionByName(rows("manual_review", F.col("file_name"), F.col("status")))
        .unionByName(rows("summary", F.col("metric"), F.col("value")))
        .unionByName(rows("status_statistics", F.concat_ws("/", "file_type", "status"), F.coalesce(F.col("total"), F.col("ratio"))))
    )


@query
def s8_load_table(spark, sf):
    path = S.scratch_folder(spark, "csv")
    S.write_csv(latest_prior(spark, sf).select(K.RESULT_COLUMNS), path)
    return seconds(S.load_table(S.read_results_csv(spark, path), "formsift_results", S.scratch_folder(spark, "table")))


@query
def s8_load_with_rejects(spark, sf):
    """Some rows have a confidence that is no number or a time that is none; they go aside with the reason."""
    path = S.scratch_folder(spark, "csv")
    key = F.regexp_extract("file_name", "([0-9]{12})", 1).cast("bigint")
    rows = S.as_text(latest_prior(spark, sf).select(K.RESULT_COLUMNS)).withColumns({
        "name_confidence": F.when(key % 11 == 3, "high").otherwise(F.col("name_confidence")),
        "processed_at": F.when(key % 13 == 4, "yesterday").otherwise(F.col("processed_at")),
    })
    S.write_csv(rows, path)
    loaded, rejects, _ = S.load_with_rejects(
        S.read_results_csv(spark, path), "formsift_checked_results", S.scratch_folder(spark, "table")
    )
    kept = loaded.select("file_name", F.lit("").alias("problem"), F.lit("").alias("value"), F.lit("").alias("reason"))
    return kept.unionByName(rejects.select("file_name", F.inline("problems")))


@query
def s9_append_results(spark, sf):
    path = S.scratch_folder(spark, "appended")
    batches = prior_results(spark, sf).withColumnRenamed("path", "gcs_uri").join(
        forms(spark, sf).select("file_name", "raw_text"), "file_name", "left"
    )
    S.append_results(batches.filter("seq < 2000000000000"), path)
    S.append_results(batches.filter("seq >= 2000000000000"), path)
    return seconds(spark.read.parquet(path))


@query
def s10_already_processed(spark, sf):
    batch = forms(spark, sf).select("file_name", "path")
    nowhere = S.scratch_folder(spark, "no-such-table")
    return runs.already_processed(batch, latest_prior(spark, sf)).unionByName(runs.already_processed(batch, nowhere))


@query
def s11_fetch_results(spark, sf):
    stored = latest_prior(spark, sf).withColumnRenamed("path", "gcs_uri")
    nowhere = S.scratch_folder(spark, "no-such-table")
    return seconds(runs.fetch_results(stored, 1000).unionByName(runs.fetch_results(nowhere, spark=spark)))


# --- run control -----------------------------------------------------------------------------------


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return S.select_documents(forms(spark, sf).select("path"), "raw")


def crowded_listing(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The listing and the texts with paths in a third folder that share base names with other paths.

    There every forty-first form has the text of a failed run, and every forty-third has no text at all.
    """
    third = forms(spark, sf).withColumn("path", F.concat(F.lit("raw/c/"), "file_name"))
    again = third.where("k % 41 = 7").withColumns({"raw_text": F.lit(None).cast("string"), "error": F.lit("read twice")})
    listed = forms(spark, sf).unionByName(again).unionByName(third.where("k % 43 = 9")).select("path")
    return S.select_documents(listed, "raw"), forms(spark, sf).where("k % 43 <> 10").unionByName(again)


@query
def c1_done_files(spark, sf):
    return runs.done_files(latest_prior(spark, sf))


@query
def c2_pending(spark, sf):
    return runs.pending(listing(spark, sf), runs.done_files(latest_prior(spark, sf)))


@query
def c3_next_batch(spark, sf):
    return runs.next_batch(c2_pending(spark, sf), 50)


@query
def c4_allow_listed(spark, sf):
    names = truth(spark, sf).filter(F.col("file_type") == "noisy")
    return runs.allow_listed(listing(spark, sf), names)


@query
def c5_upsert(spark, sf):
    """All pending forms at once; two paths with one base name and listed files without a text are among them."""
    listed, texts = crowded_listing(spark, sf)
    return seconds(next_run(texts, listed, latest_prior(spark, sf).select(K.RESULT_COLUMNS), None))


@query
def c6_failure_capture(spark, sf):
    return results(spark, sf, ["file_name", "employee_name", *K.VERDICT])


@query
def c7_basename(spark, sf):
    paths = forms(spark, sf).select("path").unionByName(table(spark, sf, "pages").select(F.col("url").alias("path")))
    return paths.select("path", T.basename(F.col("path")).alias("file_name"))


@query
def c8_document_type(spark, sf):
    return forms(spark, sf).select("file_name", T.document_type(F.col("file_name")).alias("file_type"))


@query
def c9_document_type_cased(spark, sf):
    return forms(spark, sf).select("file_name", T.document_type_cased(F.col("file_name")).alias("file_type"))


@query
def c10_stream_ingest(spark, sf):
    log, checkpoint = S.scratch_folder(spark, "log"), S.scratch_folder(spark, "stream")

    def prepare(batch: DataFrame) -> DataFrame:
        return forms_of(batch, sf, "arriving_customers")

    schema = table(spark, sf, "customer").schema
    # three writes whose files arrive one after the other; every seventh form fails the first time and is handed in again
    arriving = S.scratch_folder(spark, "arriving")
    customers = table(spark, sf, "customer")
    for part in range(3):
        customers.where(F.pmod(F.xxhash64("c_custkey"), F.lit(3)) == part).write.mode("append").parquet(arriving)
    files = len(spark.read.schema(schema).parquet(arriving).inputFiles())
    I.ingest(spark, arriving, schema, log, checkpoint, lambda batch: failing(prepare(batch)), max_files=-(-files // 3))
    again = I.failed_files(spark, log)
    I.retry(spark, prepare(customers).join(again, "file_name", "left_semi"), log)
    I.close_run(spark, log, listing(spark, sf), S.scratch_folder(spark, "outputs"))
    return I.current_results(spark, log).select("file_name", *K.FIELDS, *K.VERDICT)


def failing(documents: DataFrame) -> DataFrame:
    broken = F.when(F.col("k") % 7 == 0, F.lit("service away"))
    return documents.withColumn("error", F.coalesce("error", broken))


@query
def c10_next_run(spark, sf):
    """One batch run: stored results after the next 50 pending forms."""
    listed, texts = crowded_listing(spark, sf)
    return seconds(next_run(texts, listed, latest_prior(spark, sf).select(K.RESULT_COLUMNS), 50))


BUCKETS = 64


def prior_store(spark: SparkSession, sf: str, batches: int = 1) -> ResultStore:
    """The results of earlier runs in a store, taken in batch by batch in the order of storing."""
    store = ResultStore.create(spark, S.scratch_folder(spark, "result-store"), BUCKETS)
    rows = S.stored(prior_results(spark, sf).select(*K.RESULT_COLUMNS, "seq"), "prior")
    # those stored a first time come first, then the others; either kind is dealt by its key
    part = F.pmod(F.xxhash64("file_name"), F.lit(max(1, batches // 2)))
    number = F.when(F.col("seq") >= 2_000_000_000_000, part + batches // 2).otherwise(part)
    for at in range(batches):
        store.upsert(rows.where((number if batches > 1 else F.lit(0)) == at), ["seq"], "prior", at + 1)
    return store


@query
def c5_bucketed_upsert(spark, sf):
    """The next 50 pending forms go into stored results; only their buckets of texts and results are read or written."""
    listed, texts = crowded_listing(spark, sf)
    texts = texts.select("path", "file_name", "raw_text", "error", "processed_at", "processing_time_seconds")
    stored = KeyedTable.create(spark, S.scratch_folder(spark, "text-store"), "path", texts.schema, BUCKETS)
    stored.upsert(texts, ["path"])
    store = prior_store(spark, sf)
    run_batch(stored, listed, store, 50)
    return seconds(store.read())


@query
def c10_stream_state(spark, sf):
    """Every seventh form fails the first time and is handed in again as a new file; the state keeps the last result."""
    arriving, checkpoint = S.scratch_folder(spark, "arriving"), S.scratch_folder(spark, "state")
    store = ResultStore.create(spark, S.scratch_folder(spark, "result-store"), BUCKETS)
    documents = S.stored(
        forms(spark, sf).select("k", "path", "file_name", "raw_text", "error", "processed_at", "processing_time_seconds"), "documents"
    )
    failing(documents).write.parquet(arriving)
    files = len(spark.read.schema(documents.schema).parquet(arriving).inputFiles())
    state.ingest_latest(spark, arriving, documents.schema, store, checkpoint, max_files=-(-files // 2))
    again = store.read().where(F.col("status") == K.FAILED).select("file_name")
    documents.join(again, "file_name", "left_semi").select(documents.columns).write.mode("append").parquet(arriving)
    state.ingest_latest(spark, arriving, documents.schema, store, checkpoint, max_files=files)
    return store.read().select("file_name", *K.FIELDS, *K.VERDICT)


# --- scalar text functions -------------------------------------------------------------------------


def on_text(fn: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        documents = table(spark, sf, "documents")
        texts = documents.select(
            F.lit("document").alias("source"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("part"), "text"
        ).unionByName(
            table(spark, sf, "conversations").select(
                F.lit("conversation").alias("source"), F.col("conv_id").alias("id"), F.col("turn").alias("part"), "text"
            )
        )
        return texts.select("source", "id", "part", fn(F.col("text")).alias("value"))

    return run


def on_truth(fn: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return truth(spark, sf).select(
            "k", "copy_no",
            *[fn(F.col(c)).alias(c) for c in ("employee_name", "employee_address", "employee_ssn")],
        )

    return run


def on_form_lines(fn: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return form_lines(spark, sf).select("k", "line_no", fn(F.col("line")).alias("value"))

    return run


EMAIL = r"[a-z0-9._]+@[a-z0-9]+[.][a-z]+"

QUERIES["t1_squeeze"] = on_text(T.squeeze)
QUERIES["t2_squeeze_or_null_word"] = on_truth(T.squeeze_or_null_word)
QUERIES["t3_alnum"] = on_text(T.alnum)
QUERIES["t4_alnum_for_compare"] = on_truth(T.alnum_for_compare)
QUERIES["t5_split_lines"] = all_lines
QUERIES["t6_first_match"] = on_text(lambda text: T.first_match(EMAIL, text))
QUERIES["t7_drop_initials"] = on_form_lines(T.drop_initials)
QUERIES["t8_swap_two_words"] = on_form_lines(T.swap_two_words)


@query
def t9_order_name(spark, sf):
    found = form_facts(spark, sf).select("k", "low_text", F.posexplode("lines").alias("line_no", "line"))
    return found.select("k", "line_no", T.order_name(F.col("line"), F.col("low_text")).alias("value"))


@query
def t10_personal_id(spark, sf):
    return forms(spark, sf).select("k", T.personal_id(F.col("raw_text")).alias("value"))


@query
def t11_employer_id(spark, sf):
    return forms(spark, sf).select("k", T.employer_id(F.col("raw_text")).alias("value"))


QUERIES["t12_lenient_double"] = on_form_lines(T.lenient_double)
QUERIES["t13_street_key"] = on_form_lines(T.street_key)


@query
def t14_percent_text(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(
        C.share(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("share")
    )
    return orders.select("o_custkey", T.percent_text(F.col("share")).alias("value"))


# --- line predicates -------------------------------------------------------------------------------


def lines_where(predicate: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return all_lines(spark, sf).filter(predicate(F.col("line")))

    return run


QUERIES.update({name: lines_where(predicate) for name, predicate in L.LINE_PREDICATES.items()})


@query
def l12_label_line(spark, sf):
    lowered = computed(all_lines(spark, sf), {"low": F.lower("line")})
    return lowered.filter(L.is_label_in_lower(F.col("low"))).drop("low")


@query
def l1_16_line_flags(spark, sf):
    return with_flags(all_lines(spark, sf)).select("source", "id", "line_no", "flags")


@query
def l1_16_flag_counts(spark, sf):
    return flag_counts(with_flags(all_lines(spark, sf)), ["source"])


# --- address assembly ------------------------------------------------------------------------------


@query
def a1_city_state_zip(spark, sf):
    parsed = form_lines(spark, sf).withColumn("p", A.parse_city_state_zip(T.single_blanks(F.col("line"))))
    return parsed.select("k", "line_no", "p.*").filter("zip IS NOT NULL")


@query
def a2_city_state(spark, sf):
    parsed = form_lines(spark, sf).withColumn("p", A.parse_city_state(T.single_blanks(F.col("line"))))
    return parsed.select("k", "line_no", "p.*").filter("state IS NOT NULL")


def from_place(place: Callable[[Column], Column], look_up: Callable[[Column, Column], Column]) -> Query:
    """A look-up around a place in the look-ahead of every street line."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = street_rows(form_facts(spark, sf)).withColumn("place", place(F.col("ahead")))
        return rows.filter("place > 0").select(
            "k", "street_index", look_up(F.col("ahead"), F.col("place")).alias("value")
        )

    return run


def first_state_place(ahead: Column) -> Column:
    return W.position(ahead, lambda f: f["has_state"])


def first_zip_place(ahead: Column) -> Column:
    return W.position(ahead, lambda f: f["zip"].isNotNull())


QUERIES["a3_previous_city"] = from_place(first_zip_place, A.previous_city)
QUERIES["a4_next_city"] = from_place(first_state_place, A.next_city)
QUERIES["a5_zip_after"] = from_place(first_state_place, A.zip_after)


@query
def a6_previous_state_and_city(spark, sf):
    rows = street_rows(form_facts(spark, sf)).withColumn("place", first_zip_place(F.col("ahead")))
    found = rows.filter("place > 0").withColumn("p", A.previous_state_and_city(F.col("ahead"), F.col("place")))
    return found.select("k", "street_index", "p.*")


@query
def a7_address(spark, sf):
    rows = form_facts(spark, sf).select("k", F.inline(X.streets(F.col("facts"))))
    return rows.select("k", F.col("index").alias("street_index"), "address")


@query
def a8_quality(spark, sf):
    rows = form_facts(spark, sf).select("k", F.inline(X.streets(F.col("facts"))))
    return rows.select("k", F.col("index").alias("street_index"), "quality")


@query
def a9_best_by_street(spark, sf):
    best = A.best_by_street(X.streets(F.col("facts")))
    rows = form_facts(spark, sf).select("k", F.explode(best).alias("street_key", "best"))
    return rows.select("k", "street_key", "best.quality", "best.address")


@query
def a10_upgraded_address(spark, sf):
    rows = form_facts(spark, sf).select("k", F.inline(X.upgraded(X.streets(F.col("facts")))))
    return rows.select("k", F.col("index").alias("street_index"), "address")


# --- blocks and employer fields --------------------------------------------------------------------


@query
def b1_anchors(spark, sf):
    return form_facts(spark, sf).select(
        "k",
        (F.nullif(X.anchor(F.col("facts"), "employer_anchor"), F.lit(0)) - 1).alias("employer_start"),
        (F.nullif(X.anchor(F.col("facts"), "employee_anchor"), F.lit(0)) - 1).alias("employee_start"),
    )


def block_rows(df: DataFrame, employer: Column, employee: Column) -> DataFrame:
    def tagged(mode: str, block: Column) -> Column:
        return F.transform(
            block, lambda f, i: F.struct(F.lit(mode).alias("mode"), i.alias("pos"), f["line"].alias("line"))
        )

    blocks = F.filter(F.array(tagged("employer", employer), tagged("block", employee)), lambda b: b.isNotNull())
    return df.select("k", F.inline(F.flatten(blocks)))


@query
def b2_blocks(spark, sf):
    facts = F.col("facts")
    return block_rows(form_facts(spark, sf), X.employer_block(facts), X.employee_block(facts))


@query
def b3_useful_lines(spark, sf):
    blocks = X.with_blocks(form_facts(spark, sf))
    return block_rows(blocks, F.col("employer_lines"), F.col("employee_lines"))


@query
def b4_employer_name(spark, sf):
    blocks = X.with_blocks(form_facts(spark, sf))
    return blocks.select("k", X.employer_name(F.col("employer_lines")).alias("employer_name"))


@query
def b5_employer_address(spark, sf):
    blocks = X.with_blocks(form_facts(spark, sf))
    return blocks.select("k", X.employer_address(F.col("employer_lines")).alias("employer_address"))


@query
def b6_employer_details(spark, sf):
    return fields(spark, sf).select("k", "employer_name", "employer_address", "employer_ein")


# --- name search, scoring, selection ---------------------------------------------------------------


@query
def n1_name_before_street(spark, sf):
    rows = street_rows(form_facts(spark, sf))
    return rows.select("k", "street_index", N.name_before(F.col("back")).alias("name"))


@query
def n2_employee_context(spark, sf):
    around = W.window(F.col("facts"), F.col("street_index"), *K.EMPLOYEE_CONTEXT)
    rows = street_rows(form_facts(spark, sf)).withColumn("around", around)
    return rows.select("k", "street_index", N.in_employee_context(F.col("around")).alias("has_employee"))


@query
def n3_employer_context(spark, sf):
    around = W.window(F.col("facts"), F.col("street_index"), *K.EMPLOYER_CONTEXT)
    rows = street_rows(form_facts(spark, sf)).withColumn("around", around)
    return rows.select("k", "street_index", N.in_employer_context(F.col("around")).alias("has_employer"))


@query
def n4_name_evidence(spark, sf):
    return candidate_rows(spark, sf).select("k", F.col("index").alias("street_index"), "name", "repeats")


@query
def n5_candidate_score(spark, sf):
    return candidate_rows(spark, sf).select("k", F.col("index").alias("street_index"), "score")


@query
def n6_candidates(spark, sf):
    rows = candidate_rows(spark, sf)
    return rows.select(
        "k", F.col("index").alias("street_index"), "name", "address", "has_employee", "has_employer", "score"
    )


def best_rows(df: DataFrame, facts: Column, low_text: Column) -> DataFrame:
    found = computed(df, {"best": X.best_candidate(X.candidates(facts, low_text))}).filter("best IS NOT NULL")
    return found.select("k", "best.score", "best.name", "best.address")


@query
def n7_best_candidate(spark, sf):
    return best_rows(form_facts(spark, sf), F.col("facts"), F.col("low_text"))


@query
def n8_block_details(spark, sf):
    lines = F.col("employee_lines")
    return best_rows(X.with_blocks(form_facts(spark, sf)), lines, X.joined_low(lines))


@query
def n9_fallback(spark, sf):
    return X.with_candidates(forms(spark, sf).select("k", "raw_text")).select(
        "k", F.col("_full.name").alias("full_name"), F.col("_full.address").alias("full_address")
    )


@query
def n10_merge(spark, sf):
    work = X.with_candidates(forms(spark, sf).select("k", "raw_text"))
    return work.select(
        "k",
        F.coalesce("_block.name", "_full.name").alias("name"),
        F.coalesce("_block.address", "_full.address").alias("address"),
    )


@query
def n11_final_name_order(spark, sf):
    return fields(spark, sf).select("k", "employee_name")


@query
def n12_extract_fields(spark, sf):
    return fields(spark, sf).select("k", *K.FIELDS)


# --- validation ------------------------------------------------------------------------------------


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return VA.with_validity(fields(spark, sf))


@query
def v1_company_term(spark, sf):
    return all_lines(spark, sf).filter(V.has_company_term(F.col("line")))


@query
def v2_valid_name(spark, sf):
    shaped = all_lines(spark, sf).filter(V.has_name_shape(F.col("line")))
    named = computed(shaped, {"name": T.squeeze_or_null_word(F.col("line"))})
    return named.filter(V.is_valid_name(F.col("name")))


@query
def v3_address_word(spark, sf):
    return all_lines(spark, sf).filter(V.has_address_word(F.col("line")))


@query
def v4_street_number(spark, sf):
    return all_lines(spark, sf).filter(V.has_street_number(F.col("line")))


def given_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return truth(spark, sf).select("k", "copy_no", T.squeeze_or_null_word(F.col("employee_address")).alias("address"))


@query
def v5_state_zip(spark, sf):
    return given_addresses(spark, sf).select(
        "k", "copy_no",
        V.state_before_zip(F.col("address")).alias("state"), V.zip_after_state(F.col("address")).alias("zip"),
    )


@query
def v6_valid_address(spark, sf):
    return given_addresses(spark, sf).select("k", "copy_no", V.is_valid_address(F.col("address")).alias("valid"))


@query
def v7_valid_id(spark, sf):
    return form_lines(spark, sf).filter(V.is_valid_id(T.squeeze_or_null_word(F.col("line"))))


@query
def v8_name_evidence(spark, sf):
    seen = checked(spark, sf).withColumn("_normal", T.alnum(F.col("raw_text")))
    return seen.filter("_name IS NOT NULL").select(
        "k", V.name_evidence(F.col("_name"), F.col("_normal")).alias("seen")
    )


@query
def v9_id_evidence(spark, sf):
    seen = VA.with_validity(fields(spark, sf, ["employee_ssn"]))
    return seen.select("k", V.id_evidence(F.col("_id"), F.col("raw_text")).alias("seen"))


@query
def v10_address_evidence(spark, sf):
    valid = checked(spark, sf).filter("_address_ok")
    return valid.select("k", V.address_evidence(F.col("_address"), F.col("raw_text")).alias("seen"))


def verdicts(*columns: str, of: list[str] = K.CHECKED_FIELDS) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return VA.validate_fields(fields(spark, sf, of), columns=list(columns)).select("k", *columns)

    return run


QUERIES["v11_name_confidence"] = verdicts("name_confidence", of=["employee_name"])
QUERIES["v12_address_confidence"] = verdicts("address_confidence", of=["employee_address"])
QUERIES["v13_id_confidence"] = verdicts("id_confidence", of=["employee_ssn"])
QUERIES["v14_overall_confidence"] = verdicts("overall_confidence")


@query
def v15_failing_fields(spark, sf):
    rated = VA.validate_fields(fields(spark, sf, K.CHECKED_FIELDS), columns=K.CONFIDENCES[:3])
    failing = V.failing_fields(*[F.col(c) for c in K.CONFIDENCES[:3]])
    return rated.select("k", failing.alias("failing"))


QUERIES["v16_status"] = verdicts("status")
QUERIES["v17_review_reason"] = verdicts("review_reason")
QUERIES["v18_validate"] = verdicts(*K.VERDICT)


@query
def v19_result_rows(spark, sf):
    return seconds(results(spark, sf))


@query
def v19_test_result_rows(spark, sf):
    return process_documents(forms(spark, sf), K.TEST_RESULT_COLUMNS)


# --- evaluation ------------------------------------------------------------------------------------


COMPARED = ["processed_at", "file_name", *K.CHECKED_FIELDS, "status", "review_reason"]


def checks(spark: SparkSession, sf: str) -> DataFrame:
    return E.field_checks(truth(spark, sf), results(spark, sf, COMPARED))


@query
def e1_truth_with_results(spark, sf):
    return E.join_truth(truth(spark, sf).select(S.TRUTH_COLUMNS), results(spark, sf, COMPARED)).drop("notes")


@query
def e2_field_rows(spark, sf):
    return E.unpivot_fields(E.join_truth(truth(spark, sf), results(spark, sf, COMPARED)))


@query
def e3_state_for_compare(spark, sf):
    return computed(all_lines(spark, sf), {"state": C.state_for_compare(F.col("line"))}).filter("state <> ''")


@query
def e4_zip_for_compare(spark, sf):
    return truth(spark, sf).select("k", "copy_no", C.zip_for_compare(F.col("employee_address")).alias("zip"))


@query
def e5_field_outcome(spark, sf):
    return checks(spark, sf)


@query
def e6_similarity(spark, sf):
    """Ratio of each pair that nothing cheaper decides."""
    rows = E.unpivot_fields(E.join_truth(truth(spark, sf), results(spark, sf, COMPARED)))
    want, have = T.alnum_for_compare(F.col("expected_value")), T.alnum_for_compare(F.col("extracted_value"))
    pairs = E.undecided(rows).select("file_name", "field_name", want.alias("want"), have.alias("have"))
    return pairs.withColumn("ratio", C.similarity(F.col("want"), F.col("have")))


@query
def e7_failed_fields(spark, sf):
    return E.failed_fields(checks(spark, sf))


@query
def e8_accuracy(spark, sf):
    return E.accuracy(checks(spark, sf)).select("accuracy", "clean_accuracy", "noisy_accuracy")


@query
def e9_approval_precision(spark, sf):
    return E.accuracy(checks(spark, sf)).select("approval_precision")


@query
def e10_accuracy_summary(spark, sf):
    return E.accuracy_summary(checks(spark, sf))


# --- reports ---------------------------------------------------------------------------------------


@query
def g1_latest_by_key(spark, sf):
    return latest_prior(spark, sf).select("file_name", "status", "seq")


@query
def g1_latest_turn(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("conv_id", F.col("conv_id").cast("string"))
    return R.latest_by_key(turns, "conv_id", ["turn"])


STATUS = ["file_name", "file_type", "status"]


@query
def g2_status_distribution(spark, sf):
    return R.status_distribution(results(spark, sf, STATUS)).drop("ratio")


@query
def g3_status_ratios(spark, sf):
    return R.status_ratios(results(spark, sf, STATUS)).select("section", "file_type", "status", "ratio")


@query
def g4_status_statistics(spark, sf):
    return R.status_statistics(latest_prior(spark, sf))


@query
def g4_incremental_statistics(spark, sf):
    """The same from running counters after ten batches."""
    return prior_store(spark, sf, 10).statistics()


@query
def g5_incremental_summary(spark, sf):
    return prior_store(spark, sf, 10).summary(listing(spark, sf))


@query
def g5_run_summary(spark, sf):
    return R.run_summary(latest_prior(spark, sf), listing(spark, sf))


@query
def g6_status_summary(spark, sf):
    return R.status_summary(results(spark, sf, STATUS))


@query
def g7_pipeline_summary(spark, sf):
    return R.pipeline_summary(results(spark, sf, STATUS))


@query
def g8_detail_report(spark, sf):
    return seconds(R.detail_report(latest_prior(spark, sf).withColumnRenamed("path", "gcs_uri")))


@query
def g9_share_of_total(spark, sf):
    return R.share_of_total(results(spark, sf, ["file_name", "status"]), "status")


@query
def g9_share_of_order_status(spark, sf):
    return R.share_of_total(table(spark, sf, "orders"), "o_orderstatus")


@query
def g9_share_of_event_type(spark, sf):
    return R.share_of_total(table(spark, sf, "events"), "event_type")


@query
def g10_report_bundle(spark, sf):
    folder = S.scratch_folder(spark, "reports")
    S.write_reports(latest_prior(spark, sf).withColumnRenamed("path", "gcs_uri"), folder)
    detail = spark.read.parquet(f"{folder}/detail").groupBy("file_type", "status").agg(F.count("*").alias("total"))
    status = spark.read.parquet(f"{folder}/status_summary").select(F.lit("").alias("file_type"), "status", "total")
    kinds = spark.read.parquet(f"{folder}/pipeline_summary")
    parts = {"detail": detail, "status": status, "kinds": kinds}
    tagged = [part.select(F.lit(name).alias("report"), "file_type", "status", "total") for name, part in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
