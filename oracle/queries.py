"""SQL for every query of the catalog that plain SQL can express."""

from __future__ import annotations

from formsift import constants as K
from oracle import ctes as Q

FIELDS = ", ".join(K.FIELDS)
VERDICT = ", ".join(K.VERDICT)
RESULT = ", ".join(c for c in K.RESULT_COLUMNS if c != "processed_at")
RESULT_SECONDS = f"epoch(processed_at)::BIGINT AS processed_at, {RESULT}"

TEXTS = (
    "(SELECT 'document' AS source, doc_id AS id, 0::BIGINT AS part, text FROM documents"
    " UNION ALL SELECT 'conversation', conv_id, turn, text FROM conversations)"
)
EMAIL = r"[a-z0-9._]+@[a-z0-9]+[.][a-z]+"


def on_text(value: str) -> str:
    return f"SELECT source, id, part, {value} AS value FROM {TEXTS}"


def on_truth(fn) -> str:
    return "SELECT k, copy_no, " + ", ".join(f"{fn(c)} AS {c}" for c in K.CHECKED_FIELDS) + " FROM truth"


def on_form_lines(value: str) -> str:
    return f"SELECT id AS k, line_no, {value} AS value FROM form_lines"


def lines_where(condition: str) -> str:
    return f"SELECT source, id, line_no, line FROM all_lines WHERE {condition}"


LINE_CONDITIONS = {
    "l1_number_line": Q.number("line"),
    "l2_code_line": Q.code("line"),
    "l3_state_line": Q.state("line"),
    "l4_contains_state": Q.has_state("line"),
    "l5_zip_line": Q.zip_line("line"),
    "l6_contains_zip": Q.has_zip("line"),
    "l7_has_address_word": Q.address_word("line"),
    "l8_company_like": Q.company("line"),
    "l9_street_line": Q.street("line"),
    "l10_city_state_zip_line": f"{Q.has_state('line')} AND {Q.has_zip('line')}",
    "l11_ignored_word": Q.ignored("line"),
    "l12_label_line": Q.label("line"),
    "l13_title_case_word": Q.title("line"),
    "l14_possible_name_line": Q.possible_name("line"),
    "l15_single_name_part": Q.single_name(Q.single("line")),
    "l16_full_name_line": Q.full_name(Q.single("line")),
}
#: Bit i - 1 for predicate i.
FLAGS = " + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(LINE_CONDITIONS.values()))
FLAG_COUNTS = " UNION ALL ".join(
    f"SELECT source, '{name}' AS predicate, count(*) FILTER (WHERE {c}) AS n_lines FROM all_lines GROUP BY source"
    for name, c in LINE_CONDITIONS.items()
)

LISTED = "(SELECT path FROM forms WHERE starts_with(path, 'raw/') AND lower(path) LIKE '%.pdf')"
DONE = "(SELECT file_name FROM latest_prior WHERE status IS DISTINCT FROM 'FAILED')"
PENDING = (
    f"SELECT string_split(path, '/')[-1] AS file_name, path FROM {LISTED}"
    f" WHERE string_split(path, '/')[-1] NOT IN (SELECT file_name FROM {DONE})"
)


# a third folder: every forty-first form again, failed; every forty-third listed without a text there
CROWDED = (
    f"(SELECT path FROM {LISTED} UNION ALL SELECT 'raw/c/' || file_name FROM forms"
    " WHERE (k % 41 = 7 OR k % 43 = 9) AND lower(file_name) LIKE '%.pdf')"
)


def merged_run(cap: str) -> str:
    """Stored results after the pending paths, or the first of them, are processed; the later path of a name stays."""
    batch = (
        f"(SELECT path, string_split(path, '/')[-1] AS file_name FROM {CROWDED}"
        f" WHERE string_split(path, '/')[-1] NOT IN (SELECT file_name FROM {DONE}) {cap})"
    )
    blank = {**dict.fromkeys(K.FIELDS, "NULL"), **dict.fromkeys(K.CONFIDENCES, "CAST(0 AS DOUBLE)"),
             "status": "'FAILED'", "review_reason": "coalesce(f.error, 'read twice')"}
    failed = ", ".join(f"{blank.get(c, 'r.' + c)} AS {c}" for c in K.RESULT_COLUMNS if c != "processed_at")
    new = (
        f"(SELECT b.path, r.* FROM {batch} b JOIN forms f ON f.path = b.path AND f.k % 43 <> 10"
        " JOIN results r ON r.file_name = f.file_name"
        f" UNION ALL SELECT b.path, r.processed_at, {failed} FROM {batch} b JOIN forms f"
        " ON b.path = 'raw/c/' || f.file_name AND f.k % 41 = 7 JOIN results r ON r.file_name = f.file_name)"
    )
    last = f"(SELECT * FROM {new} QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY path DESC) = 1)"
    return (
        f"SELECT {RESULT_SECONDS} FROM {last} UNION ALL SELECT {RESULT_SECONDS} FROM latest_prior"
        f" WHERE file_name NOT IN (SELECT file_name FROM {new})"
    )


def place_of(condition: str) -> str:
    return (
        "(SELECT a.*, p.place FROM ahead a JOIN (SELECT k, pos, min(off) AS place FROM ahead"
        f" WHERE mode = 'full' AND {condition} GROUP BY k, pos) p ON p.k = a.k AND p.pos = a.pos WHERE a.mode = 'full')"
    )


def around_place(condition: str, value: str) -> str:
    return f"SELECT k, pos AS street_index, {value} AS value FROM {place_of(condition)} GROUP BY k, pos"


def distribution(source: str) -> str:
    return f"""
SELECT 'status_distribution' AS section, g.file_type, s.status, count_if(r.status = s.status) AS total,
  {Q.rounded('CAST(count_if(r.status = s.status) AS DOUBLE) / count(*) * 100', 2)} AS percentage
FROM (SELECT unnest(['all', 'clean', 'noisy', 'unknown']) AS file_type) g
JOIN {source} r ON g.file_type = 'all' OR g.file_type = r.file_type
CROSS JOIN (SELECT unnest(['AUTO_APPROVED', 'NEEDS_REVIEW', 'FAILED']) AS status) s
GROUP BY g.file_type, s.status"""


def ratios(source: str) -> str:
    auto, needs = "count_if(status = 'AUTO_APPROVED')", "count_if(status = 'NEEDS_REVIEW')"
    def one(name, a, b):
        value = f"CASE WHEN {b} > 0 THEN {Q.rounded(f'CAST({a} AS DOUBLE) / {b}', 4)} END"
        return f"SELECT 'ratio' AS section, 'all' AS file_type, '{name}' AS status, {value} AS ratio FROM {source}"
    return (
        one("NEEDS_REVIEW_to_AUTO_APPROVED", needs, auto) + " UNION ALL "
        + one("AUTO_APPROVED_to_NEEDS_REVIEW", auto, needs)
    )


def summary(source: str, listing: str) -> str:
    average = Q.rounded("CAST(sum(CAST(processing_time_seconds AS DECIMAL(30, 6))) AS DOUBLE) / count(*)", 2)
    found = f"(SELECT count(*) FROM {listing})"
    def share(status):
        return Q.number_text(f"CAST(count_if(status = '{status}') AS DOUBLE) / count(*) * 100", 2)
    remaining = f"({found} - count(*))"
    metrics = {
        "total_pdfs_found_in_raw": f"max({found})::VARCHAR",
        "total_pdfs_processed": "count(*)::VARCHAR",
        "remaining_pdfs": f"{remaining}::VARCHAR",
        "auto_approved": "count_if(status = 'AUTO_APPROVED')::VARCHAR",
        "auto_approved_percentage": share("AUTO_APPROVED"),
        "needs_review": "count_if(status = 'NEEDS_REVIEW')::VARCHAR",
        "needs_review_percentage": share("NEEDS_REVIEW"),
        "failed": "count_if(status = 'FAILED')::VARCHAR",
        "failed_percentage": share("FAILED"),
        "needs_review_to_auto_approved_ratio": Q.number_text(
            "CAST(count_if(status = 'NEEDS_REVIEW') AS DOUBLE) / count_if(status = 'AUTO_APPROVED')", 4),
        "clean_processed": "count_if(file_type = 'clean')::VARCHAR",
        "noisy_processed": "count_if(file_type = 'noisy')::VARCHAR",
        "total_processing_time_seconds": Q.number_text("CAST(sum(CAST(processing_time_seconds AS DECIMAL(30, 6))) AS DOUBLE)", 2),
        "average_processing_time_seconds_per_pdf": f"{average}::VARCHAR",
        "estimated_remaining_time_seconds":
            f"CASE WHEN {remaining} > 0 THEN {Q.number_text(f'{remaining} * {average}', 2)} ELSE '0.0' END",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {value} AS value FROM {source}" for name, value in metrics.items()
    )


def share_of_total(source: str, column: str) -> str:
    return (
        f"SELECT {column}, count(*) AS total, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE)"
        f" AS percentage FROM {source} GROUP BY {column}"
    )


NAME2, TEXT2 = "name2", "body"
ACC = {
    "accuracy": Q.share("passed", "passed + failed"), "clean_accuracy": Q.share("clean_passed", "clean"),
    "noisy_accuracy": Q.share("noisy_passed", "noisy"),
    "approval_precision": Q.share("approved_passed", "approved"),
}
SUMMARY_METRICS = {
    "total_files_in_ground_truth": "files::VARCHAR", "total_field_checks": "checks::VARCHAR",
    "pass_fields": "passed::VARCHAR", "fail_fields": "failed::VARCHAR",
    "not_verifiable_fields": "open::VARCHAR", "verifiable_fields": "(passed + failed)::VARCHAR",
    "field_level_accuracy_excluding_not_verifiable": Q.percent_text(ACC["accuracy"]),
    "clean_field_level_accuracy": Q.percent_text(ACC["clean_accuracy"]),
    "noisy_field_level_accuracy": Q.percent_text(ACC["noisy_accuracy"]),
    "auto_approval_precision": Q.percent_text(ACC["approval_precision"]),
    "accuracy_formula": Q.quoted(K.ACCURACY_FORMULA), "precision_formula": Q.quoted(K.PRECISION_FORMULA),
}
PRIOR_TEXT = ", ".join(
    f"coalesce({c}::VARCHAR, '') AS {c}" for c in K.RESULT_COLUMNS if c != "processed_at"
)
NUMBERISH = (
    r"regexp_full_match(line, '[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?')"
)

SELECTS = {
    "s1_list_documents": f"SELECT path FROM {LISTED} ORDER BY path",
    "s2_read_ocr_text": "SELECT file_name, coalesce(raw_text, '') AS raw_text FROM forms"
    " UNION ALL SELECT 'doc_' || doc_id || '.pdf', coalesce(text, '') || CASE WHEN doc_id % 7 = 3 THEN chr(65533) ELSE '' END"
    " FROM documents",
    "s2_read_ocr_files": "SELECT file_name, coalesce(raw_text, '') AS raw_text FROM forms",
    "s3_read_results_csv": f"SELECT {PRIOR_TEXT} FROM latest_prior",
    "s4_read_truth_csv": "SELECT file_name, file_type, employee_name, employee_address, employee_ssn, notes FROM truth",
    "s5_write_results": f"SELECT {RESULT_SECONDS} FROM results",
    "s6_write_manual_review": f"SELECT {RESULT_SECONDS} FROM latest_prior WHERE status IS DISTINCT FROM 'AUTO_APPROVED'",
    "s7_write_all": "SELECT 'results' AS output, file_name AS item, status AS value FROM latest_prior"
    " UNION ALL SELECT 'manual_review', file_name, status FROM latest_prior WHERE status IS DISTINCT FROM 'AUTO_APPROVED'"
    f" UNION ALL SELECT 'summary', metric, value FROM ({summary('latest_prior', LISTED)})"
    " UNION ALL SELECT 'summary', unnest(['current_batch_runtime_seconds', 'last_updated']), unnest(['12.5', '2024-01-01 00:00:00'])"
    f" UNION ALL SELECT 'status_statistics', file_type || '/' || status, total::DOUBLE::VARCHAR FROM ({distribution('latest_prior')})"
    f" UNION ALL SELECT 'status_statistics', file_type || '/' || status, ratio::VARCHAR FROM ({ratios('latest_prior')})",
    "s8_load_table": f"SELECT {RESULT_SECONDS} FROM latest_prior",
    "s8_load_with_rejects": "SELECT * FROM (WITH p AS (SELECT file_name, regexp_extract(file_name, '([0-9]{12})', 1)::BIGINT AS n FROM latest_prior)"
    " SELECT file_name, '' AS problem, '' AS value, '' AS reason FROM p WHERE n % 11 <> 3 AND n % 13 <> 4"
    " UNION ALL SELECT file_name, 'name_confidence', 'high', 'not a double' FROM p WHERE n % 11 = 3"
    " UNION ALL SELECT file_name, 'processed_at', 'yesterday', 'not a timestamp' FROM p WHERE n % 13 = 4)",
    "s9_append_results": f"SELECT file_name, path AS gcs_uri, {FIELDS}, {VERDICT}, epoch(processed_at)::BIGINT AS processed_at, raw_text"
    " FROM prior LEFT JOIN (SELECT file_name, raw_text FROM forms) USING (file_name)",
    "s10_already_processed": "SELECT file_name, path FROM forms f WHERE EXISTS (SELECT 1 FROM latest_prior p WHERE p.file_name = f.file_name)",
    "s11_fetch_results": "SELECT file_name, path AS gcs_uri, " + FIELDS + ", " + VERDICT
    + ", epoch(processed_at)::BIGINT AS processed_at FROM latest_prior ORDER BY file_name LIMIT 1000",
    "c1_done_files": f"SELECT file_name FROM {DONE}",
    "c2_pending": PENDING,
    "c3_next_batch": f"{PENDING} ORDER BY path LIMIT 50",
    "c4_allow_listed": f"SELECT string_split(path, '/')[-1] AS file_name, path FROM {LISTED}"
    " WHERE string_split(path, '/')[-1] IN (SELECT file_name FROM truth WHERE file_type = 'noisy')",
    "c5_upsert": merged_run(""),
    "c6_failure_capture": f"SELECT file_name, employee_name, {VERDICT} FROM results",
    "c7_basename": "SELECT path, string_split(path, '/')[-1] AS file_name FROM (SELECT path FROM forms UNION ALL SELECT url FROM pages)",
    "c8_document_type": f"SELECT file_name, {Q.kind_any_case('file_name')} AS file_type FROM forms",
    "c9_document_type_cased": f"SELECT file_name, {Q.kind_cased('file_name')} AS file_type FROM forms",
    "c10_stream_ingest": f"SELECT file_name, {FIELDS}, {VERDICT} FROM results",
    "c10_next_run": merged_run("ORDER BY path LIMIT 50"),
    "t1_squeeze": on_text(Q.squeeze("text")),
    "t2_squeeze_or_null_word": on_truth(Q.squeeze_or_null_word),
    "t3_alnum": on_text(Q.alnum("text")),
    "t4_alnum_for_compare": on_truth(Q.alnum_for_compare),
    "t5_split_lines": "SELECT source, id, line_no, line FROM all_lines",
    "t6_first_match": on_text(f"nullif(regexp_extract(text, '{EMAIL}'), '')"),
    "t7_drop_initials": on_form_lines(Q.drop_initials("line")),
    "t8_swap_two_words": on_form_lines(Q.swap("line")),
    "t9_order_name": f"SELECT id AS k, line_no, {Q.order_name('line', 'f.text')} AS value"
    " FROM form_lines l JOIN form_text f ON f.k = l.id",
    "t10_personal_id": f"SELECT k, nullif(regexp_extract(raw_text, '{Q.PERSONAL_ID}'), '') AS value FROM forms",
    "t11_employer_id": f"SELECT k, nullif(regexp_extract(raw_text, '{Q.EMPLOYER_ID}'), '') AS value FROM forms",
    "t12_lenient_double": on_form_lines(
        f"coalesce(CASE WHEN {NUMBERISH} THEN try_cast(replace(line, '_', '') AS DOUBLE) END, CAST(0 AS DOUBLE))"),
    "t13_street_key": on_form_lines(Q.street_key("line")),
    "t14_percent_text": f"SELECT o_custkey, {Q.percent_text(Q.share("count_if(o_orderstatus = 'F')", 'count(*)'))} AS value"
    " FROM orders GROUP BY o_custkey",
    **{name: lines_where(condition) for name, condition in LINE_CONDITIONS.items()},
    "l1_16_line_flags": f"SELECT source, id, line_no, CAST({FLAGS} AS INTEGER) AS flags FROM all_lines",
    "l1_16_flag_counts": FLAG_COUNTS,
    "a1_city_state_zip": f"SELECT id AS k, line_no, {Q.A1_CITY} AS city, {Q.A1_STATE} AS state, {Q.zip_in('line')} AS zip"
    f" FROM form_lines WHERE {Q.has_zip('line')}",
    "a2_city_state": f"SELECT id AS k, line_no, {Q.A2_CITY} AS city, {Q.A2_STATE} AS state"
    f" FROM form_lines WHERE {Q.ENDS_IN_STATE}",
    "a3_previous_city": around_place("has_zip", f"{Q.single('arg_max(line, off) FILTER (off < place AND before_ok)')}"),
    "a4_next_city": around_place("has_state", f"{Q.single('arg_min(line, off) FILTER (off > place AND after_ok)')}"),
    "a5_zip_after": around_place("has_state", "arg_min(zip, off) FILTER (off > place AND has_zip)"),
    "a6_previous_state_and_city": f"""
SELECT k, pos AS street_index,
  CASE WHEN any_value(state_line) FILTER (off = hit) THEN {Q.single('arg_max(line, off) FILTER (off < hit AND before_ok)')}
       ELSE any_value(city2) FILTER (off = hit) END AS city,
  CASE WHEN any_value(state_line) FILTER (off = hit) THEN any_value(line) FILTER (off = hit)
       ELSE any_value(state2) FILTER (off = hit) END AS state
FROM (SELECT *, state AS state_line, {Q.A2_CITY} AS city2, {Q.A2_STATE} AS state2,
        max(off) FILTER (off < place AND (state OR ends_in_state)) OVER (PARTITION BY k, pos) AS hit
      FROM {place_of('has_zip')}) GROUP BY k, pos""",
    "a7_address": "SELECT k, pos AS street_index, address FROM assembled WHERE mode = 'full'",
    "a8_quality": "SELECT k, pos AS street_index, quality FROM graded WHERE mode = 'full'",
    "a9_best_by_street": "SELECT k, street_key, quality, address FROM best_address WHERE mode = 'full'",
    "a10_upgraded_address": "SELECT k, pos AS street_index, address FROM upgraded WHERE mode = 'full'",
    "b1_anchors": "SELECT k, employer_start, employee_start FROM anchors",
    "b2_blocks": f"SELECT k, mode, row_number() OVER (PARTITION BY k, mode ORDER BY line_no) - 1 AS pos, {Q.single('line')} AS line FROM block_lines",
    "b3_useful_lines": f"SELECT k, mode, pos, {Q.single('line')} AS line FROM useful_lines",
    "b4_employer_name": "SELECT k, employer_name FROM employer",
    "b5_employer_address": "SELECT k, employer_address FROM employer",
    "b6_employer_details": "SELECT k, employer_name, employer_address, employer_ein FROM extracted",
    "n1_name_before_street": "SELECT k, pos AS street_index, name FROM names WHERE mode = 'full'",
    "n2_employee_context": "SELECT k, pos AS street_index, has_employee FROM contexts WHERE mode = 'full'",
    "n3_employer_context": "SELECT k, pos AS street_index, has_employer FROM contexts WHERE mode = 'full'",
    "n4_name_evidence": "SELECT k, pos AS street_index, name, repeats FROM scored WHERE mode = 'full'",
    "n5_candidate_score": "SELECT k, pos AS street_index, score FROM scored WHERE mode = 'full'",
    "n6_candidates": "SELECT k, pos AS street_index, name, address, has_employee, has_employer, score FROM scored WHERE mode = 'full'",
    "n7_best_candidate": "SELECT k, score, name, address FROM best WHERE mode = 'full'",
    "n8_block_details": "SELECT k, score, name, address FROM best WHERE mode = 'block'",
    "n9_fallback": "SELECT k, full_name, full_address FROM merged",
    "n10_merge": "SELECT k, coalesce(block_name, full_name) AS name, coalesce(block_address, full_address) AS address FROM merged",
    "n11_final_name_order": "SELECT k, employee_name FROM employee",
    "n12_extract_fields": f"SELECT k, {FIELDS} FROM extracted",
    "v1_company_term": lines_where(Q.company("line", K.VALID_COMPANY_WORDS)),
    "v2_valid_name": f"SELECT * FROM (SELECT source, id, line_no, line, {Q.squeeze_or_null_word('line')} AS name FROM all_lines)"
    f" WHERE {Q.valid_name('name')}",
    "v3_address_word": lines_where(Q.address_word("line", K.VALID_ADDRESS_WORDS)),
    "v4_street_number": lines_where(Q.street_number("line")),
    "v5_state_zip": f"SELECT k, copy_no, {Q.state_zip('a', 1)} AS state, {Q.state_zip('a', 2)} AS zip"
    f" FROM (SELECT k, copy_no, {Q.squeeze_or_null_word('employee_address')} AS a FROM truth)",
    "v6_valid_address": f"SELECT k, copy_no, {Q.valid_address('a')} AS valid"
    f" FROM (SELECT k, copy_no, {Q.squeeze_or_null_word('employee_address')} AS a FROM truth)",
    "v7_valid_id": f"SELECT id AS k, line_no, line FROM form_lines WHERE {Q.valid_id(Q.squeeze_or_null_word('line'))}",
    "v8_name_evidence": f"SELECT k, CASE WHEN {Q.name_whole('name2', 'body')} > 0 THEN {Q.name_whole('name2', 'body')}"
    f" ELSE {Q.name_outer('name2', 'body')} END AS seen FROM valid WHERE name2 IS NOT NULL",
    "v9_id_evidence": f"SELECT k, {Q.count_literal('body', 'id2')} AS seen FROM valid",
    "v10_address_evidence": "SELECT k, address_seen AS seen FROM seen WHERE address_ok",
    "v11_name_confidence": "SELECT k, name_confidence FROM validated",
    "v12_address_confidence": "SELECT k, address_confidence FROM validated",
    "v13_id_confidence": "SELECT k, id_confidence FROM validated",
    "v14_overall_confidence": "SELECT k, overall_confidence FROM validated",
    "v15_failing_fields": "SELECT k, failing FROM validated",
    "v16_status": "SELECT k, status FROM validated",
    "v17_review_reason": "SELECT k, review_reason FROM validated",
    "v18_validate": f"SELECT k, {VERDICT} FROM validated",
    "v19_result_rows": f"SELECT {RESULT_SECONDS} FROM results",
    "v19_test_result_rows": f"SELECT {', '.join(K.TEST_RESULT_COLUMNS)} FROM results",
    "e1_truth_with_results": "SELECT * FROM joined",
    "e2_field_rows": "SELECT * FROM unpivoted",
    "e3_state_for_compare": f"SELECT * FROM (SELECT source, id, line_no, line, {Q.state_for_compare('line')} AS state FROM all_lines) WHERE state <> ''",
    "e4_zip_for_compare": f"SELECT k, copy_no, {Q.zip_for_compare('employee_address')} AS zip FROM truth",
    "e5_field_outcome": "SELECT * FROM checks",
    "e6_similarity": "SELECT c.file_name, c.field_name, c.a AS want, c.b AS have, r.ratio"
    " FROM compared c JOIN ratios r ON c.a = r.a AND c.b = r.b WHERE c.known IS NULL",
    "e7_failed_fields": "SELECT * FROM checks WHERE result = 'Fail'",
    "e8_accuracy": f"SELECT {ACC['accuracy']} AS accuracy, {ACC['clean_accuracy']} AS clean_accuracy,"
    f" {ACC['noisy_accuracy']} AS noisy_accuracy FROM accuracy",
    "e9_approval_precision": f"SELECT {ACC['approval_precision']} AS approval_precision FROM accuracy",
    "e10_accuracy_summary": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {v} AS value FROM accuracy" for m, v in SUMMARY_METRICS.items()),
    "g1_latest_by_key": "SELECT file_name, status, seq FROM latest_prior",
    "g1_latest_turn": "SELECT conv_id::VARCHAR AS conv_id, turn, role, text FROM (SELECT *, row_number() OVER"
    " (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn = 1",
    "g2_status_distribution": distribution("results"),
    "g3_status_ratios": ratios("results"),
    "g4_status_statistics": f"SELECT *, NULL::DOUBLE AS ratio FROM ({distribution('latest_prior')}) UNION ALL"
    " SELECT section, file_type, status, NULL::BIGINT AS total, NULL::DOUBLE AS percentage, ratio"
    f" FROM ({ratios('latest_prior')})",
    "g5_run_summary": summary("latest_prior", LISTED),
    "g6_status_summary": "SELECT status, count(*) AS total FROM results GROUP BY status",
    "g7_pipeline_summary": f"SELECT {Q.kind_cased('file_name')} AS file_type, status, count(*) AS total FROM results GROUP BY ALL",
    "g8_detail_report": f"SELECT file_name, path AS gcs_uri, {Q.kind_cased('file_name')} AS file_type, {FIELDS}, {VERDICT},"
    " epoch(processed_at)::BIGINT AS processed_at FROM latest_prior",
    "g9_share_of_total": share_of_total("results", "status"),
    "g9_share_of_order_status": share_of_total("orders", "o_orderstatus"),
    "g9_share_of_event_type": share_of_total("events", "event_type"),
    "g10_report_bundle": f"SELECT 'detail' AS report, {Q.kind_cased('file_name')} AS file_type, status, count(*) AS total FROM latest_prior GROUP BY ALL"
    " UNION ALL SELECT 'status', '', status, count(*) FROM latest_prior GROUP BY status"
    f" UNION ALL SELECT 'kinds', {Q.kind_cased('file_name')} AS file_type, status, count(*) FROM latest_prior GROUP BY ALL",
}
SELECTS |= {
    "s1_list_folder": SELECTS["s1_list_documents"],
    "c5_bucketed_upsert": SELECTS["c10_next_run"],
    "c10_stream_state": SELECTS["c10_stream_ingest"],
    "g4_incremental_statistics": SELECTS["g4_status_statistics"],
    "g5_incremental_summary": SELECTS["g5_run_summary"],
}

ORACLE = {name: Q.with_steps(select) for name, select in SELECTS.items()}
