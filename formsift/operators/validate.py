"""Validation of extracted fields and result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formsift import constants as K
from formsift.functions import checks as V, text as T
from formsift.operators.stages import built_once, computed

KINDS = ["name", "address", "id"]


@built_once
def valid_of(kind: str, column: str) -> Column:
    checks = {"name": V.is_valid_name, "address": V.is_valid_address, "id": V.is_valid_id}
    return checks[kind](F.col(column))


@built_once
def outer_words_of(name: str, normal_text: str) -> Column:
    return V.outer_words_count(F.col(name), F.col(normal_text))


@built_once
def address_evidence_of(address: str, text: str) -> Column:
    return V.address_evidence(F.col(address), F.col(text))


def with_validity(df: DataFrame) -> DataFrame:
    """Adds the cleaned fields (T2) and whether each is valid (V2, V6, V7), for the fields that `df` has."""
    there = {kind: field for kind, field in zip(KINDS, K.CHECKED_FIELDS) if field in df.columns}
    df = df.withColumns({f"_{kind}": T.squeeze_or_null_word(F.col(field)) for kind, field in there.items()})
    return df.withColumns({f"_{kind}_ok": valid_of(kind, f"_{kind}") for kind in there})


def with_evidence(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds the evidence counts (V8-V10), worked out for valid fields only."""
    raw = F.col(text)
    if "_name_ok" in df.columns:
        df = df.withColumn("_normal", F.when(F.col("_name_ok"), T.alnum(raw)))
        df = df.withColumn("_whole", F.when(F.col("_name_ok"), V.whole_name_count(F.col("_name"), F.col("_normal"))))
        found = F.when(F.col("_whole") > 0, F.col("_whole"))
        df = df.withColumn("_name_seen", found.when(F.col("_name_ok"), outer_words_of("_name", "_normal")))
    if "_address_ok" in df.columns:
        df = df.withColumn("_address_seen", F.when(F.col("_address_ok"), address_evidence_of("_address", text)))
    if "_id_ok" in df.columns:
        df = df.withColumn("_id_seen", F.when(F.col("_id_ok"), V.id_evidence(F.col("_id"), raw)))
    return df


def validate_fields(df: DataFrame, text: str = "raw_text", columns: list[str] = K.VERDICT) -> DataFrame:
    """`df` with four confidences, status and review reason, or those wanted; no shuffle.

    The confidence of one field needs that field only; the overall one, status and reason need all three.
    """
    seen = with_evidence(with_validity(df), text)
    there = [kind for kind in KINDS if f"_{kind}_ok" in seen.columns]
    rated = seen.withColumns(
        {f"{kind}_confidence": V.confidence(F.col(f"_{kind}_ok"), F.col(f"_{kind}_seen")) for kind in there}
    )
    if len(there) < len(KINDS):
        return computed(
            rated.withColumnsRenamed({f"{kind}_confidence": f"_{kind}_confidence" for kind in there}),
            {c: F.col(f"_{c}") for c in columns},
        ).select(*df.columns, *columns)
    three = [F.col(f"{kind}_confidence") for kind in KINDS]
    rated = rated.withColumns({"_overall": V.overall(*three), "_failing": V.failing_fields(*three)})
    failing, total = F.col("_failing"), F.col("_overall")
    seen_counts = [F.col(c) for c in ("_name_seen", "_address_seen", "_id_seen")]
    verdict = {
        **{c: F.col(f"_{c}") for c in K.CONFIDENCES[:3]},
        "overall_confidence": total,
        "status": V.status(failing, total),
        "review_reason": V.review_reason(failing, total, *seen_counts),
    }
    judged = computed(
        rated.withColumnsRenamed({c: f"_{c}" for c in K.CONFIDENCES[:3]}), {c: verdict[c] for c in columns}
    )
    return judged.select(*df.columns, *columns)


def assemble_results(df: DataFrame, columns: list[str] = K.RESULT_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows from extracted and validated documents.

    Where `error` is set the row is FAILED: fields NULL, confidences 0.0, the error as the reason.
    """
    failed = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    df = df.withColumn("file_type", T.document_type(F.col("file_name")))
    fixed = {field: F.when(~failed, F.col(field)) for field in K.FIELDS if field in columns}
    fixed |= {name: F.when(failed, F.lit(0.0)).otherwise(F.col(name)) for name in K.CONFIDENCES if name in columns}
    if "status" in columns:
        fixed["status"] = F.when(failed, K.FAILED).otherwise(F.col("status"))
    if "error" in df.columns and "review_reason" in columns:
        fixed["review_reason"] = F.when(failed, F.col("error")).otherwise(F.col("review_reason"))
    return df.withColumns(fixed).select(*keep, *columns)
