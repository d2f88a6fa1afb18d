"""Field checks, evidence counts, confidences and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from formsift import constants as K
from formsift.functions import lines as L, text as T

#: Two to four words, judged from the left without going back.
NAME_SHAPE = rf"^{K.SPACE}*+{K.NON_SPACE}++(?:{K.SPACE}++{K.NON_SPACE}++){{1,3}}+{K.SPACE}*+\z"
VALID_WORD = r"^(?=.*[a-z])[A-Za-z][A-Za-z.'-]*\z"
STATE_ZIP = rf"{K.WORD_BEGIN}({K.STATE_CODES}){K.WORD_END}{K.SPACE}+({K.ZIP_PLAIN})"


def has_company_term(name: Column) -> Column:
    """V1: a company word of the validator's list, or the phrase ' and sons'."""
    return L.is_company_like(name, K.VALID_COMPANY_WORDS)


def has_name_shape(value: Column) -> Column:
    """What every valid name (V2) has, on a value as it is: two to four words. Spares the others the cleaning by T2."""
    return F.coalesce(value.rlike(NAME_SHAPE), F.lit(False))


def is_valid_name(name: Column) -> Column:
    """V2, for a name cleaned by T2.

    Two to four words; words of one letter do not count, every other one is letters with . ' - and not
    all upper case, and at least two are left. No company word and no known OCR noise.
    """
    words = F.transform(F.split(name, " "), lambda word: F.btrim(word, F.lit(".'- ")))
    long_words = F.filter(words, lambda word: F.char_length(word) > 1)
    valid = (
        name.rlike(r"^[^ ]+(?: [^ ]+){1,3}\z")
        & ~T.any_phrase(F.lower(name), K.BAD_NAME_TERMS)
        & ~has_company_term(name)
        & (F.size(long_words) >= 2)
        & F.forall(long_words, lambda word: word.rlike(VALID_WORD))
    )
    return F.coalesce(valid, F.lit(False))


def has_address_word(address: Column) -> Column:
    """V3: an address word of the validator's list."""
    return L.has_address_word(address, K.VALID_ADDRESS_WORDS)


def has_street_number(address: Column) -> Column:
    """V4: starts with a street number and a letter."""
    return T.strip(address).rlike(K.STREET_NUMBER)


def state_before_zip(address: Column) -> Column:
    """V5: state of the first state code that a ZIP follows, NULL without one."""
    return F.nullif(F.regexp_extract(address, STATE_ZIP, 1), F.lit(""))


def zip_after_state(address: Column) -> Column:
    """V5: the ZIP of that pair."""
    return F.nullif(F.regexp_extract(address, STATE_ZIP, 2), F.lit(""))


def is_valid_address(address: Column) -> Column:
    """V6, for an address cleaned by T2."""
    valid = (
        has_street_number(address)
        & has_address_word(address)
        & address.rlike(STATE_ZIP)
        & (F.regexp_count(address, F.lit("[A-Za-z0-9-]+")) >= 6)
    )
    return F.coalesce(valid, F.lit(False))


def is_valid_id(person_id: Column) -> Column:
    """V7, for an id cleaned by T2."""
    return F.coalesce(person_id.rlike(rf"^{K.DIGIT}{{3}}-{K.DIGIT}{{2}}-{K.DIGIT}{{4}}\z"), F.lit(False))


def whole_name_count(name: Column, normal_text: Column) -> Column:
    """V8, first part: occurrences of the name in text normalised by T3, also inside words."""
    return T.count_text(normal_text, T.alnum(name))


def outer_words_count(name: Column, normal_text: Column) -> Column:
    """V8, second part: the rarer of the first and last word as whole words; 0 for a single word."""
    normal = T.alnum(name)
    counted = F.least(
        T.count_word(normal_text, F.substring_index(normal, " ", 1)),
        T.count_word(normal_text, F.substring_index(normal, " ", -1)),
    )
    return F.when(normal.contains(" "), counted).otherwise(0)


def name_evidence(name: Column, normal_text: Column) -> Column:
    """V8."""
    whole = whole_name_count(name, normal_text)
    return F.when(whole > 0, whole).otherwise(outer_words_count(name, normal_text))


def id_evidence(person_id: Column, raw_text: Column) -> Column:
    """V9: literal occurrences of the id."""
    return T.count_text(raw_text, person_id)


def address_evidence(address: Column, raw_text: Column) -> Column:
    """V10, for a valid address: the rarer of street number and ZIP."""
    return F.least(
        T.count_word(raw_text, T.first_match(rf"^{K.DIGIT}{{1,6}}", address)),
        T.count_text(raw_text, zip_after_state(address)),
    )


def confidence(valid: Column, evidence: Column) -> Column:
    """0.0 when invalid, 0.95 with repeated evidence, else 0.90."""
    return (
        F.when(~valid, F.lit(0.0))
        .when(evidence >= 2, F.lit(K.CONFIDENCE_REPEATED))
        .otherwise(F.lit(K.CONFIDENCE_VALID))
    )


def overall(name: Column, address: Column, person_id: Column) -> Column:
    """Mean of the three, added in this order."""
    return (name + address + person_id) / F.lit(3.0)


def failing_fields(name: Column, address: Column, person_id: Column) -> Column:
    """Names of the fields below the threshold, '' when there is none."""
    return F.concat_ws(
        ", ",
        *[
            F.when(value < K.THRESHOLD, field)
            for value, field in zip((name, address, person_id), K.CHECKED_FIELDS)
        ],
    )


def status(failing: Column, total: Column) -> Column:
    """V16."""
    return F.when((failing == "") & (total >= K.THRESHOLD), K.AUTO_APPROVED).otherwise(K.NEEDS_REVIEW)


def review_reason(failing: Column, total: Column, name: Column, address: Column, person_id: Column) -> Column:
    """V17; the last three are evidence counts."""
    return (
        F.when(failing != "", F.concat(F.lit(K.REASON_MISSING), failing))
        .when(total < K.THRESHOLD, F.lit(K.REASON_OVERALL))
        .otherwise(
            F.concat(F.lit(K.REASON_COMPLETE), F.format_string(K.REASON_EVIDENCE, name, address, person_id))
        )
    )
