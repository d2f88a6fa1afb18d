"""All line predicates (L1-L16) of a line as bits of one number, worked out in one scan and read as often as needed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from formsift import constants as K
from formsift.functions import lines as L, text as T
from formsift.operators.stages import computed

#: What every state code, and every word of the two lists, has; spares most lines the longer patterns.
CODE_SHAPE = "[A-Z][A-Z]"
LISTED_WORDS = sorted({*K.ADDRESS_WORDS, *K.COMPANY_WORDS})
#: Bit of each predicate, from the lowest, in the order of L1 to L16.
BITS = {name: 1 << i for i, name in enumerate(L.LINE_PREDICATES)}


def with_flags(lines: DataFrame, line: str = "line", name: str = "flags") -> DataFrame:
    """Adds an int with the bits of all predicates that hold for a stripped line; 0 for a NULL line.

    What several predicates ask is asked once: lower case, a digit, a label, a state, a ZIP, an address word. A line with
    a digit is no name, one without is no number, ZIP or street. The steps' columns are dropped again.
    """
    own = set(lines.columns)

    def free(wanted: str) -> str:
        while wanted in own:
            wanted += "_"
        return wanted

    low, digit, listed = free("low"), free("digit"), free("listed")
    asked = {part: free(f"is_{part}") for part in ("state", "has_state", "has_zip", "label", "code", "name")}
    x, d = F.col(line), F.col(digit)
    first = computed(lines, {low: F.lower(x), digit: x.rlike(K.DIGIT)})
    second = computed(first, {
        listed: T.any_word(F.col(low), LISTED_WORDS),
        asked["state"]: L.is_state(x),
        asked["has_state"]: x.rlike(CODE_SHAPE) & L.contains_state(x),
        asked["has_zip"]: d & L.contains_zip(x),
        asked["label"]: L.is_label_in_lower(F.col(low)),
        asked["code"]: x.isin(K.CHECKBOX_MARKS) | (d & L.is_code(x)),
        asked["name"]: ~d & x.rlike(r"^[A-Za-z.]"),
    })
    part = {key: F.col(column) for key, column in asked.items()}
    word = F.col(listed) & T.any_word(F.col(low), K.ADDRESS_WORDS)
    company = F.col(listed) & T.any_word(F.col(low), K.COMPANY_WORDS)
    holds = {
        "l1_number_line": d & L.is_number(x),
        "l2_code_line": part["code"],
        "l3_state_line": part["state"],
        "l4_contains_state": part["has_state"],
        "l5_zip_line": part["has_zip"] & L.is_zip(x),
        "l6_contains_zip": part["has_zip"],
        "l7_has_address_word": word,
        "l8_company_like": F.col(low).contains(K.COMPANY_PHRASE) | company,
        "l9_street_line": d & x.rlike(K.STREET_NUMBER) & word,
        "l10_city_state_zip_line": part["has_state"] & part["has_zip"],
        "l11_ignored_word": F.col(low).isin(K.IGNORED_WORDS),
        "l12_label_line": part["label"],
        "l13_title_case_word": ~d & L.is_title_word(x),
        "l14_possible_name_line": part["name"] & ~part["label"] & ~part["code"] & ~part["state"] & x.rlike(L.NAME_SHAPE),
        "l15_single_name_part": part["name"] & ~part["label"] & x.rlike(L.SINGLE_NAME),
        "l16_full_name_line": part["name"] & L.is_full_name(x),
    }
    bits = reduce(lambda a, b: a + b, (F.when(holds[key], F.lit(bit)).otherwise(F.lit(0)) for key, bit in BITS.items()))
    return computed(second, {name: bits}).drop(low, digit, listed, *asked.values())


def has_flag(flags: Column, predicate: str) -> Column:
    """Whether the bit of a predicate, by its name in LINE_PREDICATES, is set."""
    return flags.bitwiseAND(F.lit(BITS[predicate])) != 0


def flag_counts(flagged: DataFrame, by: list[str], flags: str = "flags") -> DataFrame:
    """by, predicate, n_lines: lines of each group for which each predicate holds, 0 included; one aggregate of bits."""
    counts = flagged.groupBy(*by).agg(*(F.count_if(has_flag(F.col(flags), name)).alias(name) for name in BITS))
    return counts.unpivot(by, list(BITS), "predicate", "n_lines")
