"""Line predicates (L1-L16) over a stripped, non-blank line."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from formsift import constants as K
from formsift.functions import text as T, windows as W

STATE_TOKEN = rf"(?:^|{K.SPACE})(?:{K.STATE_CODES})(?:{K.SPACE}|\z)"
IGNORED = T.one_of(K.IGNORED_WORDS)
LABEL = rf"^{IGNORED}\z|" + T.one_of(K.LABEL_KEYWORDS)
LABEL_SEARCH = T.phrase_search(K.LABEL_KEYWORDS)
#: STATE_TOKEN for a line whose only white space is the blank: two capitals by themselves come first, the codes after.
STATE_WORD = rf"(?=[A-Z][A-Z](?: |\z))(?<![^ ])(?:{K.STATE_CODES})"
NAME_SHAPE = r"^[A-Za-z][A-Za-z .'-]*\z"
SINGLE_NAME = rf"^\.*{K.TITLE_WORD}\z"
IGNORED_TOKEN = rf"(?:^|{K.SPACE})\.*{IGNORED}\.*(?:{K.SPACE}|\z)"


def is_number(line: Column) -> Column:
    """L1: digits with an optional fraction."""
    return line.rlike(rf"^{K.DIGIT}+(?:\.{K.DIGIT}+)?\z")


def is_code(line: Column) -> Column:
    """L2: a checkbox mark, or digits with at most one letter."""
    return line.isin(K.CHECKBOX_MARKS) | line.rlike(rf"^{K.DIGIT}+[a-zA-Z]?\z")


def is_state(line: Column) -> Column:
    """L3: the whole line is a state code."""
    return line.isin(K.STATES)


def contains_state(line: Column) -> Column:
    """L4: a blank-separated token is exactly a state code."""
    return line.rlike(STATE_TOKEN)


def is_zip(line: Column) -> Column:
    """The whole line is a ZIP."""
    return line.rlike(rf"^{K.DIGIT}{{5}}(?:-{K.DIGIT}{{4}})?\z")


def contains_zip(line: Column) -> Column:
    """A ZIP occurs in the line."""
    return line.rlike(K.ZIP)


def has_address_word(line: Column, words: list[str] = K.ADDRESS_WORDS) -> Column:
    """A word of the line is an address word."""
    return T.any_word(F.lower(line), words)


def is_company_like(name: Column, words: list[str] = K.COMPANY_WORDS) -> Column:
    """A company word, or the phrase ' and sons'."""
    return F.lower(name).contains(K.COMPANY_PHRASE) | T.any_word(F.lower(name), words)


def is_street(line: Column) -> Column:
    """Starts with a number and a letter, and has an address word."""
    return line.rlike(K.STREET_NUMBER) & has_address_word(line)


def is_city_state_zip(line: Column) -> Column:
    """A state token and a ZIP."""
    return contains_state(line) & contains_zip(line)


def is_ignored_word(line: Column) -> Column:
    """The whole line is a word to ignore."""
    return F.lower(line).isin(K.IGNORED_WORDS)


def is_label(line: Column) -> Column:
    """An ignored word, or a label keyword anywhere."""
    return F.lower(line).rlike(LABEL)


def is_label_in_lower(low: Column) -> Column:
    """L12 for a line in lower case that is worked out already, as a column: plain searches need no pattern.

    A keyword that holds another one is found by that.
    """
    shortest = [w for w in K.LABEL_KEYWORDS if not any(v in w and v != w for v in K.LABEL_KEYWORDS)]
    found = low.isin(K.IGNORED_WORDS)
    for word in shortest:
        found = found | low.contains(word)
    return found


def is_title_word(word: Column) -> Column:
    """Letters with . ' -, first one upper, not all upper; outer dots and blanks are ignored."""
    return word.rlike(rf"^[. ]*{K.TITLE_WORD}[. ]*\z")


def has_letter(line: Column) -> Column:
    return line.rlike("[A-Za-z]")


def is_possible_name(line: Column) -> Column:
    """Letters, blanks and . ' - only, and no label, number, code, state, ZIP or street.

    A line of that shape holds no digit, so number, ZIP and street are ruled out already.
    """
    return line.rlike(NAME_SHAPE) & ~is_label(line) & ~is_code(line) & ~is_state(line)


def is_single_name(line: Column) -> Column:
    """One title-case word that is no label.

    A title-case word starts with a letter and has a lower-case one, so it is no number, code, state,
    ZIP or street, has two letters, and is not all upper.
    """
    return line.rlike(SINGLE_NAME) & ~is_label(line)


def is_full_name(line: Column) -> Column:
    """Two title-case words, none ignored, and no label.

    Title-case words hold no digit and are no state code, so state, ZIP and street are ruled out.
    """
    return (
        line.rlike(rf"^\.*{K.TITLE_WORD}{K.SPACE}+\.*{K.TITLE_WORD}\z")
        & ~F.lower(line).rlike(IGNORED_TOKEN)
        & ~is_label(T.single_blanks(line))
    )


def ends_in_state(line: Column) -> Column:
    """A squeezed line of two or more tokens, the last one a state code."""
    return F.substring(line, -3, 3).isin([" " + code for code in K.STATES])


LINE_PREDICATES = {
    "l1_number_line": is_number,
    "l2_code_line": is_code,
    "l3_state_line": is_state,
    "l4_contains_state": contains_state,
    "l5_zip_line": is_zip,
    "l6_contains_zip": contains_zip,
    "l7_has_address_word": has_address_word,
    "l8_company_like": is_company_like,
    "l9_street_line": is_street,
    "l10_city_state_zip_line": is_city_state_zip,
    "l11_ignored_word": is_ignored_word,
    "l12_label_line": is_label,
    "l13_title_case_word": is_title_word,
    "l14_possible_name_line": is_possible_name,
    "l15_single_name_part": is_single_name,
    "l16_full_name_line": is_full_name,
}


def line_facts(line: Column) -> Column:
    """Everything the window searches need to know about a line, worked out once per line.

    `line` is squeezed, as every use of it is squeezed in the end; `low` and the phrase searches keep
    the spacing of the text. Most lines are plain ASCII with single blanks and need no squeezing. One
    look for a digit spares a line either the number patterns or the name patterns, and phrases are plain searches
    or patterns that give up at the first character where they can: this is half the work on a document.
    """
    odd = line.rlike("[^ -~]") | line.contains("  ")
    squeezed = F.when(odd, T.single_blanks(line)).otherwise(line)
    return W.let(
        F.struct(
            line.alias("raw"),
            F.lower(line).alias("low"),
            squeezed.alias("line"),
            line.rlike(K.DIGIT).alias("digit"),
        ),
        lambda c: F.struct(
            c["line"].alias("line"),
            c["low"].alias("low"),
            F.when(c["digit"] & c["line"].rlike(rf"{K.DIGIT}{{5}}"), T.first_group(K.ZIP, c["line"])).alias("zip"),
            has_letter(c["line"]).alias("letter"),
            is_state(c["line"]).alias("state"),
            c["line"].rlike(STATE_WORD).alias("has_state"),
            ends_in_state(c["line"]).alias("ends_in_state"),
            (c["digit"] & is_street(c["line"])).alias("street"),
            (c["low"].isin(K.IGNORED_WORDS) | c["low"].rlike(LABEL_SEARCH)).alias("label"),
            (c["digit"] & is_number(c["line"])).alias("number"),
            (c["line"].isin(K.CHECKBOX_MARKS) | (c["digit"] & is_code(c["line"]))).alias("code"),
            (~c["digit"] & is_full_name(c["line"])).alias("full_name"),
            (~c["digit"] & is_single_name(c["line"])).alias("single_name"),
            (c["low"].contains("employee") | c["low"].contains(K.LAST_NAME_LABEL)).alias("employee"),
            c["low"].contains("employer").alias("employer"),
            c["raw"].contains(K.EMPLOYER_ANCHOR).alias("employer_anchor"),
            reduce(or_, [c["raw"].contains(stop) for stop in K.EMPLOYER_STOPS]).alias("employer_stop"),
            c["raw"].contains(K.EMPLOYEE_ANCHOR).alias("employee_anchor"),
            c["raw"].contains(K.EMPLOYEE_END).alias("employee_end"),
        ),
    )
