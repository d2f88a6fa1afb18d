"""Scalar text functions (T1-T14): Column in, Column out, no UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from formsift import constants as K

#: White space other than the blank.
ODD_SPACE = K.SPACE_CHARS.replace(" ", "")


def strip(value: Column) -> Column:
    """White space removed from both ends."""
    return F.btrim(value, F.lit(K.SPACE_CHARS))


def single_blanks(value: Column) -> Column:
    """White-space runs become one blank, ends stripped.

    Characters are replaced first, so that the pattern has to find runs of one plain character only.
    """
    return F.btrim(F.regexp_replace(F.translate(value, ODD_SPACE, " " * len(ODD_SPACE)), "  +", " "))


def squeeze(value: Column) -> Column:
    """As single_blanks, and empty becomes NULL."""
    return F.nullif(single_blanks(value), F.lit(""))


def squeeze_or_null_word(value: Column) -> Column:
    """Squeeze, and the words that stand for a missing value become NULL."""
    clean = single_blanks(value)
    return F.when(~F.lower(clean).isin(["", *K.NULL_WORDS]), clean)


def alnum(value: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else one blank; NULL becomes ''."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]+", " "))


def alnum_for_compare(value: Column) -> Column:
    """T4: as T3, with the null words blanked first."""
    bare = F.lower(strip(F.coalesce(value, F.lit(""))))
    return F.when(bare.isin(K.BLANK_WORDS), F.lit("")).otherwise(alnum(value))


def split_lines(raw_text: Column) -> Column:
    """T5: non-blank stripped lines, in order."""
    parts = F.split(F.coalesce(raw_text, F.lit("")), K.LINE_BREAK)
    return F.filter(F.transform(parts, strip), lambda line: line != "")


def first_match(pattern: str, text: Column) -> Column:
    """First match of a pattern, NULL when there is none."""
    return F.regexp_substr(text, F.lit(pattern))


def first_group(pattern: str, line: Column, group: int = 0) -> Column:
    """First match in a short text. regexp_substr runs its pattern twice inside a lambda; this does not."""
    return F.get(F.regexp_extract_all(line, F.lit(pattern), group), F.lit(0))


def drop_initials(name: Column) -> Column:
    """Single-letter tokens (dots ignored) removed, unless nothing would be left."""
    has_initial = name.rlike(rf"(?:^|{K.SPACE})\.*\p{{L}}\.*(?:{K.SPACE}|\z)")
    clean = squeeze(name)
    kept = F.btrim(F.regexp_replace(single_blanks(name), r"(?:^| )\.*\p{L}\.*(?= |\z)", ""))
    return F.when(has_initial, F.coalesce(F.nullif(kept, F.lit("")), clean)).otherwise(clean)


def swap_two_words(name: Column) -> Column:
    """T8: 'a b' becomes 'b a' after T7; any other number of words stays."""
    return F.regexp_replace(drop_initials(name), r"^([^ ]+) ([^ ]+)\z", "$2 $1")


def order_name(name: Column, context: Column) -> Column:
    """Swapped when the lower-cased context names the last name before the first name."""
    last = F.instr(context, K.LAST_NAME_LABEL)
    first = F.instr(context, K.FIRST_NAME_LABEL)
    reversed_labels = (last > 0) & (first > 0) & (last < first)
    return F.when(reversed_labels, swap_two_words(name)).otherwise(drop_initials(name))


def personal_id(raw_text: Column) -> Column:
    """First personal id."""
    return first_match(K.PERSONAL_ID, raw_text)


def employer_id(raw_text: Column) -> Column:
    """First employer id."""
    return first_match(K.EMPLOYER_ID, raw_text)


def lenient_double(value: Column) -> Column:
    """Text to double; blank or unparsable counts as 0."""
    text = strip(value)
    numeric = text.rlike(
        r"^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?\z"
        r"|^[+-]?(?i:inf|infinity|nan)\z"
    )
    unsigned_nan = F.regexp_replace(F.regexp_replace(text, "_", ""), r"(?i)^[+-]nan\z", "nan")
    return F.coalesce(F.when(numeric, unsigned_nan.try_cast("double")), F.lit(0.0))


def street_key(street: Column) -> Column:
    """First two alphanumeric words joined by '_', NULL when there are fewer."""
    low = F.lower(street)
    shape = r"^[^a-z0-9]*([a-z0-9]+)[^a-z0-9]+([a-z0-9]+)"
    return F.when(
        low.rlike(shape),
        F.concat_ws("_", F.regexp_extract(low, shape, 1), F.regexp_extract(low, shape, 2)),
    )


def fixed_point(value: Column, places: int) -> Column:
    """A double as text, rounded on its exact binary value with ties to even."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))


def round_exact(value: Column, places: int) -> Column:
    """A double rounded as `fixed_point` does; F.round would see 1.015 as a tie."""
    return fixed_point(value, places).cast("double")


def percent_text(share: Column) -> Column:
    """A share as percent text with two decimals."""
    return F.concat(fixed_point(share * 100, 2), F.lit("%"))


def basename(path: Column) -> Column:
    """Last path segment."""
    return F.substring_index(path, "/", -1)


def document_type(file_name: Column) -> Column:
    """Clean, noisy or unknown by file name, any case."""
    return _type_of(F.lower(file_name))


def document_type_cased(file_name: Column) -> Column:
    """As C8 but lower-case words only."""
    return _type_of(file_name)


def _type_of(name: Column) -> Column:
    return (
        F.when(name.contains("clean"), "clean").when(name.contains("noisy"), "noisy").otherwise("unknown")
    )


def count_text(haystack: Column, needle: Column) -> Column:
    """Non-overlapping occurrences of a literal; 0 when either is blank."""
    removed = F.char_length(haystack) - F.char_length(F.replace(haystack, needle, F.lit("")))
    return F.coalesce(F.try_divide(removed, F.char_length(needle)).cast("int"), F.lit(0))


def count_word(haystack: Column, literal: Column) -> Column:
    """Occurrences of a literal with a word boundary at both ends."""
    quoted = F.concat(
        F.lit(r"\b\Q"), F.replace(literal, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b")
    )
    return F.coalesce(F.regexp_count(haystack, quoted), F.lit(0))


def one_of(words: list[str]) -> str:
    """Pattern for one of the words, grouped by first letter so that few branches start per character."""
    tails: dict[str, list[str]] = {}
    for word in words:
        tails.setdefault(word[0], []).append(re.escape(word[1:]))
    return "(?:" + "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in tails.items()) + ")"


def phrase_search(phrases: list[str]) -> str:
    """Pattern that finds one of the phrases, also inside a word, as `any_phrase` does.

    A phrase that holds another one is found by that. At most characters a look at two of them ends the search; the
    phrases share their beginnings. Phrases have two characters at least.
    """
    shortest = [p for p in phrases if not any(q in p and q != p for q in phrases)]
    first, second = ("".join(sorted({re.escape(p[i]) for p in shortest})) for i in (0, 1))

    def tails(rest: list[str]) -> str:
        by_letter: dict[str, list[str]] = {}
        for tail in rest:
            by_letter.setdefault(tail[:1], []).append(tail[1:])
        parts = [re.escape(letter) + tails(more) for letter, more in by_letter.items() if letter]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""

    return f"(?=[{first}][{second}]){tails(shortest)}"


def any_word(lowered: Column, words: list[str]) -> Column:
    """True when a run of letters of lower-cased text is one of the words."""
    return lowered.rlike(rf"(?:^|[^a-z]){one_of(words)}(?![a-z])")


def any_phrase(lowered: Column, phrases: list[str]) -> Column:
    """True when lower-cased text holds one of the phrases, also inside a word."""
    return lowered.rlike(one_of(phrases))
