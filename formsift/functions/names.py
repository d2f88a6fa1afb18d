"""Name search and candidate scoring."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from formsift import constants as K
from formsift.functions import lines as L, text as T, windows as W


def name_before(back: Column) -> Column:
    """The name in the look-back (line facts, oldest first) of a street line, or NULL.

    The nearest full-name line wins. Failing that, the nearest two single names are joined top to
    bottom, provided at most five other lines lie between them.
    """
    context = F.array_join(F.transform(back, lambda f: f["low"]), " ")
    full = W.last_of(back, lambda f: f["full_name"])["line"]
    singles = F.filter(
        F.transform(
            back, lambda f, i: F.struct(i.alias("at"), f["line"].alias("line"), f["single_name"].alias("hit"))
        ),
        lambda s: s["hit"],
    )
    lower = F.try_element_at(singles, F.lit(-1))
    upper = F.try_element_at(singles, F.lit(-2))
    near = (lower["at"] - upper["at"] - 1) <= K.NAME_GAP
    joined = F.when(near, F.concat_ws(" ", upper["line"], lower["line"]))
    return W.let(
        F.struct(F.coalesce(full, joined).alias("name"), context.alias("context")),
        lambda c: T.order_name(c["name"], c["context"]),
    )


def in_employee_context(around: Column) -> Column:
    """The lines around a street, joined, speak of the employee.

    The joined text is only built when no single line does; 'last name' may span two lines.
    """
    joined = F.array_join(F.transform(around, lambda f: f["low"]), " ")
    return F.exists(around, lambda f: f["employee"]) | joined.contains(K.LAST_NAME_LABEL)


def in_employer_context(around: Column) -> Column:
    """The lines around a street speak of the employer."""
    return F.exists(around, lambda f: f["employer"])


def evidence(name: Column, low_text: Column) -> Column:
    """Whole-word count of the name in lower-cased text, else the rarer of its outer words."""
    low = F.lower(name)
    whole = T.count_word(low_text, low)
    outer = F.least(
        T.count_word(low_text, F.substring_index(low, " ", 1)),
        T.count_word(low_text, F.substring_index(low, " ", -1)),
    )
    counted = W.let(whole, lambda count: F.when(count > 0, count).otherwise(outer))
    return F.when(low.contains(" "), counted).otherwise(0)


#: Names up to which each is searched for by itself; an index of the text pays from then on. The counts are the same.
FEW_NAMES = 8
PLAIN_WORD = "[a-z0-9_]+"
#: Letters, digits and marks beyond ASCII: where words end beside them is left to the search.
ODD_LETTER = r"[\p{L}\p{Nd}\p{Mn}&&[^\x00-\x7f]]"


def word_index(low_text: Column, wanted: Column) -> Column:
    """Map from each wanted key that occurs to its count: words, and pairs of neighbours with one blank between.

    Words and pairs of the text are sorted once. Runs of equal ones are counted by where they begin, and are met with
    the wanted keys by sorting both together, so that the cost does not multiply text and keys.
    """
    # a piece keeps the blank where exactly one stands before the next word
    pieces = F.regexp_extract_all(low_text, F.lit(f"{PLAIN_WORD}(?: (?={PLAIN_WORD}))?"), 0)

    def keys(pieces: Column) -> Column:
        pairs = F.transform(
            pieces, lambda p, i: F.when(p.endswith(" "), F.concat(p, F.rtrim(F.get(pieces, i + 1))))
        )
        return F.concat(F.transform(pieces, lambda p: F.rtrim(p)), F.filter(pairs, lambda p: p.isNotNull()))

    def counted(ordered: Column) -> Column:
        begins = F.filter(
            F.transform(ordered, lambda k, i: F.when((i == 0) | (k != F.get(ordered, i - 1)), i)), lambda i: i.isNotNull()
        )
        return W.let(begins, lambda b: F.transform(
            b,
            lambda at, j: F.struct(
                F.get(ordered, at).alias("key"),
                F.lit(False).alias("asked"),
                (F.coalesce(F.get(b, j + 1), F.size(ordered)) - at).alias("n"),
            ),
        ))

    def met(both: Column) -> Column:
        def answer(k: Column, i: Column) -> Column:
            before = F.get(both, i - 1)
            return F.when(
                k["asked"] & (i > 0) & ~before["asked"] & (before["key"] == k["key"]),
                F.struct(k["key"].alias("key"), before["n"].alias("n")),
            )

        return F.map_from_entries(F.filter(F.transform(both, answer), lambda e: e.isNotNull()))

    asked = F.transform(
        F.array_distinct(wanted), lambda k: F.struct(k.alias("key"), F.lit(True).alias("asked"), F.lit(0).alias("n"))
    )
    all_keys = W.let(pieces, lambda p: F.sort_array(keys(p)))
    return W.let(F.sort_array(F.concat(W.let(all_keys, counted), asked)), met)


def evidence_of_all(names: Column, low_text: Column, few: int = FEW_NAMES) -> Column:
    """N4 for an array of different names: map from name to evidence.

    More than `few` names share an index of the text; names that are not two plain words, and texts with letters beyond
    ASCII, are searched name by name.
    """

    def by(one: Column) -> Column:
        return F.map_from_entries(F.transform(names, lambda name: F.struct(name.alias("name"), one(name).alias("n"))))

    def outer(low: Column) -> tuple[Column, Column]:
        return F.substring_index(low, " ", 1), F.substring_index(low, " ", -1)

    def looked_up(counts: Column, name: Column) -> Column:
        low = F.lower(name)
        first, last = outer(low)
        found, left, right = (F.coalesce(F.try_element_at(counts, key), F.lit(0)) for key in (low, first, last))
        # matches of one word twice may overlap
        plain = low.rlike(rf"^{PLAIN_WORD} {PLAIN_WORD}\z") & (first != last)
        shared = W.let(found, lambda n: F.when(n > 0, n).otherwise(F.least(left, right)))
        return F.when(plain, shared).otherwise(evidence(name, low_text))

    wanted = F.flatten(F.transform(names, lambda name: F.array(F.lower(name), *outer(F.lower(name)))))
    indexed = W.let(word_index(low_text, wanted), lambda counts: by(lambda name: looked_up(counts, name)))
    alone = (F.size(names) <= few) | low_text.rlike(ODD_LETTER)
    return F.when(alone, by(lambda name: evidence(name, low_text))).otherwise(indexed)


def score(
    name: Column, address: Column, employee: Column, employer: Column, repeats: Column, person: Column
) -> Column:
    """Score of a (name, address) pair.

    `person` is a bonus from an outside person detector, 0 without one.
    """
    points = K.SCORE

    def term(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    letters = F.regexp_replace(name, "[^A-Za-z]", "")
    return (
        term(F.coalesce(name, F.lit("")) != "", points["name"])
        + term(F.coalesce(address, F.lit("")) != "", points["address"])
        + term(L.contains_state(address), points["state"])
        + term(L.contains_zip(address), points["zip"])
        + term(employee, points["employee"])
        + term(employer, points["employer"])
        + term(L.is_full_name(name), points["full_name"])
        + person
        + F.when(repeats >= 2, points["evidence_many"])
        .when(repeats == 1, points["evidence_one"])
        .otherwise(0)
        + term(T.any_phrase(F.lower(name), K.BAD_NAME_TERMS), points["bad_term"])
        + term(letters.rlike(r"^[A-Z]+\z"), points["all_caps"])
        + term(name.rlike(rf"^{K.NON_SPACE}{{1,2}}{K.SPACE}"), points["short_first"])
        + term(L.is_company_like(name), points["company"])
    )
