"""Field extraction from OCR text.

A document is one row and stays one row: lines, windows, candidates and ranking are array expressions
on it. Nothing is exploded or shuffled, so the job is a map over the input files, a repeated or missing
key cannot mix two documents, and a hot key costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formsift import constants as K
from formsift.functions import address as A, lines as L, names as N, text as T, windows as W
from formsift.operators.stages import built_once, computed


def with_facts(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds `lines`, `facts` (line facts) and `low_text` (all lines, lower case)."""
    df = df.withColumn("lines", T.split_lines(F.col(text)))
    return df.withColumns({"facts": facts_of("lines"), "low_text": F.lower(F.array_join("lines", " "))})


@built_once
def facts_of(lines: str) -> Column:
    return F.transform(lines, L.line_facts)


def anchor(facts: Column, mark: str) -> Column:
    """B1: 1-based position of the first line with the mark, 0 for none.

    Marks: employer_anchor, employer_stop, employee_anchor, employee_end.
    """
    return W.position(facts, lambda f: f[mark])


def useful(block: Column) -> Column:
    """Block lines that are no number, code or label; their order is their new numbering."""
    return F.filter(block, lambda f: ~f["number"] & ~f["code"] & ~f["label"])


def employer_block(facts: Column) -> Column:
    """B2 for the employer: after its anchor, up to a stop line or the end; NULL without an anchor."""
    return W.let(
        F.struct(facts.alias("facts"), anchor(facts, "employer_anchor").alias("start")),
        lambda c: W.let(
            W.after(c["facts"], c["start"]),
            lambda rest: W.let(
                anchor(rest, "employer_stop"),
                lambda stop: F.when(
                    c["start"] > 0, F.when(stop > 0, W.before(rest, stop)).otherwise(rest)
                ),
            ),
        ),
    )


def employee_block(facts: Column) -> Column:
    """B2 for the employee: up to the address anchor, else the next 44 lines; NULL without an anchor."""
    return W.let(
        F.struct(facts.alias("facts"), anchor(facts, "employee_anchor").alias("start")),
        lambda c: W.let(
            W.after(c["facts"], c["start"]),
            lambda rest: W.let(
                anchor(rest, "employee_end"),
                lambda stop: F.when(
                    c["start"] > 0,
                    F.when(stop > 0, W.before(rest, stop)).otherwise(
                        F.slice(rest, F.lit(1), F.lit(K.BLOCK_LINES))
                    ),
                ),
            ),
        ),
    )


def with_blocks(df: DataFrame) -> DataFrame:
    """Adds the useful lines of both blocks: `employer_lines`, `employee_lines`."""
    return df.withColumns(
        {
            "employer_lines": useful_of("employer", "facts"),
            "employee_lines": useful_of("employee", "facts"),
        }
    )


@built_once
def useful_of(party: str, facts: str) -> Column:
    return useful(employer_block(F.col(facts)) if party == "employer" else employee_block(F.col(facts)))


def employer_name(block: Column) -> Column:
    """First useful line with a letter that is no street."""
    return T.squeeze(W.first_of(block, lambda f: f["letter"] & ~f["street"])["line"])


def employer_address(block: Column) -> Column:
    """Address from the first street line of the block, NULL without one."""
    return W.let(
        F.struct(block.alias("block"), W.position(block, lambda f: f["street"]).alias("at")),
        lambda c: F.when(
            c["at"] > 0,
            A.address_of(
                F.get(c["block"], c["at"] - 1)["line"],
                F.slice(c["block"], c["at"] + 1, F.lit(K.LOOK_AHEAD)),
            ),
        ),
    )


@built_once
def employer_address_of(block: str) -> Column:
    return employer_address(F.col(block))


def streets(facts: Column) -> Column:
    """Street lines with their assembled address (A7), its quality (A8) and street key."""
    found = F.filter(
        F.transform(
            facts,
            lambda f, i: F.struct(i.alias("index"), f["line"].alias("line"), f["street"].alias("street")),
        ),
        lambda s: s["street"],
    )
    ahead = F.transform(
        found,
        lambda s: F.struct(
            s["index"].alias("index"),
            s["line"].alias("line"),
            W.window(facts, s["index"], 1, K.LOOK_AHEAD).alias("ahead"),
        ),
    )
    placed = F.transform(
        ahead,
        lambda s: F.struct(
            s["index"].alias("index"),
            s["line"].alias("line"),
            s["ahead"].alias("ahead"),
            A.places(s["ahead"]).alias("at"),
        ),
    )
    assembled = F.transform(
        placed,
        lambda s: F.struct(
            s["index"].alias("index"),
            s["line"].alias("line"),
            A.assemble(s["line"], s["ahead"], s["at"]).alias("address"),
        ),
    )
    return F.transform(
        assembled,
        lambda s: F.struct(
            s["index"].alias("index"),
            T.street_key(s["line"]).alias("key"),
            s["address"].alias("address"),
            A.quality(s["address"]).alias("quality"),
        ),
    )


def upgraded(found: Column) -> Column:
    """Street entries with the best address of the same street."""


    def pick(entry: Column, best: Column) -> Column:
        same_street = F.when(entry["key"].isNotNull(), F.try_element_at(best, entry["key"]))
        return F.struct(
            entry["index"].alias("index"),
            entry["key"].alias("key"),
            W.let(same_street, lambda b: A.upgrade(entry["address"], entry["quality"], b)).alias("address"),
        )

    return W.let(
        found,
        lambda entries: W.let(
            A.best_by_street(entries), lambda best: F.transform(entries, lambda entry: pick(entry, best))
        ),
    )


def candidates(facts: Column, low_text: Column, person: Column | None = None) -> Column:
    """struct(index, name, address, has_employee, has_employer, repeats, score) per street line
    that has both a name and an address.

    `person` is an optional map from name to the bonus of an outside person detector.
    """
    named = F.filter(
        F.transform(
            upgraded(streets(facts)),
            lambda s: F.struct(
                s["index"].alias("index"),
                s["address"].alias("address"),
                W.let(W.window(facts, s["index"], -K.NAME_LOOK_BACK, -1), N.name_before).alias("name"),
            ),
        ),
        lambda s: s["name"].isNotNull() & s["address"].isNotNull(),
    )

    def counted(rows: Column) -> Column:
        """Map from name to evidence: once per different name."""
        names = F.array_distinct(F.transform(rows, lambda s: s["name"]))
        return W.let(names, lambda distinct: N.evidence_of_all(distinct, low_text))

    def with_context(entry: Column, evidence: Column) -> Column:
        index = entry["index"]
        return F.struct(
            index.alias("index"),
            entry["address"].alias("address"),
            entry["name"].alias("name"),
            W.let(W.window(facts, index, *K.EMPLOYEE_CONTEXT), N.in_employee_context).alias("has_employee"),
            N.in_employer_context(W.window(facts, index, *K.EMPLOYER_CONTEXT)).alias("has_employer"),
            F.try_element_at(evidence, entry["name"]).alias("repeats"),
        )

    seen = W.let(
        named,
        lambda rows: W.let(
            counted(rows), lambda evidence: F.transform(rows, lambda entry: with_context(entry, evidence))
        ),
    )
    return F.transform(
        seen,
        lambda s: F.struct(
            s["index"].alias("index"),
            T.drop_initials(s["name"]).alias("name"),
            s["address"].alias("address"),
            s["has_employee"].alias("has_employee"),
            s["has_employer"].alias("has_employer"),
            s["repeats"].alias("repeats"),
            N.score(
                s["name"],
                s["address"],
                s["has_employee"],
                s["has_employer"],
                s["repeats"],
                F.lit(0) if person is None else F.coalesce(F.try_element_at(person, s["name"]), F.lit(0)),
            ).alias("score"),
        ),
    )


def best_candidate(found: Column) -> Column:
    """Highest score, then an address with a state, then with a ZIP, then the earliest line."""
    return F.array_max(
        F.transform(
            found,
            lambda c: F.struct(
                c["score"].alias("score"),
                L.contains_state(c["address"]).alias("has_state"),
                L.contains_zip(c["address"]).alias("has_zip"),
                (-c["index"]).alias("earliness"),
                c["name"].alias("name"),
                c["address"].alias("address"),
            ),
        )
    )


@built_once
def best_in(facts: str, text: str, person: str | None = None) -> Column:
    """N6 and N7 over the named columns."""
    bonus = None if person is None else F.col(person)
    return best_candidate(candidates(F.col(facts), F.col(text), bonus))


def joined_low(facts: Column) -> Column:
    return F.array_join(F.transform(facts, lambda f: f["low"]), " ")


def with_candidates(df: DataFrame, text: str = "raw_text", person: str | None = None) -> DataFrame:
    """Adds the best candidate of the employee's block, `_block` (N8), and where that leaves a part
    open the best one of the whole document, `_full` (N9)."""
    work = with_blocks(with_facts(df, text)).withColumn("block_text", joined_low(F.col("employee_lines")))
    work = work.withColumn("_block", best_in("employee_lines", "block_text", person))
    incomplete = F.col("_block.name").isNull() | F.col("_block.address").isNull()
    return work.withColumn("_full", F.when(incomplete, best_in("facts", "low_text", person)))


def extract_fields(
    df: DataFrame, text: str = "raw_text", person: str | None = None, fields: list[str] = K.FIELDS
) -> DataFrame:
    """`df` with six nullable text fields added, or those wanted; its other columns pass through.

    What no wanted field needs is not searched for.

    The employee's block is searched first (N8). Only where a part is missing is the whole document
    searched (N9), and each part is filled by itself (N10); the name order is decided last, with the
    whole document as context (N11). `person` names an optional map column, see `candidates`.
    """
    work = with_candidates(df, text, person)
    work = work.withColumn("_name", F.coalesce("_block.name", "_full.name"))
    found = {
        "employee_name": T.order_name(F.col("_name"), F.col("low_text")),
        "employee_address": F.coalesce("_block.address", "_full.address"),
        "employee_ssn": T.personal_id(F.col(text)),
        "employer_name": employer_name(F.col("employer_lines")),
        "employer_address": employer_address_of("employer_lines"),
        "employer_ein": T.employer_id(F.col(text)),
    }
    return computed(work, {field: found[field] for field in fields}).select(*df.columns, *fields)
