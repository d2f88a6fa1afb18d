"""Address assembly (A1-A10) over line facts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from formsift import constants as K
from formsift.functions import lines as L, text as T, windows as W


def parse_city_state_zip(line: Column) -> Column:
    """A1: struct(city, state, zip) of a squeezed line.

    The first token with a ZIP gives the ZIP. When the token before it is a state code, that is the
    state and everything before is the city; otherwise both stay NULL.
    """
    before_zip = rf"^((?:[^ ]+ )*?)[^ ]*?({K.ZIP})"
    before_state = rf"(?:^| )({K.STATE_CODES}) \z"
    return W.let(
        F.struct(
            T.first_group(before_zip, line, 1).alias("head"), T.first_group(before_zip, line, 2).alias("zip")
        ),
        lambda a: W.let(
            F.struct(
                a["zip"].alias("zip"),
                T.first_group(before_state, a["head"], 1).alias("state"),
                F.btrim(F.regexp_replace(a["head"], before_state, "")).alias("city"),
            ),
            lambda b: F.struct(
                F.when(b["state"].isNotNull() & (b["city"] != ""), b["city"]).alias("city"),
                b["state"].alias("state"),
                b["zip"].alias("zip"),
            ),
        ),
    )


def parse_city_state(line: Column) -> Column:
    """A2: struct(city, state) of a squeezed line of two or more tokens that ends in a state code."""
    fits = L.ends_in_state(line)
    return F.struct(
        F.when(fits, F.substring(line, F.lit(1), F.char_length(line) - 3)).alias("city"),
        F.when(fits, F.substring(line, -2, 2)).alias("state"),
    )


def may_be_previous_city(fact: Column) -> Column:
    return fact["letter"] & ~fact["state"] & fact["zip"].isNull() & ~fact["label"] & ~fact["street"]


def may_be_next_city(fact: Column) -> Column:
    return may_be_previous_city(fact) & ~fact["number"] & ~fact["code"]


def previous_city(ahead: Column, place: Column) -> Column:
    """A3: nearest city-like line before a 1-based position of the look-ahead."""
    return W.last_of(W.before(ahead, place), may_be_previous_city)["line"]


def next_city(ahead: Column, place: Column) -> Column:
    """A4: nearest city-like line after the position."""
    return W.first_of(W.after(ahead, place), may_be_next_city)["line"]


def zip_after(ahead: Column, place: Column) -> Column:
    """A5: first ZIP on a later line."""
    return W.first_of(W.after(ahead, place), lambda fact: fact["zip"].isNotNull())["zip"]


def previous_state_and_city(ahead: Column, place: Column) -> Column:
    """struct(city, state) of the nearest earlier state line or 'city ST' line."""
    earlier = W.before(ahead, place)
    hit = F.coalesce(
        F.array_max(
            F.transform(
                earlier,
                lambda fact, i: F.when(fact["state"] | fact["ends_in_state"], i + 1),
            )
        ),
        F.lit(0),
    )
    line = F.get(earlier, hit - 1)
    parsed = parse_city_state(line["line"])
    return F.struct(
        F.when(line["state"], previous_city(earlier, hit)).otherwise(parsed["city"]).alias("city"),
        F.when(line["state"], line["line"]).otherwise(parsed["state"]).alias("state"),
    )


def join_parts(*parts: Column) -> Column:
    """The parts that exist, the street line always among them."""
    return T.single_blanks(F.concat_ws(" ", *parts))


def places(ahead: Column) -> Column:
    """Where each rule of A7 first fires in the look-ahead (1-based, 0 for never)."""
    return F.struct(
        W.position(ahead, lambda f: f["has_state"] & f["zip"].isNotNull()).alias("city_state_zip"),
        W.position(ahead, lambda f: f["ends_in_state"]).alias("city_state"),
        W.position(ahead, lambda f: f["state"]).alias("state"),
        W.position(ahead, lambda f: f["zip"].eqNullSafe(f["line"])).alias("zip"),
    )


def assemble(street: Column, ahead: Column, place: Column) -> Column:
    """The address that starts at a street line.

    The four rules are tried in order and the first that fires wins. By the time the ZIP-only rule is
    reached no state is left in the look-ahead, so it adds the ZIP alone.
    """
    p = place["city_state_zip"]
    rule_one = W.let(
        parse_city_state_zip(F.get(ahead, p - 1)["line"]),
        lambda one: join_parts(
            street,
            F.coalesce(one["city"], previous_city(ahead, p), next_city(ahead, p)),
            one["state"],
            one["zip"],
        ),
    )

    q = place["city_state"]
    rule_two = W.let(
        parse_city_state(F.get(ahead, q - 1)["line"]),
        lambda two: join_parts(street, two["city"], two["state"], zip_after(ahead, q)),
    )

    s = place["state"]
    rule_three = join_parts(
        street,
        F.coalesce(previous_city(ahead, s), next_city(ahead, s)),
        F.get(ahead, s - 1)["line"],
        zip_after(ahead, s),
    )

    rule_four = join_parts(street, F.get(ahead, place["zip"] - 1)["line"])

    return (
        F.when(p > 0, rule_one)
        .when(q > 0, rule_two)
        .when(s > 0, rule_three)
        .when(place["zip"] > 0, rule_four)
        .otherwise(T.single_blanks(street))
    )


def address_of(street: Column, ahead: Column) -> Column:
    """A7 for one street line and its look-ahead."""
    return W.let(
        F.struct(street.alias("street"), ahead.alias("ahead")),
        lambda c: W.let(
            F.struct(c["street"].alias("street"), c["ahead"].alias("ahead"), places(c["ahead"]).alias("at")),
            lambda d: assemble(d["street"], d["ahead"], d["at"]),
        ),
    )


def quality(address: Column) -> Column:
    """How complete an address looks; NULL scores 0."""
    return (
        F.when(L.is_street(address), K.QUALITY["street"]).otherwise(0)
        + F.when(L.contains_state(address), K.QUALITY["state"]).otherwise(0)
        + F.when(L.contains_zip(address), K.QUALITY["zip"]).otherwise(0)
    )


def best_by_street(streets: Column) -> Column:
    """Map of street key to struct(quality, address); best quality, earliest line on ties.

    `streets` is an array of struct(index, key, quality, address). Sorting brings every key together
    with its best entry first, so the work stays n log n in the street lines of a document.
    """
    ranked = F.sort_array(
        F.transform(
            F.filter(streets, lambda s: s["key"].isNotNull()),
            lambda s: F.struct(
                s["key"].alias("key"),
                (-s["quality"]).alias("worse"),
                s["index"].alias("index"),
                s["address"].alias("address"),
            ),
        )
    )
    firsts = W.let(
        ranked,
        lambda r: F.filter(r, lambda s, i: ~s["key"].eqNullSafe(F.get(r, i - 1)["key"])),
    )
    return F.map_from_entries(
        F.transform(
            firsts,
            lambda s: F.struct(
                s["key"], F.struct((-s["worse"]).alias("quality"), s["address"].alias("address"))
            ),
        )
    )


def upgrade(address: Column, own_quality: Column, best: Column) -> Column:
    """A10: the best address of the same street when it is strictly better."""
    return F.when(best["quality"] > own_quality, best["address"]).otherwise(address)
