"""Personal data by candidates and boosted trees, in SQL expressions only.

Fixed rules give the base spans. Further generators with high recall propose spans that may overlap these and each
other; boosted trees over their form and context score them, and a threshold for each kind, set for precision on
documents that the trees have not seen, selects what is added. The trees are fitted on the corpus itself: candidates
whose form or context decides them are the labels, and what is collected is the table of distinct feature values, whose
size is bounded by the bins, not by the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formsift.llm import base


KINDS = ("email", "ip", "card", "phone")
#: A number up to 255 with any number of zeros before it.
OCTET = "(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|)"
OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"

# The base rules. Equal to the plain patterns, but no start within a run that has failed is tried again,
# and what cannot be shortened is not given back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[(]\x20?(?:at|AT)\x20?[\])])\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|[\[(]\x20?(?:dot|DOT)\x20?[\])])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
}
# Words that name a kind shortly before a span.
WORDS = {
    "email": "mail|contact|write to|reach|an:|correo|courriel",
    "ip": r"\bip\b|host|server|address|addr|adresse",
    "card": "card|visa|master|amex|karte|tarjeta|carte|payment|iban",
    "phone": r"phone|\btel\b|telef|tél|\bcall\b|mobil|\bfax\b|cell|whatsapp|hotline|handy",
}
#: Features in order: digits, separators, plus, brackets, checksum, octets, sign before, sign after, word before, kind, even groups.
FEATURES = ("digits", "gaps", "plus", "brackets", "sum", "octets", "left", "right", "word", "kind", "even")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator of one row: expressions above read them and do not work them out again."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def pieces(text: str, pattern: str, trigger: str) -> Column:
    """The text cut before every match, each match closed by a sign; empty where the trigger does not occur."""
    marked = F.regexp_replace(F.col(text), F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}"))
    return F.when(F.col(text).rlike(trigger), F.split(marked, OPEN)).otherwise(F.array().cast("array<string>"))


def spans(cut: str) -> str:
    """SQL: structs (s, e, m, b, a) of the matches in a column of pieces: begin, end, text, up to 24 characters around.

    A begin is the sum of the lengths before; those of 256 pieces are added up first, so that many matches stay cheap.
    """
    lengths = f"transform({cut}, (p, i) -> cast(length(p) - if(i = 0, 0, 1) AS bigint))"
    sums = (
        "struct(n AS n, transform(sequence(0, cast((size(n) - 1) div 256 AS int)), "
        "j -> aggregate(slice(n, j * 256 + 1, 256), 0L, (x, y) -> x + y)) AS t)"
    )
    start = (
        "aggregate(slice(q.t, 1, cast(i div 256 AS int)), 0L, (x, y) -> x + y) "
        "+ aggregate(slice(q.n, cast(i div 256 AS int) * 256 + 1, i % 256), 0L, (x, y) -> x + y)"
    )
    match = f"substring_index({cut}[i], '{CLOSE}', 1)"
    found = (
        f"transform(sequence(1, size(q.n) - 1), i -> struct({start} AS s, {match} AS m, "
        f"right({cut}[i - 1], 24) AS b, left(substring({cut}[i], length({match}) + 2), 24) AS a))"
    )
    whole = f"transform(transform(array({lengths}), n -> {sums}), q -> {found})[0]"
    ended = f"transform({whole}, x -> struct(x.s AS s, x.s + length(x.m) AS e, x.m AS m, x.b AS b, x.a AS a))"
    return f"CASE WHEN size({cut}) > 1 THEN {ended} ELSE cast(array() AS {SPANS}) END"


SPANS = "array<struct<s: bigint, e: bigint, m: string, b: string, a: string>>"
FOUND = "array<struct<kind: string, s: bigint, e: bigint>>"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the checksum."""
    digit = f"cast(substring({digits}, length({digits}) - k, 1) AS int)"
    twice = f"(2 * {digit} - if({digit} > 4, 9, 0))"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, k) -> t + if(k % 2 = 0, {digit}, {twice})) % 10 = 0"


def valid(kind: str, span: str = "x") -> str:
    """SQL: whether a base match passes the check of its kind."""
    digits = f"regexp_replace({span}.m, '[^0-9]', '')"
    if kind == "ip":
        # as text: a part may have more digits than any number type
        return f"{span}.m RLIKE '^{OCTET}([.]{OCTET}){{3}}$'"
    if kind == "card":
        return f"length({digits}) BETWEEN 13 AND 19 AND {luhn(digits)}"
    if kind == "phone":
        return f"length({digits}) BETWEEN 9 AND 15"
    return "true"


def features(kind: str, span: str = "x") -> str:
    """SQL: the feature struct of a candidate, every feature a small whole number."""
    digits = f"regexp_replace({span}.m, '[^0-9]', '')"
    sign = "CASE WHEN {c} = '' THEN 0 WHEN {c} RLIKE '[A-Za-z]' THEN 1 WHEN {c} RLIKE '[0-9]' THEN 2 WHEN {c} RLIKE '[\\\\s,;:]' THEN 0 ELSE 3 END"
    checksum = f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN if({luhn(digits)}, 2, 1) ELSE 0 END"
    octets = f"if(forall(split({span}.m, '[.]'), p -> coalesce(cast(p AS int) <= 255, false)), 2, 1)" if kind == "ip" else "0"
    words = WORDS[kind].replace("\\", "\\\\")
    even = f"if({span}.m RLIKE '^([0-9]{{4}}[ -]){{3}}[0-9]{{4}}$' OR {span}.m RLIKE '[0-9]{{3,4}}[ .-][0-9]{{3,4}}$', 1, 0)"
    return (
        f"struct(least(length({digits}), 20) AS digits, least(length(regexp_replace({span}.m, '[^ ().-]', '')), 6) AS gaps, "
        f"if({span}.m LIKE '+%', 1, 0) AS plus, if({span}.m RLIKE '[\\\\[(]', 1, 0) AS brackets, {checksum} AS sum, "
        f"{octets} AS octets, {sign.format(c=f'right({span}.b, 1)')} AS left, {sign.format(c=f'left({span}.a, 1)')} AS right, "
        f"if({span}.b RLIKE '(?i){words}', 1, 0) AS word, {KINDS.index(kind)} AS kind, {even} AS even)"
    )


def label(f: str = "f") -> str:
    """SQL: 1 or 0 where form and context decide a candidate, null where they leave it open."""
    return f"""CASE
        WHEN {f}.left IN (1, 2) OR {f}.right IN (1, 2) THEN 0
        WHEN {f}.kind = 0 THEN if({f}.brackets = 0 AND {f}.gaps > 0, 1, if({f}.word = 1, 1, null))
        WHEN {f}.kind = 1 THEN if({f}.octets = 2, 1, 0)
        WHEN {f}.kind = 2 THEN if({f}.sum = 2, 1, 0)
        WHEN {f}.digits < 9 OR {f}.digits > 15 THEN 0
        WHEN {f}.plus = 1 THEN 1
        WHEN {f}.gaps = 0 THEN 0
        WHEN {f}.word = 1 THEN 1
        ELSE null END"""


@dataclass
class PiiModel:
    """Boosted trees of two levels: (feature, cut, feature left, cut left, feature right, cut right, four leaves)."""

    shift: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def sql(self, f: str) -> str:
        def leaf(value: float) -> str:
            return f"{value!r}D"

        terms = [leaf(self.shift)]
        for a, x, b, y, c, z, (p, q, r, s) in self.trees:
            terms.append(
                f"if({f}.{FEATURES[a]} <= {x}, if({f}.{FEATURES[b]} <= {y}, {leaf(p)}, {leaf(q)}), "
                f"if({f}.{FEATURES[c]} <= {z}, {leaf(r)}, {leaf(s)}))"
            )
        return f"(1D / (1D + exp(-({' + '.join(terms)}))))"

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.shift)
        for a, x, b, y, c, z, leaves in self.trees:
            down = np.where(rows[:, a] <= x, np.where(rows[:, b] <= y, 0, 1), np.where(rows[:, c] <= z, 2, 3))
            total += np.array(leaves)[down]
        return 1 / (1 + np.exp(-total))


def boosted(rows: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 24, rate: float = 0.4) -> PiiModel:
    """Gradient boosting on distinct feature values with their weights, Newton leaves with a ridge of 1."""
    share = float(np.clip((weight * target).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    model = PiiModel(shift=float(np.log(share / (1 - share))))
    cuts = [(i, int(v)) for i in range(rows.shape[1]) for v in np.unique(rows[:, i])[:-1]]

    def best(mask: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int]:
        def gain(cut: tuple[int, int]) -> float:
            side = mask & (rows[:, cut[0]] <= cut[1])
            rest = mask & ~side
            return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (side, rest))

        return max(cuts, key=gain) if cuts else (0, 0)

    for _ in range(rounds):
        p = model.scores(rows)
        g, h = weight * (target - p), weight * p * (1 - p)
        everything = np.ones(len(rows), dtype=bool)
        a, x = best(everything, g, h)
        side = rows[:, a] <= x
        (b, y), (c, z) = best(side, g, h), best(~side, g, h)
        ends = (side & (rows[:, b] <= y), side & (rows[:, b] > y), ~side & (rows[:, c] <= z), ~side & (rows[:, c] > z))
        leaves = tuple(float(np.clip(rate * g[m].sum() / (h[m].sum() + 1), -4, 4)) for m in ends)
        model.trees.append((a, x, b, y, c, z, leaves))
    return model


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text, row and for every kind the base matches (base_*) and the proposed ones (more_*).

    row holds all other columns, whatever their names; where nothing reads it, it is not read.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.struct(*others).alias("row"),
    )
    rows = rows.withColumn("t", F.translate("text", OPEN + CLOSE, OTHER + OTHER))
    trigger = {"email": "@|[\\[(] ?(?:at|AT)", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "[0-9]"}
    rows = computed(
        rows,
        **{f"base_{k}": pieces("t", BASE[k], "\\+[0-9]" if k == "phone" else trigger[k]) for k in KINDS},
        **{f"more_{k}": pieces("t", MORE[k], trigger[k]) for k in KINDS},
    )
    names = [f"{n}_{k}" for n in ("base", "more") for k in KINDS]
    found = computed(rows.select("doc_id", "text", "row", *(F.col(n).alias(f"cut_{n}") for n in names)), **{n: F.expr(spans(f"cut_{n}")) for n in names})
    return found.select("doc_id", "text", "row", *names)


def fit_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", precision: float = 0.99) -> PiiModel:
    """Fits the trees on all documents but a quarter, by hash of the key; that quarter sets the thresholds.

    Collects one row for each distinct combination of features, label and part: a bounded number at any size.
    """
    found = candidates(docs, key, text)
    proposed = F.concat(*(F.expr(f"transform(more_{k}, x -> {features(k)})") for k in KINDS))
    rows = computed(found.select("doc_id", *(f"more_{k}" for k in KINDS)), proposed=proposed)
    rows = rows.select(F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, F.lit(False)).alias("unseen"), F.explode("proposed").alias("f"))
    table = rows.groupBy("unseen", "f").agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.expr(label()))
    table = table.where("label is not null").select("unseen", "label", "n", *(F.col(f"f.{n}") for n in FEATURES)).collect()
    seen = [r for r in table if not r.unseen]
    if len({r.label for r in seen}) < 2:
        return PiiModel(thresholds=dict.fromkeys(KINDS, 2.0))
    x, y, w = arrays(seen)
    # as many of either kind of label count alike, and no single combination rules
    w = np.sqrt(w)
    w *= np.where(y == 1, 0.5 / w[y == 1].sum(), 0.5 / w[y == 0].sum()) * len(w) * 10
    model = boosted(x, y, w)
    x, y, w = arrays([r for r in table if r.unseen] or seen)
    score = model.scores(x)
    for i, kind in enumerate(KINDS):
        own = x[:, FEATURES.index("kind")] == i
        model.thresholds[kind] = threshold(score[own], y[own], w[own], precision)
    return model


def arrays(table: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.array([[r[n] for n in FEATURES] for r in table], dtype=np.int64).reshape(-1, len(FEATURES))
    return x, np.array([r.label for r in table], dtype=float), np.array([r.n for r in table], dtype=float)


def threshold(score: np.ndarray, target: np.ndarray, weight: np.ndarray, precision: float) -> float:
    """Halfway between the least score from which on at least this share is right and the next lower one.

    It is 0.5 at least, and beyond 1 where there is no such score.
    """
    order = np.argsort(-score, kind="stable")
    right, all_ = np.cumsum((weight * target)[order]), np.cumsum(weight[order])
    last = np.append(score[order][1:] != score[order][:-1], True) if len(score) else np.empty(0, bool)
    good = np.flatnonzero(last & (right >= precision * all_))
    if not len(good):
        return 2.0
    lower = score[order][good[-1] + 1] if good[-1] + 1 < len(score) else 0.0
    return max(0.5, float(score[order][good[-1]] + lower) / 2)


def pii_spans(docs: DataFrame, model: PiiModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, row (all other columns), base, all for every row; spans are structs (kind, s, e) by code points, end exclusive.

    base has the matches of the fixed rules that pass their checks, by kind, then begin. all has these and what the
    model adds: proposed spans that reach their kind's threshold and are not covered by base spans, best first, each of
    which meets none that was added before it. Added spans may overlap base spans. A null text is empty and has none; a null key stays null; repeated rows give repeated rows; an empty
    table gives an empty one; other columns are not read.
    """
    found = candidates(docs, key, text)
    kept = {f"ok_{k}": F.expr(f"transform(filter(base_{k}, x -> {valid(k)}), x -> struct('{k}' AS kind, x.s AS s, x.e AS e))") for k in KINDS}
    scored = {
        f"new_{k}": F.expr(
            f"filter(transform(transform(more_{k}, x -> struct('{k}' AS kind, x.s AS s, x.e AS e, {features(k)} AS f)), "
            f"x -> struct(x.kind AS kind, x.s AS s, x.e AS e, x.f AS f, {model.sql('x.f')} AS p)), "
            f"x -> x.p >= {model.thresholds[k]:.9f}D)"
        )
        for k in KINDS
    }
    rows = computed(found, **kept, **scored)
    rows = computed(
        rows.select("doc_id", "text", "row", *kept, *scored),
        base=F.concat(*(F.col(f"ok_{k}") for k in KINDS)),
        proposed=F.concat(*(F.col(f"new_{k}") for k in KINDS)),
    ).select("doc_id", "text", "row", "base", "proposed")
    # what a base span covers is known; what goes beyond the base spans is added whole
    points = "concat(array(x.s), transform(filter(base, y -> x.s < y.e AND y.e < x.e), y -> y.e))"
    rows = computed(
        rows,
        free=F.expr(f"filter(proposed, x -> exists({points}, p -> NOT exists(base, y -> y.s <= p AND p < y.e)))"),
    )
    meets = "exists(free, y -> x.s < y.e AND y.s < x.e AND NOT (y.s = x.s AND y.e = x.e AND y.f.kind = x.f.kind))"
    # ties go to the longer, then the first, then the kind listed first
    ranked = "array_sort(transform(contested, x -> struct(-x.p AS p, x.s - x.e AS n, x.s AS s, x.f.kind AS i, x.kind AS kind, x.e AS e)))"
    added = (
        f"aggregate({ranked}, cast(array() AS {FOUND}), (z, x) -> if(exists(z, y -> x.s < y.e AND y.s < x.e), z, "
        "concat(z, array(struct(x.kind AS kind, x.s AS s, x.e AS e)))))"
    )
    rows = computed(rows, contested=F.expr(f"filter(free, x -> {meets})"), alone=F.expr(f"filter(free, x -> NOT {meets})"))
    alone = "transform(alone, x -> struct(x.kind AS kind, x.s AS s, x.e AS e))"
    rows = computed(rows, added=F.expr(f"concat({alone}, {added})"))
    by_kind = F.concat(*(F.expr(f"array_sort(filter(concat(base, added), x -> x.kind = '{k}'))") for k in KINDS))
    return computed(rows.select("doc_id", "text", "row", "base", "added"), all=by_kind).select("doc_id", "text", "row", "base", "all")


def joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap are one, named by the first."""
    return F.expr(f"""
        CASE WHEN size({spans}) = 0 THEN {text} ELSE aggregate(
            array_sort({spans}, (x, y) -> CASE WHEN x.s < y.s THEN -1 WHEN x.s > y.s THEN 1 WHEN x.e > y.e THEN -1 WHEN x.e < y.e THEN 1 ELSE 0 END),
            struct('' AS done, 0L AS at),
            (z, x) -> CASE WHEN x.s >= z.at
                THEN struct(concat(z.done, substring({text}, cast(z.at + 1 AS int), cast(x.s - z.at AS int)), '[', upper(x.kind), ']') AS done, x.e AS at)
                ELSE struct(z.done AS done, greatest(z.at, x.e) AS at) END,
            z -> concat(z.done, substring({text}, cast(z.at + 1 AS int)))
        ) END
    """)


def redact(docs: DataFrame, model: PiiModel, key: str = "doc_id", text: str = "text", size: str | None = None) -> DataFrame:
    """All rows and columns, the texts redacted; a column that holds the text's length (size) follows. Null stays null."""
    there = f"known_{base.fresh()}"
    found = pii_spans(docs.withColumn(there, F.col(f"`{text}`").isNotNull()), model, key, text)
    done = computed(found, redacted=redacted("text", "all"))

    def column(name: str) -> Column:
        if name == text:
            return F.when(F.col("known"), F.col("redacted"))
        if name == size:
            kind = dict(docs.dtypes)[name]
            return F.when(F.size("all") > 0, F.length("redacted").cast(kind)).otherwise(F.col("row")[name])
        return F.col("row")[name]

    # whether the text was null: kept with the other columns, where its name cannot clash
    return done.withColumn("known", F.col("row")[there]).select(*(column(c).alias(c) for c in docs.columns))
