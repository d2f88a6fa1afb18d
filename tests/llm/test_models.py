"""Classifier, language model, personal data, pages, search and pipeline on small fixtures."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from formsift.llm import lm_scoring
from formsift.llm.html_main import extract_pages, main_text, votes
from formsift.llm.lm_scoring import lm_scores
from formsift.llm.pii import KINDS, PiiModel, candidates, features, fit_pii, joined, pii_spans, redact
from formsift.llm.quality import QualityModel, fit_quality, keep_good, quality_scores
from formsift.llm.topk import build, exact_topk, search
from tests.llm.conftest import prose, table

LOWER = {i: i + 32 for i in range(65, 91)}


# quality


@pytest.fixture(scope="module")
def marked(spark):
    def junk(seed):
        return " ".join(w.upper() + "!!" for w in prose(seed, 80).split())

    docs = [(i, prose(i, 80) if i % 3 else junk(i)) for i in range(400)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(400)] + [(3, 0, 0), (None, 1, 0), (9999, None, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_rows_are_told_apart(marked):
    docs, labels = marked
    rows = table(quality_scores(docs, fit_quality(docs, labels)))
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held]) > 0.95


def test_labels_of_held_out_rows_are_not_used(marked):
    docs, labels = marked
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_quality(docs, labels) == fit_quality(docs, turned)


def test_quality_of_odd_rows(odd, empty, marked):
    model = fit_quality(*marked)
    assert len(table(quality_scores(odd, model))) == odd.count()
    assert quality_scores(empty, model).count() == 0 and keep_good(empty, model).count() == 0
    left = keep_good(odd, model)
    assert left.columns == odd.columns
    alone = fit_quality(marked[0], marked[1].where("quality = 1"))
    assert alone.slope == 0 and all(r["score"] > 0.9 for r in table(quality_scores(odd, alone)))
    assert fit_quality(empty, marked[1]).good == b"" and fit_quality(marked[0], marked[1].limit(0)) == QualityModel(b"", b"", 0.0, 0.0)


# language model


def brute_lm(rows, prior=200.0, added=0.1):
    words = {i: re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + ["\0"] for i, t in rows}
    train = [i for i, _ in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    count = collections.Counter(w for i in train for w in words[i])
    pairs = collections.Counter(p for i in train for p in zip(["\0", *words[i]], words[i], strict=False))
    n, v = sum(count.values()), len(count)
    out = {}
    for i, own in words.items():
        base = [math.log10((count[w] + added) / (n + added * (v + 1))) for w in own]
        score = 0.0
        for b, before, w in zip(base, ["\0", *own], own, strict=False):
            c = pairs[before, w]
            c = 2 ** int(math.log2(c)) if c else 0
            score += math.log10((c + prior * 10**b) / (count[before] + prior))
        out[i] = (len(own), sum(count[w] > 0 for w in own), n, sum(base), score)
    return out


@pytest.mark.parametrize("pass_bytes", [lm_scoring.PASS_BYTES, 70_000])
def test_scores_are_those_of_brute_force(spark, pass_bytes, monkeypatch):
    rows = [(i, prose(i, 3 + i % 90)) for i in range(150)] + [(500, ""), (501, None), (502, "Zebra zebra")]
    monkeypatch.setattr(lm_scoring, "BITS_PER_TOKEN", 200)  # next to no false hits
    wanted = brute_lm(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in table(lm_scores(docs, pass_bytes=pass_bytes)):
        n, known, total, base, score = wanted[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)


def test_counts_beyond_32_bits_are_kept():
    words = np.array([3, 9], dtype=np.uint64)
    lookup = lm_scoring.Lookup(words, np.array([5, 2**40 + 1], dtype=np.uint64), 1, 0, np.zeros((0, 1), np.uint8))
    assert lookup.count(np.array([9, 4, 3], dtype=np.uint64)).tolist() == [2**40 + 1, 0, 5]
    assert lm_scoring.FOUND["count"].itemsize == 8


def test_pairs_are_counted_once_however_many_passes(spark, monkeypatch):
    read = []
    monkeypatch.setattr(lm_scoring, "GROUP_BLOCKS", 1)
    monkeypatch.setattr(lm_scoring, "ROW_WORDS", 7)
    whole = lm_scoring.filter_blocks
    monkeypatch.setattr(lm_scoring, "filter_blocks", lambda *a: read.append(1) or whole(*a))
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "BITS_PER_TOKEN", 1200)
    many = {r["doc_id"]: r for r in table(lm_scores(docs, pass_bytes=70_000))}
    assert read == [1] and many == {r["doc_id"]: r for r in table(lm_scores(docs))}


def test_language_model_of_odd_rows(odd, empty):
    rows = table(lm_scores(odd))
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in rows)
    assert lm_scores(empty).count() == 0


# personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(int(d) if k % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(BASE[k], text or "") if passes(k, m[0])]


def noisy(n):
    rng = random.Random(8)
    parts = ["a@b.c", "x.y@z-1.co.uk", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-9999",
             "+", "-", "é", "漢", "\n", " ", "12", "0.0.0.0.7", "b@c.d_e@f.g", "\u0001", "99999999999999999999", "(", "tel 555-010-9999 "]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_are_those_of_the_rules(spark, odd_rows):
    rows = [(i, t) for i, t in enumerate([*noisy(300), *(t for _, t in odd_rows), "1" * 4000, "a." * 3000 + "@", "a@b.c " * 900])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii_spans(docs, PiiModel(thresholds=dict.fromkeys(KINDS, 2.0)))
    texts = dict(rows)
    for r in table(found):
        assert [(s["kind"], s["s"], s["e"]) for s in r["base"]] == base_spans(texts[r["doc_id"]])
        assert r["all"] == r["base"]


def test_addresses_with_parts_of_any_length(spark):
    zeros, nines = "0" * 60, "9" * 45
    parts = ["0", "00", "7", "99", "100", "199", "249", "255", "256", "260", "300", "999", "1000", nines, zeros, zeros + "255", zeros + "256", zeros + "1" * 39]
    rows = [(i, f"at {'.'.join(own)} x") for i, own in enumerate((*["1"] * at, p, *["1"] * (3 - at)) for p in parts for at in range(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["base"] for r in table(pii_spans(docs, fit_pii(docs)))}
    for i, text in rows:
        assert [(s["kind"], s["s"], s["e"]) for s in found[i] if s["kind"] == "ip"] == [s for s in base_spans(text) if s[0] == "ip"]


def test_model_adds_what_the_rules_lose_and_redaction_takes_effect(spark):
    good, bad = "4111111111111111", "4111111111111112"
    rows = [(i, f"{prose(i, 5)} {good if i % 2 else bad} {prose(i, 2)} +1 (555) 010-{i:04d} x 10.0.0.{i % 300} a{i}@b.org") for i in range(300)]
    rows += [(1000, f"pay {good} {good} now"), (1001, "see +1 (555) 010-9999 10.0.0.1 there"), (1002, None), (1003, f"id {bad} {bad}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_chars": F.length("text"), "row": F.lit(1), "base": F.lit("b")})
    model = fit_pii(docs)
    found = {r["doc_id"]: r for r in table(pii_spans(docs, model))}
    assert [(s["kind"], s["s"], s["e"]) for s in found[1000]["all"]] == [("card", 4, 20), ("card", 21, 37)]
    assert {s["kind"] for s in found[1001]["all"]} >= {"phone", "ip"}
    assert found[1003]["all"] == [] and found[1002]["all"] == []
    for r in found.values():
        assert [s for s in r["all"] if s in r["base"]] == r["base"]
    clean = redact(docs, model, size="n_chars")
    assert clean.columns == docs.columns
    done = {r["doc_id"]: r for r in table(clean)}
    assert done[1000]["text"] == "pay [CARD] [CARD] now" and done[1000]["n_chars"] == 21 and done[1002]["text"] is None
    assert done[1003]["text"] == f"id {bad} {bad}"
    assert all("@" not in (r["text"] or "") for r in done.values())


def scored_model():
    """Scores that fall with the number of digits, all beyond the thresholds."""
    tree = (0, 10, 0, 7, 0, 12, (3.0, 2.0, 1.0, 0.5))
    return PiiModel(trees=[tree], thresholds=dict.fromkeys(KINDS, 0.1))


def chosen(base, proposed):
    """(kind, s, e) of what is added, from (score, kind, s, e), by brute force."""
    known = {p for _, s, e in base for p in range(s, e)}
    taken = []
    for _, kind, s, e in sorted(proposed, key=lambda x: (-x[0], x[2] - x[3], x[2], KINDS.index(x[1]))):
        if not set(range(s, e)) <= known and all(e <= t[1] or t[2] <= s for t in taken):
            taken.append((kind, s, e))
    return taken


def test_added_spans_are_those_of_a_greedy_choice(spark):
    rng = random.Random(3)
    parts = ["1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "555 010 9999", "555-0100", "a@b.c", "a @ b . c", "1.2.3.4 555 0100", "(12) 345 6789", "+1 555 010 9999", " ", "-", ".", "12", "@", "x"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 12)))) for i in range(500)]
    docs, model = spark.createDataFrame(rows, "doc_id long, text string"), scored_model()
    found = {r["doc_id"]: r for r in table(pii_spans(docs, model).select("doc_id", "base", "all"))}
    proposed = {k: F.expr(f"transform(more_{k}, x -> struct({features(k)} AS f, '{k}' AS kind, x.s AS s, x.e AS e))") for k in KINDS}
    every = F.concat(*(F.col(k) for k in KINDS))
    scored = F.expr(f"transform(every, x -> struct({model.sql('x.f')} AS p, x.kind AS kind, x.s AS s, x.e AS e))")
    given = table(candidates(docs, "doc_id", "text").select("doc_id", *(c.alias(k) for k, c in proposed.items())).withColumn("every", every).select("doc_id", scored.alias("x")))
    chains = extended = 0
    for r in given:
        base = [(s["kind"], s["s"], s["e"]) for s in found[r["doc_id"]]["base"]]
        spans = [(x["p"], x["kind"], x["s"], x["e"]) for x in r["x"]]
        added = chosen(base, spans)
        assert sorted((s["kind"], s["s"], s["e"]) for s in found[r["doc_id"]]["all"]) == sorted(base + added)
        extended += any(s < b[2] and b[1] < e for _, s, e in added for b in base)
        chains += len(added) > sum(all(x is y or x[3] <= y[2] or y[3] <= x[2] or x[0] > y[0] for y in spans) for x in spans)
    assert extended and chains


def test_personal_data_of_odd_rows(odd, empty):
    assert pii_spans(odd, fit_pii(odd)).count() == odd.count()
    assert redact(odd, fit_pii(empty)).columns == odd.columns
    assert redact(empty, fit_pii(empty)).count() == 0
    digest = table(pii_spans(odd, fit_pii(odd)).select(F.sha2(joined("base"), 256).alias("h")))
    assert hashlib.sha256(b"").hexdigest() in {r["h"] for r in digest}


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<!-- no <p>such</p> --><article class="post-%d"><h1>Fish &amp; chips</h1><p>First  line<br>goes <b>on</b> &eacute;.</p><p>Second <a href="x">link</a> here,
with more words.<div class="ad">Buy now</div><ul><li>One<li>Two</ul><form><p>Name</p></form>
<section id="comments"><p>Great read, I agree with all of it and more!</p></section></article>
<aside><p>Related things to read that go on for very long, longer than all else on this page, and on.</p></aside>
<footer>&copy; me</footer></body></html>"""
TEXT = "Fish & chips\n\nFirst line goes on é.\n\nSecond link here, with more words.\n\nOne\n\nTwo"


def test_main_text_of_a_page():
    assert main_text(PAGE % 1, None) == TEXT
    assert votes(PAGE % 1)[0][0] == "html>body>article.post-#"
    assert main_text("", None) == "" and main_text("plain &lt;text", None) == "plain <text"
    assert main_text("<div><p>a<p>b</div><script>x", None) == "a\n\nb"


def test_pages_of_a_host_follow_its_path(spark):
    plain = "<html><body><div class=top><p>{0}</p></div><div class='story n7'><p>{1}</p></div></body></html>"
    long, short = "many words that run on and on " * 9, "few words"
    rows = [(i, f"https://A.example/{i}", plain.format(short, long)) for i in range(8)]
    rows += [(8, "http://a.example:80/x", plain.format(long, short)), (9, None, PAGE % 9), (10, "x", None), (10, "x", None), (None, "", "<p>q")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("t"), "path": F.lit(1), "host": F.lit(0)})
    found = table(extract_pages(pages))
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[8] == short and texts[0] == long.strip() and texts[9] == TEXT and texts[10] == "" and texts[None] == "q"
    assert extract_pages(pages.limit(0)).count() == 0


LONG = "Words of an article that run on for a while, line after line, until they end. " * 4


def page_of(body):
    return f"<html><body><nav><a href=/>Home</a></nav>{body}<div class='site-footer'><p>All that is left of it.</p></div></body></html>"


@pytest.mark.parametrize("wrapper", ["content-sidebar-wrap", "page-with-sidebar", "sidebar-layout", "menu-open", "has-sidebar", "banner-page"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main class='social'>{}</main>", "<div class=text>{}</div>"])
def test_wrappers_named_after_something_else_keep_the_article(wrapper, inner):
    text = f"<p>{LONG}</p><p>{LONG}</p><div class='related-posts'><p>More of it</p></div>"
    page = page_of(f"<div class='{wrapper}'>{inner.format(text)}<div class='sidebar-left'><p>{LONG[:100]}</p></div></div>")
    assert main_text(page, None) == f"{LONG.strip()}\n\n{LONG.strip()}"


def test_slug_ids_within_an_article_are_kept():
    body = (
        f"<h1 id='notice'>T</h1><h2 id='related-work'>Related work</h2><p id=notice>{LONG}</p><section id='search-strategy'><p>{LONG}</p></section>"
        "<div id='left-sidebar'><p>Not this</p></div><section id=comments><article><p>Nor what readers write</p></article></section>"
    )
    wanted = f"T\n\nRelated work\n\n{LONG.strip()}\n\n{LONG.strip()}"
    assert main_text(page_of(f"<article>{body}</article>"), None) == wanted
    assert main_text(page_of(f"<div id=text>{body}</div>"), "html>body>div") == wanted


def test_what_readers_write_is_no_article_however_long():
    page = page_of(f"<div class=story><p>{LONG}</p></div><div id=comments><article><p>{LONG * 9}</p></article></div>")
    assert main_text(page, None) == LONG.strip()


LEAD = "A lead that says in a sentence or two what the article is about, before it begins in earnest."
LAYOUTS = {  # every text in them belongs to the article
    "section": f"<div class=content><h1>T</h1><p>{LEAD}</p><section><p>{LONG}</p></section></div>",
    "entry": f"<div class=post><h1>A title</h1><div class=entry><p>{LONG}</p><p>{LONG}</p></div></div>",
    "header": f"<div class=post><header class=post-header><h1>A title</h1></header><div class=entry><p>{LONG}</p></div></div>",
    "halves": f"<div class=text><div class=first><p>{LONG}</p></div><div class=second><p>{LEAD}</p></div></div>",
    "wrapped": f"<div id=a><h1>A title</h1><div class=b><div class=c><div class=d><p>{LONG}</p></div></div></div></div>",
    "scrap": f"<div id=a><h1>A long title</h1><div class=b><span>By me</span><div class=c><p>{LONG}</p></div></div></div>",
    "outside": f"<div id=a><h1>A title</h1><p>{LEAD}</p><article><p>{LONG}</p></article></div>",
    "three": f"<div id=a><section><h2>One</h2><p>{LEAD}</p></section><div class=b><p>{LONG}</p></div><section><p>{LEAD}</p></section></div>",
}
AROUND = "<div class=links><a href=1>Another page of this site</a> <a href=2>And another one</a></div><div class=top><p>few words</p></div>"


def texts_in(part):
    return "\n\n".join(t.strip() for t in re.findall(r">([^<>]+)<", part) if t.strip())


@pytest.mark.parametrize("layout", list(LAYOUTS))
def test_article_without_an_element_of_its_own_is_whole(layout):
    part = LAYOUTS[layout]
    page = page_of(f"{AROUND}{part}{AROUND}")
    assert main_text(page, None) == texts_in(part)
    assert main_text(page, votes(page)[0][0]) == texts_in(part)


def test_hosts_follow_the_whole_article(spark):
    rows = [(f"{name} {i}", f"http://{name}.example/{i}", page_of(f"{AROUND}{part}")) for name, part in LAYOUTS.items() for i in range(3)]
    found = {r["page_id"]: r["text"] for r in table(extract_pages(spark.createDataFrame(rows, "page_id string, url string, html string")))}
    assert found == {key: texts_in(LAYOUTS[key.split()[0]]) for key, _, _ in rows}


def test_what_follows_an_article_element_is_not_added():
    page = page_of(f"<div><article><h1>T</h1><p>{LONG}</p></article><div class=legal><p>{LEAD}</p></div></div>")
    assert main_text(page, None) == f"T\n\n{LONG.strip()}"


def test_each_template_of_a_host_has_its_path(spark):
    block = "<div class=top><p>{0}</p></div><div class='story n7'><p>{1}</p></div><div class=note><p>{2}</p></div>"
    short = "few words"
    rows = [(i, "http://two.example/x", page_of(block.format(short, LONG, short))) for i in range(9)]
    rows += [(i, "http://two.example/y", page_of(block.format(LONG, short, short))) for i in range(10, 12)]
    # the page's own best path leads for no other page: the first of its paths that wins
    rows += [(20, "http://two.example/z", page_of(block.format(LONG, short, LONG * 2)))]
    found = {r["page_id"]: r["text"] for r in table(extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert set(found.values()) == {LONG.strip()} and len(found) == 12


# search


def brute_topk(rows, k, every, scale=1024):
    own = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in own:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in own if j != i and len(v) == len(q))[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_topk_is_that_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr("formsift.llm.topk.SHARD_ROWS", 40)
    monkeypatch.setattr("formsift.llm.topk.BLOCK_QUERIES", 7)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(200)]
    rows += [(i, [0.5] * 6) for i in range(200, 260)] + [(300, None), (301, []), (302, [None] * 6), (303, [math.nan] * 6), (None, [1.0] * 6)]
    rows += [(305, [math.inf] * 6), (310, [0.1, 0.2]), (311, [0.3, 0.4]), (5, [0.5] * 6), (-5, [-2.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "v": F.lit(2), "row": F.lit(3)})
    found = table(exact_topk(df.repartition(4), k=4, every=5))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] != 5) == [
        r for r in brute_topk(rows, 4, 5) if r[0] != 5
    ]
    assert sum(r["query_id"] == 5 for r in found) == 8  # two rows of that id ask
    assert exact_topk(df.limit(0)).count() == 0 and exact_topk(df, every=1_000_003).where("query_id <> 0").count() == 0


def test_topk_refuses_products_beyond_64_bits(spark):
    large = spark.createDataFrame([(0, [1e18, 1.0]), (1, [-1e18, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        exact_topk(large)
    rows = [(0, [1e5, -1e5]), (1, [-1e5, 1e5]), (2, [1e5, 1e5])]
    found = table(exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=2))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == brute_topk(rows, 10, 2)


def test_tree_search_leaves_nodes_out_but_no_result():
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 50, (3000, 3))
    tree = build(np.arange(3000), rows)
    queries = rng.integers(-50, 50, (20, 3))
    scores, ids = search(tree, np.full(20, -1), queries, 5, np.full(20, np.iinfo(np.int64).min))
    every = queries @ rows.T
    for q in range(20):
        order = np.lexsort((np.arange(3000), -every[q]))[:5]
        assert ids[q].tolist() == order.tolist() and scores[q].tolist() == every[q][order].tolist()


# pipeline


def test_pipeline_stages_on_the_small_tables(spark, small):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.base.staged(stage(spark, docs, small), "stage")
        assert docs.columns == before
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        ids = left
    assert {r.doc_id for r in pipeline.STAGES[-1][1](spark, docs, small).collect()} == ids
