"""Token counts, packing and SentencePiece against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from formsift.llm.packing import best_filling, pack, packing_plan, token_pieces
from formsift.llm.sentencepiece_scan import Decoder, Pieces, chosen_states, sentencepiece_decode, sentencepiece_encode, written
from formsift.llm.token_counts import token_counts
from formsift.llm.wordbpe import WordBpe
from tests.llm.conftest import prose, table

BPE = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def some_texts(n: int) -> list[str]:
    rng = random.Random(5)
    signs = "ab's tdrevml'' 1!.éÉÜ\n\x1c▁<|>ΣİК漢😀"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_counts_and_ids_are_the_librarys(library):
    texts = [*some_texts(800), "it's we'Re 'sound !'s 'll'llx", "<|endoftext|>a<|startoftext|>", "ŉ ſ ÀÉÿŸ", "d" * 500]
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bpe = WordBpe(BPE)
    assert bpe.counts_of(texts) == [len(i) for i in ids]
    assert bpe.ids_of(texts) == [np.array(i, dtype="<u4").tobytes() for i in ids]
    assert bpe.counts_of(["", ""]) == [0, 0] and bpe.ids_of([]) == []


def test_token_counts_of_odd_rows(odd, odd_rows, library):
    rows = table(token_counts(odd, BPE, limit=100))
    wanted = sorted(
        (str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in odd_rows
    )
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == wanted


def test_empty_tables(empty):
    assert token_counts(empty, BPE).count() == 0
    assert pack(empty, BPE).count() == 0
    assert sentencepiece_encode(empty, MODEL).count() == 0


def test_packing_is_gapless_and_whole(odd, odd_rows, library):
    rows = table(pack(odd, BPE, capacity=256))
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    wanted = []
    for i, t in odd_rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), 256)):
            wanted.append((str(i), k, a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes())))
    names = ("piece", "start", "length", "ids_crc32")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in rows) == sorted(wanted)
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // 256) + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(rng.choice([1, 5, 300])):
        counts[rng.randint(1, 2048)] = rng.choice([1, 2, 50, 5000])
    runs = packing_plan(counts, 2048)
    seen: dict = {}
    for items, times in runs:
        assert sum(length * n for length, n in items) <= 2048
        for length, n in items:
            seen[length] = seen.get(length, 0) + n * times
    assert seen == counts
    # first-fit decreasing, one piece at a time, as the plain measure
    if sum(counts.values()) < 3000:
        gaps: list[int] = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                i = next((i for i, g in enumerate(gaps) if g >= length), None)
                if i is None:
                    gaps.append(2048 - length)
                else:
                    gaps[i] -= length
        assert sum(times for _, times in runs) <= len(gaps) * 1.02 + 1


def test_best_filling_is_the_best():
    assert best_filling([7, 5, 3], [1, 2, 9], 10) in ([1, 0, 1], [0, 2, 0])
    assert best_filling([7], [0], 10) == [0]


def test_pieces_cut_only_long_documents(odd):
    pieces = table(token_pieces(odd, BPE, 2048))
    assert {r["length"] for r in pieces if r["start"]} and all(r["length"] <= 2048 for r in pieces)


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_scan_is_the_librarys_encoding(processor):
    model, decoder = Pieces(MODEL), Decoder(MODEL)
    texts = [*some_texts(400), "   hello  world ", "x" * 300, " " * 50 + "x", "the" * 100, prose(9, 200)]
    for text in texts:
        ids = processor.encode(text)
        raw = model.encode(text)
        assert raw == np.array(ids, dtype="<u4").tobytes(), text
        assert decoder.decode(raw) == processor.decode(ids), text


@pytest.mark.parametrize("size", [5, 16, 37])
def test_chunks_join_to_the_same_ids(spark, processor, size):
    texts = [*some_texts(60), "the" * 100, "▁" * 40, prose(4, 100), "x" * 200, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sentencepiece_encode(docs, MODEL, giant=1, chunk=size).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert bytes(row["ids"]) == np.array(processor.encode(texts[row["doc_id"]]), dtype="<u4").tobytes(), row["text"]


def test_relations_composed_in_pairs_give_the_one_path(spark):
    rng, rows, wanted = random.Random(3), [], set()
    for text, chunks in enumerate([1, 2, 3, 4, 5, 8, 13]):
        path = [f"s{rng.randrange(4)}" for _ in range(chunks + 1)]
        for chunk in range(chunks):  # other pairs enter by states that nothing leads to: one path only goes through
            pairs = {(path[chunk], path[chunk + 1])} | {(f"n{chunk}", f"s{i}") for i in range(4)}
            rows += [(text, chunk, chunks - 1, a, b) for a, b in pairs if chunk or a == path[0]]
            wanted.add((text, chunk, path[chunk], path[chunk + 1]))
    relations = spark.createDataFrame(rows, "row long, chunk long, last long, entry string, leave string")
    found = chosen_states(relations, 13).select("row", "chunk", "entry", "leave").collect()
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted


def test_neighbours_fit_as_merging_says():
    model, rng = Pieces(MODEL), random.Random(5)
    pieces = list(model.ids)
    for _ in range(20_000):
        whole = rng.choice(pieces)
        at = rng.randrange(len(whole) + 1)
        for pair in ((rng.choice(pieces), rng.choice(pieces)), (whole[:at], whole[at:])):
            if pair[1] in model.ids and (not pair[0] or pair[0] in model.ids):
                assert model.fit(pair) == model.fit_by_merging(pair), pair


def test_encode_and_decode_odd_rows(odd, odd_rows, processor):
    rows = table(sentencepiece_decode(sentencepiece_encode(odd, MODEL, giant=500, chunk=64), MODEL))
    wanted = sorted((str(i), np.array(processor.encode(t or ""), dtype="<u4").tobytes()) for i, t in odd_rows)
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in rows) == wanted
    assert all(r["decoded"] == r["text"].replace("▁", " ") for r in rows)
