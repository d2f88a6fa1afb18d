"""SentencePiece encoding as a max-plus scan over boundary states, and decoding.

A segmentation is a path over places of the text whose steps are pieces. The given model merges pairs by rank, and a
path is its result exactly if each two neighbouring pieces are what merging makes of their joined text. So a step has
weight 0 where that holds and minus infinity where not: one path of weight 0 is left, and the max-plus product of
transfer matrices is the composition of relations between boundary states.

A boundary state at a cut is the piece that ends at or spans it, with the place of its end. A giant text is split into
chunks; each chunk yields the relation between the states at its two cuts, neighbouring relations are composed two by
two in rounds of joins, the states at all cuts follow on the way back, and every chunk is traced on its own between its
two states. Where no piece of the vocabulary holds two neighbouring characters, the boundary is forced; between forced
boundaries a text consists of few distinct runs, which a worker remembers.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsift.llm import base
from formsift.llm.wordbpe import merged

SPACE = "▁"
#: Characters of a chunk, and from how many on a text is split into chunks.
CHUNK = 16_384
GIANT = 2 * CHUNK
#: Stands for a character that is no piece; no model has so many pieces.
NO_PIECE = 0xFFFF
#: Longer runs between forced boundaries are not remembered.
LONG_RUN = 64

State = tuple[str, int]  # a piece and the place of its end
Edge = tuple[str, float]  # a symbol at an end of a piece and the rank of the merge that ends it
INF = float("inf")
NOT_WHOLE: tuple = ()


class Made(dict):
    """Works a value out when it is asked for first; holds a bounded number of the latest ones."""

    def __init__(self, make, bound: int = 700_000):
        super().__init__()
        self.make, self.bound = make, bound
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        if len(self) >= self.bound // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Ranks(dict):
    """Rank and joined text of a pair of symbols, by the joined piece; None if it is no piece."""

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks

    def get(self, pair, default=None):
        joined = pair[0] + pair[1]
        rank = self.ranks.get(joined)
        return default if rank is None else (rank, joined)

    __getitem__ = get


class Pieces:
    """One merge-by-rank SentencePiece model in a worker."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        ranks: dict[str, float] = {}
        for i in range(own.get_piece_size()):
            piece = own.id_to_piece(i)
            if own.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (own.is_control(i) or own.is_unknown(i)):
                self.ids[piece] = i
                if len(piece) > 1:
                    ranks[piece] = -own.get_score(i)
        self.longest = max(map(len, self.ids))
        self.together = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: Every beginning of a piece, with the piece's id where it is a whole one.
        self.starts = dict.fromkeys((p[:i] for p in self.ids for i in range(1, len(p))), -1) | self.ids
        self.pieces = {i: p for p, i in self.ids.items()}
        self.raw_ids = {i: i.to_bytes(4, "little") for i in self.pieces}
        self.follows = Made(self.follow)
        self.words = re.compile(self.word_pattern())
        self.ranks = Ranks(ranks)
        self.fits = Made(self.fit)
        self.edges = Made(self.both_edges)
        self.whole = Made(lambda piece: self.edges[piece] is not NOT_WHOLE)
        self.known = Made(self.ids_of_run, 500_000)

    def both_edges(self, piece: str) -> tuple[list[Edge], list[Edge]] | None:
        """What stands at a piece's left and right end while it is merged, each with the rank of the merge that ends it.

        None if a merge makes a pair of lower rank than its own: ranks then do not tell when a merge happens.
        """
        symbols, ranks = [*piece], self.ranks.ranks
        left, right, last = [], [], -INF
        while len(symbols) > 1:
            found = [(ranks.get(a + b, INF), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))]
            rank, i = min(found)
            if rank == INF:
                return NOT_WHOLE
            if rank < last:
                return None if merged(symbols, self.ranks)[1] == [piece] else NOT_WHOLE
            if i == 0:
                left.append((symbols[0], rank))
            if i == len(symbols) - 2:
                right.append((symbols[-1], rank))
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            last = rank
        return [*left, (piece, INF)], [*right, (piece, INF)]

    def fit(self, pair: tuple[str, str]) -> bool:
        """Whether merging two neighbouring pieces' text gives these pieces; the first may be empty.

        Only what stands on both sides of the seam can merge across it. Both sides change in order of rank, and a pair
        across the seam merges if its rank comes before the merge that ends either; of equal ranks the left one does.
        """
        if not pair[0]:
            return self.whole[pair[1]]
        before, own = self.edges[pair[0]], self.edges[pair[1]]
        if before is NOT_WHOLE or own is NOT_WHOLE:
            return False
        if before is None or own is None:
            return self.fit_by_merging(pair)
        ranks, right, left = self.ranks.ranks, iter(before[1]), iter(own[0])
        (a, a_ends), (b, b_ends) = next(right), next(left)
        while True:
            rank = ranks.get(a + b)
            if rank is not None and rank < a_ends and rank <= b_ends:
                return False
            if a_ends <= b_ends:
                if a_ends == INF:
                    return True
                a, a_ends = next(right)
            else:
                b, b_ends = next(left)

    def fit_by_merging(self, pair: tuple[str, str]) -> bool:
        return merged([*pair[0], *pair[1]], self.ranks)[1] == [p for p in pair if p]

    def word_pattern(self) -> str:
        """Spaces with what follows them up to the next space; letters end before a sign that no piece has after one."""
        after = {b for a, b in self.together if a.isalnum()}
        signs = "".join(map(re.escape, sorted({*"\n.,;:!?*#$%&|()\"'/-"} - after)))
        return f"{SPACE}*[^\\W_]+(?=[{signs}{SPACE}]|\\Z)|{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n"

    # steps of the lattice

    def steps(self, text: str, at: int) -> Iterator[str]:
        """Pieces that begin at a place; a character that is no piece is a step of its own."""
        yield text[at]
        for n in range(2, min(self.longest, len(text) - at) + 1):
            piece = text[at : at + n]
            if text[at + n - 2 : at + n] not in self.together:
                return
            if piece in self.ids and self.whole[piece]:
                yield piece

    def spanning(self, text: str, cut: int) -> list[State]:
        """All states that a path can be in at a cut: pieces that begin before it and end at or after it."""
        return [
            (piece, at + len(piece))
            for at in range(max(0, cut - self.longest), cut)
            for piece in self.steps(text, at)
            if at + len(piece) >= cut
        ]

    def forward(self, text: str, states: list[State], stop: int) -> dict[State, dict[State, int]]:
        """Steps between states that a path can take from the given ones: state -> state before -> entry states as bits.

        A state whose end is at or after stop is not left; of the max-plus product only finite entries are kept.
        """
        into: dict[State, dict[State, int]] = {}
        reached: dict[State, int] = {}
        heap: list[tuple[int, str]] = []
        for i, state in enumerate(states):
            if state not in reached:
                heapq.heappush(heap, (state[1], state[0]))
            reached[state] = reached.get(state, 0) | 1 << i
        while heap:
            at, piece = heapq.heappop(heap)
            if at >= stop:
                continue
            here = reached[piece, at]
            for step in self.steps(text, at):
                if piece and not self.fits[piece, step]:
                    continue
                state = (step, at + len(step))
                if state not in reached:
                    heapq.heappush(heap, (state[1], step))
                    reached[state] = 0
                reached[state] |= here
                into.setdefault(state, {})[piece, at] = here
        self.reached = reached
        return into

    def ids_of_run(self, run: str) -> bytes:
        """Ids of a run between forced boundaries.

        From the one state at its begin, at most one piece ends at each place, so a place that led nowhere is not tried
        again. The longest step is tried first. Pieces are known by their ids here; a character that is no piece fits
        beside everything that is whole.
        """
        starts, follows, n = self.starts, self.follows, len(run)
        path, ends, tried, at = [NO_PIECE], [0], set(), 0
        while at < n:
            found, end = [], at + 1
            code = starts.get(run[at], -1)
            found.append((NO_PIECE if code < 0 else code, end))
            while end < n and (code := starts.get(run[at : end + 1])) is not None:
                end += 1
                if code >= 0:
                    found.append((code, end))
            before = path[-1] << 16
            while found:
                code, end = found.pop()
                if end not in tried and (code == NO_PIECE or follows[before | code]):
                    path.append(code)
                    ends.append(end)
                    tried.add(end)
                    at = end
                    break
            else:
                path.pop()
                ends.pop()
                at = ends[-1]
        if NO_PIECE not in path[1:]:
            return b"".join(map(self.raw_ids.__getitem__, path[1:]))
        return b"".join(
            self.raw_ids[code] if code != NO_PIECE else self.piece_ids(run[end - 1]) for code, end in zip(path[1:], ends[1:], strict=True)
        )

    def follow(self, pair: int) -> bool:
        before, own = pair >> 16, pair & 0xFFFF
        return self.fit(("" if before == NO_PIECE else self.pieces[before], self.pieces[own]))

    def trace(self, into, entry: State, last: State, begin: int) -> bytes:
        """Ids of the pieces after the entry state up to the last one, those that begin at or after `begin` only."""
        out = []
        while last != entry:
            if last[1] - len(last[0]) >= begin:
                out.append(self.piece_ids(last[0]))
            last = next(iter(into[last])) if len(into[last]) == 1 else next(
                s for s in into[last] if s == entry or self.leads(into, s, entry)
            )
        return b"".join(reversed(out))

    def leads(self, into, state: State, entry: State) -> bool:
        todo, seen = [state], set()
        while todo:
            s = todo.pop()
            if s == entry:
                return True
            if s not in seen:
                seen.add(s)
                todo += into.get(s, ())
        return False

    def piece_ids(self, piece: str) -> bytes:
        found = self.ids.get(piece)
        if found is not None:
            return found.to_bytes(4, "little")
        return b"".join(self.bytes[b].to_bytes(4, "little") for b in piece.encode("utf-8", "replace"))

    # runs between forced boundaries

    def runs(self, text: str) -> Iterator[str]:
        """Runs of a text in the model's writing. Words with the space before them, then cut where no piece goes on."""
        for word in self.words.findall(text):
            if len(word) <= LONG_RUN:
                yield word
                continue
            begin = 0
            for at in range(1, len(word)):
                if word[at - 1 : at + 1] not in self.together:
                    yield word[begin:at]
                    begin = at
            yield word[begin:]

    def encode_run(self, run: str) -> bytes:
        return self.known[run] if len(run) <= LONG_RUN else self.ids_of_run(run)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        words = self.words.findall(written(text))
        if words and max(map(len, words)) > LONG_RUN:
            return b"".join(map(self.encode_run, self.runs(written(text))))
        return b"".join(map(self.known.__getitem__, words))

    # chunks of a giant text

    def transfer(self, left: str, body: str, right: str) -> list[tuple[State, State]]:
        """The relation between the states at both cuts of a chunk; places count from the chunk's begin.

        left and right are the text around the chunk, as long as the longest piece at least, or to the text's ends.
        """
        text, first, stop = left + body + right, len(left), len(left) + len(body)
        entries = self.spanning(text, first) or [("", 0)]
        one, other = self.inner(left, body)
        if one is None:
            self.forward(text, entries, stop)
            pairs = self.pairs(entries, stop)
        else:  # forced boundaries inside: every path goes through them, whatever lies between
            self.forward(text, entries, first + one)
            into = self.pairs(entries, first + one)
            entered = {a for a, (_, end) in into if end == first + one}
            self.forward(text, [("", first + other)], stop)
            left_by = {b for _, b in self.pairs([("", first + other)], stop)}
            pairs = [(a, b) for a in entered for b in left_by]
        last = not right
        return [((a[0], a[1] - first), (b[0], b[1] - stop)) for a, b in pairs if not last or b[1] == stop]

    def pairs(self, entries: list[State], stop: int) -> list[tuple[State, State]]:
        ends = [(s, bits) for s, bits in self.reached.items() if s[1] >= stop and s[1] - len(s[0]) < stop]
        return [(entry, s) for s, bits in ends for i, entry in enumerate(entries) if bits >> i & 1]

    def inner(self, left: str, body: str) -> tuple[int | None, int]:
        """The first and the last forced boundary inside a chunk, and not within a piece's length of its begin."""
        forced = (i for i in range(1, len(body)) if body[i - 1 : i + 1] not in self.together)
        one = next(forced, None)
        if one is None:
            return None, 0
        other = next(i for i in range(len(body) - 1, 0, -1) if body[i - 1 : i + 1] not in self.together)
        return one, other

    def traced(self, left: str, body: str, right: str, entry: State, leave: State) -> bytes:
        """Ids of the pieces that begin in the chunk, between its two states."""
        text, first = left + body + right, len(left)
        stop = first + len(body)
        entry, leave = (entry[0], entry[1] + first), (leave[0], leave[1] + stop)
        one, other = self.inner(left, body)
        if one is None:
            return self.trace(self.forward(text, [entry], stop), entry, leave, first) if entry[1] < stop else b""
        into = self.forward(text, [entry], first + one)
        head = b"" if entry[1] == first + one else self.trace(
            into, entry, next(s for s in into if s[1] == first + one), first
        )
        start = ("", first + other)
        tail = self.trace(self.forward(text, [start], stop), start, leave, first)
        return head + b"".join(map(self.encode_run, self.runs(body[one:other]))) + tail


def written(text: str) -> str:
    """A text as the model writes it: spaces become a visible sign, one of which goes before the text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Decoder:
    """The bytes that each id stands for; control pieces stand for none."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i)
            else b"" if own.is_control(i) or own.is_unknown(i)
            else own.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(own.get_piece_size())
        ]

    def decode(self, raw: bytes) -> str:
        """The text that ids stand for: byte pieces join to characters, the first space is the model's own."""
        text = b"".join(map(self.bytes.__getitem__, memoryview(raw).cast("I"))).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def decoder_of(path: str) -> Decoder:
    return Decoder(path)


def pieces_of(path: str) -> Pieces:
    return base.held(("pieces", path), lambda: Pieces(path))


def chosen_states(relations: DataFrame, chunks: int) -> DataFrame:
    """row, chunk, entry, leave: the states at both cuts of every chunk on the one path through each text.

    relations holds the pairs of states (entry, leave) of each chunk, and the text's last chunk. Neighbours are
    composed two by two, in as many rounds as it takes to halve the longest text's chunks to one: the max-plus product
    of two relations is their join on the state at the cut between them. Then the way back, level by level: a chosen
    pair tells the state in its middle, as no two paths lead between the same two states.
    """
    levels: list[DataFrame] = []
    now = relations
    while chunks > 1:
        left = now.where("chunk % 2 = 0").withColumnRenamed("leave", "middle")
        right = now.where("chunk % 2 = 1").select(
            "row", (F.col("chunk") - 1).alias("chunk"), F.col("entry").alias("middle"), "leave"
        )
        both = left.join(right, ["row", "chunk", "middle"])
        alone = left.where("chunk = last").withColumnsRenamed({"middle": "leave"}).withColumn("middle", F.lit(None).cast("string"))
        composed = both.unionByName(alone).withColumns({"chunk": F.expr("chunk div 2"), "last": F.expr("last div 2")})
        levels.append(base.staged(composed, "composed"))
        now = levels[-1].drop("middle")
        chunks = (chunks + 1) // 2
    chosen = now.select("row", "chunk", "entry", "leave")
    for level in reversed(levels):
        halves = F.expr(
            "IF(middle IS NULL, array(struct(2 * chunk AS chunk, entry, leave)), array("
            "struct(2 * chunk AS chunk, entry, middle AS leave), struct(2 * chunk + 1 AS chunk, middle AS entry, leave)))"
        )
        chosen = level.join(chosen, ["row", "chunk", "entry", "leave"], "left_semi").select("row", F.inline(halves))
    chosen = base.staged(chosen, "states")
    for level in levels:
        base.discard(level)
    return chosen


def sentencepiece_encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", giant: int = GIANT, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, text, ids for every row: its whole text's ids as little-endian 32-bit numbers, without begin or end.

    model is the path of a merge-by-rank model with byte pieces, found at that path on every worker. Texts of `giant`
    characters or more are dealt out in chunks. A null text counts as empty and has no ids; a null key stays null;
    repeated rows give repeated rows; an empty table gives an empty one; other columns are not read.
    """
    rows = base.texts_only(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    long = F.length("text") >= giant

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for part in base.slices(batch):
                ids = [pieces.encode(t) for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), part.column("text"), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = pieces_of(model).longest + 1
        for batch in batches:
            for row, doc, raw in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                whole = written(raw)
                for at in range(0, len(raw), chunk):
                    begin, end = at + bool(at), at + chunk + 1  # the model's own space goes before the text
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row]), pa.array([doc], pa.int64()), pa.array([at // chunk]),
                            pa.array([whole[max(0, begin - around) : begin]]), pa.array([raw[at : at + chunk]]),
                            pa.array([whole[end : end + around]]),
                        ],
                        ["row", "doc_id", "chunk", "before", "text", "after"],
                    )

    parts = "row long, doc_id long, chunk long, before string, text string, after string"
    chunks = base.staged(rows.where(long).mapInArrow(cut, parts), "chunks").repartition("row", "chunk")

    def body(number: int, raw: str) -> str:
        return written(raw) if number == 0 else raw.replace(" ", SPACE)

    def related(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for r in batch.to_pylist():
                own = pieces.transfer(r["before"], body(r["chunk"], r["text"]), r["after"])
                columns = [[r["row"]] * len(own), [r["chunk"]] * len(own)]
                states = [[json.dumps(pair[side]) for pair in own] for side in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), *(pa.array(c, pa.string()) for c in states)],
                    ["row", "chunk", "entry", "leave"],
                )

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            ids = []
            for r in batch.to_pylist():
                entry, leave = (tuple(json.loads(r[side])) for side in ("entry", "leave"))
                ids.append(pieces.traced(r["before"], body(r["chunk"], r["text"]), r["after"], entry, leave))
            columns = [*(batch.column(c) for c in ("row", "doc_id", "chunk", "text")), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "chunk", "text", "ids"])

    def joined(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        return pa.table({
            "doc_id": rows["doc_id"].slice(0, 1),
            "text": pa.array(["".join(rows["text"].to_pylist())], pa.string()),
            "ids": pa.array([b"".join(rows["ids"].to_pylist())], pa.binary()),
        })

    lasts = chunks.groupBy("row").agg(F.max("chunk").alias("last"))
    most = chunks.agg(F.coalesce(F.max("chunk"), F.lit(-1))).first()[0] + 1
    relations = base.staged(chunks.mapInArrow(related, "row long, chunk long, entry string, leave string").join(lasts, "row"), "relations")
    states = chosen_states(relations, most)
    base.discard(relations)
    done = chunks.join(states, ["row", "chunk"]).select(*chunks.columns, "entry", "leave")
    ids = done.mapInArrow(traced, "row long, doc_id long, chunk long, text string, ids binary")
    whole = "doc_id long, text string, ids binary"
    giants = ids.groupBy("row").applyInArrow(joined, whole)  # one text, as it came in one row
    return rows.where(~long).mapInArrow(encoded, whole).unionByName(giants)


def sentencepiece_decode(rows: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; null ids give null, no ids the empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(model)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                own = [None if raw is None else decoder.decode(raw) for raw in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own, pa.string())], [*part.schema.names, to])

    return rows.mapInArrow(decoded, T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())]))
