"""Quality by compression: two zstandard dictionaries, one of good and one of bad labelled text.

A text is compressed in blocks with either dictionary; the difference of the two sizes over the size of the text says
which kind of text it is closer to (near nothing for text that repeats itself, which packs well with either), and a
logistic curve fitted on labelled rows the dictionaries have not seen makes it a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formsift.llm import base

BLOCK = 512
LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    shift: float

    def scorer(self):
        differ = compressed_difference(self.good, self.bad)
        return lambda text: 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * differ(text) + self.shift))))


def compressed_difference(good: bytes, bad: bytes):
    """A function of a text: (size with the bad dictionary - size with the good one) / size of the text, 0 if empty."""
    import zstandard

    def packer(raw: bytes):
        kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        words = zstandard.ZstdCompressionDict(raw, dict_type=kind)
        words.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    with_good, with_bad = packer(good), packer(bad)

    def differ(text: str) -> float:
        raw = text.encode("utf-8", "surrogatepass")
        a = b = 0
        for at in range(0, len(raw), BLOCK):
            block = raw[at : at + BLOCK]
            a += len(with_good(block))
            b += len(with_bad(block))
        return (b - a) / len(raw) if raw else 0.0

    return differ


def fit_quality(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = 1500, longest: int = 20_000,
    dictionary_bytes: int = 262_144, key: str = "doc_id", text: str = "text", label: str = "quality", parts: int = 5,
) -> QualityModel:
    """Fits on a bounded sample of labelled rows: rows_per_class of each label at most, whole texts.

    Rows whose crc32 of the key is divisible by parts are never used, nor rows without label or with a text that is
    empty or of more than `longest` characters; the sample is the first by hash of the key. A third of it, not seen by the dictionaries, calibrates the score with the labels'
    true shares. Without both labels the model knows the share of good rows only.
    """
    marks = labels.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where(
        "doc_id is not null and label in (0, 1)"
    ).where(~base.held_out(F.col("doc_id"), parts)).dropDuplicates(["doc_id"])
    shares = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    total = sum(shares.values())
    order = F.xxhash64("doc_id")
    picked = None
    for one in (0, 1):
        own = marks.where(F.col("label") == one).orderBy(order, "doc_id").limit(rows_per_class)
        picked = own if picked is None else picked.unionByName(own)
    # at most 2 * rows_per_class rows
    rows = base.texts_only(docs, key, text).join(F.broadcast(picked), "doc_id")
    fit = F.length("text").between(1, longest)
    sample = rows.select("doc_id", "label", "text").where(fit).dropDuplicates(["doc_id"]).collect()
    sample.sort(key=lambda r: (r.doc_id * 0x9E3779B97F4A7C15 % 2**64, r.doc_id))
    texts = {one: [r.text for r in sample if r.label == one] for one in (0, 1)}
    prior = math.log((shares.get(1, 0) + 1) / (shares.get(0, 0) + 1)) if total else 0.0
    if min(map(len, texts.values())) < 3:
        return QualityModel(b"", b"", 0.0, prior)
    learn, check = {}, {}
    for one, own in texts.items():
        cut = max(1, len(own) * 2 // 3)
        learn[one], check[one] = own[:cut], own[cut:]
    size = min(dictionary_bytes, *(sum(len(t.encode()) for t in learn[one]) for one in (0, 1)))
    good, bad = (dictionary(learn[one], size) for one in (1, 0))
    differ = compressed_difference(good, bad)
    x = np.array([differ(t) for one in (0, 1) for t in check[one]])
    y = np.array([one for one in (0, 1) for _ in check[one]], dtype=float)
    weight = np.where(y == 1, shares[1] / total / max(1, len(check[1])), shares[0] / total / max(1, len(check[0])))
    slope, shift = logistic(x, y, weight * len(x))
    return QualityModel(good, bad, slope, shift)


def dictionary(texts: list[str], size: int) -> bytes:
    """A trained dictionary, or plain text where there is too little to train on."""
    import zstandard

    samples = [raw[at : at + BLOCK] for raw in (t.encode("utf-8", "surrogatepass") for t in texts) for at in range(0, len(raw), BLOCK)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and shift of the weighted logistic curve by Newton steps; a small ridge keeps separable data finite."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = 0.3, key: str = "doc_id", text: str = "text", parts: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from its whole text alone; a map without any shuffle.

    An empty or null text has the score of the label shares; a null key is not held out; repeated rows give repeated
    rows; an empty table gives an empty one.
    """

    @base.tidy
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = base.held(("quality", model.good, model.bad), model.scorer)
        for batch in batches:
            for part in base.slices(batch):
                scores = pa.array([score(t) for t in part.column("text").to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), scores], ["doc_id", "score"])

    rows = base.texts_only(docs, key, text).mapInArrow(scored, "doc_id long, score double")
    return rows.select(
        "doc_id", base.held_out(F.col("doc_id"), parts).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows whose whole text scores at least the threshold, with all their columns; a map without any shuffle."""

    @base.tidy
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = base.held(("quality", model.good, model.bad), model.scorer)
        for batch in batches:
            for part in base.slices(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                yield part.filter(pa.array([score(t or "") >= threshold for t in texts], pa.bool_()))

    base.short_batches(docs.sparkSession)
    return docs.mapInArrow(chosen, docs.schema)
