"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space.

Every text becomes a vector of hashed byte pairs (what characters stand together), hashed words and a few shape
counts.  A bounded sample of labelled documents fixes feature weights and a latent space (leading right singular
vectors); its projected, unit-length vectors and labels are broadcast, their size bounded by ``SAMPLE`` x ``LATENT``.
Each document's cosine to every sampled vector is computed exactly, in blocks of one matrix product; the ``NEIGHBOURS``
most similar vote with their labels, weighted by a power of their similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import mix, words_of

#: Labelled documents the model is fitted on, at most.  The documents with the smallest scrambled ids are taken.
SAMPLE = 4000
PAIRS, WORDS, SHAPES = 1024, 512, 24
FEATURES = PAIRS + WORDS + SHAPES
LATENT = 64
NEIGHBOURS = 25
#: Weight of a vote: similarity to this power.
SHARPNESS = 8
#: Documents per matrix product.
BLOCK = 256
#: Bytes of a text looked at in one step; longer texts are counted piece by piece, never cut off.
PIECE = 1 << 20

_PAIR_CELL = (mix(np.arange(65536, dtype=np.uint64), 11) % np.uint64(PAIRS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Counts of one whole text; a missing text counts as empty."""
    out = np.zeros(FEATURES, np.float32)
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(raw), PIECE):
        piece = raw[at:at + PIECE + 1].astype(np.int32)
        out[:PAIRS] += np.bincount(_PAIR_CELL[piece[:-1] * 256 + piece[1:]], minlength=PAIRS)
    words = words_of(text)
    cells = np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words))
    out[PAIRS:PAIRS + WORDS] = np.bincount(cells % WORDS, minlength=WORDS)
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    shape = out[PAIRS + WORDS:]
    shape[:5] = (np.count_nonzero(cells[1:] == cells[:-1]) / n, 1 - len(np.unique(cells)) / n,
                 float(lengths.mean()) / 16 if len(words) else 0.0, sum(w.isupper() for w in words) / n,
                 sum(not w.isalnum() for w in words) / n)
    shape[6 + min(16, len(words).bit_length())] = 0.5
    return out


@dataclass
class Model:
    """What the votes need; every array is bounded by the constants above."""
    weights: np.ndarray
    centre: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (_scaled(counts, self.weights) - self.centre) @ self.axes
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        return latent / np.where(norm > 0, norm, 1)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of the similarity-weighted votes for label 1; the prior where nothing is similar."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        cosines = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.vectors))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, 1), 0, 1) ** SHARPNESS
        total = weight.sum(1)
        votes = (weight * self.labels[near]).sum(1)
        return np.where(total > 1e-9, votes / np.maximum(total, 1e-9), self.prior)


def _scaled(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted log counts, each group of features of unit length, shapes as they are."""
    out = np.log1p(counts) * weights
    for a, b in ((0, PAIRS), (PAIRS, PAIRS + WORDS)):
        norm = np.linalg.norm(out[:, a:b], axis=1, keepdims=True)
        out[:, a:b] /= np.where(norm > 0, norm, 1)
    out[:, PAIRS + WORDS:] = counts[:, PAIRS + WORDS:]
    return out


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """The latent space and its labelled vectors; without labelled rows every score is one half."""
    if not len(counts):
        return Model(np.ones(FEATURES, np.float32), np.zeros(FEATURES, np.float32),
                     np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    seen = np.count_nonzero(counts, axis=0)
    weights = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + np.float32(0.3)
    scaled = _scaled(counts, weights)
    centre = scaled.mean(0) * np.float32(0.5)
    scaled -= centre
    values, axes = np.linalg.eigh((scaled.T @ scaled).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :LATENT]).astype(np.float32)
    model = Model(weights, centre, axes, np.zeros((0, 1), np.float32), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.project(counts).astype(np.float32)
    return model


def _is_held_out(doc_id: str):
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out third.

    Rows without id, label or with a label other than 0 and 1 are left out; of several labels of one id the
    smallest counts, of several texts the first in byte order.  Only ids and feature counts reach the driver.
    """
    spark = documents.sparkSession
    chosen = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~_is_held_out("doc_id"))
              .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample).collect())
    if not chosen:
        return fit(np.zeros((0, FEATURES), np.float32), np.zeros(0))
    known = spark.createDataFrame([(int(r["_id"]), int(r["_label"])) for r in chosen], "_id long, _label int")
    picked = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text")).join(
        F.broadcast(known), "_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marks = batch.column("_id"), batch.column("_text"), batch.column("_label")
            blobs = []
            for text in texts:
                row = features(text.as_py())
                at = np.flatnonzero(row).astype(np.int16)
                blobs.append(at.tobytes() + row[at].tobytes())
            yield pa.RecordBatch.from_arrays([ids, marks, pa.array(blobs, pa.binary())], ["_id", "_label", "_row"])

    rows = picked.select("_id", "_text", "_label").mapInArrow(count, "_id long, _label int, _row binary")
    rows = sorted(rows.groupBy("_id").agg(F.min("_label").alias("_label"), F.min("_row").alias("_row")).collect(),
                  key=lambda r: r["_id"])
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for i, row in enumerate(rows):
        n = len(row["_row"]) // 6
        counts[i, np.frombuffer(row["_row"], np.int16, n)] = np.frombuffer(row["_row"], np.float32, n, 2 * n)
    return fit(counts, np.array([r["_label"] for r in rows], np.float64))


def scored(documents: DataFrame, model: Model, text: str = "text", score: str = "score",
           predicted: str = "predicted") -> DataFrame:
    """All columns of the documents and ``score`` (double) and ``predicted`` (int), under these or other names.

    Columns of the two names are replaced.  A missing text is scored as an empty one; equal texts have equal scores.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kept = documents.drop(score, predicted)
    schema = kept.withColumns({score: F.lit(0.0), predicted: F.lit(0)}).schema

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                counts = np.stack([features(t.as_py()) for t in block.column(text)])
                # Rounded, so that the order of additions inside a product cannot show.
                scores = np.round(np.clip(model.score(counts), 0, 1), 5)
                columns = [*block.columns, pa.array(scores, pa.float64()),
                           pa.array((scores >= 0.5).astype(np.int32), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*block.schema.names, score, predicted])

    return kept.mapInArrow(vote, schema)


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document, one row per input row.

    ``held_out``: crc32 of the id as text leaves remainder 1 modulo 3 (false for a missing id).  Labels, source, language
    and id are no input of a score.  Empty tables give an empty result; without usable labels all scores are 0.5.
    """
    model = train(documents, labels, sample)
    return scored(documents.select("doc_id", "text"), model).select(
        "doc_id", _is_held_out("doc_id").alias("held_out"), "score", "predicted")
