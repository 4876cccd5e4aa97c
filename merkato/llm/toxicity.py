"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what sets toxic text apart: the words of toxic
documents that hold a byte fragment far more usual there than in ordinary ones. A window (one word with its
blanks) is compressed with both; the distance is how many bytes the toxic dictionary saves. A document's
largest distances and its share of windows over the thresholds go into a logistic calibration, fitted on
labelled rows that trained no dictionary.

Choosing the toxic dictionary's words by fragments departs from training it on toxic text as it is, and windows are single
words: toxic documents are ordinary text but for a few words, and dictionaries trained on all of it hardly differ.
The README gives figures for both.

Only a bounded sample of labelled rows trains (``SAMPLE``, chosen by a hash of the id, whole texts); rows whose
crc32 of the id is 2 modulo 4 are held out from all of it. Every document is scored, whole. Workers remember the
distance of up to ``REMEMBERED`` words.

Defined cases: a null or empty text has no windows and gets the calibration's value for none; where labels of one kind
are missing, every score is the share of toxic labels (0 without labels); repeated rows are scored one by one;
an empty table gives no rows; a null id is never held out; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship, worker_memory

#: Bounds of the sample: toxic and ordinary rows for the dictionaries, and for the calibration.
SAMPLE = {"toxic": 800, "ordinary": 3_000, "toxic calibration": 400, "ordinary calibration": 1_600}
#: Dictionary bytes, compression level, fragment bytes; how much more usual a fragment is, in how many documents.
DICTIONARY, LEVEL, FRAGMENT, CONTRAST, LEAST_DOCUMENTS = 16_384, 3, 5, 8.0, 4
#: Distances (bytes saved) whose share of windows is a feature; score from which a document is predicted toxic.
THRESHOLDS, PREDICTED = (2, 3, 4), 0.3
REMEMBERED = 1_000_000
#: Behind every window: zstandard begins no match in the last bytes of its input, where short words end.
TAIL = bytes(12)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _fragments(word: bytes) -> set[bytes]:
    word = b" " + word + b" "
    return {word[k:k + FRAGMENT] for k in range(len(word) - FRAGMENT + 1)}


def _document_counts(texts: list[list[bytes]]) -> Counter:
    counts = Counter()
    for own in texts:
        counts.update(set().union(*map(_fragments, set(own))) if own else ())
    return counts


def _dictionary(chosen: list[bytes]) -> bytes:
    """A trained dictionary, or the plain bytes where there is too little to train on."""
    samples = [b" " + b" ".join(chosen[k:k + 16]) + b" " for k in range(0, len(chosen), 16)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


class Distances:
    """Bytes that the toxic dictionary saves over the ordinary one, word by word."""

    def __init__(self, toxic: bytes, ordinary: bytes, remembered: int = REMEMBERED):
        self.sizes = []
        for content in (toxic, ordinary):
            made = zstandard.ZstdCompressionDict(content)
            made.precompute_compress(level=LEVEL)
            self.sizes.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        self.remembered, self.known = remembered, {}

    def features(self, text: str | None) -> list[float]:
        own = words(text)
        if not own:
            return [0.0] * (2 + len(THRESHOLDS))
        if len(self.known) > self.remembered:
            self.known.clear()
        for word in set(own).difference(self.known):
            window = b" " + word + b" " + TAIL
            self.known[word] = len(self.sizes[1](window)) - len(self.sizes[0](window))
        found = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
        top = np.sort(found)[::-1][:3]
        shares = [100.0 * np.count_nonzero(found >= t) / len(own) for t in THRESHOLDS]
        return [float(top[0]), float(top.sum()) / 3, *[min(s, 10.0) for s in shares]]


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: list[float]  # of the features, then the constant
    prior: float

    def usable(self) -> bool:
        return bool(self.weights)


def _logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.c_[features, np.ones(len(features))]
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * features.shape[1] + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame) -> dict[str, list[str]]:
    """Texts of the bounded sample. Ids are chosen from the labels alone; only their rows of ``docs`` are fetched."""
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).withColumn("part", part).where("part != 2")
    chosen = []
    for name, most in SAMPLE.items():
        parts = F.col("part") == 0 if "calibration" in name else F.col("part") != 0
        rows = usable.where(parts & (F.col("toxic") == (1 if name.startswith("toxic") else 0)))
        chosen.append(rows.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most).select(
            F.col("doc_id").alias("id"), F.lit(name).alias("use")))
    ids = chosen[0]
    for more in chosen[1:]:
        ids = ids.unionByName(more)
    texts: dict[str, dict[int, str]] = {name: {} for name in SAMPLE}
    # Fewer than six thousand ids, whatever the input.
    for row in docs.join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("id", "use", "text").toLocalIterator():
        texts[row.use][row.id] = max(texts[row.use].get(row.id, ""), row.text or "")
    return {use: [found[i] for i in sorted(found)] for use, found in texts.items()}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = _sample(docs, labels)
    counts = {use: len(texts) for use, texts in sample.items()}
    toxic_labels = counts["toxic"] + counts["toxic calibration"]
    prior = toxic_labels / max(sum(counts.values()), 1)
    if not all(counts.values()):
        return Model(b"", b"", [], prior)
    toxic, ordinary = ([words(t) for t in sample[use]] for use in ("toxic", "ordinary"))
    there, elsewhere = _document_counts(toxic), _document_counts(ordinary)
    telling = {f for f, n in there.items() if n >= min(LEAST_DOCUMENTS, len(toxic)) and (n + 0.5) / (
        len(toxic) + 1) > CONTRAST * (elsewhere[f] + 0.5) / (len(ordinary) + 1)}
    chosen = [w for own in toxic for w in sorted(set(own)) if not telling.isdisjoint(_fragments(w))]
    if not chosen:
        return Model(b"", b"", [], prior)
    model = Model(_dictionary(chosen), _dictionary([w for own in ordinary for w in own]), [], prior)
    distances = Distances(model.toxic, model.ordinary)
    texts = sample["toxic calibration"] + sample["ordinary calibration"]
    marks = np.array([1.0] * counts["toxic calibration"] + [0.0] * counts["ordinary calibration"])
    model.weights = _logistic(np.array([distances.features(t) for t in texts]), marks).tolist()
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``(doc_id, held_out, score, predicted)``."""
    key, usable = f"toxicity {uuid.uuid4().hex}", model.usable()

    def run(batches):
        if usable:
            memory = worker_memory()
            if key not in memory:
                for old in [k for k in memory if str(k).startswith("toxicity ")]:
                    del memory[old]
                memory[key] = Distances(model.toxic, model.ordinary)
            weights = np.array(model.weights)
        for batch in batches:
            texts = batch.column("text")
            if usable:
                x = np.array([memory[key].features(t.as_py()) + [1.0] for t in texts]).reshape(-1, len(weights))
                scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            else:
                scores = np.full(len(texts), model.prior)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


ship(__name__)
