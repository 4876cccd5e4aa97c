"""Importance resampling towards a target distribution, by hashed word n-grams.

Features are all runs of one to ``LONGEST`` words; each falls into one of ``BUCKETS`` by its CRC-32. Two passes read the
texts: the first counts the buckets of all documents (each task adds up one array and emits its non-zero
entries), the second looks every feature up in the array of gains ``floor(1000 ln(target share / document share))`` and adds
them up. The score is that weight plus Gumbel noise drawn from the id, and is written out. The ``k`` highest
scores then are a draw without replacement with probabilities in proportion to the exponentials of the weights.

The cutoff is found by bisection on numbers, never by sorting all rows: each job counts the rows at or over a few
trial scores, evenly spaced between the bounds known so far (``TRIALS`` + 1 halves the range several times a job), until
the score of row ``k`` is known; where rows tie on it, the same search runs on their ids, and on a row number
where even those tie. Only what was drawn is range-partitioned, for the ranks.

The driver holds the two arrays of ``BUCKETS`` sums and the counts of the trials, whatever the input.

Defined cases: a null or empty text has no features, weight 0 and just its noise as score; a null id hashes as no
digits and comes last among ties; repeated rows are rows of their own, and where more of them tie than can be drawn the first
by stored row number are; without target texts every gain compares with an even target; an empty table
gives no rows; a very long text is held once with its words; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.functions.ordering import number_rows
from merkato.llm.common import ship, store

#: Fixed values of the contract: buckets, words in the longest feature, hash seed, words a drawn document has, percent drawn.
BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 3, 42, 20, 5
#: Trial values that one count job tests.
TRIALS = 15
#: Words whose features are hashed in one go: bounds the arrays of a very long text.
PART = 1 << 18

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LAST_ID = (1 << 63) - 1


def words(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and whatever is not ASCII, with A-Z lower-cased."""
    return _WORD.findall(text.lower()) if text else []


def features(own: list[bytes]):
    """CRC-32 of all features of a text's words, in arrays: a run's checksum goes on from that of the run one word shorter."""
    for first in range(0, len(own), PART):
        part = own[first:first + PART + LONGEST - 1]
        starts = min(PART, len(own) - first)
        spaced = [b" " + w for w in part]
        sums = list(map(crc32, part[:starts]))
        yield np.fromiter(sums, np.int64, len(sums))
        for more in range(1, LONGEST):
            sums = list(map(crc32, spaced[more:], sums))
            yield np.fromiter(sums, np.int64, len(sums))


def feature_count(n: int) -> int:
    return sum(max(n - more, 0) for more in range(LONGEST))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for sums in features(words(text.as_py())):
                    total += np.bincount(sums % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = _texts(rows).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in found.collect():  # one row per bucket
        counts[row.bucket] = row.n
    return counts


def _texts(rows: DataFrame, *others: Column) -> DataFrame:
    return rows.select(*others, F.col("text").cast("string").cast("binary").alias("text"))


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight, in thousandths."""
    buckets, all_s, all_t = len(documents), int(documents.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (all_s + buckets)) / float((s + 1) * (all_t + buckets))))
        for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every document."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches):
        for batch in batches:
            ids, made = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                own = words(text.as_py())
                weight = sum(int(gain[sums % len(gain)].sum()) for sums in features(own))
                made.append((len(own), feature_count(len(own)), weight, weight + noise(doc_id, seed)))
            columns = np.array(made, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names=names)

    rows = _texts(docs, F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def cutoff(rows: DataFrame, key: Column, k: int, trials: int = TRIALS) -> tuple[int, int]:
    """The ``k``-th smallest value of a whole-number column, and how many rows are below it. ``1 <= k <= rows``."""
    values = rows.select(key.alias("key"))
    low, high = values.agg(F.min("key"), F.max("key")).first()
    below = 0  # rows under low
    while low < high:
        # Trials split low..high; a row count at or under each tells between which two the value lies.
        steps = sorted({low + (high - low) * t // (trials + 1) for t in range(1, trials + 1)})
        at_most = values.agg(*[F.count(F.when(F.col("key") <= step, 1)).alias(f"n{i}") for i, step in enumerate(steps)]).first()
        for step, count in zip(steps, at_most, strict=True):
            if count >= k:
                high = step
                break
            low, below = step + 1, count
    return low, below


def draw(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``rank`` 1 to ``k`` by score from the highest, then id, then ``row``; null for those not drawn.

    ``rows`` must be stored: it is read once for each count job.
    """
    order = [-F.col("score"), F.coalesce("doc_id", F.lit(_LAST_ID)), F.col("row")]
    if k <= 0:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    taken, tied, left = F.lit(False), F.lit(True), k
    for key in order:
        value, below = cutoff(rows.where(tied), key, left)
        taken = taken | (tied & (key < value))
        tied = tied & (key == value)
        left -= below
        if rows.where(tied).count() == left:
            break
    drawn = number_rows(rows.where(taken | tied), order, "rank")
    return drawn.unionByName(rows.where(~(taken | tied)).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per document: ``(doc_id, n_features, weight, score, rank)``.

    Of the documents with at least ``least_words`` words, ``percent`` percent are drawn and ranked.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = store(scored(docs, gain, seed).withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    able = rows.where(F.col("n_words") >= least_words)
    ranked = draw(able, percent * able.count() // 100)
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


ship(__name__)
