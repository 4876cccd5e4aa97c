"""Fill-in-middle transformation: two cuts of a text, found through a compressed set of its code-point boundaries.

The UTF-8 bytes of a text have one boundary before every code point and one at the end. They are kept as a set of
byte offsets in the manner of Roaring bitmaps: one container for every 65,536 bytes, held as a sorted array, a bitmap or
a list of runs, whichever takes the fewest bytes, with the cumulative cardinalities of the containers. The
offset of boundary ``k`` is a binary search for its container, then a local select in it. ASCII text is one
run for each container; mixed scripts become bitmaps, sparse starts (wide characters) arrays.

A document's cuts and form come from a hash of its id alone, so any partitioning gives the same rows. Everything
is one pass over the documents without an exchange.

Defined cases: a null text is the empty text and stays plain; a text that holds a sentinel stays plain; a null id hashes as
no digits; equal cuts give an empty middle, and cuts at the ends an empty prefix or suffix; repeated rows are
transformed one by one with equal cuts; bytes that are no UTF-8 are cut where
they would start a code point, and may come back as replacement characters; a very long
text needs its own size once more and at most an eighth of it for the set; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship

#: Fixed values of the contract: sentinels, percent transformed, percent of those with the suffix first, hash seed.
PREFIX, SUFFIX, MIDDLE, RATE, SUFFIX_FIRST, SEED = "<P>", "<S>", "<M>", 90, 20, 1
#: Bytes that one container covers, and bytes of a bitmap for them.
SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8
#: Bytes of texts that go out in one Arrow batch.
BATCH_BYTES = 64 << 20


class ArrayContainer:
    """Sorted offsets."""

    def __init__(self, offsets: np.ndarray):
        self.offsets = offsets.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class BitmapContainer:
    """One bit for every offset, with the number of set bits before each 64-bit word."""

    def __init__(self, marks: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[:len(marks)] = marks
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of consecutive offsets, with the number of offsets before each."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def _container(marks: np.ndarray, count: int):
    """The smallest container for one span, from a 0/1 mark for each of its bytes."""
    edges = np.flatnonzero(np.diff(marks, prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    array, runs = 2 * count, 4 * len(starts)
    if runs <= min(array, BITMAP_BYTES):
        return RunContainer(starts, ends - starts)
    return ArrayContainer(np.flatnonzero(marks)) if array <= BITMAP_BYTES else BitmapContainer(marks)


class BoundarySet:
    """The offsets at which a code point of some UTF-8 bytes starts, and their end."""

    def __init__(self, data: bytes):
        self.containers, counts = [], []
        plain, size = data.isascii(), len(data) + 1
        for first in range(0, size, SPAN):
            length = min(SPAN, size - first)
            if plain:
                self.containers.append(RunContainer(np.zeros(1, np.int64), np.array([length])))
                counts.append(length)
                continue
            part = np.frombuffer(data, np.uint8, min(length, len(data) - first), first)
            marks = np.ones(length, np.int8)  # the end of the text has no byte of its own
            marks[:len(part)] = (part & 0xC0) != 0x80
            count = int(np.count_nonzero(marks))
            if count:
                self.containers.append((first, _container(marks, count)))
                counts.append(count)
        if plain:
            self.containers = [(k * SPAN, c) for k, c in enumerate(self.containers)]
        self.upto = np.cumsum(counts)

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        """The offset of boundary ``k``, counted from 0."""
        at = int(np.searchsorted(self.upto, k, side="right"))
        first, container = self.containers[at]
        return first + container.select(k - (int(self.upto[at - 1]) if at else 0))


def check_sentinels(*sentinels: str) -> None:
    """Sentinels must be told apart wherever texts without them touch them."""
    if len(set(sentinels)) < len(sentinels) or not all(sentinels):
        raise ValueError("sentinels must be different and not empty")
    if any(s[0] in other[1:] for s in sentinels for other in sentinels):
        raise ValueError("the first character of a sentinel must not occur inside a sentinel")


def transform(doc_id: int | None, data: bytes, sentinels: tuple[bytes, bytes, bytes], rate: int = RATE,
              suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """``(code points, form, prefix, middle, output)`` of one text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[k:k + 4]) for k in (0, 4, 8, 12))
    bounds = BoundarySet(data)
    n = len(bounds) - 1
    if not data or h3 % 100 >= rate or any(s in data for s in sentinels):
        return n, "plain", None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = bounds.select(first), bounds.select(second)
    p, s, m = sentinels
    if h4 % 100 < suffix_first:
        return n, "spm", first, second - first, b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    return n, "psm", first, second - first, b"".join((p, data[:a], s, data[b:], m, data[a:b]))


def fill_in_middle(docs: DataFrame, prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE, rate: int = RATE,
                   suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """One row per document: ``(doc_id, n, form, prefix_chars, middle_chars, output)``.

    ``rate`` percent of the documents are cut, ``suffix_first`` percent of those put the suffix before the prefix.
    """
    check_sentinels(prefix, suffix, middle)
    sentinels = tuple(s.encode() for s in (prefix, suffix, middle))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.binary())])

    def run(batches):
        for batch in batches:
            made, held = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                made.append((doc_id, *transform(doc_id, text.as_py() or b"", sentinels, rate, suffix_first, seed)))
                held += len(made[-1][-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
                    made, held = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary").withColumn(
        "output", F.col("output").cast("string"))


def restored(output: Column, form: Column, prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE) -> Column:
    """The text before the transformation, rebuilt from output and form alone."""
    def between(first: str, last: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))

    tail = F.split_part(output, F.lit(middle), F.lit(2))
    return F.when(form == "psm", F.concat(between(prefix, suffix), tail, between(suffix, middle))).when(
        form == "spm", F.concat(between(prefix, middle), tail, between(suffix, prefix))).otherwise(output)


ship(__name__)
