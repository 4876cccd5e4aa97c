"""Packing token sequences: shortest pack first over the histogram of lengths.

Documents are tokenized where they are read. A document is cut into pieces of the sequence length and one rest.
Whole pieces are sequences of their own. The rests are counted by length, at most ``length - 1`` counts however many
documents there are, and packed on that histogram: lengths are placed longest first, each into the pack pattern
with the most room that holds it, and a pattern stands for as many packs as its count. Every place of
every pattern is then a range of ranks within its length, and pieces find their sequence and offset by their rank.

Ranks come from a range exchange with one total per slice and length, so that a length which a third
of the pieces have is spread over many tasks. The driver sees the histogram and the patterns only.

Defined cases: a null or empty text is the closing id alone; repeated rows (even of one id) are packed
as documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merkato.llm.common import ship, store, worker_memory

#: Fixed values of the contract: ids in a sequence, the id that closes a document.
LENGTH, CLOSING = 2048, 1
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker remembers before it starts anew.
REMEMBERED = 1_200_000


class WordIds:
    """Ids of white-space separated words, each tokenized once as long as it is remembered.

    The tokenizer never joins characters across white space, so a text's ids are its words' ids. A
    text of Latin-1 characters is lower-cased first, which the tokenizer would do to each of them alike, unless that
    makes a marker of the tokenizer.
    """

    def __init__(self, file: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks have the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        # Markers such as <|endoftext|> are ids of their own, matched before letters are lower-cased.
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = frozenset(i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>"))
        # For words of Latin-1 letters, already in lower case: one pre-token each, nothing to normalize.
        self.quick = Tokenizer(self.tokenizer.model)
        self.quick.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Byte-level vocabularies write the bytes that are no visible Latin-1 characters as those from U+0100 on.
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self.visible = {b: 256 + k for k, b in enumerate(hidden) if b != 32}
        self.remembered, self.known = remembered, {}

    def of(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        try:
            text.encode("latin-1")
            lower = text.lower()
            if not any(m in lower for m in self.markers):
                text = lower
        except UnicodeEncodeError:
            pass
        words = text.encode().split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) > self.remembered:
            known.clear()
        self._learn({w for w in words if w not in known})
        return b"".join(map(known.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        plain: dict[str, list[bytes]] = defaultdict(list)  # letters only, perhaps with a full stop or comma behind
        for word in words:
            text = word.decode()
            core = text[:-1] if text[-1] in ".," else text
            if core.isalpha() and (core.isascii() or max(core) <= "\xff"):
                plain[core.lower()].append(word)
            else:
                self.known[word] = self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        stops = {s: self._packed(self.tokenizer.encode(s, add_special_tokens=False).ids) for s in ".,"}
        todo = [c for c in plain if c.encode() not in self.known]
        parts = [todo[k:k + 64] for k in range(0, len(todo), 64)]
        lines = [" ".join(p).encode().decode("latin-1").translate(self.visible) for p in parts]
        for part, made in zip(parts, self.quick.encode_batch_fast(lines), strict=True):
            start, cores, ids = 0, iter(part), made.ids
            for end, i in enumerate(ids, 1):
                if i in self.ends:
                    self.known[next(cores).encode()] = self._packed(ids[start:end])
                    start = end
        for core, forms in plain.items():
            own = self.known[core.encode()]
            for form in forms:
                self.known[form] = own + stops[chr(form[-1])] if form[-1:] in (b".", b",") else own

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, remembered: int = REMEMBERED) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: every document cut at multiples of ``length``.

    ``vocabulary`` is the tokenizer's file; unset, it is found on each worker in the public vocabularies.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64())])
    closing = CLOSING.to_bytes(4, "little")

    def run(batches):
        memory, key = worker_memory(), ("word ids", vocabulary, remembered)
        if key not in memory:  # a worker runs many tasks and keeps what it knows
            import public_tokenizers

            memory[key] = WordIds(vocabulary or public_tokenizers.path(VOCABULARY), remembered)
        known = memory[key]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = memoryview(known.of(text.as_py() or "") + closing)
                count = len(ids) // 4
                rows += [(doc_id, at, min(length, count - at), zlib.crc32(ids[4 * at:4 * (at + length)]), count)
                         for at in range(0, count, length)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows
                else [pa.array([], f.type) for f in schema], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """``(count, lengths)``: packing patterns of the histogram, each pattern's lengths from long to short.

    Lengths are placed from long to short. The packs with the most room take a length first; the packs that are left of a
    pattern when the length runs out stay as they are.
    """
    open_packs: dict[int, list[list]] = defaultdict(list)  # room -> [count, lengths]
    done = []
    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        left = histogram[size]
        while left:
            room = max((r for r in open_packs if open_packs[r]), default=0)
            if room < size:
                open_packs[length].append([left, ()])
                room = length
            count, lengths = open_packs[room].pop()
            taken = min(count, left)
            if count > taken:
                open_packs[room].append([count - taken, lengths])
            left -= taken
            after = (taken, lengths + (size,))
            if room == size:
                done.append(after)
            else:
                open_packs[room - size].append(list(after))
    return done + [(n, lengths) for packs in open_packs.values() for n, lengths in packs]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, first rank, count, first sequence, offset, used)``: ranks of a length and where they go."""
    rows, ranks, sequence = [], defaultdict(int), 0
    for count, lengths in patterns:
        offset = 0
        for size in lengths:
            rows.append((size, ranks[size], count, sequence, offset, sum(lengths)))
            ranks[size] += count
            offset += size
        sequence += count
    return rows


def _ranked(rows: DataFrame) -> DataFrame:
    """Add ``rank``, from 0 within each length, in order of document and start."""
    order = ["length", "doc_id", "start", "ids_crc32"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sliced = store(ranged.withColumn("slice", F.spark_partition_id()).withColumn(
        "position", F.monotonically_increasing_id()), "pieces-in-order")
    firsts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"), F.min("position").alias("first"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("length", "slice", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return sliced.join(firsts, ["length", "slice"]).withColumn(
        "rank", F.col("before") + F.col("position") - F.col("first")).drop("slice", "position", "first", "before")


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Give pieces (as from ``pieces``) their ``sequence_id``, ``offset`` and ``sequence_tokens``."""
    spark = cut.sparkSession
    cut = store(cut, "pieces")
    counted = cut.groupBy("length").count().collect()  # at most ``length`` rows
    whole = sum(r["count"] for r in counted if r["length"] == length)
    patterns = shortest_pack_first({r["length"]: r["count"] for r in counted if r["length"] < length}, length)
    ranked = _ranked(cut)
    table = spark.createDataFrame(
        [(length, 0, whole, 0, 0, length)] * bool(whole)
        + [(size, rank, n, whole + sequence, offset, used) for size, rank, n, sequence, offset, used in places(patterns)],
        "at_length long, first long, count long, sequence long, `offset` long, sequence_tokens long")
    # A few thousand rows: patterns grow with the number of lengths, not of documents.
    fits = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (
        F.col("rank") < F.col("first") + F.col("count"))
    return ranked.join(F.broadcast(table), fits).select(
        *cut.columns, (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset", "sequence_tokens")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens)``."""
    return pack(pieces(docs, vocabulary, length), length)


ship(__name__)
