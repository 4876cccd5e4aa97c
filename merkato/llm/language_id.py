"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of a bounded labelled sample recognises every substring of that sample. A text
is parsed greedily with it into phrases, each the longest match from where the last one ended (a byte that the
sample lacks is a phrase of its own). The fewer phrases, the closer the text is to the sample; ``phrases × log2(sample
bytes) / text bytes`` estimates the cross entropy in bits a byte, and the language with the least of it wins.

The automata are made on the driver from the sample and travel as edge lists. A worker lays them out as one dense table
(state × byte class) and parses many texts at once: texts are cut into blocks of ``BLOCK`` bytes, and one array step
moves every block in every language by one byte. No phrase crosses a block; that adds at most one phrase a block,
the same for all languages, and keeps a very long text from holding up the others. Every text is parsed whole, where it
is read, without an exchange.

Texts are lower-cased, and what is not a word character becomes one blank. The sample has at most ``ROWS`` rows of each
language, chosen by a hash of the id among labelled rows that are not held out, and of each row a passage of at most
``PASSAGE`` code points from a place that the hash draws. At most ``LANGUAGES`` languages are learned, the most frequent
first, and all languages share ``TABLE_BYTES`` of table in each worker, which bounds the sample of each further where there are many.

``score`` is how far the runner-up lies behind, as a share of its bits: 0 for a tie, near 1 for a clear case, 1 where one
language alone was learned.

Defined cases: a null text, and one without a letter, is ``und`` with score 0, and so is every text where nothing was
learned; ties go to the smaller language by code point; a null id is never held out; repeated rows are
predicted one by one; letters of scripts that no sample has are phrases of one byte; a very long text needs a few
times its own size; an empty table gives no rows; labels are read only while learning, other columns never.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merkato.llm.common import ship, worker_memory

#: Bounds of the sample: rows of a language, code points of a row, languages, bytes of table in a worker.
ROWS, PASSAGE, LANGUAGES, TABLE_BYTES = 160, 640, 256, 160 << 20
#: Bytes of a block, blocks parsed at once in all languages, bytes of texts gathered before they are parsed.
BLOCK, LANES, GATHERED = 1024, 16_384, 16 << 20

_NO_WORD = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """Lower case, with one blank for whatever lies between words, at both ends too."""
    return b" %s " % _NO_WORD.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class SuffixAutomaton:
    """The smallest automaton that recognises all substrings of some bytes. State 0 is the start."""

    def __init__(self, data: bytes):
        moves, length, link = [{}], [0], [-1]
        last = 0
        for byte in data:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and byte not in moves[at]:
                moves[at][byte] = new
                at = link[at]
            if at >= 0:
                there = moves[at][byte]
                if length[there] == length[at] + 1:
                    link[new] = there
                else:  # the state's longer strings keep it, its shorter ones get one of their own
                    twin = len(moves)
                    moves.append(dict(moves[there]))
                    length.append(length[at] + 1)
                    link.append(link[there])
                    while at >= 0 and moves[at].get(byte) == there:
                        moves[at][byte] = twin
                        at = link[at]
                    link[there] = link[new] = twin
            last = new
        self.states = len(moves)
        self.edges = np.array([(s, b, t) for s, own in enumerate(moves) for b, t in own.items()], np.int32).reshape(-1, 3)


@dataclass
class Model:
    """Per language, in code-point order: the automaton's edges and states, and the bytes of its sample."""

    languages: list[str]
    edges: list[np.ndarray]
    states: list[int]
    sizes: list[int]


class Parser:
    """The automata of all languages as one table, and the parse of many texts with it."""

    def __init__(self, model: Model):
        self.languages = model.languages
        known = np.unique(np.concatenate([e[:, 1] for e in model.edges]))
        self.classes = len(known) + 1  # the last class is of bytes that no sample has
        self.class_of = np.full(256, self.classes - 1, np.uint8 if self.classes <= 256 else np.int64)
        self.class_of[known] = np.arange(len(known))
        table, self.roots, first = [], [], 0
        for edges, states in zip(model.edges, model.states, strict=True):
            # One more state, without any move: behind a byte that the sample lacks. 0 stands for no move.
            own = np.zeros((states + 1, self.classes), np.int32)
            own[edges[:, 0], self.class_of[edges[:, 1]]] = (first + edges[:, 2]) * self.classes + 1
            own[0, own[0] == 0] = (first + states) * self.classes + 1
            table.append(own)
            self.roots.append(first * self.classes)
            first += states + 1
        self.table = np.concatenate(table).reshape(-1)
        self.bits = np.log2(np.maximum(np.array(model.sizes, np.float64), 2.0))
        self.start = np.stack([self.table[r:r + self.classes] for r in self.roots])  # language × class

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of every text (rows) in every language (columns)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = self.class_of[np.frombuffer(b"".join(texts) + bytes(BLOCK), np.uint8)]
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        length = np.minimum(np.repeat(sizes, blocks) - nth * BLOCK, BLOCK)
        found = np.zeros((len(texts), len(self.languages)), np.int64)
        order = np.argsort(-length, kind="stable")
        lanes = max(LANES // len(self.languages), 1)
        for k in range(0, len(order), lanes):
            chosen = order[k:k + lanes]
            np.add.at(found, owner[chosen], self._parse(data, begin[chosen], length[chosen]))
        return found

    def _parse(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Blocks, longest first, with all languages side by side; a step moves the blocks that still have bytes."""
        languages, blocks = len(self.languages), len(begin)
        rows = np.lib.stride_tricks.sliding_window_view(data, BLOCK)[begin].T.copy()  # position × block
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # blocks longer than a position
        state = np.repeat(np.array(self.roots, np.int32)[:, None], blocks, axis=1)
        ends = np.ones((languages, blocks), np.int32)  # the phrase that ends with the block
        for position, n in enumerate(active.tolist()):
            symbols = rows[position, :n]
            moved = self.table.take(state[:, :n] + symbols)
            miss = moved == 0
            ends[:, :n] += miss
            np.copyto(moved, self.start.take(symbols, axis=1), where=miss)
            state[:, :n] = moved - 1
        return ends.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        named, score = ["und"] * len(texts), [0.0] * len(texts)
        at = [k for k, text in enumerate(texts) if text and has_letter(text)]
        if not at:
            return named, score
        data = [plain(texts[k]) for k in at]
        sizes = np.fromiter(map(len, data), np.float64, len(data))
        entropy = self.phrases(data) * self.bits / sizes[:, None]
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(at)), best]
        entropy[np.arange(len(at)), best] = np.inf
        second = entropy.min(axis=1)  # infinite where there is one language
        for k, b, share in zip(at, best.tolist(), (1.0 - least / second).tolist(), strict=True):
            named[k], score[k] = self.languages[b], share
        return named, score


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the CRC-32 of the id is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, rows: int = ROWS, passage: int = PASSAGE, languages: int = LANGUAGES,
          table_bytes: int = TABLE_BYTES) -> Model:
    """A model from a bounded sample of the labelled rows."""
    text, drawn = F.col("text").cast("string"), F.md5(F.col("doc_id").cast("string").cast("binary"))
    labelled = docs.select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    usual = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.char_length("text") - passage, F.lit(0)) + 1).cast("int")
    first = Window.partitionBy("lang").orderBy("drawn", "doc_id", "passage")
    sample = labelled.join(F.broadcast(usual.select("lang")), "lang").select(
        "lang", "doc_id", drawn.alias("drawn"), F.substring(F.col("text"), place + 1, F.lit(passage)).alias("passage")).withColumn(
        "nth", F.row_number().over(first)).where(F.col("nth") <= rows)
    passages: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "nth").toLocalIterator():  # languages × rows passages at most
        if has_letter(row.passage):
            passages.setdefault(row.lang, []).append(plain(row.passage))
    # An automaton has at most two states for a byte; a table row has at most 256 classes of 4 bytes.
    classes = len({b for own in passages.values() for p in own for b in p}) + 1
    most = table_bytes // (2 * 4 * classes * max(len(passages), 1))
    named = sorted(passages)
    data = [b"".join(passages[lang])[:most] for lang in named]
    made = [SuffixAutomaton(d) for d in data]
    return Model(named, [a.edges for a in made], [a.states for a in made], [len(d) for d in data])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``(doc_id, held_out, lang_pred, score)``."""
    key = f"language {uuid.uuid4().hex}"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # edges of bounded automata

    def run(batches):
        memory = worker_memory()
        if key not in memory:
            for old in [k for k in memory if str(k).startswith("language ")]:
                del memory[old]
            memory[key] = Parser(shared.value) if shared.value.languages else None
        parser = memory[key]
        for batch in batches:
            named, score, part, held = [], [], [], 0
            for k, text in enumerate(batch.column("text")):
                part.append(None if (own := text.as_py()) is None else own.decode("utf-8", "replace"))
                held += len(part[-1] or "")
                if held >= GATHERED or k + 1 == len(batch):
                    found = parser.predict(part) if parser else (["und"] * len(part), [0.0] * len(part))
                    named, score, part, held = named + found[0], score + found[1], [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


ship(__name__)
