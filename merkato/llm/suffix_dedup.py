"""Removal of byte strings that occur elsewhere, by suffix arrays built with linear grouping.

A byte goes when a string of ``length`` bytes that covers it also starts at any other place of any document. Sorting all
suffixes of a corpus together is neither needed nor possible in bounded memory; only strings that can be equal
have to meet. So every start of a ``length``-byte window is filed under the window's anchor: the ``GRAM``-byte string
inside it with the smallest hash, the leftmost of equals. Equal windows have the same anchor at the same offset.
Neighbouring starts with one anchor place form a segment, so a text has about one segment per 85 bytes.

1. Anchors that occur once are dropped (counted before they are exchanged). What is left is stored.
2. Segments with the same bytes are of one kind. The bytes of each kind of an anchor are fetched, once for a kind that
   occurs once and twice for one that occurs more often, and sorted: the suffix array of the segments of an
   anchor, whose neighbours share ``length`` bytes where a window is repeated.
3. The spans so found in a kind are those of all its segments. An anchor with more than ``crowd`` kinds (a passage
   that a third of all documents share, each in another place) is not sorted in one task: its windows are
   counted by digest instead, which combines before the exchange.

The suffix array is built by grouping (Baier 2016): suffixes are grouped by their first byte; groups are
processed from the largest down, each suffix points to the nearest earlier one of a smaller group, and the
suffixes pointed to split off their groups by the number of pointers. That leaves groups of equal Lyndon
prefixes, from which the order of each group is emitted in one pass, without renaming or recursion.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; repeated rows, even of one id, are texts of
their own and remove each other; invalid surrogates cannot occur in a string column; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship, store

#: Fixed value of the contract: bytes of a string that may not repeat.
LENGTH = 200
#: Bytes of an anchor, kinds of segments of one anchor that are sorted in one task, bytes hashed at a time.
GRAM, CROWD, CHUNK = 32, 2048, 1 << 22
#: A suffix that points nowhere yet.
UNKNOWN = -2


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size, reach = len(values) - width + 1, 1
    low = values
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[:size], low[width - reach:width - reach + size])


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` neighbours (a power of two), by doubling, mixed at the end."""
    h, reach, base = raw.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while reach < gram:
        h = h[:-reach] * np.uint64(base) + h[reach:]
        base = base * base % (1 << 64)
        reach *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def segments(raw: bytes, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK):
    """Arrays ``(anchor, first, count)``: hash of the anchor, first window start, number of window starts.

    Long texts are taken in chunks; a segment may end at a chunk's border, which changes no window's anchor.
    """
    made = []
    for at in range(0, max(len(raw) - length + 1, 0), chunk):
        part = np.frombuffer(raw, np.uint8, min(chunk + length - 1, len(raw) - at), at)
        hashes = _gram_hashes(part, gram)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = _window_minimum((hashes & ~np.uint64((1 << 24) - 1)) | place, length - gram + 1)
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        anchor = hashes[(low[first] & np.uint64((1 << 24) - 1)).astype(np.int64)]
        made.append((anchor, first + at, np.diff(np.append(first, len(low)))))
    if not made:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(column) for column in zip(*made, strict=True))


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of a text of positive numbers, by linear grouping.

    ``order`` holds the suffixes by group; a group is named by where it begins there. A suffix that another
    one points to moves to the upper end of its group, and the moved ones of a group become the next group.
    """
    n = len(text)
    if n == 0:
        return []
    sizes: dict[int, int] = {}
    for symbol in text:
        sizes[symbol] = sizes.get(symbol, 0) + 1
    begin, total = {}, 0
    for symbol in sorted(sizes):
        begin[symbol], total = total, total + sizes[symbol]
    group = [begin[s] for s in text]
    size = {begin[s]: c for s, c in sizes.items()}
    free = dict.fromkeys(size, 0)
    order, place = [0] * n, [0] * n
    for i, g in enumerate(group):
        place[i] = g + free[g]
        free[g] += 1
        order[place[i]] = i
    before = [UNKNOWN] * n

    # Groups from the largest down; a split only makes groups below the one in hand smaller.
    end = n
    while end > 0:
        current = group[order[end - 1]]
        pointed: dict[int, int] = {}
        for i in order[current:end]:
            if before[i] != UNKNOWN:
                continue
            # Members of the group passed on the way have no pointer yet; all of them get the same one.
            passed, j = [i], i - 1
            while j >= 0 and group[j] >= current:
                if before[j] == UNKNOWN:
                    passed.append(j)
                    j -= 1
                else:
                    j = before[j]
            for k in passed:
                before[k] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + len(passed)
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, {}).setdefault(group[j], []).append(j)
        # A group of m suffixes has fewer than the root of 2m different counts, so ordering them is less than m steps.
        for count in sorted(by_count, reverse=True):
            for old, moved in by_count[count].items():
                keep = size[old] - len(moved)
                if keep == 0:
                    continue
                top = old + keep
                chosen = set(moved)
                inside = [j for j in order[top:old + size[old]] if j not in chosen]
                holes = [place[j] for j in moved if place[j] < top]
                for j, hole in zip(inside, holes, strict=True):
                    order[hole], place[j] = j, hole
                for k, j in enumerate(moved, top):
                    order[k], place[j], group[j] = j, k, top
                size[old], size[top] = keep, len(moved)
        end = current

    # Emit: from the smallest suffix on, what stands before a suffix goes to the front of its group.
    filled = [-1] * n
    front = {g: g for g in size}

    def emit(j: int) -> None:
        while j >= 0:
            at = front[group[j]]
            if placed[j]:
                break
            filled[at], placed[j] = j, True
            front[group[j]] = at + 1
            j = before[j]

    placed = [False] * n
    emit(n - 1)
    for k in range(n):
        emit(filled[k] - 1)
    return filled


def _units(rows: list[tuple[int, bytes]], reach: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Segments of one anchor, side by side, as few symbols as tell them apart.

    ``rows`` are ``(offset of the anchor, bytes)``. A column is a place relative to the anchor. Neighbouring columns in
    which all rows that are there agree, and which the same rows have, become one unit. Returns the symbol of every
    row and unit (0 where the row is not there), the first and last unit of every row, and the units' first columns.
    """
    width = reach + max(len(raw) - o for o, raw in rows)
    table = np.full((len(rows), width), -1, np.int16)
    for k, (o, raw) in enumerate(rows):
        table[k, reach - o:reach - o + len(raw)] = np.frombuffer(raw, np.uint8)
    there = table >= 0
    same = table.max(axis=0) == np.where(there, table, 256).min(axis=0)
    start = np.concatenate(([True], ~(same[1:] & same[:-1] & (there[:, 1:] == there[:, :-1]).all(axis=0))))
    first = np.flatnonzero(start)
    own = table[:, first].astype(np.int64)
    symbols = np.where(own < 0, 0, np.arange(len(first)) * 256 + own + 2)
    present = own >= 0
    bounds = list(zip(present.argmax(axis=1).tolist(), (len(first) - present[:, ::-1].argmax(axis=1)).tolist(), strict=True))
    return symbols, bounds, first


def _longest_shared(sides: list[bytes]) -> list[int]:
    """For every text the longest beginning that it has in common with another one: a neighbour in sorted order."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    longest = [0] * len(sides)
    for a, b in zip(order, order[1:], strict=False):
        x, y = sides[a], sides[b]
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            n = int((np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)).argmax())
        longest[a], longest[b] = max(longest[a], n), n
    return longest


def repeated_starts(rows: list[tuple[int, bytes]], length: int = LENGTH) -> list[np.ndarray]:
    """For every segment of one anchor, which of its window starts have an equal window in another segment.

    Every window holds the anchor, so an equal one agrees on both sides of it: what lies beyond the longest
    agreement with any other segment, to the left and to the right, is cut off before sorting.
    """
    left = _longest_shared([raw[:o][::-1] for o, raw in rows])
    right = _longest_shared([raw[o:] for o, raw in rows])
    result = [np.zeros(max(len(raw) - length + 1, 0), bool) for _, raw in rows]
    able = [k for k in range(len(rows)) if left[k] + right[k] >= length]
    trimmed = [(left[k], rows[k][1][rows[k][0] - left[k]:rows[k][0] + right[k]]) for k in able]
    for k, marks in zip(able, _sorted_starts(trimmed, length) if len(able) > 1 else (), strict=False):
        start = rows[k][0] - left[k]
        result[k][start:start + len(marks)] = marks
    return result


def _sorted_starts(rows: list[tuple[int, bytes]], length: int) -> list[np.ndarray]:
    """The same from the suffix array of all segments."""
    reach = max(o for o, _ in rows)
    symbols, bounds, first = _units(rows, reach)
    text, row_of, unit_of = [], [], []
    for k, (a, b) in enumerate(bounds):
        text += symbols[k, a:b].tolist() + [1]
        row_of += [k] * (b - a + 1)
        unit_of += range(a, b + 1)
    order = suffix_array(text)
    rank = [0] * len(text)
    for k, i in enumerate(order):
        rank[i] = k
    # Units that each suffix shares with the one before it in the order, never across the end of a row.
    shared, h = [0] * len(text), 0
    for i, k in enumerate(rank):
        if k == 0:
            h = 0
            continue
        j = order[k - 1]
        while text[i + h] == text[j + h] != 1:
            h += 1
        shared[k] = h
        h = max(h - 1, 0)
    edges = np.append(first, 1 << 30)
    result = [np.zeros(max(len(raw) - length + 1, 0), bool) for _, raw in rows]
    for k, i in enumerate(order):
        if text[i] == 1:
            continue
        units = max(shared[k], shared[k + 1] if k + 1 < len(order) else 0)
        if not units:
            continue
        row, unit = row_of[i], unit_of[i]
        offset, raw = rows[row]
        start = int(first[unit]) - reach + offset  # of the unit, in the row's bytes
        last = unit + units
        stop = len(raw) if last >= bounds[row][1] else int(edges[last]) - reach + offset
        inside = min(int(edges[unit + 1]) - int(first[unit]), stop - start - length + 1)
        if inside > 0:
            result[row][start:start + inside] = True
    return result


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], marks, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, check, text)``: the check tells texts with one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("check"), text.alias("text"))


def _anchors(docs: DataFrame, length: int, digests: bool) -> DataFrame:
    """One row per segment: its anchor, and with ``digests`` its bytes' digest and place."""
    def run(batches):
        for batch in batches:
            columns = [[] for _ in range(6)]
            for doc_id, check, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_py().encode()
                anchor, first, count = segments(raw, length)
                if not len(anchor):
                    continue
                columns[0].append(anchor.view(np.int64))
                if digests:
                    view, starts, ends = memoryview(raw), first.tolist(), (first + count + length - 1).tolist()
                    made = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts, ends, strict=True)]
                    columns[1].append(np.array(made, np.uint64).view(np.int64))
                    columns[2].append((doc_id, check, len(first)))
                    columns[3].append(first)
                    columns[4].append(count)
            join = lambda c, t: np.concatenate(c).astype(t) if c else np.zeros(0, t)
            arrays = [pa.array(join(columns[0], np.int64))]
            if digests:
                times = [n for _, _, n in columns[2]]
                ids = pa.array([d for d, _, _ in columns[2]], pa.int64()).take(pa.array(np.repeat(np.arange(len(times)), times)))
                checks = np.repeat(np.array([c for _, c, _ in columns[2]], np.int32), times)
                arrays += [pa.array(join(columns[1], np.int64)), ids, pa.array(checks),
                           pa.array(join(columns[3], np.int32)), pa.array(join(columns[4], np.int32))]
            names = ["anchor", "digest", "doc_id", "check", "first", "count"]
            yield pa.RecordBatch.from_arrays(arrays, names=names[:len(arrays)])

    schema = "anchor long" + ", digest long, doc_id long, check int, first int, count int" * digests
    return _keyed(docs).mapInArrow(run, schema)


def _with_lists(docs: DataFrame, rows: DataFrame, name: str, how: str) -> DataFrame:
    """Documents beside the rows of their places, as one list; rows of one document are bounded by its text."""
    packed = F.struct(*[c for c in rows.columns if c not in ("doc_id", "check")])
    lists = rows.groupBy("doc_id", "check").agg(F.collect_list(packed).alias(name)).select(
        F.col("doc_id").alias("_id"), F.col("check").alias("_check"), name)
    return _keyed(docs).join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("check") == F.col("_check")), how).select(
        "doc_id", "check", "text", name)


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments: ``(anchor, digest, offset, raw, single)``."""
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                raw = row["text"].encode()
                for at in row["wanted"]:
                    part = raw[at["first"]:at["first"] + at["count"] + length - 1]
                    hashes = _gram_hashes(np.frombuffer(part, np.uint8), GRAM).view(np.int64)
                    # All windows of the segment hold the anchor; of equal strings it is the leftmost they all hold.
                    offset = at["count"] - 1 + int(np.flatnonzero(hashes[at["count"] - 1:] == at["anchor"])[0])
                    rows.append((at["anchor"], at["digest"], offset, part, at["single"]))
            names = ["anchor", "digest", "offset", "raw", "single"]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
            for k in range(0, max(len(rows), 1), 4096):
                columns = list(zip(*rows[k:k + 4096], strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return _with_lists(docs, wanted, "wanted", "inner").mapInArrow(
        run, "anchor long, digest long, offset int, raw binary, single boolean")


SPANS = "anchor long, digest long, low int, high int"


def _span_table(made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True)) or [[]] * 4
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["anchor", "digest", "low", "high"])


def _sorted_spans(cut: DataFrame, length: int) -> DataFrame:
    """Repeated spans of kinds from the suffix arrays of anchors; a task's rows come in order of anchor."""
    def spans(group):
        # A kind that occurs again stands beside a copy of itself.
        rows = [(r["offset"], r["raw"]) for r in group]
        rows += [(r["offset"], r["raw"]) for r in group if not r["single"]]
        for row, marks in zip(group, repeated_starts(rows, length), strict=False):
            for a, b in _runs(marks):
                yield row["anchor"], row["digest"], a, b + length - 1

    def run(batches):
        group, made = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if group and group[0]["anchor"] != row["anchor"]:
                    made += spans(group)
                    group = []
                group.append(row)
            if len(made) > 4096:
                yield _span_table(made)
                made = []
        if group:
            made += spans(group)
        yield _span_table(made)

    return cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, SPANS)


def _counted_spans(cut: DataFrame, length: int) -> DataFrame:
    """Repeated spans of kinds of crowded anchors: every window by digest, counted, and found again."""
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                raw = row["raw"]
                rows += [(row["anchor"], row["digest"], hashlib.blake2b(raw[k:k + length], digest_size=16).digest(),
                          1 if row["single"] else 2, k) for k in range(len(raw) - length + 1)]
            names = ["anchor", "digest", "window", "times", "low"]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
            for k in range(0, max(len(rows), 1), 8192):
                columns = list(zip(*rows[k:k + 8192], strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    windows = cut.repartition("anchor", "digest").mapInArrow(
        run, "anchor long, digest long, window binary, times long, low int")
    again = windows.groupBy("anchor", "window").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "window")
    # A kind's windows are at most those of its anchor's reach; neighbours among them become one span again.
    found = windows.join(again, ["anchor", "window"]).groupBy("anchor", "digest").agg(F.array_sort(F.collect_list("low")).alias("lows"))
    place = F.posexplode("lows").alias("k", "low")
    return found.select("anchor", "digest", place).groupBy("anchor", "digest", (F.col("low") - F.col("k")).alias("run")).agg(
        F.min("low").alias("low"), (F.max("low") + length).cast("int").alias("high")).drop("run")


def repeated_spans(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``(doc_id, check, low, high)``: byte spans that strings starting elsewhere cover; spans may overlap."""
    # Stored, so that the join below is one of plain rows, whose hot anchors adaptive execution can split.
    twice = store(_anchors(docs, length, False).groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    rows = store(_anchors(docs, length, True).join(twice, "anchor"), "segments")
    kinds = store(rows.groupBy("anchor", "digest").agg(
        (F.count("*") == 1).alias("single"), F.min(F.struct("doc_id", "check", "first", "count")).alias("at")), "kinds")
    crowded = store(kinds.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "crowded")
    cut = store(_cut(docs, kinds.select("anchor", "digest", "single", "at.*"), length), "cut")
    spans = _sorted_spans(cut.join(crowded, "anchor", "left_anti"), length).unionByName(
        _counted_spans(cut.join(crowded, "anchor", "left_semi"), length))
    return rows.join(store(spans, "kind-spans"), ["anchor", "digest"]).select(
        "doc_id", "check", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """One row per document: ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``; ``kept`` is what is left."""
    spans = store(repeated_spans(docs, length, crowd), "repeated-spans")

    def run(batches):
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                raw = row["text"].encode()
                mark = np.zeros(len(raw) + 1, np.int32)
                for span in row["spans"] or ():
                    mark[span["low"]] += 1
                    mark[span["high"]] -= 1
                gone = np.cumsum(mark)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                made.append((row["doc_id"], len(raw), int(gone.sum()), len(_runs(gone)), hashlib.sha256(kept).hexdigest(), kept))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = list(zip(*made, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return _with_lists(docs, spans, "spans", "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


ship(__name__)
