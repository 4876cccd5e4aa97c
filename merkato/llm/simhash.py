"""Near-duplicate detection: SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits; the copies of one fingerprint are one entry. For distance ``r`` the bits are cut into
``segments`` pieces. Two fingerprints within ``r`` agree, in at least one piece, to within that piece's small
radius (``radii``: floor(r / m) for the first r mod m + 1 pieces, one less for the others). Each piece has a table
from its value to the fingerprints; every fingerprint looks up the values in the Hamming ball around its own
piece, and what the table returns is kept after comparing whole fingerprints. Flips are enumerated from one
side only, 0 to 1 (of two values one bit apart, one has the 0); for larger radii both sides enumerate.

A value shared by more than ``cold`` fingerprints (thousands of near copies of one text) leaves the join: its
fingerprints and look-ups are cut into blocks, each pair of blocks is one group in Python, and it returns
a spanning forest of its links, never the links themselves. Nothing is dropped, and the answer is the
same for any ``cold``. Components come from alternating large-star and small-star steps on the links.

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle; repeated rows are rows of one fingerprint; a null id
gets the component of its fingerprint; an empty table gives no rows; other columns are not read, and
``one_of_each`` carries them along under any name.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship, store, unused

#: Fixed values of the contract: bits that may differ, words in a shingle, hash seed.
DISTANCE, SHINGLE, SEED = 4, 4, 42
#: Pieces of the fingerprint; fingerprints that share a value and are still joined; rows in a block.
SEGMENTS, COLD, BLOCK = 3, 256, 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle + 1, 1)
    spans = zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1:].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[2 * counts > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long. Each text is hashed where it is read."""
    def run(batches):
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(made, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _pieces(segments: int, distance: int) -> list[tuple[int, int, int]]:
    """``(first bit, bits, radius)`` of every piece."""
    edges = [64 * k // segments for k in range(segments + 1)]
    radius, wide = divmod(distance, segments)
    return [(a, b - a, radius if k <= wide else radius - 1) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def _ball(k: int, value: Column, bits: int, flips: int) -> Column:
    """The look-ups of one piece that are ``flips`` bits away from the own value."""
    masks = F.array(*[F.lit(sum(1 << b for b in chosen)).cast("long") for chosen in combinations(range(bits), flips)])
    if flips == 1:  # the other side has the bit set
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
    return F.transform(masks, lambda m: F.struct(F.lit(k).alias("piece"), value.bitwiseXOR(m).alias("value")))


def _exploded(fps: DataFrame, pieces, probes: bool) -> DataFrame:
    """Rows ``(piece, value, fp)``: the table entries, or the look-ups that differ from the own value."""
    made = []
    for k, (first, bits, radius) in enumerate(pieces):
        value = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))
        if not probes:
            if radius >= 0:
                made.append(F.array(F.struct(F.lit(k).alias("piece"), value.alias("value"))))
            continue
        for flips in range(1, radius + 1):
            made.append(_ball(k, value, bits, flips))
    if not made:
        return fps.where("false").selectExpr("0 AS piece", "0L AS value", "fp")
    return fps.select(F.explode(F.concat(*made)).alias("at"), "fp").select("at.piece", "at.value", "fp")


def _near(distance: int) -> Column:
    return F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance


def _forest(distance: int):
    """Links of one pair of blocks as a spanning forest: ``(a, b)`` per fingerprint and its group's smallest."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        left = np.unique(group.fp[group.side == 0].to_numpy()).view(np.uint64)
        right = np.unique(group.fp[group.side == 1].to_numpy()).view(np.uint64)
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        near = np.bitwise_count(left[:, None] ^ right[None, :]) <= distance
        own, other = np.arange(len(left)), np.full(len(right), len(left))
        while True:
            reached = np.minimum(other, np.where(near, own[:, None], len(left)).min(axis=0))
            back = np.minimum(own, np.where(near, reached[None, :], len(left)).min(axis=1))
            if (back == own).all() and (reached == other).all():
                break
            own, other = back, reached
        linked = other < len(left)
        a = np.concatenate([left, right[linked]])
        b = left[np.concatenate([own, other[linked]])]
        keep = a != b
        return pd.DataFrame({"a": a[keep].view(np.int64), "b": b[keep].view(np.int64)})

    return run


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, cold: int = COLD,
          block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links whose components are those of all pairs of fingerprints within ``distance``.

    ``fps`` has one column ``fp`` without repeats.
    """
    pieces = _pieces(segments, distance)
    entries = _exploded(fps, pieces, probes=False)
    lookups = _exploded(fps, pieces, probes=True)
    at = ["piece", "value"]
    crowded = store(entries.groupBy(*at).count().where(F.col("count") > cold), "crowded")
    quiet = entries.join(crowded, at, "left_anti")
    other = quiet.withColumnRenamed("fp", "other")
    same = quiet.join(other, at).where((F.col("fp") < F.col("other")) & _near(distance))
    balls = lookups.join(other, at).where((F.col("fp") != F.col("other")) & _near(distance))
    found = same.unionByName(balls).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    # Crowded values: block rows (the table's own, then those of the look-ups) against block columns.
    asked = store(lookups.join(crowded, at, "left_semi"), "crowded-lookups")
    sizes = crowded.join(asked.groupBy(*at).agg(F.count("*").alias("asking")), at, "left").select(
        *at, F.ceil(F.col("count") / block).cast("int").alias("blocks"),
        F.ceil(F.coalesce("asking", F.lit(0)) / block).cast("int").alias("asking"))
    among = lambda count: F.pmod(F.xxhash64("fp", F.lit(7)), count).cast("int")
    table = entries.join(sizes, at).withColumn("part", among(F.col("blocks")))
    calls = asked.join(sizes, at).withColumn("part", F.col("blocks") + among(F.col("asking")))
    columns = F.explode(F.sequence(F.lit(0), F.least(F.col("part"), F.col("blocks") - 1)))
    left = table.unionByName(calls).select(
        *at, F.col("part").alias("row"), columns.alias("column"), F.lit(0).alias("side"), "fp")
    rows = F.explode(F.sequence(F.col("part"), F.col("blocks") + F.col("asking") - 1))
    right = table.select(*at, rows.alias("row"), F.col("part").alias("column"), F.lit(1).alias("side"), "fp")
    packed = left.unionByName(right)
    hot = packed.groupBy(*at, "row", "column").applyInPandas(_forest(distance), "a long, b long")
    return found.unionByName(hot).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(fp, root)`` for every fingerprint that has a link; the root is the group's smallest value.

    Large-star and small-star steps on written tables, until a round changes nothing.
    """
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = store(large.where("a != b").distinct(), "large-star")
        # Small star: smaller neighbours, and the node itself, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        small = store(small.where("a != b").distinct(), "small-star")
        moved = small.join(edges, ["a", "b"], "left_anti").limit(1).count()
        gone = edges.join(small, ["a", "b"], "left_anti").limit(1).count()
        edges = small
        if not moved and not gone:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, segments: int = SEGMENTS,
                    cold: int = COLD, block: int = BLOCK) -> DataFrame:
    """One row per document: ``(doc_id, fingerprint, component_id)``."""
    made = store(fingerprints(docs, shingle), "fingerprints")
    firsts = store(made.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(firsts.select("fp"), distance, segments, cold, block))
    placed = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    per_fp = placed.join(smallest, "root").select("fp", "component_id")
    return made.join(per_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``first_of_each`` by fingerprints."""
    return first_of_each(docs, near_duplicates(docs, **options))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents whose id is their component's smallest, with all their columns; one row of an id that repeats.

    Rows with a null id are told apart by nothing else, so a component of only such rows keeps one.
    """
    of_kept, of_repeated = unused(docs, "of_kept", "of_repeated")
    found = store(found.select("doc_id", "component_id"), "near-duplicates")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").count()
    # The ids grow with the documents, so they are merged at any size and never broadcast.
    left = docs.join(kept.select(F.col("doc_id").alias(of_kept)).hint("merge"), F.col("doc_id").eqNullSafe(F.col(of_kept)), "left_semi")
    repeated = store(kept.where("count > 1").select(F.col("doc_id").alias(of_repeated)), "repeated-ids")
    if repeated.isEmpty():
        return left
    again = F.col("doc_id").eqNullSafe(F.col(of_repeated))
    return left.join(repeated, again, "left_anti").unionByName(
        left.join(repeated, again, "left_semi").dropDuplicates(["doc_id"]))


ship(__name__)
