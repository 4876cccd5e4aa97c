"""Language identification, importance resampling and fill-in-middle against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import check
import numpy as np
import pytest
from pyspark.sql import functions as F

from merkato.llm import fill_middle, importance, language_id
from merkato.llm.catalog import QUERIES, SQL

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 977}é" for k in range(30_000))
ROWS = [
    (1, "the cat sat on the mat and looked at the dog over there and then the cat sat on the mat again", "en", "a", 0),
    (2, "THE cat; sat_on the mat\nand looked at the dog over there and then the cat sat on the mat again", "en", "a", 0),
    (3, None, "en", None, None), (4, "", None, "b", 0), (5, " \t\n12 34 -- ", "de", "b", 0),
    (6, LONG, "de", "c", 0), (7, LONG, "fr", "c", 0), (7, LONG, "fr", "c", 0),
    (8, "Ünïcode 🙂 text\x1fwith\x85odd blanks 日本語 ñandú " * 5, "fr", None, 0),
    (9, "a <P> b", "en", "c", 0), (10, "x<S>", "en", "c", 0), (11, "<M>", "en", "c", 0), (12, "< P><S <M", "en", "c", 0),
    (13, "é", "es", "c", 0), (None, "no id " * 30, "en", "a", 0), (None, "no id " * 30, "en", "a", 0),
    *[(20 + k, " ".join(f"v{(k * j) % 7}" for j in range(30)), "es", "d", 0) for k in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, COLUMNS).withColumns({
        name: F.lit(1) for name in ("score", "rank", "row", "weight", "n", "form", "output", "passage", "drawn", "nth", "bucket", "key")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def given(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


# Fill-in-middle


@pytest.mark.parametrize("data", [
    "", "abc", "é" * 70_000, "a" * 200_000, "日本語" * 50_000, "ab" * 40_000 + "日é🙂" * 9_000 + "z" * 70_000,
    "🙂" * 40_000, "".join(chr(97 + k % 3) + "é" * (k % 2) for k in range(60_000))])
def test_boundaries(data):
    raw = data.encode()
    expected = [k for k in range(len(raw)) if raw[k] & 0xC0 != 0x80] + [len(raw)]
    found = fill_middle.BoundarySet(raw)
    assert len(found) == len(expected)
    rng = np.random.default_rng(1)
    for k in {0, 1, len(expected) - 1, *rng.integers(0, len(expected), 400).tolist()} & set(range(len(expected))):
        assert found.select(k) == expected[k]


def test_all_kinds_of_containers():
    data = "a" * 65_536 + "é" * 32_768 + "🙂a" * 9_000 + "🙂" * 60_000
    kinds = {type(c) for _, c in fill_middle.BoundarySet(data.encode()).containers}
    assert kinds == {fill_middle.RunContainer, fill_middle.BitmapContainer}
    sparse = np.zeros(65_536, np.int8)
    sparse[[3, 99, 65_535]] = 1
    made = fill_middle._container(sparse, 3)
    assert isinstance(made, fill_middle.ArrayContainer) and [made.select(k) for k in range(3)] == [3, 99, 65_535]


def filled(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def test_fill_in_middle(docs, given):
    for df in (docs, given):
        made = fill_middle.fill_in_middle(df).withColumn("text", fill_middle.restored(F.col("output"), F.col("form"))).collect()
        assert Counter((r.doc_id, r.text) for r in made) == Counter((r.doc_id, r.text or "") for r in df.collect())
        assert all(tuple(r)[1:6] == filled(r.doc_id, r.text) for r in made)


def test_fill_in_middle_of_bytes_that_are_no_text(spark):
    rows = spark.sql("SELECT 5L AS doc_id, cast(X'61C3FF80E9620000' AS string) AS text")
    made = fill_middle.fill_in_middle(rows, rate=100).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).first()
    assert made.n == 7 and made.back.replace("\ufffd", "") == "ab\0\0"  # a stray continuation byte starts nothing


def test_sentinels_must_be_distinct(docs):
    for prefix, suffix, middle in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P><", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs, prefix, suffix, middle)


@pytest.mark.parametrize("name", ["op13_fill_in_middle"])
def test_same_rows_as_sql(spark, small, name):
    assert check.differences(QUERIES[name](spark, small), check.connect(small), SQL[name]) is None


# Importance resampling


def plain_features(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    return len(own), [zlib.crc32(" ".join(own[k:k + n]).encode()) % 10_000 for n in (1, 2, 3) for k in range(len(own) - n + 1)]


def resampled(rows, targets, percent=5):
    made = [(i, *plain_features(t)) for i, t in rows]
    s, t = Counter(b for *_, f in made for b in f), Counter(b for x in targets for b in plain_features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s}
    out, able = [], []
    for i, n, f in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[:percent * len(able) // 100]):
        row[4] = k + 1
    return Counter(map(tuple, out))


@pytest.mark.parametrize("percent", [5, 0, 100])
def test_importance_resampling(spark, docs, given, small, percent):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    wanted = [r.text for r in target.collect()]
    for df in (docs, given):
        found = importance.resample(df, target, percent=percent).collect()
        assert Counter(map(tuple, found)) == resampled([(r.doc_id, r.text) for r in df.collect()], wanted, percent)


def test_features_of_parts_are_those_of_the_whole(monkeypatch):
    own = [f"w{k % 13}".encode() for k in range(50)]
    whole = Counter(np.concatenate(list(importance.features(own))).tolist())
    for part in (1, 2, 3, 7, 49, 50, 51):
        monkeypatch.setattr(importance, "PART", part)
        assert Counter(np.concatenate(list(importance.features(own))).tolist()) == whole
    assert sum(whole.values()) == importance.feature_count(50)


def test_draw_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i) if i < 5 else None, int(s)) for i, s in zip(rng.integers(0, 7, 400), rng.integers(-3, 3, 400), strict=True)]
    frame = spark.createDataFrame(rows, "doc_id long, score long").coalesce(1).withColumn("row", F.monotonically_increasing_id())
    ordered = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for k in (1, 57, 400):
        drawn = {r["rank"]: (r.doc_id, r.score) for r in importance.draw(frame, k).where("rank IS NOT NULL").collect()}
        assert drawn == {n + 1: row for n, row in enumerate(ordered[:k])}


@pytest.mark.parametrize("trials", [1, 3, 15])
def test_cutoff(spark, trials):
    values = [-(1 << 62), -5, -5, 0, 1, 1, 1, 2, 1 << 62, (1 << 63) - 1] if trials > 1 else [-5, -5, 0, 1, 1, 7]
    frame = spark.createDataFrame([(v,) for v in values], "v long").coalesce(1)
    for k in range(1, len(values) + 1, 2):
        assert importance.cutoff(frame, F.col("v"), k, trials) == (values[k - 1], sum(v < values[k - 1] for v in values))


# Language identification


def parsed(text, sample):
    """Phrases of a greedy parse by plain substring search, block by block."""
    count = 0
    for first in range(0, len(text), language_id.BLOCK):
        block, at = text[first:first + language_id.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end < len(block) and block[at:end + 1] in sample:
                end += 1
            at, count = end, count + 1
    return count


@pytest.mark.parametrize("lanes", [16_384, 3])
def test_phrases_against_plain_search(monkeypatch, lanes):
    monkeypatch.setattr(language_id, "LANES", lanes)
    rng = np.random.default_rng(lanes)
    samples = {"a": b"", "b": b"x", "c": bytes(rng.choice(list(b"abc "), 700)), "d": b"abcabcabbcaab" * 20 + "日本語 é".encode()}
    made = {k: language_id.SuffixAutomaton(s) for k, s in samples.items()}
    model = language_id.Model(list(made), [m.edges for m in made.values()], [m.states for m in made.values()], [len(s) for s in samples.values()])
    texts = [b" ", b"abcab", b"q", b"qq a", "é日".encode(), bytes(rng.choice(list(b"abc x"), 3000)), samples["c"], b"abc" * 1024,
             *[bytes(rng.choice(list(b"ab c"), n)) for n in rng.integers(1, 2500, 30)]]
    found = language_id.Parser(model).phrases(texts)
    assert found.tolist() == [[parsed(t, s) for s in samples.values()] for t in texts]


def test_an_automaton_knows_all_substrings_and_no_more():
    data = b"abracadabra arbadacarba"
    made = language_id.SuffixAutomaton(data)
    moves = {(s, b): t for s, b, t in made.edges.tolist()}
    assert made.states <= 2 * len(data)

    def reached(state, text):
        for byte in text:
            state = moves.get((state, byte))
            if state is None:
                return False
        return True

    inside = {data[a:b] for a in range(len(data)) for b in range(a + 1, len(data) + 1)}
    assert all(reached(0, s) for s in inside)
    assert all(reached(0, bytes([x, y, z])) == (bytes([x, y, z]) in inside) for x in data for y in data for z in data)


def test_languages_of_held_out_rows(spark):
    """On rows that the model never saw; the few that differ are mostly texts with another language's label."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, language_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert len(found) > 200 and sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_cases(spark, docs, empty):
    model = language_id.train(docs)
    rows = language_id.identify(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in ROWS)
    for r in rows:
        text = next(t for i, t, *_ in ROWS if i == r.doc_id)
        assert (r.lang_pred in model.languages) if any(map(str.isalpha, text or "")) else (r.lang_pred, r.score) == ("und", 0.0)
    nothing = language_id.train(empty)
    assert nothing.languages == []
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language_id.identify(empty, model).collect() == []


def test_nothing_is_learned_from_held_out_rows(spark):
    rows = [(i, f"word{i} text", "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en"]
    found = language_id.identify(spark.createDataFrame([(1, "word text")], "doc_id long, text string"), model).first()
    assert (found.lang_pred, found.score) == ("en", 1.0)


def test_the_sample_is_bounded(spark, docs):
    model = language_id.train(docs, rows=2, passage=50, languages=2)
    assert len(model.languages) == 2 and all(size <= 2 * (50 * 4 + 2) for size in model.sizes)


def test_empty_tables(empty):
    for df in (fill_middle.fill_in_middle(empty), importance.resample(empty, empty)):
        assert df.collect() == []
