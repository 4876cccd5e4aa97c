"""Quality rules: base counts, then divergence from the language's own distributions.

Two histograms of a document, its character classes and its common words, are compared with those of all
documents of its language by the Jensen-Shannon distance (base 2, 0 to 1). The common words of a
language are its most frequent words over all documents, in bands that cover about as many words each, so that
chance weighs little in a short text. A text without any common word has the largest distance that a missing
language can cause; the bound of words is a share of it. A document is rejected when a distance is above its
bound, unless it, or the language's reference, is too short to judge.

The references are one row per language with a fixed number of words; that row count is looked at
before they are broadcast. Words are counted per task before they are exchanged.

Defined cases: a null text is empty and fails the base rule; a null language is a language of its own;
repeated rows are judged one by one; a null id is an id of its own; a very long text is judged whole,
with its words as one array; an empty table gives no rows; other columns are not read, and
``good_documents`` carries them along under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merkato.llm.common import BLANK, store, whole_text, without_blanks, words_of

#: Fixed values of the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
SYMBOLS = "[#*$%&|<>]"

#: The method's parameters: words per reference, their bands, and when a text can be judged.
COMMON_WORDS, BANDS = 200, 8
JUDGED_WORDS, REFERENCE_WORDS = 40, 2_000
#: The bound of words is a share of the distance of a text without common words.
MOST_CLASS_DISTANCE, MOST_WORD_SHARE = 0.3, 0.65
#: Common words are looked up in as many lists, by hash.
LISTS = 256
#: Languages beyond this are joined by Spark's own choice instead of a broadcast.
BROADCAST_LANGUAGES = 5_000

CLASSES = ["lower", "upper", "digit", "blank", "symbol", "rest"]


def _total(values: Column, zero: str = "long") -> Column:
    return F.aggregate(values, F.lit(0).cast(zero), lambda a, b: a + b)


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside windows of five that occur twice or more in the text,
    and ``places``: the band of each word, from 1, and 0 if it is none of the common ones.

    Windows stand for their hash. Only texts in which some hash occurs again are sorted; the covered words are
    then counted from the gaps between the starts.
    """
    at = lambda i, k: F.get(F.col("words"), i + k)
    found = lambda w: F.array_position(F.get(F.col("common"), _list_of(w)), w).cast("int")
    hashed = F.transform("words", lambda w, i: F.struct(
        F.xxhash64(*[at(i, k) for k in range(WINDOW)]).alias("h"),
        F.coalesce(F.get(F.get(F.col("bands"), _list_of(w)), found(w) - 1), F.lit(0)).alias("k")))
    frame = frame.withColumn("hashed", hashed)
    # What stands at the last four words is no whole window.
    windows = F.slice(F.col("hashed")["h"], 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))
    frame = frame.withColumns({"windows": windows, "places": F.col("hashed")["k"]})
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(again, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    frame = frame.withColumn("ordered", ordered)
    near = lambda i, k: F.get(F.col("ordered"), i + k)["h"]
    twice = F.filter("ordered", lambda w, i: F.coalesce(
        (i > 0) & (w["h"] == near(F.greatest(i - 1, F.lit(0)), 0)), F.lit(False)) | F.coalesce(w["h"] == near(i, 1), F.lit(False)))
    frame = frame.withColumn("starts", F.array_sort(F.transform(twice, lambda w: w["i"])))
    gaps = F.transform("starts", lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), j + 1), p + WINDOW) - p))
    return frame.withColumn("n_repeat_words", F.coalesce(_total(gaps, "int"), F.lit(0)).cast("long")).drop(
        "windows", "ordered", "starts")


def _language() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def _list_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(LISTS)).cast("int")


def common_words(docs: DataFrame) -> DataFrame:
    """``(language, common, bands)``: the most frequent words of each language, and the band of each.

    Both are arrays of ``LISTS`` lists; a word is in the list of its hash.
    """
    counts = docs.select(_language().alias("language"), F.explode(words_of(whole_text())).alias("word")).groupBy(
        "language", "word").count()
    order = Window.partitionBy("language").orderBy(F.desc("count"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= COMMON_WORDS)
    before = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("count")
    total = F.sum("count").over(Window.partitionBy("language"))
    banded = ranked.withColumns({"before": before, "total": total}).select(
        "language", "word", _list_of(F.col("word")).alias("list"), F.expr(f"CAST({BANDS} * before DIV total + 1 AS INT)").alias("band"))
    lists = banded.groupBy("language", "list").agg(F.array_sort(F.collect_list(F.struct("word", "band"))).alias("words"))
    filled = lists.groupBy("language").agg(F.map_from_entries(F.collect_list(F.struct("list", "words"))).alias("lists"))
    every = F.sequence(F.lit(0), F.lit(LISTS - 1))
    part = lambda name, kind: F.transform(every, lambda k: F.coalesce(
        F.try_element_at("lists", k)[name], F.array().cast(f"array<{kind}>")))
    return filled.select("language", part("word", "string").alias("common"), part("band", "int").alias("bands"))


def _beside(frame: DataFrame, per_language: DataFrame) -> DataFrame:
    small = per_language.count() <= BROADCAST_LANGUAGES
    return frame.join(F.broadcast(per_language) if small else per_language, "language", "left")


def measures(docs: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Base counts and both histograms of every document."""
    frame = docs.select("doc_id", *keep, _language().alias("language"), whole_text().alias("body"))
    frame = _beside(frame, store(common_words(docs), "common-words"))
    text = F.col("body")
    frame = frame.withColumns({
        "words": words_of(text), "n_chars": F.char_length(text).cast("long"),
        "lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANK}]")),
        # Every capital becomes A and every digit 0, and small letters go; what is left is short to scan.
        "marks": F.regexp_replace(F.mask(text, F.lit("A"), F.lit("a"), F.lit("0"), F.lit(None)), "a+", ""),
    })
    marks = F.char_length("marks")
    frame = frame.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_symbols": F.regexp_count("marks", F.lit(SYMBOLS)).cast("long"),
        "upper": (marks - F.char_length(F.replace("marks", F.lit("A"), F.lit("")))).cast("long"),
        "digit": (marks - F.char_length(F.replace("marks", F.lit("0"), F.lit("")))).cast("long"),
        "blank": (marks - F.char_length(without_blanks(F.col("marks")))).cast("long"),
        "lower": (F.col("n_chars") - marks).cast("long"),
    })
    frame = _repeated_words(frame)
    counted = [F.col(c) for c in ("lower", "upper", "digit", "blank", "n_symbols")]
    rest = F.col("n_chars") - sum(counted[1:], counted[0])
    of_word = [F.size("places") - F.size(F.array_remove(F.col("places"), F.lit(k))) for k in range(1, BANDS + 1)]
    return frame.select(
        "doc_id", *keep, "language", "n_words", (F.col("n_chars") - F.col("blank")).alias("word_chars"), "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        F.array(*counted, rest).alias("classes"),
        F.array(*[c.cast("long") for c in of_word]).alias("common_counts"))


def references(measured: DataFrame) -> DataFrame:
    """Sums of both histograms over all documents of each language."""
    slots = [("classes", len(CLASSES)), ("common_counts", BANDS)]
    sums = [F.sum(F.col(c)[k]).alias(f"{c}_{k}") for c, n in slots for k in range(n)]
    return measured.groupBy("language").agg(F.sum("n_words").alias("reference_words"), *sums).select(
        "language", "reference_words",
        *[F.array(*[F.col(f"{c}_{k}") for k in range(n)]).alias(f"reference_{c}") for c, n in slots])


def shares(counts: Column, total: Column, open_ended: bool) -> Column:
    """Counts as shares; ``open_ended`` adds a last slot for what no count covers."""
    if open_ended:
        counts = F.concat(counts, F.array(total - _total(counts)))
    return F.transform(counts, lambda c: c / total)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length, base 2."""
    def term(a: Column, b: Column) -> Column:
        part = lambda x: F.when(x > 0, x * F.log2(x * 2 / (a + b))).otherwise(F.lit(0.0))
        return (part(a) + part(b)) / 2

    return F.sqrt(F.greatest(_total(F.zip_with(p, q, term), "double"), F.lit(0.0)))


def judge(docs: DataFrame, keep: list[str] = (), class_bound: float = MOST_CLASS_DISTANCE,
          word_share: float = MOST_WORD_SHARE) -> DataFrame:
    """One row per document: base counts, ``base_failed``, both distances, ``kept``.

    ``word_share`` is the bound of ``word_distance`` as a share of that of a text without common words.
    """
    measured = store(measures(docs, keep), "measures")
    frame = _beside(measured, store(references(measured), "references"))
    total = F.col("reference_words")
    none = F.array(*[F.lit(0.0)] * BANDS, F.lit(1.0))
    distances = frame.withColumns({
        "class_distance": F.when((F.col("n_words") >= JUDGED_WORDS) & (total >= REFERENCE_WORDS), divergence(
            shares(F.col("classes"), F.col("n_chars"), False),
            shares(F.col("reference_classes"), _total(F.col("reference_classes")), False))),
        "word_distance": F.when((F.col("n_words") >= JUDGED_WORDS) & (total >= REFERENCE_WORDS), divergence(
            shares(F.col("common_counts"), F.col("n_words"), True),
            shares(F.col("reference_common_counts"), total, True))),
        "without_common": F.when(total >= REFERENCE_WORDS, divergence(
            none, shares(F.col("reference_common_counts"), total, True))),
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    })
    far = F.coalesce(F.col("class_distance") > class_bound, F.lit(False)) | F.coalesce(
        F.col("word_distance") > word_share * F.col("without_common"), F.lit(False))
    return distances.select(
        "doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance")


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns, whatever the names of these.

    Whole rows go along into the written measures, so that no document is exchanged to meet its verdict.
    """
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))
    return judge(rows, keep=["whole_row"]).where("kept").select("whole_row.*")
