"""Quality rules with thresholds that adapt to each language and source.

Each text is measured in one pass of native expressions. KLL quantile sketches of every
measure are built per language and source, merged per language and merged again over all;
a group with few documents takes the sketch of its language, and a language with few that of
all. Fences (quartiles and their distance, and the outermost hundredths) read from the sketches
replace fixed cutoffs, and join back to the measures. Measures hold no texts, so only short rows
are saved and joined.

Defined cases: a null or empty text has no words and fails the base rule; a null language or
source is a group of its own; repeated rows are each a document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 8
MIN_GROUP = 200  # documents under which a group takes the thresholds of the wider one
FENCE = 6.0  # distances of the quartiles beyond which a text is an outlier
TAIL = 0.01  # share of a group that its fence puts outside at most, on a side
SKETCH = 2000  # size of a sketch: its ranks are right to about 0.0015, a fraction of TAIL

# measure -> (side that fails, count that a failing text is above: one sign, line or window that
# comes again says nothing of a short text)
MEASURES = {
    "mean_word": ("both", None),
    "symbol_share": ("high", ("n_symbols", 3)),
    "dup_line_share": ("high", ("n_dup_lines", 1)),
    "repeat_share": ("high", ("n_repeat_words", 2 * REPEAT_WORDS)),
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def window_names(words: Column) -> Column:
    """64-bit names of all windows of eight words; ``words`` holds the words' own names."""
    n = F.size(words) - REPEAT_WORDS
    name = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(REPEAT_WORDS)]))
    return F.when(n >= 0, name).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every text; one row per row of ``docs``, without its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    df = docs.select("doc_id", "lang", "source", text.alias("text"))
    df = df.select(
        "doc_id", "lang", "source", F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("words"), lines.alias("lines"),
    )
    df = df.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        window_names(F.col("words")).alias("names"),
    )
    # most texts repeat no window, and their windows need no sorting
    some = F.size(F.array_distinct("names")) < F.size("names")
    pairs = F.array_sort(F.transform("names", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(some, pairs))
    twice = F.filter(
        "pairs", lambda x, k: (F.get("pairs", k - 1)["h"] == x["h"]) | F.coalesce(F.get("pairs", k + 1)["h"] == x["h"], F.lit(False))
    )
    df = df.withColumn("places", F.array_sort(F.transform(twice, lambda x: x["i"])))
    steps = F.transform("places", lambda p, k: F.least(F.lit(REPEAT_WORDS), F.coalesce(F.get("places", k + 1) - p, F.lit(REPEAT_WORDS))))
    n_repeat = F.coalesce(F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"))
    df = df.withColumn("n_repeat_words", n_repeat)
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return df.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        (F.col("word_chars") / words).alias("mean_word"), (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"), (F.col("n_repeat_words") / words).alias("repeat_share"),
    )


def sketches(measures: DataFrame) -> DataFrame:
    """A mergeable quantile sketch of every measure, per language and source."""
    return measures.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(c, F.lit(SKETCH)).alias(c) for c in MEASURES]
    )


def merged(parts: DataFrame, *keys: Column | str) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(c, F.lit(SKETCH)).alias(c) for c in MEASURES])


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """``low_`` and ``high_`` of every measure, read from its sketch.

    Where nearly all texts have one value, the quartiles have no distance and the fence is the
    quantile at TAIL: what next to no text of the group has is outside.
    """
    out = []
    for c, (side, _) in MEASURES.items():
        low, q1, q3, high = (F.kll_sketch_get_quantile_double(c, F.lit(q)) for q in (TAIL, 0.25, 0.75, 1 - TAIL))
        reach = FENCE * (q3 - q1)
        out.append((F.least(q1 - reach, low) if side == "both" else F.lit(float("-inf"))).alias(f"low_{c}"))
        out.append(F.greatest(q3 + reach, high).alias(f"high_{c}"))
    return sketch.select(*keys, "n", *out)


def thresholds(parts: DataFrame) -> DataFrame:
    """Fences per language and source, from the narrowest group that has enough documents."""
    by_lang = merged(parts, "lang")
    fields = [f"{side}_{c}" for c in MEASURES for side in ("low", "high")]
    own = fences(parts, "lang", "source").select("lang", "source", F.struct("n", *fields).alias("own"))
    lang = fences(by_lang, "lang").select(F.col("lang").alias("lang_"), F.struct("n", *fields).alias("wide"))
    whole = fences(merged(by_lang, F.lit(1).alias("one"))).first()  # one row; none for an empty table
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_")))
    limits = []
    for f in fields:
        narrow = F.when(F.col("own.n") >= MIN_GROUP, F.col(f"own.{f}")).when(F.col("wide.n") >= MIN_GROUP, F.col(f"wide.{f}"))
        limits.append(narrow.otherwise(F.lit(whole[f] if whole else None)).alias(f))
    return joined.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *limits)


def judged(docs: DataFrame) -> DataFrame:
    """Every document's counts, base verdict and verdict of the adaptive thresholds."""
    measures = saved(measured(docs), "measures")
    limits = saved(thresholds(saved(sketches(measures), "sketches")), "thresholds")
    same = F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_"))
    inside = F.lit(True)
    for c, (_, above) in MEASURES.items():
        within = F.col(c).between(F.col(f"low_{c}"), F.col(f"high_{c}"))
        inside &= within | (F.col(above[0]) <= above[1]) if above else within
    return measures.join(limits, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept")
    )
