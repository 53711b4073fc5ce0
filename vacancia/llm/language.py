"""Language identification by mixture inference.

Byte trigrams of words are counted per language over all labelled training texts. A text is a
mixture: each of its words is drawn from one language with the likelihood of its trigrams.
Expectation-maximisation estimates the proportions; the set of languages grows from the best
one only while the gain in log-likelihood is worth more than a penalty per language. The
prediction is the largest share of the chosen set.

Shares add up to 1 in any text, so they say nothing of a text in no learned language. For that
a second mixture sets the chosen languages together against a background in which all trigrams
are equally likely: ``known`` is their share of the words. A language close to a learned one is
nearer to that than to the background, and counts as known.

The model has one row of ``BUCKETS`` probabilities per language, whatever the corpus. It takes
``MODEL_BYTES`` at most: every language is learned, and above 512 of them trigrams share buckets
(a power of two of them each time) until all rows fit. Texts are not shuffled.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text
when nothing was learned; a null language is not learned from; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved
from vacancia.llm.flat import LOWER, Words, arrow_bytes, blocks, expand

BUCKETS = 1 << 15
MODEL_BYTES = 64 << 20
SMOOTHING = 0.1
ROUNDS = 6
PENALTY = 3.0  # times the logarithm of the words, per language beyond the first
UNKNOWN = "und"

LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def trigrams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of words with a space on either side, and how many each word has."""
    counts = ends - starts  # a word of n bytes and its spaces have n trigrams
    middle = expand(starts, counts)
    word = np.repeat(np.arange(starts.size), counts)
    low = LOWER[buf].astype(np.uint32)
    before = np.where(middle > starts[word], low[middle - 1], 0x20)
    behind = np.where(middle + 1 < ends[word], low[np.minimum(middle + 1, low.size - 1)], 0x20)
    code = (before << 16) | (low[middle] << 8) | behind
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.int64), counts


def trigram_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, bucket, n): trigrams of all texts, summed within tasks before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, end in blocks(offsets):
                part = buf[offsets[first] : offsets[end]]
                words = Words(part, offsets[first : end + 1] - offsets[first], LETTERS)
                codes, counts = trigrams(part, words.starts, words.ends)
                names, own = np.unique(langs[first:end], return_inverse=True)
                both = np.bincount(np.repeat(own[words.doc], counts) * BUCKETS + codes, minlength=names.size * BUCKETS)
                for k, name in enumerate(names.tolist()):
                    sums[name] = sums.get(name, 0) + both[k * BUCKETS : (k + 1) * BUCKETS]
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * at.size, pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    return known.mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and log-probabilities of the buckets in each."""
    counts = saved(trigram_counts(docs), "trigrams")
    few = counts.select("lang").distinct().count()
    # all languages are learned; the more there are, the fewer buckets each has in the same bytes
    buckets = BUCKETS
    while buckets > 1 and few * buckets * 4 > MODEL_BYTES:
        buckets //= 2
    counts = counts.groupBy("lang", (F.col("bucket") % buckets).alias("bucket")).agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("n")).collect()  # a row per language
    langs, tables = [], []
    for row in sorted(rows, key=lambda r: r.lang):
        table = np.zeros(buckets)
        table[[x.bucket for x in row.n]] = [x.n for x in row.n]
        langs.append(row.lang)
        tables.append(np.log((table + SMOOTHING) / (table.sum() + SMOOTHING * buckets)).astype(np.float32))
    return langs, np.array(tables, np.float32).reshape(len(langs), buckets).T.copy()


def proportions(like: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in every text, and the log-likelihood, after the rounds.

    ``like`` holds a row per word, ``first`` the first word of each text.
    """
    counts = np.diff(np.append(first, like.shape[0]))[:, None]
    share = allowed / allowed.sum(1, keepdims=True)
    for k in range(ROUNDS + 1):
        weighted = like * np.repeat(share, counts[:, 0], axis=0)
        total = weighted.sum(1, keepdims=True)
        if k < ROUNDS:
            share = np.add.reduceat(weighted / total, first, axis=0) / counts
    return share, np.add.reduceat(np.log(total[:, 0]), first)


def chosen(like: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The shares of the languages in each text, 0 outside its chosen set."""
    n, langs = first.size, like.shape[1]
    counts = np.diff(np.append(first, like.shape[0]))
    share, _ = proportions(like, first, np.ones((n, langs)))
    order = np.argsort(-share, axis=1, kind="stable")
    allowed = np.zeros((n, langs))
    rows = np.arange(n)
    allowed[rows, order[:, 0]] = 1
    best = np.add.reduceat(np.log(like[np.arange(like.shape[0]), np.repeat(order[:, 0], counts)]), first)
    result = allowed.copy()
    open_ = rows
    for k in range(1, langs):
        open_ = open_[share[open_, order[open_, k]] > 0.01]
        if not open_.size:
            break
        some = expand(first[open_], counts[open_])
        starts = np.cumsum(counts[open_]) - counts[open_]
        trial = allowed[open_]
        trial[np.arange(open_.size), order[open_, k]] = 1
        shares, found = proportions(like[some], starts, trial)
        better = found - best[open_] > PENALTY * np.log(counts[open_] + 1)
        open_, trial, shares, found = open_[better], trial[better], shares[better], found[better]
        allowed[open_], result[open_], best[open_] = trial, shares, found
    return result


def covered(like: np.ndarray, first: np.ndarray, shares: np.ndarray, background: np.ndarray) -> np.ndarray:
    """The share of each text's words that its languages explain and the background does not."""
    counts = np.diff(np.append(first, like.shape[0]))
    both = np.stack([(like * np.repeat(shares, counts, axis=0)).sum(1), background], axis=1)
    return proportions(both, first, np.ones((first.size, 2)))[0][:, 0]


def _predicted(buf: np.ndarray, offsets: np.ndarray, texts: pa.Array, table: np.ndarray, known: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the predicted languages, -1 for none, the scores, and if ``known`` is asked for the shares of known words."""
    pred, score, cover = np.full(offsets.size - 1, -1), np.zeros(offsets.size - 1), np.zeros(offsets.size - 1)
    words = Words(buf, offsets, LETTERS)
    if not words.starts.size or not table.size:
        return pred, score, cover
    _, at, which = np.unique(words.named(), return_index=True, return_inverse=True)
    codes, counts = trigrams(buf, words.starts[at], words.ends[at])
    codes = codes % table.shape[0]
    sums = np.add.reduceat(table[codes], np.cumsum(counts) - counts, axis=0)
    best = sums.max(1)
    like = np.exp(np.maximum(sums - best[:, None], -60))[which]
    some = np.flatnonzero(words.count)
    shares = chosen(like, words.first[some])
    pred[some], score[some] = shares.argmax(1), shares.max(1)
    if known:
        background = np.exp(np.clip(-np.log(table.shape[0]) * counts - best, -60, 60))[which]
        cover[some] = covered(like, words.first[some], shares, background)
    # texts of non-ASCII signs alone may hold no letter
    plain = np.concatenate([[0], np.cumsum((buf < 0x80) & LETTERS[buf])])
    for i in np.flatnonzero((pred >= 0) & (plain[offsets[1:]] == plain[offsets[:-1]])).tolist():
        if not any(map(str.isalpha, texts[i].as_py())):
            pred[i], score[i], cover[i] = -1, 0, 0
    return pred, np.minimum(score, 1.0), np.minimum(cover, 1.0)


def detected(docs: DataFrame, langs: list[str], logs: np.ndarray, known: bool = False, prefix: str = "") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, and ``known`` if asked for; only ``text`` is read.

    The names of the new columns begin with ``prefix``; they take the place of columns of these names.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(logs)
    more = [prefix + c for c in ("lang_pred", "score", "known")[: 3 if known else 2]]
    columns = [c for c in docs.columns if c not in more]
    docs = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for start, end in blocks(offsets):
                part = buf[offsets[start] : offsets[end]]
                rows = batch.slice(start, end - start)
                pred, *shares = _predicted(part, offsets[start : end + 1] - offsets[start], rows.column("text"), table, known)
                said = pa.array([UNKNOWN if k < 0 else langs[k] for k in pred.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, said, *map(pa.array, shares[: len(more) - 1])], [*columns, *more])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{more[0]}` string, " + ", ".join(f"`{c}` double" for c in more[1:]))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def language_predictions(docs: DataFrame) -> DataFrame:
    """Learns from the folds that are not held out; predicts every row."""
    langs, logs = trained(docs.where(~held_out(F.col("doc_id"))))
    found = detected(docs.select("doc_id", "text"), langs, logs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
