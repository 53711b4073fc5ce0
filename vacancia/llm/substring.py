"""Removal of repeated word windows, by level-wise doubling.

A window of 20 words repeats only if the windows of 5 and 10 words inside it do. The first
level compares 5-word windows, and only the anchor of each 20-word window (see ``repeats``).
Those that repeat are extended to 10 words, away from the side the 20-word window lacks, and
compared again; what repeats there is extended to 20. Runs of windows that are equal as a
whole are settled by their region; the rest are compared window by window. A level with no
survivors leaves nothing to extend.

Levels are joins on 64-bit names, counted before they are joined; rows of a hot name are
spread by adaptive execution, as both sides are plain exchanges. Texts move twice: to extend
the survivors to full windows, and to cut what repeats.

Defined cases: a null text has no words; rows of one doc_id and text are one document and give
equal rows; texts of one doc_id that differ are told apart, in the order of their hash; a null
doc_id comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import identified, saved
from vacancia.llm.flat import OTHER, SPACE, WORDS, Words, arrow_bytes, blocks, expand, mix
from vacancia.llm.repeats import anchor_runs, minimisers, regions, repeated, span_arrays, window_starts, with_spans

WINDOW = 20  # words; a multiple of four
_U = np.uint64


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def candidates(docs: DataFrame, window: int) -> DataFrame:
    """Rows of the first level: runs of windows by anchor, with their names at all levels.

    ``short`` names the anchor's quarter window, ``half`` the half window that holds it and
    lies inside all windows of the run, ``region`` the words of the whole run.
    """
    quarter, half = window // 4, window // 2
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for first, end in blocks(offsets):
                words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], SPACE)
                starts = window_starts(words.first[:-1], words.count, window)
                if not starts.size:
                    continue
                names = words.named()
                prefix, other = WORDS.prefix(names), OTHER.prefix(words.named(1))
                grams = np.arange(names.size - quarter + 1)
                short = WORDS.names(prefix, grams, grams + quarter)
                anchor, start, count = anchor_runs(minimisers(short, window - quarter + 1), starts)
                # windows that hold half a window from the anchor on, and those that only hold it from a quarter before
                last = start + count - 1
                cut = np.clip(anchor - half, start, last + 1)  # first start of the former
                parts = []
                for side, low, high, at in ((0, cut, last, anchor), (1, start, cut - 1, anchor - quarter)):
                    some = np.flatnonzero(low <= high)
                    low, high, at, a = low[some], high[some], at[some], anchor[some]
                    place = (a - low).astype(np.uint64) * _U(2) + _U(side)
                    parts.append((
                        words.doc[a] + first, low - words.first[words.doc[a]], high - low + 1, mix(short[a] + _U(side)),
                        WORDS.names(prefix, at, at + half), mix(OTHER.names(other, low, high + window) + place),
                    ))
                doc, low, n, s, h, r = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), batch.column("copy").take(pa.array(doc)), pa.array(low), pa.array(n), _signed(s), _signed(h), _signed(r)],
                    ["doc_id", "copy", "start", "size", "short", "half", "region"],
                )

    return docs.select("doc_id", "copy", "text").mapInArrow(
        run, f"doc_id {doc_id}, copy bigint, start bigint, size bigint, short bigint, half bigint, region bigint"
    )


def full_windows(docs: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """The last level: a row of two names for every window of the runs."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            row, start, size = span_arrays(batch.column("spans"))
            for first, end in blocks(offsets):
                words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], SPACE)
                here = np.flatnonzero((row >= first) & (row < end))
                doc = np.repeat(row[here], size[here])
                at = expand(start[here] + words.first[row[here] - first], size[here])
                one, two = (p.names(p.prefix(words.named(k)), at, at + window) for k, p in enumerate((WORDS, OTHER)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), batch.column("copy").take(pa.array(doc)),
                     pa.array(at - words.first[doc - first]), _signed(one), _signed(two)],
                    ["doc_id", "copy", "start", "one", "two"],
                )

    return with_spans(docs, runs, "inner").mapInArrow(run, f"doc_id {doc_id}, copy bigint, start bigint, one bigint, two bigint")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans of words (start, size) covered by windows that also start earlier; ``docs`` is identified."""
    place = F.struct("doc_id", "copy", "start")
    quarter = repeated(candidates(docs, window), "short").drop("short")
    half = saved(repeated(saved(quarter, "quarter"), "half"), "half")
    firsts = saved(regions(half, "half", "region").select("half", "region", "least"), "regions")
    later = half.join(firsts, ["half", "region"]).where(place > F.col("least"))
    later = later.select("doc_id", "copy", "start", (F.col("size") + window - 1).alias("size"))
    # first regions that share a half window with another region may still share whole windows
    mixed = saved(firsts.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half"), "mixed")
    open_ = half.join(firsts, ["half", "region"]).where(place == F.col("least")).join(mixed, "half", "left_semi")
    # rows of a document that stands in the table twice are one
    open_ = open_.select("doc_id", "copy", "start", "size").distinct()
    windows = saved(full_windows(docs, open_, window), "windows")
    least = saved(windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1").drop("n"), "first_windows")
    single = windows.join(least, ["one", "two"]).where(place > F.col("least"))
    return later.unionByName(single.select("doc_id", "copy", "start", F.lit(window).cast("bigint").alias("size")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = arrow_bytes(batch.column("text"))
        row, start, size = span_arrays(batch.column("spans"))
        for first, end in blocks(offsets):
            here = np.flatnonzero((row >= first) & (row < end))
            part = offsets[first : end + 1] - offsets[first]
            words = Words(buf[offsets[first] : offsets[end]], part, SPACE)
            step = np.zeros(words.starts.size + 1, np.int64)
            begin = start[here] + words.first[row[here] - first]
            np.add.at(step, begin, 1)
            np.add.at(step, begin + size[here], -1)
            stay = np.cumsum(step[:-1]) == 0
            # bytes of the words that stay, and one space behind each but the last of a text
            place = np.flatnonzero(stay)
            byte = np.zeros(words.buf.size + 1, bool)
            byte[expand(words.starts[place], words.ends[place] - words.starts[place])] = True
            inner = place[:-1][words.doc[place[:-1]] == words.doc[place[1:]]]
            byte[words.ends[inner]] = True
            out = words.buf.copy()
            out[~SPACE[out]] = 0x20
            text = out[byte[:-1]].tobytes()
            ends = np.concatenate([[0], np.cumsum(byte[:-1])])[part].tolist()
            kept = pa.array([text[i:j] for i, j in zip(ends, ends[1:])], pa.binary()).cast(pa.string())
            gone = np.bincount(words.doc[~stay], minlength=end - first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, end - first), pa.array(words.count), pa.array(gone), kept], ["doc_id", "n_words", "n_removed", "kept_text"]
            )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row with the text that is left of it, words joined by single spaces."""
    docs = identified(docs)
    spans = saved(repeated_spans(docs, window), "spans")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs, spans).mapInArrow(_cut, f"doc_id {doc_id}, n_words bigint, n_removed bigint, kept_text string")


def substring_digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
