"""Removal of repeated byte strings, by suffix arrays sorted deep-shallow.

A string of 400 bytes repeats only if the 128-byte gram that anchors it does (see
``repeats``), and equal strings have equal anchors. So the suffixes that can matter are those
around anchors that occur twice, and anchors deal them out: equal suffixes meet in one task.
A task's suffixes are sorted in two phases. Multikey quicksort orders them by words of eight
bytes down to a shallow depth. The groups that are still equal there share long prefixes; blind
tries order those: every group jumps to the first word in which its members differ, branches
on that word alone and goes on. A group that reaches 400 bytes undivided is a repeated string.

Anchors whose whole region is copied are settled by the region's name and enter the sort once,
as the witness for other regions. An anchor with more than ``MANY`` different regions would
be one hot group; the strings of its regions are compared as named rows instead, which spread
over all tasks. Both ways are exact and give the same spans.

Defined cases: a null text is empty; rows of one doc_id and text are one document and give
equal rows; matches do not cross documents; spans and counts are in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import identified, same_document, saved
from vacancia.llm.flat import BYTES, OTHER, arrow_bytes, blocks, expand, mix
from vacancia.llm.repeats import anchor_runs, minimisers, regions, repeated, span_arrays, window_starts, with_spans

LENGTH = 400  # bytes
GRAM = 128  # bytes of an anchor
SHALLOW = 4  # words of eight bytes that quicksort compares
MANY = 8192  # regions of one anchor that are sorted in one task: 5 MB of bytes
CONTEXT_BYTES = 4 << 20  # sorted in one task, about
_U = np.uint64


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def candidates(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of anchors: the run of string starts that chose each, its name and its region's."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for first, end in blocks(offsets):
                part = buf[offsets[first] : offsets[end]]
                at = offsets[first : end + 1] - offsets[first]
                starts = window_starts(at[:-1], np.diff(at), length)
                if not starts.size:
                    continue
                piece = min(8, gram)
                prefix = BYTES.of_bytes(part, piece)
                reach = gram - piece + 1
                names = mix((prefix[reach : reach + part.size - gram + 1] - prefix[: part.size - gram + 1]) * BYTES.down[: part.size - gram + 1])
                anchor, start, count = anchor_runs(minimisers(names, length - gram + 1), starts)
                other = OTHER.of_bytes(part, piece)
                region = mix(OTHER.byte_names(other, start, start + count - 1 + length, piece) + (anchor - start).astype(np.uint64))
                doc = np.searchsorted(at, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc + first)), batch.column("copy").take(pa.array(doc + first)), pa.array(start - at[doc]),
                     pa.array(count), _signed(names[anchor]), _signed(region)],
                    ["doc_id", "copy", "start", "size", "anchor", "region"],
                )

    return docs.select("doc_id", "copy", "text").mapInArrow(
        run, f"doc_id {doc_id}, copy bigint, start bigint, size bigint, anchor bigint, region bigint"
    )


def words_at(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number that sorts like them; ``buf`` has eight more."""
    return np.ndarray((buf.size - 7,), ">u8", buffer=np.ascontiguousarray(buf), strides=(1,))


def regrouped(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by group, then key; and the refined groups in that order."""
    order = np.lexsort((key, group))
    group, key = group[order], key[order]
    new = np.ones(group.size, bool)
    new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    return order, np.cumsum(new) - 1


def without_single(group: np.ndarray) -> np.ndarray:
    """Places whose group has at least two members; groups are sorted."""
    return np.flatnonzero(np.bincount(group)[group] > 1) if group.size else np.zeros(0, np.int64)


def multikey_sort(words: np.ndarray, suffixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``depth`` words with another, and their groups."""
    group = np.zeros(suffixes.size, np.int64)
    for k in range(depth):
        order, group = regrouped(group, words[suffixes + 8 * k].astype(np.uint64))
        suffixes = suffixes[order]
        some = without_single(group)
        suffixes, group = suffixes[some], group[some]
    return suffixes, group


def blind_tries(words: np.ndarray, suffixes: np.ndarray, group: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Suffixes that share ``length`` bytes with another member of their group.

    All groups grow one node a round: the node's depth is the first word in which any member
    differs from the group's head, and the children are the values of that word.
    """
    # the last word ends with the string and may overlap the one before
    offsets = np.append(np.arange(0, length - 8, 8), length - 8)
    level = np.full(suffixes.size, depth, np.int64)
    equal: list[np.ndarray] = []
    while suffixes.size:
        first = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(np.append(first, group.size))
        head = np.repeat(suffixes[first], sizes)
        reach = np.full(suffixes.size, offsets.size)
        alike = np.arange(suffixes.size)
        at = level.copy()
        while alike.size:
            alike = alike[at[alike] < offsets.size]
            same = words[suffixes[alike] + offsets[at[alike]]] == words[head[alike] + offsets[at[alike]]]
            reach[alike[~same]] = at[alike[~same]]
            alike = alike[same]
            at[alike] += 1
        node = np.repeat(np.minimum.reduceat(reach, first), sizes)
        leaf = node == offsets.size
        equal.append(suffixes[leaf])
        suffixes, group, node = suffixes[~leaf], group[~leaf], node[~leaf]
        if not suffixes.size:
            break
        order, group = regrouped(group, words[suffixes + offsets[node]].astype(np.uint64))
        suffixes, level = suffixes[order], node[order] + 1
        some = without_single(group)
        suffixes, group, level = suffixes[some], group[some], level[some]
    return np.concatenate([*equal, np.zeros(0, np.int64)])


def repeated_suffixes(buf: np.ndarray, suffixes: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> np.ndarray:
    """Which of the suffixes share ``length`` bytes (eight or more) with another; ``buf`` holds all of those bytes."""
    words = words_at(np.concatenate([buf, np.zeros(8, np.uint8)]))
    depth = min(shallow, length // 8)
    return np.sort(blind_tries(words, *multikey_sort(words, suffixes, depth), depth, length))


def contexts(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The bytes of every run's region; ``runs`` has spans with an anchor."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    by_doc = runs.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "size", "anchor")).alias("spans"))
    joined = docs.join(by_doc, same_document(docs, by_doc)).select(docs["doc_id"], docs["copy"], "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            row, start, size, anchor = span_arrays(batch.column("spans"))
            begin = offsets[row] + start
            for k in range(0, row.size, 4096):
                some = slice(k, k + 4096)
                pieces = [buf[i:j].tobytes() for i, j in zip(begin[some].tolist(), (begin[some] + size[some] - 1 + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[some])), batch.column("copy").take(pa.array(row[some])), pa.array(start[some]),
                     pa.array(size[some]), pa.array(anchor[some]), pa.array(pieces, pa.binary())],
                    ["doc_id", "copy", "start", "size", "anchor", "bytes"],
                )

    return joined.mapInArrow(run, f"doc_id {doc_id}, copy bigint, start bigint, size bigint, anchor bigint, bytes binary")


def _rows(table: pa.Table, row: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    row = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [table.column("doc_id").combine_chunks().take(row), table.column("copy").combine_chunks().take(row), pa.array(start), pa.array(size)],
        ["doc_id", "copy", "start", "size"],
    )


def sorted_spans(regions_: DataFrame, length: int) -> DataFrame:
    """Spans of repeated strings in one anchor's regions, by the suffix arrays of the tasks."""
    doc_id = regions_.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        del parts
        size = table.column("size").to_numpy()
        start = table.column("start").to_numpy()
        buf, at = arrow_bytes(table.column("bytes"))
        found = repeated_suffixes(buf, expand(at[:-1], size), length)
        row = np.searchsorted(at, found, "right") - 1
        new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(found, prepend=-2) != 1))
        count = np.diff(np.append(new, found.size))
        row, found = row[new], found[new]
        yield _rows(table, row, start[row] + found - at[row], count - 1 + length)

    return regions_.drop("many").mapInArrow(run, f"doc_id {doc_id}, copy bigint, start bigint, size bigint")


def named_strings(regions_: DataFrame, length: int) -> DataFrame:
    """A row of two names for every string of the regions."""
    doc_id = regions_.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                buf, at = arrow_bytes(some.column("bytes"))
                size, start = some.column("size").to_numpy(), some.column("start").to_numpy()
                place, row = expand(at[:-1], size), np.repeat(np.arange(some.num_rows), size)
                piece = min(8, length)
                one, two = (p.byte_names(p.of_bytes(buf, piece), place, place + length, piece) for p in (BYTES, OTHER))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(pa.array(row)), some.column("copy").take(pa.array(row)), pa.array(start[row] + place - at[row]), _signed(one), _signed(two)],
                    ["doc_id", "copy", "start", "one", "two"],
                )

    return regions_.mapInArrow(run, f"doc_id {doc_id}, copy bigint, start bigint, one bigint, two bigint")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """Spans of bytes (start, size) covered by strings that start elsewhere too; ``docs`` is identified."""
    place = F.struct("doc_id", "copy", "start")
    found = saved(repeated(candidates(docs, length, gram), "anchor"), "anchors")
    whole = saved(regions(found, "anchor", "region"), "regions")
    copied = whole.where("least < most").select("anchor", "region")
    copied = found.join(copied, ["anchor", "region"], "left_semi").select("doc_id", "copy", "start", (F.col("size") + length - 1).alias("size"))
    counts = saved(whole.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > many).alias("many")), "mixed")
    firsts = found.join(whole.select("anchor", "region", "least"), ["anchor", "region"]).where(place == F.col("least"))
    # rows of a document that stands in the table twice are one
    runs = saved(firsts.select("doc_id", "copy", "start", "size", "anchor").distinct().join(counts, "anchor"), "runs")
    texts = saved(contexts(docs.dropDuplicates(["doc_id", "copy"]) if _several(docs) else docs, runs, length).join(counts, "anchor"), "contexts")
    size = texts.agg(F.sum(F.length("bytes")).alias("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // CONTEXT_BYTES))
    by_sort = sorted_spans(texts.where("not many").repartition(parts, "anchor"), length)
    names = saved(named_strings(texts.where("many"), length), "strings")
    least = saved(names.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated_strings")
    single = names.join(least, ["one", "two"], "left_semi").select("doc_id", "copy", "start", F.lit(length).cast("bigint").alias("size"))
    return copied.unionByName(by_sort).unionByName(single)


def _several(docs: DataFrame) -> bool:
    return not docs.where("copy <> 0").isEmpty()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = arrow_bytes(batch.column("text"))
        row, start, size = span_arrays(batch.column("spans"))
        for first, end in blocks(offsets):
            here = np.flatnonzero((row >= first) & (row < end))
            at = offsets[first : end + 1] - offsets[first]
            part = buf[offsets[first] : offsets[end]]
            step = np.zeros(part.size + 1, np.int64)
            begin = start[here] + at[row[here] - first]
            np.add.at(step, begin, 1)
            np.add.at(step, begin + size[here], -1)
            out = np.cumsum(step[:-1]) > 0
            # runs of removed bytes end with their text
            edge = np.zeros(part.size + 1, bool)
            edge[at] = True
            opens = np.flatnonzero(out & (edge[:-1] | ~np.concatenate([[False], out])[:-1]))
            closes = np.flatnonzero(out & (edge[1:] | ~np.concatenate([out, [False]])[1:])) + 1
            doc = np.searchsorted(at, opens, "right") - 1
            total = np.concatenate([[0], np.cumsum(out)])[at]
            rest = part[~out].tobytes()
            ends = (at - total).tolist()
            kept = pa.array([rest[i:j] for i, j in zip(ends, ends[1:])], pa.binary())
            n = np.bincount(doc, minlength=end - first)
            runs = pa.StructArray.from_arrays([pa.array(opens - at[doc]), pa.array(closes - at[doc])], ["start", "stop"])
            spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, end - first), pa.array(np.diff(at)), pa.array(np.diff(total)), pa.array(n), kept, spans],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every row with the removed spans of bytes, and the bytes that are left."""
    docs = identified(docs)
    spans = saved(repeated_spans(docs, length, gram), "spans")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<start:bigint,stop:bigint>>"
    return with_spans(docs, spans).mapInArrow(_cut, schema)


def suffix_digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
