"""Benchmark decontamination with suffix arrays of the training texts.

Every task turns the texts it reads into shards. A shard has a suffix array over its words,
kept to the suffixes that begin with a few words of some benchmark item, which are all that
can match. Every suffix of every item is searched in it by bisection; the interval found
holds all verbatim occurrences of the suffix's first ten words. Occurrences that follow each
other in item and text are one longest match with its location. No row is shuffled.

The benchmark is the stated query set. It is cut into blocks of ``BLOCK_BYTES`` at most; each
is broadcast and searched in a pass of its own over the texts.

Defined cases: a null or empty text has no words and is clean; an item without words matches
nothing; an item shorter than the window is one window; a null item_id is the empty string;
rows with one item_id are one item; repeated document rows each give a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.flat import ALNUM, WORDS, Words, arrow_bytes, blocks, expand, joined_ranges

WINDOW = 10
LEAD = 3  # words by which suffixes are chosen before they are sorted
BLOCK_BYTES = 4 << 20  # of item texts in one broadcast; with the suffixes' first words about 64 MB
MATCH = "array<struct<item_id:string,item_word:bigint,doc_word:bigint,words:bigint>>"
MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]))


class Queries:
    """The suffixes of the items of one block: first words, and how many of them must match."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int) -> None:
        buf, offsets = arrow_bytes(pa.array(texts, pa.string()))
        words = Words(buf, offsets, ALNUM, lower=True)
        names = np.concatenate([words.named(), np.zeros(window, np.uint64)])
        left = words.first[words.doc + 1] - np.arange(words.starts.size)
        need = np.minimum(window, words.count[words.doc]) if words.starts.size else np.zeros(0, np.int64)
        use = np.flatnonzero(left >= need)
        self.words, self.needs = words, np.minimum(window, words.count)
        self.ids, self.item, self.need = ids, words.doc[use], need[use]
        self.place = use - words.first[self.item]
        self.heads = names[use[:, None] + np.arange(window)] if use.size else np.zeros((0, window), np.uint64)
        self.lead = int(min(LEAD, self.need.min())) if use.size else 1
        prefix = WORDS.prefix(names)
        self.leads = np.unique(WORDS.names(prefix, use, use + self.lead))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.leads & np.uint64((1 << 20) - 1)] = True


def bisect(queries: Queries, heads: np.ndarray, right: bool) -> np.ndarray:
    """Where each query's first words go among the sorted heads, before or behind equal ones."""
    low = np.zeros(queries.need.size, np.int64)
    high = np.full(queries.need.size, heads.shape[0])
    counted = np.arange(heads.shape[1]) < queries.need[:, None]
    while (open_ := low < high).any():
        middle = (low + high) // 2
        there = heads[np.minimum(middle, heads.shape[0] - 1)]
        differ = (there != queries.heads) & counted
        at = differ.argmax(1)
        rows = np.arange(at.size)
        below = np.where(differ.any(1), there[rows, at] < queries.heads[rows, at], right)
        low, high = np.where(open_ & below, middle + 1, low), np.where(open_ & ~below, middle, high)
    return low


def search(queries: Queries, words: Words, names: np.ndarray) -> tuple[np.ndarray, ...]:
    """All longest matches in a shard: document, item, place in the item, place in the text, words."""
    n, window = words.starts.size, queries.heads.shape[1]
    none = (np.zeros(0, np.int64),) * 5
    if not n or not queries.need.size:
        return none
    padded = np.concatenate([names, np.zeros(window, np.uint64)])
    left = words.first[words.doc + 1] - np.arange(n)
    fits = np.flatnonzero(left >= queries.lead)
    leads = WORDS.names(WORDS.prefix(names), fits, fits + queries.lead)
    some = queries.maybe[leads & np.uint64((1 << 20) - 1)]
    fits, leads = fits[some], leads[some]
    at = np.minimum(np.searchsorted(queries.leads, leads), queries.leads.size - 1)
    suffixes = fits[queries.leads[at] == leads]
    if not suffixes.size:
        return none
    heads = padded[suffixes[:, None] + np.arange(window)]
    heads[np.arange(window) >= left[suffixes][:, None]] = 0
    order = np.lexsort(heads.T[::-1])
    heads, suffixes = heads[order], suffixes[order]
    low, high = bisect(queries, heads, False), bisect(queries, heads, True)
    count = high - low
    query = np.repeat(np.arange(count.size), count)
    place = suffixes[expand(low, count)]
    inside = left[place] >= queries.need[query]
    query, place = query[inside], place[inside]
    if not query.size:
        return none
    doc, item, in_item = words.doc[place], queries.item[query], queries.place[query]
    order = np.lexsort((in_item, place - in_item, item, doc))
    doc, item, in_item, place, need = doc[order], item[order], in_item[order], place[order], queries.need[query][order]
    new = np.ones(doc.size, bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(place) != 1) | (np.diff(in_item) != 1)
    heads_at = np.flatnonzero(new)
    run = np.diff(np.append(heads_at, doc.size))
    return doc[heads_at], item[heads_at], in_item[heads_at], place[heads_at] - words.first[doc[heads_at]], run + need[heads_at] - 1


def spelled(words: Words, text: int, place: int) -> bytes:
    """A word of a text, by its bytes."""
    k = words.first[text] + place
    return words.buf[words.starts[k] : words.ends[k]].tobytes()


def spelled_matches(queries: Queries, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
    """What ``search`` finds by the names of words, as far as the words themselves are equal."""
    for doc, item, in_item, place, run in zip(*(x.tolist() for x in search(queries, words, words.named()))):
        start = 0
        for k in range(run + 1):
            if k == run or spelled(words, doc, place + k) != spelled(queries.words, item, in_item + k):
                if k - start >= queries.needs[item]:
                    yield doc, item, in_item + start, place + start, k - start
                start = k + 1


def _matcher(broadcast, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = broadcast.value
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            found = batch.column("matches").to_pylist()
            n_words = np.zeros(batch.num_rows, np.int64)
            n_hit = np.zeros(batch.num_rows, np.int64)
            for first, end in blocks(offsets):
                part = offsets[first : end + 1] - offsets[first]
                words = Words(buf[offsets[first] : offsets[end]], part, ALNUM, lower=True)
                n_words[first:end] = words.count
                for doc, item, in_item, place, run_ in spelled_matches(queries, words):
                    found[first + doc].append({"item_id": queries.ids[item], "item_word": in_item, "doc_word": place, "words": run_})
            matches = pa.array(found, MATCH_TYPE)
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), matches], ["doc_id", "text", "matches"])
                continue
            items = [sorted({m["item_id"] for m in x}) for x in found]
            for i, x in enumerate(found):
                if x:
                    starts = np.array([m["doc_word"] for m in x])
                    n_hit[i] = joined_ranges(starts, starts + np.array([m["words"] for m in x]), n_words[i]).sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                 pa.array(n_hit > 0), matches],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"])

    return run


def _cleaner(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = broadcast.value
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            clean = np.ones(batch.num_rows, bool)
            for first, end in blocks(offsets):
                words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], ALNUM, lower=True)
                clean[[first + x[0] for x in spelled_matches(queries, words)]] = False
            yield batch.filter(pa.array(clean))

    return run


def query_blocks(benchmark: DataFrame, window: int):
    """Broadcasts of the benchmark's suffixes, each of a block of bounded size."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.hash("id", "text"), F.lit(n_blocks)) == k).orderBy("id", "text").collect()
        queries = Queries([r.id for r in rows], [r.text for r in rows], window)
        yield benchmark.sparkSession.sparkContext.broadcast(queries), k == n_blocks - 1


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, hit words, items, and every longest match with its location."""
    doc_id = "doc_id " + docs.schema["doc_id"].dataType.simpleString()
    df = docs.select("doc_id", "text", F.array().cast(MATCH).alias("matches"))
    for block, last in query_blocks(benchmark, window):
        schema = f"{doc_id}, text string, matches {MATCH}"
        if last:
            schema = f"{doc_id}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, matches {MATCH}"
        df = df.mapInArrow(_matcher(block, last), schema)
    return df


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without those that hold a window of the benchmark."""
    for block, _ in query_blocks(benchmark, window):
        docs = docs.mapInArrow(_cleaner(block), docs.schema)
    return docs
