"""Token counts of texts of any length: huge ones by overlapping chunks that are spliced.

A text above ``CHUNK`` bytes is cut into overlapping chunks, which are dealt out over the tasks
and encoded by the library with offsets. Two chunks are spliced in their overlap, at the first
place where both end a token and which is proven stable: no piece of the vocabulary holds the
two characters around it side by side, so no merge of the whole text can reach over it, and what
stands on its two sides is encoded independently. The character before the overlap belongs to
the later chunk as well, so the library's space at its beginning stays outside. A text of which
two chunks do not align is cut again with wider overlaps, until every splice holds; the end of a
text is always one.

Defined cases: a null text is empty; an empty text has no tokens; repeated rows each give a row;
rows keep their doc_id, null too. For models without normalisation rules, as the given one is.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved
from vacancia.llm.flat import arrow_bytes, blocks

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 16  # bytes
OVERLAP = 1 << 10  # bytes
WIDER = 4  # times, where chunks do not align
LIMIT = 4096  # tokens
TEXT_BYTES = 1 << 21  # of texts that are encoded at once
SPACE = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Encoder:
    """The library with the pairs of characters that stand side by side in some piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        held = range(self.library.get_piece_size())
        pieces = [self.library.id_to_piece(i) for i in held if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode(texts, return_type="numpy", num_threads=1)]

    def begins(self, chunk: bytes) -> np.ndarray:
        """The byte at which each token of a chunk begins."""
        offsets = self.library.encode(chunk, return_type="offset_mapping")["offsets"]
        return np.fromiter((x[0] for x in offsets), np.int64, len(offsets))

    def stable(self, chunk: bytes, low: int, high: int) -> Iterator[int]:
        """Bytes of a window before which no piece can join two characters."""
        before = low - 1
        while chunk[before] & 0xC0 == 0x80:
            before -= 1
        text = chunk[before:high].decode(errors="ignore").replace(" ", SPACE)
        at = before
        for left, right in zip(text, text[1:]):
            at += len(left.encode()) - 2 * (left == SPACE and chunk[at] == 0x20)
            if at >= low and at < high and left + right not in self.joined:
                yield at

    def splice(self, chunk: bytes, begins: np.ndarray, low: int, high: int) -> int | None:
        """The first proven stable place of the window at which a token begins."""
        for at in self.stable(chunk, low, high):
            k = int(np.searchsorted(begins, at))
            if k < begins.size and begins[k] == at:
                return at
        return None


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def whole_texts(rows: DataFrame, path: str | None) -> DataFrame:
    """``rows`` with the number of tokens of ``text`` in its place."""
    others = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path or default_path())
        for batch in batches:
            counts: list[int] = []
            for first, last in blocks(arrow_bytes(batch.column("text"))[1], TEXT_BYTES):
                counts += known.counts(batch.column("text").slice(first, last - first).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], pa.array(counts, pa.int64())], [*[f.name for f in others], "n_tokens"])

    return rows.select(*[f.name for f in others], "text").mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "n_tokens bigint"]))


def _aligned(text: bytes, at: int) -> int:
    """The beginning of the character that holds a byte."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(text))


CUT = "row bigint, k int, size bigint, start bigint, low bigint, low_end bigint, high bigint, high_end bigint, chunk binary"


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], [x.split()[0] for x in CUT.split(", ")])


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunks of ``texts`` (row, text), each with the windows in which its two ends are looked for.

    The first chunk begins and the last one ends with the text. Places are bytes of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, value in zip(batch.column("row").to_pylist(), batch.column("text")):
                text = value.as_buffer().to_pybytes()
                n = len(text)
                edges = [0, *sorted({_aligned(text, x) for x in range(chunk, n, chunk)} - {0, n}), n]
                rows, held = [], 0
                for k, (low, high) in enumerate(zip(edges, edges[1:])):
                    low_end, high_end = (_aligned(text, min(n, x + overlap)) for x in (low, high))
                    start = _aligned(text, max(low - 1, 0))
                    rows.append((row, k, n, start, low, low_end, high, high_end, text[start : max(low_end, high_end)]))
                    held += len(rows[-1][-1])
                    if held > TEXT_BYTES:
                        yield _chunk_rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _chunk_rows(rows)

    return texts.select("row", "text").mapInArrow(run, CUT)


def encoded_chunks(chunks: DataFrame, path: str | None) -> DataFrame:
    """The places at which each chunk would be spliced (null: none in the window), and its tokens in between."""

    def one(known: Encoder, r: dict) -> tuple:
        data, start, n = r["chunk"], r["start"], r["size"]
        begins = known.begins(data)

        def splice(low: int, end: int) -> int | None:
            at = known.splice(data, begins, low - start, end - start)
            return at + start if at is not None else n if end == n else None

        def before(at: int) -> int:
            return begins.size if at == n else int(np.searchsorted(begins, at - start))

        left = 0 if r["low"] == 0 else splice(r["low"], r["low_end"])
        right = n if r["high"] == n else splice(r["high"], r["high_end"])
        return r["row"], r["k"], left, right, None if left is None or right is None else before(right) - before(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path or default_path())
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = [one(known, r) for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], ["row", "k", "left", "right", "n"])

    return chunks.mapInArrow(run, "row bigint, k int, left bigint, right bigint, n bigint")


def misaligned(spans: DataFrame) -> DataFrame:
    """Texts (row) of which some two neighbouring chunks do not agree on a splice."""
    sides = spans.select("row", F.col("k").alias("edge"), F.col("right").alias("at")).unionByName(
        spans.select("row", (F.col("k") - 1).alias("edge"), F.col("left").alias("at"))
    )
    edges = sides.groupBy("row", "edge").agg(F.min("at").alias("least"), F.max("at").alias("most"), F.count_if(F.col("at").isNull()).alias("open"))
    return edges.where("open > 0 OR least <> most").select("row").distinct()


def token_counts(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    short = whole_texts(sized.where(F.col("n_bytes") <= chunk), path)
    huge = saved(sized.where(F.col("n_bytes") > chunk).withColumn("row", F.monotonically_increasing_id()), "huge")
    counted, open_texts = [], huge
    while not open_texts.isEmpty():
        spans = saved(encoded_chunks(cut(open_texts, chunk, overlap).repartition("row", "k"), path), "spans")
        again = saved(misaligned(spans), "again")
        counted.append(spans.join(again, "row", "left_anti").groupBy("row").agg(F.sum("n").alias("n_tokens")))
        open_texts = saved(open_texts.join(again, "row", "left_semi"), "open")
        overlap *= WIDER
        chunk = max(chunk, WIDER * overlap)
    for counts in counted:
        short = short.unionByName(huge.select("row", "doc_id", "n_bytes").join(counts, "row").drop("row"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
