"""SentencePiece (BPE with byte fallback) encoding and decoding by vectorised merge rounds.

The distinct words of a batch are one flat array of symbols. A round ranks all neighbouring
pairs, takes the least rank of each word's segment, merges the leftmost pair of that rank in
every word at once, and drops the words in which no pair remains. That is the order in which
the library's queue takes the pairs of one word, and no piece reaches over the start of a
word, so the ids are the library's. Texts are read where they lie; nothing is shuffled.

Only the vocabulary is read through the library. Words above ``LONG`` symbols go through the
same merges with a heap, as rounds over them would cost the square of their length.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows
each give a row.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacancia.llm.flat import arrow_bytes, blocks, expand, segment_names

SPACE = "▁"
LONG = 256  # symbols
TEXT_BYTES = 1 << 21  # of texts whose distinct words are merged at once
NONE = np.iinfo(np.int32).max


class Model:
    """Vocabulary tables of a BPE model without normalisation rules (identity, dummy prefix)."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        normal = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        pieces = {library.id_to_piece(i): i for i in normal}
        scores = sorted({library.get_score(i) for i in normal}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(scores)}
        self.skipped = np.array([library.is_control(i) for i in range(size)])
        self.byte_of = np.full(size, -1, np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(size):
            if library.is_byte(i):
                value = int(library.id_to_piece(i)[3:5], 16)
                self.byte_of[i], self.byte_ids[value] = value, i
        surface = []
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                surface.append(bytes([self.byte_of[i]]))
            elif library.is_unknown(i):
                surface.append(" ⁇ ".encode())  # the library's fixed text for an unknown id
            else:
                surface.append(b"" if library.is_control(i) else piece.replace(SPACE, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.concatenate([[0], np.cumsum([len(x) for x in surface])])
        digits = [b"%d," % i for i in range(size)]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digits_at = np.concatenate([[0], np.cumsum([len(x) for x in digits])])
        self.leads = np.array([library.id_to_piece(i).startswith(SPACE) and not library.is_control(i) for i in range(size)])
        # symbols: every piece, and every character that some piece holds; 0 is any other character
        symbols = {x: k for k, x in enumerate(dict.fromkeys(itertools.chain(sorted({c for p in pieces for c in p}), pieces)), 1)}
        self.id_of = np.full(len(symbols) + 1, -1, np.int64)
        for piece, i in pieces.items():
            self.id_of[symbols[piece]] = i
        self.symbol_of = np.zeros(0x110000, np.int32)
        for x, k in symbols.items():
            if len(x) == 1:
                self.symbol_of[ord(x)] = k
        self.width = len(symbols) + 1
        pairs = sorted(
            (symbols[piece[:cut]] * self.width + symbols[piece[cut:]], rank_of[library.get_score(i)], symbols[piece])
            for piece, i in pieces.items() for cut in range(1, len(piece)) if piece[:cut] in symbols and piece[cut:] in symbols
        )
        self.keys = np.array([x[0] for x in pairs], np.int64)
        self.ranks = np.array([x[1] for x in pairs] + [NONE], np.int32)
        self.products = np.array([x[2] for x in pairs], np.int32)
        self.pairs = {x[0]: x[1:] for x in pairs}

    def at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the table; its end for none."""
        keys = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[np.minimum(at, self.keys.size - 1)] == keys, at, self.keys.size)

    def merged(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rounds over flat words: the final symbols, the place of their first character, their word."""
        symbol, place = self.symbol_of[codes], np.arange(codes.size)
        word = np.repeat(np.arange(lengths.size), lengths)
        rank_at = np.full(codes.size, self.keys.size)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank_at[inner] = self.at(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, ...]] = []
        while symbol.size:
            rank = self.ranks[rank_at]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, word.size))
            least_here = np.repeat(least, sizes)
            over = least_here == NONE
            if over.any():
                done.append((symbol[over], place[over], word[over]))
                go = ~over
                symbol, place, word, rank_at, rank, least_here = (x[go] for x in (symbol, place, word, rank_at, rank, least_here))
                if not symbol.size:
                    break
            hits = np.flatnonzero(rank == least_here)
            left = hits[np.diff(word[hits], prepend=-1) != 0]
            symbol[left] = self.products[rank_at[left]]
            keep = np.ones(symbol.size, bool)
            keep[left + 1] = False
            left = left - np.arange(left.size)  # each word merged once, so as many symbols went before
            symbol, place, word, rank_at = symbol[keep], place[keep], word[keep], rank_at[keep]
            for side in (left - 1, left):
                side = side[(side >= 0)]
                inside = side + 1 < word.size
                same = np.zeros(side.size, bool)
                same[inside] = word[side[inside]] == word[side[inside] + 1]
                rank_at[side[~same]] = self.keys.size
                side = side[same]
                rank_at[side] = self.at(symbol[side], symbol[side + 1])
        parts = [np.concatenate(x) for x in zip(*done)] if done else [np.zeros(0, np.int64)] * 3
        order = np.argsort(parts[1], kind="stable")
        return parts[0][order], parts[1][order], parts[2][order]

    def merged_long(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for one long word, by a heap over linked symbols."""
        symbol, n = self.symbol_of[codes].tolist(), codes.size
        after, before, heap = [*range(1, n), -1], [*range(-1, n - 1)], []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (pair := self.pairs.get(symbol[i] * self.width + symbol[after[i]])):
                heapq.heappush(heap, (pair[0], i, symbol[i], symbol[after[i]], pair[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, product = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue
            symbol[i], symbol[j], after[i] = product, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        left = [i for i in range(n) if symbol[i] >= 0]
        return np.array([symbol[i] for i in left], np.int64), np.array(left, np.int64)

    def encode_words(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and how many each has; words are code points, flat."""
        ends = np.cumsum(lengths)
        long = lengths > LONG
        short = np.repeat(~long, lengths)
        places = np.flatnonzero(short)
        symbol, place, word = self.merged(codes[places], lengths[~long])
        parts = [(symbol.astype(np.int64), places[place], np.flatnonzero(~long)[word])]
        for w in np.flatnonzero(long).tolist():
            symbol, place = self.merged_long(codes[ends[w] - lengths[w] : ends[w]])
            parts.append((symbol, place + ends[w] - lengths[w], np.full(symbol.size, w)))
        symbol, place, word = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(place, kind="stable")
        symbol, place, word = symbol[order], place[order], word[order]
        ids = self.id_of[symbol]
        lost = np.flatnonzero(ids < 0)  # characters without a piece become the ids of their bytes
        if lost.size:
            raw = [chr(c).encode("utf-8", "replace") for c in codes[place[lost]].tolist()]
            times = np.ones(ids.size, np.int64)
            times[lost] = [len(x) for x in raw]
            ids, word = np.repeat(ids, times), np.repeat(word, times)
            ids[ids < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.bincount(word, minlength=lengths.size)

    def decode_flat(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Surfaces of the ids, joined, and the bytes of each."""
        sizes = self.surface_at[ids + 1] - self.surface_at[ids]
        return self.surface[expand(self.surface_at[ids], sizes)].tobytes(), sizes

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (UTF-8, flat), flat, and how many each has."""
        if SPACE.encode() in buf.tobytes():  # the sign for a space reads as one
            data = buf.tobytes()
            texts = [data[i:j].replace(SPACE.encode(), b" ") for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        # every text that is not empty gets a space before it; words begin with their spaces
        full = np.diff(offsets) > 0
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        heads = offsets[:-1][full]
        body = np.ones(int(offsets[-1]), bool)
        body[heads] = False
        text = np.full(body.size, 0x20, np.uint8)
        text[body] = buf
        space = text == 0x20
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[heads] = True
        starts = np.flatnonzero(begin)
        sizes = np.diff(np.append(starts, text.size))
        if not starts.size:
            return np.zeros(0, np.int64), np.zeros(full.size, np.int64)
        _, at, which = np.unique(segment_names(text, starts, starts + sizes), return_index=True, return_inverse=True)
        # equal names must be equal words; else every word is its own
        if (sizes[at][which] != sizes).any() or (text[expand(starts[at][which], sizes)] != text).any():
            at = which = np.arange(starts.size)
        letters = text[expand(starts[at], sizes[at])]
        codes = np.frombuffer(letters.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        codes[codes == 0x20] = ord(SPACE)
        lengths = np.add.reduceat(((letters & 0xC0) != 0x80).astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
        ids, counts = self.encode_words(codes, lengths)
        first, counts = (np.cumsum(counts) - counts)[which], counts[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids[expand(first, counts)], np.diff(total[np.searchsorted(starts, offsets)])

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts (UTF-8) of what ``encode`` returns."""
        data, sizes = self.decode_flat(ids)
        ends = np.cumsum(counts)
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
        skip = np.zeros(counts.size, np.int64)
        some = np.flatnonzero(counts)
        skip[some] = self.leads[ids[(ends - counts)[some]]]
        return [data[i:j] for i, j in zip((at[:-1] + skip).tolist(), at[1:].tolist())]

    def listed(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The ids of every sequence as decimals joined by commas."""
        sizes = self.digits_at[ids + 1] - self.digits_at[ids]
        data = self.digits[expand(self.digits_at[ids], sizes)].tobytes()
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[i : max(i, j - 1)] for i, j in zip(at, at[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one sequence of ids, as the library decodes it."""
        ids = np.asarray(ids, np.int64)
        spoken = ids[~self.skipped[ids]]
        if not spoken.size:
            return ""
        data, sizes = self.decode_flat(ids)
        if self.leads[spoken[0]]:
            data = data[1:]
        # bytes that are no character are one replacement each; a control id ends a run of bytes
        stops = np.maximum(np.cumsum(sizes)[self.skipped[ids]] - int(self.leads[spoken[0]]), 0).tolist()
        parts = [data[i:j].decode("utf-8", "surrogateescape") for i, j in zip([0, *stops], [*stops, len(data)])]
        return re.sub("[\udc80-\udcff]", "\ufffd", "".join(parts))


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def coded(known: Model, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and counts of a column of texts, some texts at a time."""
    buf, offsets = arrow_bytes(column)
    for first, end in blocks(offsets, TEXT_BYTES):
        yield known.encode(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Each row with the ids of its text in place of the text.

    The column is ``ids``; rows that have a column of that name keep it, and the new one is ``_ids``
    (or with as many underscores as it takes).
    """
    others = [f for f in docs.schema.fields if f.name != "text"]
    name = "ids"
    while name in docs.columns:
        name = "_" + name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path or default_path())
        for batch in batches:
            first = 0
            for ids, counts in coded(known, batch.column("text")):
                part = batch.slice(first, counts.size)
                first += counts.size
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in others], lists], [*[f.name for f in others], name])

    return docs.select(*[f.name for f in others], "text").mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], f"{name} array<int>"]))


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Each row with the text of its ids in place of the ids; null ids are no ids."""
    others = [f for f in rows.schema.fields if f.name not in ("text", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path or default_path())
        for batch in batches:
            texts = [known.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in others], pa.array(texts, pa.string())], [*[f.name for f in others], "text"]
            )

    return rows.select(*[f.name for f in others], "ids").mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "text string"]))


def round_trip_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every text, decoded again: counts and digests, one row per row."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path or default_path())
        for batch in batches:
            first = 0
            for ids, counts in coded(known, batch.column("text")):
                part = batch.slice(first, counts.size)
                first += counts.size
                lists, texts = ([hashlib.sha256(x).hexdigest() for x in f(ids, counts)] for f in (known.listed, known.decode_all))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(lists, pa.string()), pa.array(texts, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_id}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
