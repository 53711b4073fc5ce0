"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates, from the uniform one
over the vocabulary to that of the longest n-gram. The weights depend on how often the context
was seen (a bucket per power of two, and one per longest shorter context where it never was). They are learned by expectation-maximisation on a part
of the training texts that is deleted from the counts for that: one tenth, by the tens of the
document's hash. The estimates then come from all training texts.

Counting and looking up are shuffles of packed arrays. Texts are dealt into blocks by a hash;
a block sends each of its distinct n-grams once, with its count, to the n-gram's bucket, packed
as sorted arrays: a count of one is a bit, and a name is as long as its distance to the next.
A bucket adds up the counts and sends them back to the blocks in the order in which they came,
so a hot n-gram is one number per block. Blocks meet their counts again and score their texts.
Tokens have names of 64 bits. Those of longer n-grams are ``SPARE`` bits longer than it takes to
number all n-grams of the corpus, so about one in 2**20 of them shares its name with another.
Events for the weights are gathered as a histogram: a row per bucket and rounded estimates, and
estimates are rounded to half as many bins until it has ``CELLS`` rows at most.

Defined cases: a null or empty text is one token, the end; repeated rows each are a document;
a null doc_id hashes as the empty text; without training texts every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import groups, saved, text_bytes
from vacancia.llm.flat import SPACE, Words, arrow_bytes, blocks, mix

ORDER = 3
BLOCK_BYTES = 8 << 20  # of text in one group
BLOCKS_PER_BUCKET = 4  # a bucket holds about 16 MB of packed n-grams, at any size of the corpus
SPARE = 20
FOLDS = 10
STEPS = 8  # histogram bins of an estimate for every doubling
ROUNDS = 60
CELLS = 20_000
_U = np.uint64
END, BEGIN = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)


def tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all tokens, each text's words and an end; and how many each text has."""
    buf, offsets = arrow_bytes(texts)
    names, counts = [], []
    for first, end in blocks(offsets):
        words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], SPACE, lower=True)
        ends = np.cumsum(words.count + 1) - 1
        out = np.empty(words.starts.size + ends.size, np.uint64)
        word = np.ones(out.size, bool)
        word[ends] = False
        out[word], out[ends] = words.named(), END
        names.append(out)
        counts.append(words.count + 1)
    none = np.zeros(0, np.int64)
    return np.concatenate([*names, none.astype(np.uint64)]), np.concatenate([*counts, none])


def grams(names: np.ndarray, counts: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """Names of the n-grams that end at each token, for n from 1 to ``order``; texts begin with markers.

    Names of tokens have 64 bits, the others ``bits``.
    """
    first = np.cumsum(counts) - counts
    place = np.arange(names.size) - np.repeat(first, counts)
    out = [mix(names)]
    for n in range(1, order):
        before = np.empty_like(names)
        before[n:] = names[:-n] if n < names.size else names[:0]
        before[place < n] = BEGIN
        out.append(mix(out[-1] * _U(0x9E3779B97F4A7C15) + before + _U(n)))
    return [x if n == 0 else x >> _U(64 - bits) for n, x in enumerate(out)]


def bucket_edges(buckets: int, bits: int) -> np.ndarray:
    """First names of the buckets: equal ranges of the numbers of so many bits."""
    return (np.arange(buckets, dtype=object) * (1 << bits) // buckets).astype(np.uint64)


def narrow(x: np.ndarray) -> bytes:
    """64-bit numbers in as few bits each as the largest needs, which the first byte tells."""
    width = max(1, int(x.max(initial=0)).bit_length())
    bits = np.unpackbits(np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bytes([width]) + np.packbits(bits[:, :width].reshape(-1), bitorder="little").tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.zeros((n, 64), np.uint8)
    bits[:, : data[0]] = np.unpackbits(np.frombuffer(data, np.uint8, offset=1), count=n * data[0], bitorder="little").reshape(n, data[0])
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u8")


def squeezed(x: np.ndarray) -> bytes:
    """Counts: a bit for each tells a one, the others follow."""
    one = x == 1
    return np.packbits(one).tobytes() + narrow(x[~one].astype(np.uint64))


def spread(data: bytes, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    head = -(-n // 8)
    other = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, head), count=n) == 0) if n else np.zeros(0, np.int64)
    out[other] = wide(data[head:], other.size)
    return out


def _packed(order: int, buckets: int, bits: int):
    every = [bucket_edges(buckets, 64 if n == 0 else bits) for n in range(order)]

    def run(table: pa.Table) -> pa.Table:
        names, counts = tokens(table.column("text"))
        learned = np.repeat(table.column("train").to_numpy(zero_copy_only=False), counts)
        rows = []
        for n, (gram, edges) in enumerate(zip(grams(names, counts, order, bits), every), 1):
            keys, at = np.unique(gram, return_inverse=True)
            seen = np.bincount(at[learned], minlength=keys.size)
            cuts = np.append(np.searchsorted(keys, edges), keys.size)
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                some = slice(cuts[k], cuts[k + 1])
                rows.append((n, k, cuts[k + 1] - cuts[k], narrow(np.diff(keys[some], prepend=edges[k])), squeezed(seen[some])))
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table({
            "n": pa.array(columns[0], pa.int32()), "bucket": pa.array(columns[1], pa.int32()),
            "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int32()), "size": pa.array(columns[2], pa.int64()),
            "keys": pa.array(columns[3], pa.binary()), "seen": pa.array(columns[4], pa.binary()),
        })

    return run


PACKED = "n int, bucket int, block int, size bigint, keys binary, seen binary"
COUNTED = "n int, bucket int, block int, size bigint, seen binary, gone binary, tokens bigint, kinds bigint, deleted bigint"


def _added(buckets: int, blocks_: int, bits: int):
    """The sums of a bucket, in the order of the pieces; and a row of its totals.

    Blocks from ``blocks_`` on hold the deleted texts; only they get the counts of those back.
    """
    def run(table: pa.Table) -> pa.Table:
        n, bucket = (table.column(c)[0].as_py() for c in ("n", "bucket"))
        edges = bucket_edges(buckets, 64 if n == 1 else bits)
        sizes, block = table.column("size").to_pylist(), table.column("block").to_pylist()
        names = [edges[bucket] + np.cumsum(wide(x, s), dtype=np.uint64) for x, s in zip(table.column("keys").to_pylist(), sizes)]
        parts = [spread(x, s) for x, s in zip(table.column("seen").to_pylist(), sizes)]
        keys, at = np.unique(np.concatenate(names), return_inverse=True)
        seen, gone = np.zeros(keys.size, np.uint64), np.zeros(keys.size, np.uint64)
        np.add.at(seen, at, np.concatenate(parts))
        ends = np.cumsum(sizes).tolist()
        for k, (b, s, e) in enumerate(zip(block, sizes, ends)):
            if b >= blocks_:
                np.add.at(gone, at[e - s : e], parts[k])
        back = [(squeezed(seen[at[e - s : e]]), squeezed(gone[at[e - s : e]]) if b >= blocks_ else b"") for b, s, e in zip(block, sizes, ends)]
        rows = len(sizes)
        return pa.table({
            "n": pa.array([n] * (rows + 1), pa.int32()), "bucket": pa.array([bucket] * (rows + 1), pa.int32()),
            "block": pa.array([*block, -1], pa.int32()), "size": pa.array([*sizes, 0], pa.int64()),
            "seen": pa.array([*[x[0] for x in back], b""], pa.binary()), "gone": pa.array([*[x[1] for x in back], b""], pa.binary()),
            "tokens": pa.array([0] * rows + [int(seen.sum())], pa.int64()), "kinds": pa.array([0] * rows + [int((seen > 0).sum())], pa.int64()),
            "deleted": pa.array([0] * rows + [int(gone.sum())], pa.int64()),
        })

    return run


def unseen(longest: np.ndarray | int, order: int) -> np.ndarray | int:
    """The bucket of a context never seen, by the longest n-gram whose context was: 0, or one of the last."""
    return np.where(np.asarray(longest) > 1, 64 - order + longest, 0)


class Block:
    """A block's texts with the counts that came back for their n-grams."""

    def __init__(self, texts: pa.Table, counted: pa.Table, order: int, bits: int, deleted: bool) -> None:
        names, self.counts = tokens(texts.column("text"))
        self.first = np.cumsum(self.counts) - self.counts
        counted = counted.sort_by([("n", "ascending"), ("bucket", "ascending")])
        which = counted.column("n").to_numpy()
        self.seen, self.gone = [], []
        for n, gram in enumerate(grams(names, self.counts, order, bits), 1):
            _, at = np.unique(gram, return_inverse=True)
            mine = counted.filter(pa.array(which == n))
            for name, out in (("seen", self.seen), ("gone", self.gone)) if deleted else (("seen", self.seen),):
                parts = [spread(x, s) for x, s in zip(mine.column(name).to_pylist(), mine.column("size").to_pylist())]
                out.append(np.concatenate(parts).astype(np.int64)[at])

    def estimates(self, totals: dict, deleted: bool) -> tuple[list[np.ndarray], np.ndarray]:
        """Estimates of every token by rising order, over the uniform one; and the context's bucket.

        ``deleted``: from the counts without the deleted texts.
        """
        counts = [s - g for s, g in zip(self.seen, self.gone)] if deleted else self.seen
        size = totals["tokens"] - totals["deleted"] if deleted else totals["tokens"]
        texts = totals["texts"] - totals["texts_deleted"] if deleted else totals["texts"]
        uniform = totals["kinds"] + 1
        out = [counts[0] / max(size, 1) * uniform]
        context, longest = np.full(counts[0].size, size), np.ones(counts[0].size, np.int64)
        for n in range(1, len(counts)):
            # a context is the n-gram that ended at the token before; at a text's begin, the markers
            context = np.empty_like(counts[n])
            context[1:] = counts[n - 1][:-1]
            context[self.first] = texts
            out.append(np.where(context > 0, counts[n] / np.maximum(context, 1), 0.0) * uniform)
            longest += context > 0
        bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, unseen(longest, len(counts))).astype(np.int64)
        return out, bucket


def _bins(ratio: np.ndarray) -> np.ndarray:
    """Bins of estimates over the uniform one; bin 0 is no estimate."""
    return np.where(ratio > 0, np.round(np.log2(np.maximum(ratio, 1e-300)) * STEPS) + 128 * STEPS, 0).astype(np.int64)


def _events(order: int, bits: int, totals: dict):
    def run(texts: pa.Table, counted: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({"bucket": pa.array([], pa.int64()), "bins": pa.array([], pa.list_(pa.int64())), "events": pa.array([], pa.int64())})
        block = Block(texts, counted, order, bits, True)
        ratios, bucket = block.estimates(totals, True)
        cells = np.stack([bucket, *[_bins(r) for r in ratios]], axis=1)
        kinds, n = np.unique(cells, axis=0, return_counts=True)
        return pa.table({"bucket": kinds[:, 0], "bins": pa.array(kinds[:, 1:].tolist(), pa.list_(pa.int64())), "events": n})

    return run


def histogram(events: DataFrame, cells: int) -> list:
    """Rows (bucket, bins, events), ``cells`` at most (one per bucket and set of estimates that are there, at least)."""
    every = saved(events.groupBy("bucket", "bins").agg(F.sum("events").alias("events")), "events")
    width, found = 1, every
    while found.count() > cells and width < 1 << 16:
        width *= 2
        wider = F.transform("bins", lambda b: F.when(b > 0, (F.floor(b / F.lit(width)) * width).cast("bigint") + width // 2).otherwise(b))
        found = every.groupBy("bucket", wider.alias("bins")).agg(F.sum("events").alias("events"))
    return found.collect()


def weights(rows: list, order: int) -> np.ndarray:
    """Mixture weights by context bucket, uniform first, that make the deleted events likeliest."""
    out = np.zeros((64, order + 1))
    out[:, 0] = 1
    buckets = np.array([r.bucket for r in rows], np.int64)
    bins = np.array([r.bins for r in rows], np.int64).reshape(len(rows), order)
    n = np.array([r.events for r in rows], float)
    ratio = np.concatenate([np.ones((len(rows), 1)), np.where(bins > 0, 2.0 ** ((bins - 128 * STEPS) / STEPS), 0.0)], axis=1)
    for b in [None, *range(64)]:
        some = np.ones(n.size, bool) if b is None else buckets == b
        if not some.any():
            continue
        share = np.full(order + 1, 1 / (order + 1))
        for _ in range(ROUNDS):
            part = ratio[some] * share
            share = (part / part.sum(1, keepdims=True) * n[some, None]).sum(0) / n[some].sum()
        share = np.maximum(share, 1e-6)
        if b is None:
            out[:] = share / share.sum()  # a bucket without events takes those of all
        else:
            out[b] = share / share.sum()
    for n in range(1, order):
        out[unseen(n, order), n + 1 :] = 0  # nothing is known of a context never seen
    return out / out.sum(1, keepdims=True)


def _scored(order: int, bits: int, totals: dict, mixture: np.ndarray):
    def run(texts: pa.Table, counted: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return texts.select(["doc_id", "held_out"]).append_column("n_tokens", pa.array([], pa.int64())).append_column(
                "n_known", pa.array([], pa.int64())).append_column("base_score", pa.array([], pa.float64())).append_column("score", pa.array([], pa.float64()))
        block = Block(texts, counted, order, bits, False)
        ratios, bucket = block.estimates(totals, False)
        share = mixture[bucket]
        mixed = share[:, 0] + sum(share[:, k] * r for k, r in enumerate(ratios, 1))
        size, kinds = totals["tokens"], totals["kinds"]
        base = np.log10((block.seen[0] + 0.1) / (size + 0.1 * (kinds + 1)))
        score = np.log10(mixed) - np.log10(kinds + 1)
        add = lambda x: np.add.reduceat(x, block.first)
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": block.counts,
            "n_known": add((block.seen[0] > 0).astype(np.int64)), "base_score": add(base), "score": add(score),
        })

    return run


def interpolated_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores of every row of ``docs`` under a model learned from the rows that are not held out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    train = crc % FOLDS != 0
    gone = train & (F.floor(crc / FOLDS) % FOLDS == 0)
    size = text_bytes(docs)
    n = groups(docs, size, BLOCK_BYTES)
    buckets = max(-(-n // BLOCKS_PER_BUCKET), 1)
    bits = min(64, SPARE + (order * size).bit_length())
    n_gone = -(-n // FOLDS)  # deleted texts have blocks of their own
    place = F.xxhash64("doc_id", text)
    dealt = docs.select(
        "doc_id", text.alias("text"), (~train).alias("held_out"), train.alias("train"),
        F.when(gone, n + F.pmod(place, F.lit(n_gone))).otherwise(F.pmod(place, F.lit(n))).cast("int").alias("block"),
    )
    packed = dealt.groupBy("block").applyInArrow(_packed(order, buckets, bits), PACKED)
    counted = saved(packed.groupBy("n", "bucket").applyInArrow(_added(buckets, n, bits), COUNTED), "counts")
    whole = counted.where("n = 1 and block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kinds", "deleted")]).first()
    texts = dealt.agg(F.count(F.when(train, 1)).alias("texts"), F.count(F.when(gone, 1)).alias("texts_deleted")).first()
    totals = {**whole.asDict(), **texts.asDict()}
    back = counted.where("block >= 0").select("n", "bucket", "block", "size", "seen", "gone")
    own = F.col("block") >= n
    events = dealt.where(own).groupBy("block").cogroup(back.where(own).groupBy("block")).applyInArrow(_events(order, bits, totals), "bucket bigint, bins array<bigint>, events bigint")
    mixture = weights(histogram(events, CELLS), order)
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = dealt.groupBy("block").cogroup(back.drop("gone").groupBy("block")).applyInArrow(_scored(order, bits, totals, mixture), schema)
    return scored.withColumn("train_tokens", F.lit(totals["tokens"]).cast("bigint"))
