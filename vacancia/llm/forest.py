"""Near-duplicate join on word shingles: a MinHash LSH forest, then exact verification.

Documents with one set of five-word shingles are a class, and only classes are compared. Every
class has ``TREES`` strings of ``DEPTH`` MinHash labels. A tree is the sorted trie of one of
them: classes with a common prefix stand together. Matching begins with whole strings, and the
prefixes are shortened by a label as long as the estimated recall is under the target. The
estimate weighs each pair found by the chance that pairs this similar are found at all.

Classes that meet under a prefix and have similar signatures are linked into families. Only
the links of a spanning forest leave a task. A node with more than ``BLOCK`` classes is not
compared pair by pair: all of them are compared with one, the head, and those that are ``LOOSE``
like it are linked to it. Those that are not ``TIGHT`` like it meet under a next head. What is
``SIMILARITY`` like a class that is not even loosely like the head is not tightly like it either,
by the triangle inequality of the Jaccard distance, so no pair is missed by that. Families are
verified exactly: all pairs of a family are compared by their shingle sets, in blocks of
``BLOCK`` classes, each once. What
leaves a task is a row per class: how many it is linked to, and one linked class. Classes of the
result are the connected components of the verified links.

Defined cases: texts of one to four words have one shingle, all of their words; texts without
words have no links; rows of one doc_id and text are one document and give equal rows; the
class is named by its least doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import identified, same_document, saved, several
from vacancia.llm.components import components, labelled
from vacancia.llm.flat import SPACE, WORDS, Words, arrow_bytes, blocks, mix

SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH = 24, 6
RECALL = 0.9999
SIMILAR = 0.62  # equal labels of a pair that goes on; 0.8 is five standard deviations off
BLOCK = 512  # classes compared at once
LOOSE, TIGHT = 0.3, 0.75  # equal labels; further apart than 1 - SIMILARITY by four standard deviations
HEADS = 8  # rounds of heads; what is left of a node then is compared in blocks
_U = np.uint64
FACTORS = np.random.default_rng(5).integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * _U(2) + _U(1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def shingle_sets(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each; and the text of each."""
    names = words.named()
    n = np.where(words.count > 0, np.maximum(words.count - size + 1, 1), 0)
    doc = np.repeat(np.arange(n.size), n)
    at = np.arange(doc.size) - np.repeat(np.cumsum(n) - n, n) + words.first[doc]
    shingle = WORDS.names(WORDS.prefix(names), at, np.minimum(at + size, words.first[doc + 1]))
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    new = np.ones(doc.size, bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    return shingle[new], doc[new]


def signatures(docs: DataFrame) -> DataFrame:
    """Every document's class (a 64-bit name of its shingle set) and labels; no class without words."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for first, end in blocks(offsets):
                words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], SPACE)
                shingle, doc = shingle_sets(words)
                here = np.flatnonzero(words.count)
                label = np.zeros((here.size, TREES * DEPTH), np.uint16)
                kind = np.zeros(here.size, np.uint64)
                if here.size:
                    starts = np.searchsorted(doc, here)
                    kind = mix(np.add.reduceat(mix(shingle ^ _U(0xD6E8FEB86659FD93)), starts) + np.diff(np.append(starts, doc.size)).astype(np.uint64))
                    for j, factor in enumerate(FACTORS):
                        label[:, j] = (mix(np.minimum.reduceat(shingle * factor, starts)) >> _U(48)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(here + first)), batch.column("copy").take(pa.array(here + first)), _signed(kind),
                     pa.array([x.tobytes() for x in label], pa.binary())],
                    ["doc_id", "copy", "class", "labels"],
                )

    return docs.select("doc_id", "copy", "text").mapInArrow(run, f"doc_id {doc_id}, copy bigint, class bigint, labels binary")


def _labels(column: pa.Array) -> np.ndarray:
    return arrow_bytes(column)[0].view(np.uint16).reshape(-1, TREES, DEPTH)


def trie_nodes(labels: np.ndarray, depth: int) -> np.ndarray:
    """The trie node of every tree at a depth, a row for each string of labels."""
    node = np.broadcast_to(mix(np.arange(1, TREES + 1, dtype=np.uint64)), labels.shape[:2])
    for k in range(depth):
        node = mix(node * _U(0x9E3779B97F4A7C15) + labels[:, :, k] + _U(1))
    return node


def prefixes(classes: DataFrame, depth: int) -> DataFrame:
    """Rows (node, tree, class): the trie node of every tree at a depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = trie_nodes(_labels(batch.column("labels")), depth)
            row = np.repeat(np.arange(node.shape[0]), TREES)
            tree = np.tile(np.arange(TREES, dtype=np.int32), node.shape[0])
            yield pa.RecordBatch.from_arrays([_signed(node.reshape(-1)), pa.array(tree), batch.column("class").take(pa.array(row))], ["node", "tree", "class"])

    return classes.select("class", "labels").mapInArrow(run, "node bigint, tree int, class bigint")


def block_pairs(rows: DataFrame, group: str, each: int = BLOCK) -> DataFrame:
    """Rows dealt into units that compare all pairs of a group once.

    A group of up to ``each`` rows is one unit. A larger one is cut into parts by class, and
    every pair of parts is a unit. ``n`` is how many rows a row's group has; ``part`` tells the sides.
    """
    parts = F.ceil(F.col("n") / each).cast("int")
    df = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    df = df.withColumn("other", other)
    return df.withColumn("unit", F.xxhash64(group, F.least("part", "other"), F.greatest("part", "other"))).withColumn("within", F.col("part") == F.col("other")).drop("n", "parts", "other")


def _units(batches: Iterator[pa.RecordBatch], key: str = "unit") -> Iterator[pa.Table]:
    """Batches of whole units, from rows that are sorted by unit."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(unit != unit[-1])[-1]) + 1 if (unit != unit[-1]).any() else 0
        if not cut and rest and rest[-1].column(key)[-1].as_py() == unit[0]:
            rest.append(batch)
            continue
        if rest and not cut:
            yield pa.Table.from_batches(rest)
            rest = [batch]
            continue
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


def unit_pairs(unit: np.ndarray, part: np.ndarray, within: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a unit's rows, those of two parts only across; in vectorised steps by distance."""
    n = unit.size
    for step in range(1, n):
        left = np.flatnonzero(unit[step:] == unit[:-step])
        if not left.size:
            return
        right = left + step
        use = within[left] | (part[left] != part[right])
        yield left[use], right[use]


def headed(nodes: DataFrame, sizes: DataFrame, labels_of: DataFrame, depth: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Links of the large nodes' classes to their heads, with the histogram of those pairs; and what is still to compare, as rows of sized nodes."""
    large = sizes.where(F.col("n") > BLOCK).select("node")
    if large.isEmpty():
        return [], None
    rest = saved(nodes.join(large, "node", "left_semi").join(labels_of, "class").select("node", "tree", "class", "labels"), "large_nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, head = _labels(batch.column("labels")), _labels(batch.column("head_labels"))
            alike = np.count_nonzero(own.reshape(own.shape[0], -1) == head.reshape(own.shape[0], -1), axis=1) / (TREES * DEPTH)
            tree = batch.column("tree").to_numpy()
            first = (trie_nodes(own, depth) == trie_nodes(head, depth)).argmax(1) == tree if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alike), pa.array(first)], [*batch.schema.names, "alike", "first"])

    stars, done = [], []
    for _ in range(HEADS):
        heads = saved(rest.groupBy("node").agg(F.min(F.struct("class", "labels")).alias("h")).select("node", F.col("h.class").alias("head"), F.col("h.labels").alias("head_labels")), "heads")
        schema = "node bigint, tree int, class bigint, labels binary, head bigint, head_labels binary, alike double, first boolean"
        met = rest.join(heads, "node").where("class <> head").select("node", "tree", "class", "labels", "head", "head_labels")
        met = saved(met.mapInArrow(run, schema).drop("head_labels"), "headed")
        counted = F.col("first") & (F.col("alike") >= SIMILARITY)
        bin_ = F.when(counted, F.floor(F.col("alike") * 100).cast("bigint"))
        stars.append(met.where(F.col("alike") >= LOOSE).select(F.col("class").alias("u"), F.col("head").alias("v"), bin_.alias("bin"), F.when(counted, 1.0).alias("pairs")))
        left = met.where(F.col("alike") < TIGHT).select("node", "tree", "class", "labels")
        counts = saved(left.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "left")
        done.append(left.join(counts.where(F.col("n") <= BLOCK), "node").select("node", "tree", "class", "n"))
        rest = left.join(counts.where(F.col("n") > BLOCK).select("node"), "node", "left_semi")
        if counts.where(F.col("n") > BLOCK).isEmpty():
            break
    else:
        done.append(rest.join(counts, "node").select("node", "tree", "class", "n"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stars, out


def families(classes: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Links of a spanning forest of similar classes under equal prefixes; and a histogram of the pairs.

    A pair is compared once: in the first tree in which it meets, and not if it met at a
    longer prefix before.
    """
    nodes = prefixes(classes, depth)
    sizes = saved(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "nodes")
    labels_of = classes.select("class", "labels")
    few = nodes.join(sizes.where(F.col("n") <= BLOCK), "node").select("node", "tree", "class", "n")
    stars, left = headed(nodes, sizes, labels_of, depth)
    few = few if left is None else few.unionByName(left)
    units = block_pairs(few, "node").join(labels_of, "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            unit, tree, part, within, name = (table.column(c).to_numpy() for c in ("unit", "tree", "part", "within", "class"))
            labels = _labels(table.column("labels"))
            flat = labels.reshape(labels.shape[0], -1)
            node = trie_nodes(labels, depth)
            longer = trie_nodes(labels, depth + 1) if depth < DEPTH else None
            found_left, found_right = [], []
            histogram = np.zeros(101)
            for left, right in unit_pairs(unit, part, within):
                for k in range(0, left.size, 1 << 14):
                    a, b = left[k : k + (1 << 14)], right[k : k + (1 << 14)]
                    new = (node[a] == node[b]).argmax(1) == tree[a]
                    if longer is not None:
                        new &= ~(longer[a] == longer[b]).any(1)
                    a, b = a[new], b[new]
                    alike = np.count_nonzero(flat[a] == flat[b], axis=1) / flat.shape[1]
                    go = alike >= SIMILAR
                    found_left.append(a[go])
                    found_right.append(b[go])
                    histogram += np.bincount(np.floor(alike[alike >= SIMILARITY] * 100).astype(int), minlength=101)
            none = np.zeros(0, np.int64)
            label = labelled(unit.size, np.concatenate([*found_left, none]), np.concatenate([*found_right, none]))
            linked = np.flatnonzero(label != np.arange(label.size))
            bins = np.flatnonzero(histogram)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*name[linked].tolist(), *[None] * bins.size], pa.int64()), pa.array([*name[label[linked]].tolist(), *[None] * bins.size], pa.int64()),
                 pa.array([*[None] * linked.size, *bins.tolist()], pa.int64()), pa.array([*[None] * linked.size, *histogram[bins].tolist()], pa.float64())],
                ["u", "v", "bin", "pairs"],
            )

    dealt = units.select("unit", "tree", "part", "within", "class", "labels").repartition("unit").sortWithinPartitions("unit")
    out = dealt.mapInArrow(run, "u bigint, v bigint, bin bigint, pairs double")
    for star in stars:
        out = out.unionByName(star)
    out = saved(out, "families")
    return out.where("u is not null").select("u", "v"), out.where("bin is not null").groupBy("bin").agg(F.sum("pairs").alias("pairs"))


def found_chance(similarity: float, depth: int) -> float:
    return 1 - (1 - similarity**depth) ** TREES


def matched(classes: DataFrame) -> DataFrame:
    """Families at the longest prefixes that reach the target recall."""
    links, pairs = None, {}
    for depth in range(DEPTH, 0, -1):
        more, histogram = families(classes, depth)
        links = more if links is None else links.unionByName(more)
        for r in histogram.collect():  # a row per percent at most
            pairs[r.bin] = pairs.get(r.bin, 0.0) + r.pairs
        there = sum(n / found_chance(k / 100, depth) for k, n in pairs.items())
        if not there or sum(pairs.values()) / there >= RECALL:
            break
    return links


def class_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The shingle set of every member class, from the text that stands for it; ``docs`` is identified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for first, end in blocks(offsets):
                words = Words(buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], SPACE)
                shingle, doc = shingle_sets(words)
                bounds = np.searchsorted(doc, np.arange(end - first + 1)).tolist()
                sets = [shingle[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
                some = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([some.column("class"), some.column("family"), some.column("docs"), pa.array(sets, pa.binary())], ["class", "family", "docs", "shingles"])

    joined = docs.join(members, same_document(docs, members)).select("class", "family", "docs", "text")
    sets = joined.mapInArrow(run, "class bigint, family bigint, docs bigint, shingles binary")
    return sets.dropDuplicates(["class"]) if several(docs) else sets


def common(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many shingles each pair of sets shares: products of 0/1 rows, over columns in pieces."""
    n = at.size - 1
    member = np.repeat(np.arange(n), np.diff(at))
    kinds, column, times = np.unique(shingles, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # a shingle of one set alone is in no intersection
    kept = np.cumsum(times > 1) - 1
    member, column = member[shared], kept[column[shared]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    out = np.zeros((n, n), np.float32)
    width = 8192
    for first in range(0, int(column[-1]) + 1 if column.size else 0, width):
        some = slice(*np.searchsorted(column, [first, first + width]))
        rows = np.zeros((n, width), np.float32)
        rows[member[some], column[some] - first] = 1
        out += rows @ rows.T
    return out


def verified(sets: DataFrame, similarity: float) -> DataFrame:
    """Rows (class, label, docs, classes): a linked class, and how many documents and classes it is linked to in a unit."""
    sizes = saved(sets.groupBy("family").agg(F.count(F.lit(1)).alias("n")), "family_sizes")
    units = block_pairs(sets.join(sizes, "family"), "family")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            unit, part, within, name, docs = (table.column(c).to_numpy() for c in ("unit", "part", "within", "class", "docs"))
            buf, at = arrow_bytes(table.column("shingles"))
            flat, at = buf.view(np.uint64), at // 8
            first = np.flatnonzero(np.diff(unit, prepend=unit[0] ^ 1))
            near_docs, near, label = np.zeros(unit.size, np.int64), np.zeros(unit.size, np.int64), np.arange(unit.size)
            for i, j in zip(first.tolist(), [*first[1:].tolist(), unit.size]):
                if j - i == 1:
                    continue
                size = np.diff(at[i : j + 1])
                if j - i == 2:
                    both = np.intersect1d(flat[at[i] : at[i + 1]], flat[at[i + 1] : at[j]], assume_unique=True).size
                    shared = np.array([[0, both], [both, 0]], np.float64)
                else:
                    shared = common(flat[at[i] : at[j]], at[i : j + 1] - at[i]).astype(np.float64)
                linked = shared >= similarity * (size[:, None] + size - shared)
                np.fill_diagonal(linked, False)
                if not within[i]:
                    linked &= part[i:j, None] != part[i:j]
                near[i:j], near_docs[i:j] = linked.sum(1), linked @ docs[i:j]
                label[i:j] = i + labelled(j - i, *np.nonzero(linked))
            some = np.flatnonzero(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[some]), pa.array(name[label[some]]), pa.array(near_docs[some]), pa.array(near[some])], ["class", "label", "docs", "classes"]
            )

    dealt = units.select("unit", "part", "within", "class", "docs", "shingles").repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(run, "class bigint, label bigint, docs bigint, classes bigint")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every document (doc_id, copy) with its class, its number of links, and whether it stands for the class; ``docs`` is identified."""
    signed = saved(signatures(docs), "signatures")
    place = F.struct("doc_id", "copy")
    # a document that stands in the table twice is one
    ids = signed.dropDuplicates(["class", "doc_id", "copy"]) if several(docs) else signed
    least = ids.groupBy("class").agg(F.min(F.struct("doc_id", "copy", "labels")).alias("l"), F.count(F.lit(1)).alias("docs"))
    first = saved(least.select("class", F.struct("l.doc_id", "l.copy").alias("least"), "docs", "l.labels"), "classes")
    classes = first.drop("labels")
    links = matched(first.select("class", "labels"))
    family = components(links)
    members = family.join(classes, family["u"] == classes["class"]).select("class", F.col("label").alias("family"), "docs", "least.*")
    sets = saved(class_sets(docs, saved(members, "members")), "sets")
    near = saved(verified(sets, similarity), "near")
    counts = near.groupBy("class").agg(F.sum("docs").alias("near_docs"), F.sum("classes").alias("near_classes"))
    label = components(near.select(F.col("class").alias("u"), F.col("label").alias("v")))
    named = label.join(classes, label["u"] == classes["class"])
    name = named.groupBy("label").agg(F.min("least").alias("name"))
    name = saved(label.join(name, "label").select(F.col("u").alias("class"), "name"), "names")
    per_class = classes.join(counts, "class", "left").join(name, "class", "left").select(
        "class", "least", F.coalesce("name", "least").alias("name"), (F.col("docs") - 1 + F.coalesce("near_docs", F.lit(0))).alias("n_links")
    )
    per_class = saved(per_class, "per_class")
    in_class = signed.select("doc_id", "copy", "class").join(per_class, "class")
    return in_class.select(
        "doc_id", "copy", F.col("name.doc_id").alias("class_id"), "n_links", F.col("least.doc_id").alias("copy_of"), (place == F.col("name")).alias("stands")
    )


def joined_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its class, its links, and the document it is an exact copy of."""
    rows = identified(docs)
    near = near_duplicates(rows).drop("stands")
    if several(rows):
        near = saved(near.distinct(), "near_duplicates")
    found = rows.join(near, same_document(rows, near), "left").select(rows["doc_id"], "class_id", "n_links", "copy_of")
    return found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copy_of", "doc_id").alias("copy_of"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without those that another one stands for; of a document's rows the least stays."""
    rows = identified(docs)
    again = several(rows)
    near = near_duplicates(rows).where("not stands").select("doc_id", "copy")
    near = saved(near.distinct() if again else near, "redundant")
    copy = F.xxhash64(F.coalesce(docs["text"], F.lit(""))) if again else F.lit(0).cast("bigint")
    kept = docs.join(near, docs["doc_id"].eqNullSafe(near["doc_id"]) & (near["copy"] == copy), "left_anti")
    if not again:
        return kept
    ids = saved(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated_ids")
    if ids.isEmpty():
        return kept
    again = docs["doc_id"].eqNullSafe(ids["doc_id"])
    same = [docs["doc_id"].alias("id_"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("copy_")]
    least = kept.join(ids, again, "left_semi").groupBy(*same).agg(F.min(F.struct(*docs.columns)).alias("row_"))
    return kept.join(ids, again, "left_anti").unionByName(least.select("row_.*"))
