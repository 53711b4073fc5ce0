"""Words and strings that differ have names that differ, also where polynomials of their bytes agree."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from vacancia.llm import common, decontaminate, forest, interpolation, language, pieces, substring, suffixes
from vacancia.llm.flat import BYTES, OTHER, SPACE, Words, arrow_bytes, segment_names

SIZES = (512, 1024, 4096)


def named(texts, seed=0):
    return Words(*arrow_bytes(pa.array(texts)), SPACE).named(seed)


@pytest.mark.parametrize("size", SIZES)
def test_doubled_words_have_names_of_their_own(size):
    for pair in (brute.doubled(size), brute.doubled(size, "abcdefgh", "hgfedcba"), brute.doubled(size, "é", "è")):
        for seed in (0, 1):
            assert len(set(named(list(pair), seed).tolist())) == 2
        for poly in (BYTES, OTHER):
            bufs = [np.frombuffer(x.encode(), np.uint8) for x in pair]
            assert len({int(poly.byte_names(poly.of_bytes(b), np.array([0]), np.array([b.size]))[0]) for b in bufs}) == 2


def test_names_are_of_the_bytes_alone():
    words = ["a", "b", "ab", "a\0", "a\0\0", "abcdefgh", "abcdefghi", "bcdefghi", "é", "xabcdefgh"]
    alone = [int(named([w])[0]) for w in words]
    assert len(set(alone)) == len(words)
    assert named([" ".join(words), "ab ab"]).tolist() == [*alone, alone[2], alone[2]]
    assert not set(alone) & set(named(words, 1).tolist())
    buf = np.frombuffer(b"one two one", np.uint8)
    one, two = segment_names(buf, np.array([0, 4, 8]), np.array([3, 7, 11]))[[0, 2]], segment_names(buf[8:], np.array([0]), np.array([3]))
    assert one[0] == one[1] == two[0]


def texts_of(size):
    one, two = brute.doubled(size)
    words = brute.sentences(3, 30).split()
    return " ".join([*words[:15], one, *words[15:]]), " ".join([*words[:15], two, *words[15:]])


@pytest.mark.parametrize("size", SIZES)
def test_operators_tell_such_words_apart(spark, size):
    one, two = texts_of(size)
    rows = [(1, one, "en", "s", None), (2, two, "en", "s", None), (3, one, "en", "s", None)]
    docs = brute.frame(spark, rows)
    removed = {r.doc_id: r.n_removed for r in substring.substring_digest(docs).collect()}
    assert removed == {k: v[1] for k, v in brute.word_windows([(r[0], r[1]) for r in rows]).items()} and removed[2] == 0 and removed[3] == 31
    items = spark.createDataFrame([("x", " ".join(one.split()[10:25]))], "item_id string, text string")
    hits = {r.doc_id: (r.n_hit, r.contaminated) for r in decontaminate.benchmark_matches(docs, items).collect()}
    assert hits == {1: (15, True), 2: (0, False), 3: (15, True)}
    clean = decontaminate.decontaminated(docs, items)
    assert [r.doc_id for r in clean.collect()] == [2]
    cut = {r.doc_id: r.n_removed for r in suffixes.suffix_digest(docs).collect()}
    assert cut[1] == cut[3] == len(one)
    near = {r.doc_id: r.copy_of for r in forest.joined_classes(docs).collect()}
    assert near == {1: 1, 2: 2, 3: 1}
    known = {r.doc_id: r.n_known for r in interpolation.interpolated_scores(docs).collect()}
    assert known == {k: v[2] for k, v in brute.unigram_scores([(r[0], r[1]) for r in rows])[1].items()}
    digests = {r.doc_id: r.ids_sha256 for r in pieces.round_trip_digest(docs).collect()}
    assert digests[1] == digests[3] != digests[2]


def test_matches_are_checked_by_bytes(spark, monkeypatch):
    # all words have one name: only their bytes tell them apart
    monkeypatch.setattr(Words, "named", lambda self, seed=0: np.ones(self.starts.size, np.uint64))
    item, text = brute.sentences(1, 12), brute.sentences(2, 30)
    held = text.split()[:8] + item.split()[:10] + text.split()[8:]
    queries = decontaminate.Queries(["x", "y"], [item, "lone"], 10)
    words = Words(*arrow_bytes(pa.array([text, " ".join(held), "a lone word"])), decontaminate.ALNUM, lower=True)
    assert sorted(decontaminate.spelled_matches(queries, words)) == [(1, 0, 0, 8, 10), (2, 1, 0, 1, 1)]


# ---- columns of the user's -------------------------------------------------------------------


def test_stages_keep_columns_of_any_names(spark):
    docs = brute.frame(spark, brute.documents()).select("*", F.lit(7.0).alias("score"), F.lit("mine").alias("known"), F.lit("own").alias("lang_pred"), F.lit("x").alias("_found_score"), F.lit("unit").alias("unit"))
    out = corpus_pipeline.identify_language(spark, docs, "")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert {tuple(r) for r in out.select("score", "known", "lang_pred", "_found_score", "unit").collect()} == {(7.0, "mine", "own", "x", "unit")}
    coded = pieces.encoded(docs.withColumn("ids", F.lit("theirs")))
    assert coded.select("ids").distinct().collect() == [("theirs",)] and coded.schema["_ids"].dataType.simpleString() == "array<int>"


@pytest.mark.parametrize("langs", [3, 700])
def test_any_number_of_languages_is_learned(spark, monkeypatch, langs):
    monkeypatch.setattr(language, "MODEL_BYTES", 512 * 4 * 64)
    words = [[f"{chr(97 + k % 26)}{chr(97 + k // 26)}{x}" for x in "stuvwx"] for k in range(langs)]
    rows = [(k, " ".join(words[k] * 5), f"l{k:03d}", "s", None) for k in range(langs)]
    names, logs = language.trained(brute.frame(spark, rows))
    assert names == sorted(r[2] for r in rows) and logs.nbytes <= language.MODEL_BYTES
    assert np.allclose(np.exp(logs.astype(float)).sum(0), 1, atol=1e-3)


# ---- near duplicates in large nodes ----------------------------------------------------------


def near_copies(n, seed=7):
    base = brute.sentences(seed, 120).split()
    texts = []
    for i in range(n):
        words = list(base)
        words[(i * 7) % 120] = f"own{i}"
        if i % 3 == 0:
            words[(i * 13 + 5) % 120] = f"more{i}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("heads", [8, 1])
def test_large_nodes_are_compared_with_heads(spark, monkeypatch, heads):
    monkeypatch.setattr(forest, "BLOCK", 4)
    monkeypatch.setattr(forest, "HEADS", heads)
    texts = near_copies(40) + near_copies(25, seed=8) + [brute.sentences(100 + i, 60) for i in range(10)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = brute.frame(spark, [(i, t, "en", "s", None) for i, t in rows])
    made = []
    monkeypatch.setattr(forest, "saved", lambda df, name, saved=common.saved: made.append(name) or saved(df, name))
    got = {r.doc_id: (r.class_id, r.n_links) for r in forest.joined_classes(docs).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    links = {i: sum(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets if j != i) for i in sets}
    assert {i: n for i, (_, n) in got.items()} == links
    assert {got[i][0] for i in range(40)} == {0} and {got[i][0] for i in range(40, 65)} == {40}
    assert made.count("headed") >= 1


# ---- packed counts ---------------------------------------------------------------------------


@pytest.mark.parametrize("counts", [[], [1], [0], [1] * 9, [0, 1, 2, 300, 1, 1, 70000, 1], [5] * 17])
def test_counts_are_packed_and_spread(counts):
    x = np.array(counts, np.uint64)
    assert interpolation.spread(interpolation.squeezed(x), x.size).tolist() == counts


@pytest.mark.parametrize("cells", [1, 3, 40, 10_000])
def test_the_histogram_is_bounded(spark, cells):
    rows = [(b, [1000 + 7 * i, 0 if i % 2 else 1100 + i, 900 + i * i], 2) for b in range(2) for i in range(50)]
    found = interpolation.histogram(spark.createDataFrame(rows, "bucket bigint, bins array<bigint>, events bigint"), cells)
    assert len(found) <= max(cells, 4) and sum(r.events for r in found) == 200
    assert {(r.bucket, tuple(b > 0 for b in r.bins)) for r in found} == {(b, (True, x, True)) for b in range(2) for x in (True, False)}


def test_scores_do_not_depend_on_blocks_and_buckets(spark, monkeypatch):
    docs = brute.frame(spark, brute.documents())
    found = []
    for block, per in ((8 << 20, 4), (2000, 1), (500, 7)):
        monkeypatch.setattr(interpolation, "BLOCK_BYTES", block)
        monkeypatch.setattr(interpolation, "BLOCKS_PER_BUCKET", per)
        found.append({(r.doc_id, r.n_tokens): r.score for r in interpolation.interpolated_scores(docs).collect()})
    for other in found[1:]:
        assert other == pytest.approx(found[0])


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_are_those_of_plain_counts(spark, order):
    rows = [(i, brute.sentences(i % 37, 20 + i % 9, "a b c D e f g".split()) if i % 11 else None) for i in range(240)]

    def learned(events):
        return interpolation.weights([type("R", (), {"bucket": b, "bins": list(bins), "events": n})() for (b, bins), n in events.items()], order)

    expected = brute.interpolated(rows, order, learned)
    docs = brute.frame(spark, [(d, t, "en", "s", None) for d, t in rows])
    got = {r.doc_id: r.score for r in interpolation.interpolated_scores(docs, order).collect()}
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("numbers", [[0], [1], [5, 0, 7], [(1 << 64) - 1, 0, 1], [1 << 33] * 9, list(range(1000))])
def test_numbers_are_packed_in_bits(numbers):
    x = np.array(numbers, np.uint64)
    packed = interpolation.narrow(x)
    assert interpolation.wide(packed, x.size).tolist() == numbers
    assert len(packed) == 1 + -(-x.size * max(1, max(numbers).bit_length()) // 8)
