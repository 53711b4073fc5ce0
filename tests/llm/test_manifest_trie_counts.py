"""Merkle manifest, prefix trie and token counts against plain versions, on odd inputs."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import brute
from vacancia.session import configured
from vacancia.llm import common, merkle, prefix_trie, resync, running

ROWS = brute.documents()


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def sources(n, seed=5):
    rng = random.Random(seed)
    return [(i if i % 17 else None, rng.choice(["Text A", None, "", "b" * 50, "É À"]) if i % 3 else f"T {i}", rng.choice(["en", None]), rng.choice(["x", "x", "x", "é", "Z", "", None, f"only{i}"]), i) for i in range(n)]


# ---- running sums -------------------------------------------------------------------------


def test_running_sums_over_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(str(g), int(rng.integers(-(1 << 62), 1 << 62)), k) for k, g in enumerate(np.repeat(range(9), [1, 700, 0, 3, 1500, 1, 1, 40, 2]))]
    df = spark.createDataFrame(rows, "group string, x bigint, k bigint").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.k: r.run_x for r in running.running(df, "group", ["k"], ["x"], "run").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sums = {}
    for group, x, k in rows:
        sums[group] = (sums.get(group, 0) + x) % (1 << 64)
        assert got[k] % (1 << 64) == sums[group]


def test_running_sums_of_equal_rows_are_spread(spark):
    df = spark.range(5000, numPartitions=4).select(F.lit("g").alias("group"), F.lit(1).cast("bigint").alias("one"))
    found = running.running(df, "group", ["one"], ["one"], "run")
    assert sorted(r.run_one for r in found.collect()) == list(range(1, 5001))


# ---- Merkle manifest ----------------------------------------------------------------------

MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("rows", [ROWS, sources(700), sources(1), [(1, "a", "en", "s", 1)] * 20, [(k, None, None, None, None) for k in range(300)]], ids=["texts", "sources", "one", "equal", "null"])
def test_manifest(spark, rows):
    found = merkle.manifest_digest(brute.frame(spark, rows, extra=True))
    assert found.columns == MERKLE
    assert rows_of(found, MERKLE) == sorted(brute.merkle(rows), key=repr)


def test_manifest_of_nothing(spark):
    assert merkle.manifest_digest(brute.frame(spark, [])).count() == 0


def test_a_level_moves_its_nodes_once(spark):
    nodes = common.saved(spark.range(4000).select(F.lit("g").alias("group"), F.col("id").alias("node"), F.lit(4000).cast("bigint").alias("size"), F.lit(b"x").alias("digest"), F.lit(1).alias("rest")), "nodes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with configured(spark, merkle.DEALT):
            plan = merkle.level(nodes)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 2
    assert "ENSURE_REQUIREMENTS" not in plan
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


# ---- prefix trie --------------------------------------------------------------------------

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string, p1 string, part string"


def talk(seed, convs, turns, said=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", None]), rng.choice([f"w{rng.randrange(said)}  x", "", None, "a b c"])) for c in convs for t in range(rng.randrange(1, turns))]


def turn_rows(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], TURNS)


@pytest.mark.parametrize(
    "rows",
    [
        talk(1, range(90), 6),
        talk(2, range(0, 900, 7), 9, said=1),
        [(c, t, "user", f"t{t}") for c in range(40) for t in range(c + 1)],  # every conversation goes on where another ended
        [(c, t, "user", "same") for c in (0, 3, 20, 41) for t in range(400)] + [(7, None, None, None), (None, 1, "user", "nobody")],
        [(c, 0, "user", "hello") for c in range(300)],
        [(1, 0, "user", "taken away")],
        talk(3, range(-45, 0), 5),
    ],
    ids=["short", "alike", "growing", "long", "one", "turnless", "negative"],
)
def test_prefix_trie(spark, monkeypatch, rows):
    monkeypatch.setattr(prefix_trie, "CELLS", prefix_trie.CELLS if len(rows) % 2 else (4, 4))  # a sketch that proves little changes nothing
    monkeypatch.setattr(prefix_trie, "TEXT", 64)
    found = prefix_trie.trie(turn_rows(spark, rows))
    assert found.columns == TRIE
    assert rows_of(found, TRIE) == sorted(brute.prefix_trie(rows), key=repr)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(turn_rows(spark, [])).count() == 0


def test_estimates_are_never_too_low_and_most_tails_stay(spark):
    rows = talk(4, range(400), 9, said=1000)
    names = prefix_trie.prefixes(prefix_trie.rebuilt(turn_rows(spark, rows))[0])
    marked = prefix_trie.screened(names, prefix_trie.sketch(names))
    n = marked.groupBy("depth", "p1", "p2").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("alone").cast("int")).alias("alone"))
    assert n.where("n > 1 AND alone = 1").isEmpty()
    assert n.where("n = 1 AND alone = 1").count() > 0.95 * n.where("n = 1").count()


def test_subtree_sums_take_rounds_by_the_logarithm_of_the_depth(spark, monkeypatch):
    made = []
    monkeypatch.setattr(prefix_trie, "saved", lambda df, name, saved=common.saved: made.append(name) or saved(df, name))
    chain = spark.range(200).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.lit(1).cast("bigint").alias("n"))
    assert all(r.n == 200 - r.id for r in prefix_trie.subtree_sums(chain, ["n"]).collect())
    assert made.count("sums") <= 10


# ---- token counts -------------------------------------------------------------------------

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=resync.default_path())


def odd_texts():
    rng = random.Random(8)
    alphabet = ["a", "b", " ", "  ", "the", "▁", "é", "你", "好", "\n", "\t", "\0", "😀", "ﷺ", "\U000e0001", "<s>", "</s>", "<0x41>", "ing", "    "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 900))) for _ in range(60)]
    texts += ["a" * 3000, " " * 2000, "你好" * 800, "ab" * 1000 + " " + "x" * 1500, "the quick " * 300, "\U000e0001" * 300, "", None, " ", "▁" * 900]
    texts += [r[1] for r in ROWS]
    return texts


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (200, 1), (1000, 300), (resync.CHUNK, resync.OVERLAP)])
def test_token_counts(spark, chunk, overlap):
    texts = odd_texts()
    docs = brute.frame(spark, [(k // 2 if k % 31 else None, t, "en", "s", k) for k, t in enumerate(texts)], extra=True)
    found = resync.token_counts(docs, chunk=chunk, overlap=overlap, limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(k // 2 if k % 31 else None, len((t or "").encode()), n := len(LIBRARY.encode(t or "")), n > 100) for k, t in enumerate(texts)]
    assert rows_of(found, found.columns) == sorted(expected, key=repr)


def test_overlaps_are_widened_where_chunks_do_not_align(spark, monkeypatch):
    made = []
    monkeypatch.setattr(resync, "saved", lambda df, name, saved=common.saved: made.append(name) or saved(df, name))
    docs = brute.frame(spark, [(1, "a" * 5000 + " b" * 500, "en", "s", 1), (2, "b c " * 900, "en", "s", 1)])
    found = {r.doc_id: r.n_tokens for r in resync.token_counts(docs, chunk=128, overlap=4).collect()}
    assert found == {1: len(LIBRARY.encode("a" * 5000 + " b" * 500)), 2: len(LIBRARY.encode("b c " * 900))}
    assert made.count("spans") > 2


def test_token_counts_of_nothing(spark):
    assert resync.token_counts(brute.frame(spark, [])).count() == 0
