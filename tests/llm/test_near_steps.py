"""Near duplicates in few steps: what a task can join up needs no round over all links."""

import numpy as np
import pytest

import brute
from vacancia.llm import components, forest


def counting(monkeypatch, *modules):
    written = []
    for module in modules:
        saved = module.saved
        monkeypatch.setattr(module, "saved", lambda df, name, saved=saved: written.append(name) or saved(df, name))
    return written


def least_reached(links):
    """The least node of every linked node's component."""
    label = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in label:
        before = dict(label)
        for u, v in links:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
        if label == before:
            break
    return label


def test_a_path_in_one_task_is_joined_up_at_once(spark, monkeypatch):
    links = [(k, k + 1) for k in range(60)]
    written = counting(monkeypatch, components)
    found = components.components(spark.createDataFrame(links, "u bigint, v bigint").coalesce(1))
    assert {r.u: r.label for r in found.collect() if r.u != r.label} == {k: 0 for k in range(1, 61)}
    assert len(written) <= 3


@pytest.mark.parametrize("piece", [3, 40])
def test_components_of_links_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(components, "PIECE", piece)
    rng = np.random.default_rng(piece)
    order = rng.permutation(60).tolist()
    links = [*zip(order[:30], order[1:31]), *rng.integers(100, 160, (50, 2)).tolist(), *[(200, k) for k in range(201, 215)], (-5, 300), (300, -7), (7, 7)]
    links += links[:20]
    found = components.components(spark.createDataFrame(links, "u bigint, v bigint").repartition(5)).collect()
    assert {r.u: r.label for r in found} == least_reached(links) and len(found) == len({r.u for r in found})


def test_a_large_group_takes_no_more_steps(spark, monkeypatch):
    words = brute.sentences(3, 60).split()
    rows = [(k, " ".join([*words[:k], f"x{k}", *words[k:]]), "en", "s", None) for k in range(10, 40)] + [(k, words[0] * k, "en", "s", None) for k in range(60, 64)]
    pairs = [(r[0], r[1]) for r in rows]
    monkeypatch.setattr(forest, "BLOCK", 8)
    monkeypatch.setattr(forest.block_pairs, "__defaults__", (8,))
    written = counting(monkeypatch, components, forest)
    found = {r.doc_id: (r.class_id, r.n_links) for r in forest.joined_classes(brute.frame(spark, rows)).collect()}
    assert found == brute.links(pairs)
    assert written.count("least") + written.count("star") <= 6
