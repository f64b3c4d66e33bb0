"""The manifest in blocks against a plain list-by-list computation."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import numpy as np
import pytest

from daybook.llm import merkle
from tests.llm.conftest import ODD


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, reached):
    """Root, and per node its siblings and the node that ``reached`` leads to."""
    below = [([], node) for node in reached]
    owners = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        groups = [nodes[k : k + 8] for k in range(0, len(nodes), 8)]
        for k, members in enumerate(owners):
            run, place = groups[k // 8], k % 8
            for member in members:
                siblings, node = below[member]
                siblings += run[:place] + run[place + 1 :]
                below[member] = (siblings, digest(*run[:place], node, *run[place + 1 :]))
        owners = [sum(owners[k : k + 8], []) for k in range(0, len(owners), 8)]
        nodes = [digest(*group) for group in groups]
    return nodes[0], below


def brute_force(rows):
    """rows: (doc_id, text, lang, source); n_chars is -1, as in the fixture."""
    made = []
    for doc_id, text, lang, source in rows:
        leaf, low = (digest(*map(field, (doc_id, source, lang, -1, t))) for t in (text, lower(text)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        made.append((lang is not None, (lang or "").encode(), doc_id is not None, doc_id or 0, leaf, low if hit else leaf, doc_id))
    made.sort()
    trees = [list(group) for _, group in groupby(made, key=lambda m: m[:2])]
    climbed = [climb([m[4] for m in tree], [m[5] for m in tree]) for tree in trees]
    subroots = [root for root, _ in climbed]
    root, _ = climb(subroots, subroots) if subroots else (None, None)
    out = []
    for number, (tree, (subroot, below)) in enumerate(zip(trees, climbed)):
        for m, (siblings, reached) in zip(tree, below):
            changed = [*subroots[:number], reached, *subroots[number + 1 :]]
            upper = climb(subroots, changed)[1][number]
            out.append((m[6], m[4], subroot, root, digest(*siblings, *upper[0]), upper[1], upper[1] == root))
    return sorted(out, key=str)


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("levels", range(1, 6))
def test_every_node_has_a_place_of_its_own(levels):
    found = merkle.places(levels)
    assert [len(depth) for depth in found] == [8**depth for depth in range(levels)]
    assert sorted(np.concatenate(found)) == list(range(merkle.nodes_in(levels)))


def test_subtrees_are_contiguous_at_half_height():
    """Of five levels, the upper two come first, then each subtree of three levels as one run."""
    found = merkle.places(5)
    assert sorted(np.concatenate(found[:2])) == list(range(9))
    first = [found[2][0], *found[3][:8], *found[4][:64]]
    assert sorted(first) == list(range(9, 9 + merkle.nodes_in(3)))


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512])
def test_paths_of_a_block_lead_to_its_root(leaves):
    nodes = [digest(str(k)) for k in range(leaves)]
    height = merkle._height(leaves, 4)
    block = merkle.Block(merkle.build(nodes, height), height, leaves)
    root, below = climb(nodes, nodes)
    for k, node in enumerate(nodes):
        path = block.path(k)
        assert "".join(b + a for b, a in path) == "".join(below[k][0])
        assert merkle.folded(node, path) == root


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_trees_of_many_sizes(spark, documents, levels):
    """Blocks of 8, 64 and 4,096 leaves; one language has most rows, ten have one."""
    rows = [(k * 7 % 1000, f"Text {k} A", "en", "web") for k in range(600)]
    rows += [(k, "B", "fr", None) for k in range(9)] + [(5, "C", f"l{k}", "x") for k in range(10)] + [(6, "D", None, "x")]
    found = merkle.manifest(documents(rows), levels)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_odd_rows(spark, documents):
    rows = [(doc_id, text, None, None) for doc_id, text in ODD]
    found = merkle.manifest(documents(ODD))
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)
    assert merkle.manifest(documents([])).collect() == []


def test_tampering_shows_where_letters_change(spark, documents):
    rows = [(k, "UPPER" if k % 2 else "lower", "en", "web") for k in range(300)]
    for row in merkle.manifest(documents(rows)).collect():
        tampered = zlib.crc32(str(row.doc_id).encode()) % 3 == 0 and row.doc_id % 2 == 1
        assert row.verified is not tampered
        assert (row.folded_root == row.root) is row.verified
