"""SimHash fingerprints and the Gray-ordered index against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from stream_commerce.llm import fingerprints
from tests.llm import brute

WORDS = [f"w{i}" for i in range(300)]


def _plain(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", brute.lower(text))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _texts() -> list[str | None]:
    rng = random.Random(6)
    out: list[str | None] = [None, "", " \t\n", "One", "one", "ONE two", "one two three", "ÉTÉ été\x85x\xa0y z", "a b c " * 30_000]
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 30, 300]))]
        out += [" ".join(base)] * 2
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append("  ".join(words))
    return out


@pytest.mark.parametrize("limit", [fingerprints.LIMIT, 3])
def test_near_duplicates_match_brute_force(spark, limit):
    texts = _texts()
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print string, node int").repartition(3)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in fingerprints.near_duplicates(docs, limit=limit).collect()}
    prints = {i: _plain(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a in prints for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = brute.find(pairs, prints)
    assert found == {i: (f"{prints[i]:016x}", expected[i]) for i in prints}


def _near(rng: random.Random, count: int) -> list[int]:
    out = []
    for _ in range(count):
        base = rng.getrandbits(64) if not out or rng.random() < 0.3 else rng.choice(out)
        for _ in range(rng.randint(0, 4)):
            base ^= 1 << rng.randrange(64)
        out.append(base)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("limit", [20_000, 5])
def test_links_connect_what_brute_force_connects(spark, limit):
    prints = _near(random.Random(limit), 700) + [0, 1, 3, (1 << 64) - 1, 1 << 63]
    prints = list(dict.fromkeys(prints))
    rows = [(p - (1 << 64) if p >> 63 else p, i, i) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "print long, gray long, node long")
    found = [(r["u"], r["v"]) for r in fingerprints.links(nodes, limit=limit).collect()]
    for u, v in found:  # an edge joins members of one component
        assert u != v
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert brute.find(found, range(len(prints))) == brute.find(pairs, range(len(prints)))


def test_index_finds_every_close_pair_of_a_group():
    rng = random.Random(2)
    group = np.repeat(np.arange(5), [1, 2, 70, 9, 300])
    prints = np.array([x for g in range(5) for x in _sorted(_near(rng, 2000)[:int((group == g).sum())])], np.uint64)
    found = set()
    for i, j in fingerprints.close_pairs(fingerprints.build(prints, group)):
        found |= set(zip(i.tolist(), j.tolist(), strict=True))
    raw = prints.tolist()
    assert found == {(i, j) for j in range(len(raw)) for i in range(j) if group[i] == group[j] and (raw[i] ^ raw[j]).bit_count() <= 2}


def _sorted(prints: list[int]) -> list[int]:
    own = np.array(prints, np.uint64)
    return own[np.argsort(fingerprints.gray_rank(own))].tolist()


def test_gray_ranks_invert_the_gray_code():
    rank = np.array([0, 1, 2, 3, 1000, 2**64 - 1], np.uint64)
    assert (fingerprints.gray_rank(rank ^ (rank >> np.uint64(1))) == rank).all()


def test_a_dense_family_gives_a_forest_only(spark):
    # All patterns of two bits: every one is near to zero, and half a million pairs are close.
    prints = [0, *(1 << b for b in range(63)), *(1 << a | 1 << b for a in range(63) for b in range(a))]
    nodes = spark.createDataFrame([(p, p, i) for i, p in enumerate(prints)], "print long, gray long, node long")
    edges = fingerprints.links(nodes).collect()
    assert len(edges) <= 3 * len(prints)
    assert set(brute.find([tuple(e) for e in edges], range(len(prints))).values()) == {0}


def test_repeated_and_missing_ids(spark):
    a, b = " ".join(WORDS[:40]), " ".join(WORDS[100:140])
    docs = spark.createDataFrame([(7, a), (7, b), (9, b), (3, a), (12, "else"), (None, a), (None, "nobody's words")], "doc_id long, text string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in fingerprints.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(7, 3), (7, 3), (9, 3), (3, 3), (12, 12), (None, 3), (None, None)], key=str)
    assert fingerprints.near_duplicates(docs.limit(0)).count() == 0
