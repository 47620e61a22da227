"""Components, min-max near duplicates and fuzzy lines against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from stream_commerce.llm import lines, minmax, shared
from stream_commerce.llm.components import _verified, components, prefix_pairs
from tests.llm import brute

WORDS = [f"w{i}" for i in range(400)]


def family(rng: random.Random, size: int, copies: int, edits: int) -> list[str]:
    base = [rng.choice(WORDS) for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = rng.choice(WORDS)
        out.append(" ".join(words))
    return out


def test_components_match_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    pairs += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    rows = pairs + [(b, a) for a, b in pairs[:40]] + [(5, 5), (None, 3), (4, None)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    expected = brute.find(pairs, {x for p in pairs for x in p})
    linked = {n: c for n, c in expected.items() if any(m != n and d == c for m, d in expected.items())}
    assert found == linked
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_prefix_filter_loses_no_link(spark):
    rng = random.Random(8)
    sets = {}
    for f in range(6):
        base = rng.sample(range(1000 * f, 1000 * f + 300), 60)
        for k in range(12):
            sets[100 * f + k] = sorted({*base[rng.randrange(8):], *rng.sample(range(10_000, 10_400), rng.randint(0, 16))})
    nodes = spark.createDataFrame([(n, n) for n in sets], "node long, own long")
    rows = spark.createDataFrame(list(sets.items()), "node long, hashes array<long>")
    found = {(r["a"], r["b"]) for r in prefix_pairs(nodes, rows, 80).collect()}
    for a in sets:
        for b in sets:
            if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]}):
                assert (a, b) in found


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(spark, size):
    rng = random.Random(size)
    texts = [t for k in range(12) for t in family(rng, rng.choice([1, 2, 9, 40, 120]), 7, 6)]
    texts += [None, "", " \t\n", "One", "one", "ONE two", "Ünit É x", "ünit é x", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    rows = [(i, t, "x", True, i) for i, t in enumerate(texts)] + [(None, "one", "x", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, kept boolean, node long")
    found = {r["doc_id"]: r for r in minmax.near_duplicates(docs, size).collect()}
    sets = {i: brute.shingles(t, size) for i, t in enumerate(texts)}
    expected = brute.near(sets, 80)
    assert len(found) == len(rows)
    for i in sets:
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (
            len(sets[i]), expected[i], expected[i] == i)
    assert found[None]["component_id"] is None and found[None]["kept"]
    left = minmax.keep_first(docs, size=size)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {None, *(i for i, c in expected.items() if i == c)}


def test_rows_sharing_an_id_are_one_node(spark):
    a, b = " ".join(WORDS[:40]), " ".join(WORDS[100:140])
    docs = spark.createDataFrame([(7, a), (7, b), (7, a), (9, b), (3, a), (12, "else")], "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in minmax.near_duplicates(docs, 2).collect()}
    assert found == {(7, 3), (9, 3), (3, 3), (12, 12)}


def test_word_hashes_know_words_only():
    one = minmax.word_hashes("Ab c\tAB x\x0b ab ".encode())
    assert len(one) == 4 and one[0] == one[3] and len({*one.tolist()}) == 3
    long = minmax.word_hashes(b"x " * 3_000_000 + b"y")
    assert len(long) == 3_000_001 and len(np.unique(long)) == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minmax.near_duplicates(docs).count() == 0
    assert lines.fuzzy_lines(docs).count() == 0


def _runs(line: str) -> set[str]:
    return {line[i:i + lines.GRAM] for i in range(max(1, len(line) - lines.GRAM + 1))}


def test_fuzzy_lines_match_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice(WORDS) + rng.choice("abcdef") * rng.randint(0, 5) for _ in range(rng.randint(10, 30))) for _ in range(25)]
    texts = []
    for i in range(60):
        held = []
        for _ in range(4):
            line = rng.choice(base)
            at = rng.randrange(len(line))
            held.append(rng.choice([line, "  " + line.upper(), line[:at] + "z" + line[at + 1:]]))
        texts.append("\n".join([*held, "", f"only here {i * 7919} times {i}"]))
    texts += [None, "", "a", "A ", "long " * 3000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, line int")
    found = {(r["doc_id"], r["line"]): r for r in lines.fuzzy_lines(docs).collect()}
    places = {(i, n): x.strip(" ").lower() for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n"))}
    assert set(found) == set(places)
    numbers = {x: k for k, x in enumerate(dict.fromkeys(v for v in places.values() if v))}
    classes = brute.near({k: _runs(x) for x, k in numbers.items()}, 80)
    first: dict[int, tuple[int, int]] = {}
    for place in sorted(places):
        if places[place]:
            first.setdefault(classes[numbers[places[place]]], place)
    for place, x in places.items():
        kept = first[classes[numbers[x]]] if x else place
        assert (found[place]["kept"], found[place]["first_doc"], found[place]["first_line"]) == (kept == place, *kept)
    left = {r["doc_id"]: r["text"] for r in lines.kept_text(docs, lines.fuzzy_lines(docs)).collect()}
    for i, text in enumerate(texts):
        assert left[i] == "\n".join(x for n, x in enumerate((text or "").split("\n")) if found[i, n]["kept"])
    assert left[len(texts) - 4] == ""


def test_lines_close_to_the_bound_and_without_spaces_are_linked(spark):
    rng = random.Random(9)
    signs = [chr(c) for c in range(0x4E00, 0x5200)]
    pairs = []
    while len(pairs) < 200:
        spaced = len(pairs) % 2
        old = " ".join(rng.choice(WORDS) for _ in range(rng.randint(20, 40))) if spaced else "".join(
            rng.choice(signs) for _ in range(rng.randint(60, 200)))
        new = list(old)
        for at in rng.sample(range(len(old)), max(1, len(old) // 50)):
            new[at] = "z"
        if not spaced:
            new[0] = "z"
        a, b = _runs(old), _runs("".join(new))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            pairs.append((old, "".join(new)))
    for s in range(20):  # alike but for their first characters
        tail = "".join(rng.choice(signs) for _ in range(300))
        pairs += [(f"a{s:02}{tail}", f"b{s + 50}{tail}")]
    docs = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)], "doc_id long, text string")
    found = {r["doc_id"]: r["first_doc"] for r in lines.fuzzy_lines(docs).collect()}
    linked = [found[2 * i + 1] == 2 * i for i in range(len(pairs))]
    assert all(linked[200:])
    assert sum(linked[:200]) >= 198


def test_pairs_of_lines_carry_texts_and_writes_leave_no_shuffle_files(spark, monkeypatch):
    seen, asked = {}, spark.conf.get(shared.SHUFFLE_CLEANUP)

    def kept(df, label, own=shared.saved):
        seen[label] = dict(df.dtypes)
        return own(df, label)

    monkeypatch.setattr("stream_commerce.llm.components.saved", kept)
    docs = spark.createDataFrame([(i, f"{' '.join(WORDS[i // 2:i // 2 + 30])} {i % 2}") for i in range(20)], "doc_id long, text string")
    assert lines.fuzzy_lines(docs).count() == 20
    assert seen["sets"] == {"node": "bigint", "held": "string", "n": "int"}
    assert spark.conf.get(shared.SHUFFLE_CLEANUP) == asked
    during = []
    monkeypatch.setattr(DataFrameWriter, "parquet",
                        lambda self, path, own=DataFrameWriter.parquet: during.append(spark.conf.get(shared.SHUFFLE_CLEANUP)) or own(self, path))
    shared.saved(spark.range(9), "x")
    assert during == ["true"]


def test_many_pairs_are_confirmed_part_by_part(spark, monkeypatch):
    written = []
    monkeypatch.setattr("stream_commerce.llm.components.saved", lambda df, label, own=shared.saved: written.append(label) or own(df, label))
    held = spark.createDataFrame([(i, list(range(i % 3, i % 3 + 20)), 20) for i in range(12)], "node long, held array<long>, n int")
    pairs = spark.createDataFrame([(i, k) for i in range(12) for k in range(i + 1, 12)], "a long, b long")
    found = {tuple(r) for r in _verified(pairs, held, 95, lambda x: x).collect()}
    assert found == {(i, k) for i in range(12) for k in range(i + 1, 12) if i % 3 == k % 3}
    assert written == ["sized", "confirmed", "confirmed", "confirmed"]
