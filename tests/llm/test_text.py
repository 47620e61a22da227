"""Licences, repeated passages, decontamination and toxicity against brute force."""

from __future__ import annotations

import random
import re
import zlib

import pandas as pd
import pytest

from stream_commerce.llm import decontaminate, licences, passages, toxicity
from tests.llm import brute

FILL = "lorem ipsum dolor sit amet mit licence under the public version work general".split()


def test_licence_places_match_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice([*FILL, "mit", "license", "apache", "general", "public"]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += ["MIT-License, mit  license; Apache\nLICENSE", None, "", "mit", "Kelvin mité license", "mitK license",
              "General Public License GENERAL PUBLIC LICENSE", "Released under the really MIT License.", "x " * 30_000 + "mit license"]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(5, "mit license", 0), (None, "apache license", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, template int")
    found = licences.scan(docs).collect()
    assert len(found) == len(rows)
    expected = []
    for i, t, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(t))
        hits = [(p, label) for phrase, label in licences.PHRASES.items() for p in range(len(words))
                if words[p:p + len(phrase.split())] == phrase.split()]
        at = [p for p, _ in hits]
        expected.append((i, len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted(expected, key=key)
    for r in found:
        assert 0 <= r["score"] <= 1 and {*r["base_labels"].split(",")} - {""} <= {*r["labels"].split(",")}


def test_licence_notices_stand_an_extra_word(spark):
    docs = spark.createDataFrame([(1, "This work is licensed under CC BY-NC 4.0."), (2, "licensed under the apache software license, version 2.0")],
                                 "doc_id long, text string")
    found = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert found[1]["labels"] == "cc-by-nc" and found[1]["base_labels"] == ""
    assert found[2]["labels"] == "apache" and found[2]["n_base"] == 0 and found[2]["score"] < 1


def test_passages_keep_the_first_and_say_where(spark):
    long = "one two three four five six seven eight nine"
    rows = [(4, f"start\n{long}\nend"), (2, f"{long.upper()} \néè short\n  one two   three four five six seven eight nine"),
            (9, None), (10, ""), (4, f"start\n{long}\nend"), (None, long)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, unit string")
    found = {(r["doc_id"], r["copy"]): r for r in passages.removed(docs).collect()}
    assert len(found) == 6
    assert [tuple(x) for x in found[2, 0]["removed"]] == [(2, 55, 103, 2, 0)]
    assert [tuple(x)[:3] for x in found[4, 0]["removed"]] == [(1, 6, 50)] == [tuple(x)[:3] for x in found[4, 1]["removed"]]
    assert found[None, 0]["n_removed"] == 1 and found[9, 0]["n_units"] == found[10, 0]["n_units"] == 1
    left = {(r["doc_id"], r["copy"]): r for r in passages.deduplicated(docs).collect()}
    assert left[4, 0]["text"] == "start\nend" and left[None, 0]["text"] == "" and left[9, 0]["text"] == ""
    text = rows[1][1]
    assert left[2, 0]["text"] == "\n".join(text[s["start"]:s["end"]] for s in left[2, 0]["spans"]) == text[:54]
    assert passages.removed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def _random_text(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_decontamination_finds_edited_passages_only(spark):
    rng = random.Random(4)
    items = [_random_text(rng, 30) for _ in range(20)] + ["tiny item", None]
    docs, leaks = [], {}
    for i in range(80):
        text = _random_text(rng, rng.choice([5, 60, 300]))
        if i % 2:
            k = rng.randrange(20)
            part = list(items[k][10:10 + 90])
            for _ in range(rng.randint(0, 5)):
                part[rng.randrange(90)] = "z"
            at = rng.randrange(len(text))
            text = text[:at] + " " + "".join(part).upper().replace(" ", " \n") + " " + text[at:]
            leaks[i] = k
        docs.append((i, text, "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, items[3][:20], "x"), (None, items[5], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    for block in (decontaminate.BLOCK_CHARS, 1500):
        found = decontaminate.find(table, bench, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {*leaks.items(), (None, 5)}
    for r in found:
        if r["doc_id"] is not None:
            inside = re.sub(r"\s+", " ", docs[r["doc_id"]][1][r["start"]:r["end"]].lower())
            item = items[r["item_id"]]
            assert any(brute.edit_distance_within(item[w:w + 64], inside) <= decontaminate.EDITS for w in range(0, len(item) - 63))
    left = decontaminate.clean(table, bench)
    assert left.columns == table.columns
    assert {r["doc_id"] for r in left.collect()} == {None, 1000, 1001, 1002, *(i for i in range(80) if i not in leaks)}
    assert decontaminate.find(table, bench.limit(0)).count() == 0


def test_alignment_matches_the_full_table():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("abc") for _ in range(60))
        at = rng.randrange(40)
        pattern = list(text[at:at + 16])
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(pattern))
            pattern[k:k + 1] = rng.choice([["x"], [], [pattern[k], "x"]])
        chars, own = decontaminate.codes(text)[0], decontaminate.codes("".join(pattern))[0]
        hit = decontaminate.aligned(own, chars, at - 4, at + 4, 4)
        least = brute.edit_distance_within("".join(pattern), text)
        if hit is None:
            assert least > 0  # never misses an exact one
        else:
            start, end, cost = hit
            assert least <= cost <= 4
            assert brute.edit_distance_within("".join(pattern), text[start:end]) <= cost


@pytest.fixture(scope="module")
def rude(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        words = _random_text(rng, rng.choice([8, 40, 200])).split()
        bad = int(i % 4 == 0)
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgle", "Quaxbin", "vrumpt"]))
        rows.append((i, " ".join(words), 0.0))
        labels.append((i, bad))
    rows += [(900, None, 0.0), (901, "", 0.0), (None, "zorgle", 0.0), (902, "plain words here " * 20_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    return docs, spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int"), dict(labels)


def test_toxicity_on_held_out_rows(spark, rude):
    docs, labels, truth = rude
    model = toxicity.train(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == docs.count()
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in truth if found[i]["held_out"]} == set(held)
    assert sum(found[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert found[900]["score"] == found[901]["score"] < 0.5 and found[902]["predicted"] == 0
    left = toxicity.keep_clean(docs, model)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, r in found.items() if r["predicted"] == 0}


def test_held_out_labels_do_not_matter(spark, rude):
    docs, labels, _ = rude
    other = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end toxic")
    text = pd.Series(["zorgle and more", "calm", ""])
    assert toxicity.train(docs, labels).scores(text).tolist() == toxicity.train(docs, other).scores(text).tolist()


def test_toxicity_without_labels(spark, rude):
    docs, labels, _ = rude
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs.limit(3), none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_shared_runs_match_brute_force(spark):
    rng = random.Random(12)
    pool = [" ".join(rng.choice(FILL) for _ in range(rng.randint(2, 12))) + rng.choice(".!?") for _ in range(25)]
    texts = []
    for i in range(60):
        held = [rng.choice(pool) if rng.random() < 0.6 else f"only {i} here {n}." for n in range(rng.randint(0, 9))]
        texts.append("".join(x + rng.choice([" ", "  ", "\n", " \n\n ", "\t"]) for x in held))
    texts += [None, "", " \n ", "Same.", "same.  ", "x. " * 20_000]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 0), (None, "Same.", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, unit int")
    found = [(r["doc_id"], r["shared_words"]) for r in passages.shared_runs(docs).collect()]
    cut = [[y for y in (re.sub(r"[ \t\x0b\f\r]+", " ", x).strip(" ").lower()
                        for x in re.split(r"\n|(?<=[.!?])[ \t\x0b\f\r]+", t or "")) if y] for _, t, _ in rows]
    where = {}
    for k, own in enumerate(cut):
        for x in own:
            where.setdefault(x, set()).add(k)
    expected = []
    for (i, _, _), own in zip(rows, cut, strict=True):
        best = run = 0
        for x in own:
            run = run + len(x.split(" ")) if len(where[x]) > 1 else 0
            best = max(best, run)
        if best:
            expected.append((i, best))
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert passages.shared_runs(docs.limit(0)).count() == 0


def test_short_items_are_found_exactly_at_word_ends(spark):
    items = [(1, "Blue  whale"), (2, "42"), (3, "blue whale"), (4, " "), (5, None), (6, "é!")]
    texts = ["The blue\nwhale, 42 of them.", "bluewhale 142 42nd", "BLUE WHALE", "", None, "42", "x é! y é!z", "whale " * 50_000 + "42"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["start"], r["end"], r["edits"]) for r in decontaminate.find(docs, bench).collect())
    assert found == [(0, 1, 4, 14, 0), (0, 2, 16, 18, 0), (0, 3, 4, 14, 0), (2, 1, 0, 10, 0), (2, 3, 0, 10, 0), (5, 2, 0, 2, 0),
                     (6, 6, 2, 4, 0), (7, 2, 300_000, 300_002, 0)]
    assert decontaminate.clean(docs, bench).count() == len(texts)
    assert decontaminate.clean(docs, bench, min_chars=5).count() == len(texts) - 2
    assert decontaminate.find(docs.limit(0), bench).count() == decontaminate.find(docs, bench.limit(0)).count() == 0


def test_repeated_words_do_not_fill_a_notice(spark):
    whole = "this source code form is subject to the terms of the mozilla public license"
    texts = ["this source " * 6 + "public license " * 6, whole, whole.replace("form ", "form here "), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licences.scan(docs).collect()}
    assert found[0] == ("", 0.0) and found[1] == ("mpl", 1.0) and found[2][0] == "mpl"
    assert licences.scan(docs.limit(0)).count() == 0


def test_both_dictionaries_are_trained(monkeypatch):
    made = []
    train = toxicity.zstandard.train_dictionary

    def noted(size, samples, **choice):
        made.append(train(size, samples, **choice).as_bytes())
        return train(size, samples, **choice)

    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", noted)
    toxic = [f"you {a}headed {b}brain number {i}" for i in range(60) for a, b in [("dunder", "mosquito"), ("blockish", "porridge")]]
    ordinary = [f"the number {i} of {w} is you and a day {i * i} later" for i in range(400) for w in ("apples", "bridges", "rivers")]
    pieces = toxicity.toxic_windows(toxic, ordinary)
    assert pieces and all(len(x) >= toxicity.LEAST for x in pieces) and not any(b" number" in x for x in pieces)
    contents = (toxicity.trained(pieces, toxicity.TOXIC_BYTES, **toxicity.TOXIC_SEGMENTS),
                toxicity.trained(toxicity.ordinary_windows(ordinary), toxicity.ORDINARY_BYTES))
    assert list(contents) == made
    assert toxicity.trained([b"a piece that is alone"], 100) == b"a piece that is alone"
    known = toxicity.Dictionaries(*contents)
    insult, plain = "you dunderheaded mosquitobrain of apples", "the number of apples is you and a day"
    assert toxicity.text_features([insult], known)[0, 0] > 5 > toxicity.text_features([plain], known)[0, 0]
