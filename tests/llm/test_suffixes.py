import collections
import random

import numpy as np
import pytest

import clusterloom.llm.suffixes as module
from clusterloom.llm.suffixes import LoserTree, coded_run, decoded_run, repeats_digest, without_repeats
from tests.llm.rows import TEXTS, frame


def brute(rows, length=200):
    seen = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for name, text in rows:
        data = (text or "").encode()
        marks = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        spans = sum(1 for i, mark in enumerate(marks) if mark and (i == 0 or not marks[i - 1]))
        out.append((name, len(data), sum(marks), spans, bytes(b for b, mark in zip(data, marks) if not mark)))
    return sorted(map(repr, out))


def found(df):
    rows = without_repeats(df).collect()
    return sorted(
        repr((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"]))) for r in rows
    )


def passages():
    rnd = random.Random(4)
    words = lambda n: " ".join(rnd.choice(["the", "of", "ärger", f"x{rnd.randrange(500)}"]) for _ in range(n))
    shared = [words(n) for n in (40, 60, 100, 300)] + ["", ""]
    rows = [
        (i, f"{words(rnd.randint(0, 120))} {rnd.choice(shared)[rnd.randint(0, 30):]}{words(rnd.randint(0, 80))}")
        for i in range(150)
    ]
    odd = ["a" * 199, "b" * 200, "b" * 200, "c" * 201, "d" * 3000, "ab" * 400, "\0" * 450, "Zz " * 70, "Zz " * 70 + "q"]
    return [*rows, (208, rows[0][1]), (208, rows[0][1]), *[(300 + i, text) for i, text in enumerate(odd)]]


def test_equals_brute_force(spark):
    rows = passages()
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_every_row(spark):
    rows = [row for row in TEXTS if len(row[1] or "") < 60_000]
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, [])) == []
    digest = repeats_digest(without_repeats(frame(spark, rows)))
    assert digest.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_stretches_of_long_texts_join(spark, monkeypatch):
    monkeypatch.setattr(module, "STRETCH", 500)
    rows = passages()[:60]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("hot", [0, 5])
def test_hot_grams_are_dealt_out(spark, monkeypatch, hot):
    """Also where every gram counts as hot, and with few contexts at a time."""
    monkeypatch.setattr(module, "HOT_ANCHORS", hot)
    monkeypatch.setattr(module, "HELD_CONTEXTS", 7)
    monkeypatch.setattr(module, "BUCKET_STRINGS", 100)
    rows = passages()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_a_line_in_every_document(spark, monkeypatch):
    """100 bytes that all share, in surroundings of their own or of a few."""
    monkeypatch.setattr(module, "HOT_ANCHORS", 50)
    rnd = random.Random(6)
    line = "this line of one hundred bytes stands in every document of the collection, whatever its other text x"
    around = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(150))
    few = [around() for _ in range(4)]
    rows = [(i, (rnd.choice(few) if i % 3 else around()) + line + (rnd.choice(few) if i % 2 else around())) for i in range(400)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_many_contexts_of_one_gram_stay_small():
    """A task sends strings of a hot gram in pieces; none grows with their number."""
    rnd = np.random.default_rng(1)
    texts = [rnd.integers(97, 123, 336, np.uint8).tobytes() for _ in range(3000)]
    entries = [(text, 1, row, 0) for row, text in enumerate(texts)] + [(texts[0], 1, 9999, 5), (texts[1], 2, 0, 0)]
    blocks, known = module.hot_strings(entries, 200, 40)
    assert sorted(known) == [(0, 0, 336), (1, 0, 336), (9999, 5, 341)]
    sizes = [len(module.zstandard.decompress(block)) // 32 for block in blocks.values()]
    assert sum(sizes) == 3000 * 137 and max(sizes) < 2 * sum(sizes) / 40
    again, _ = module.hot_strings([(texts[7], 1, 70_000, 3)], 200, 40)
    found = [piece for n, block in again.items() for piece in module.hot_stretches([block, blocks[n]], 200)]
    assert {row for row, *_ in found} == {7, 70_000} and max(end for *_, end in found) == 339


def test_loser_tree_merges_and_knows_common_prefixes():
    rnd = random.Random(5)
    runs = []
    for _ in range(7):
        texts = sorted(bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(0, 40)))
        if texts:
            runs.append([(text, b"x", 1, 1, i) for i, text in enumerate(texts)])
    merged = list(LoserTree([decoded_run(coded_run(run)) for run in runs]))
    texts = [text for _, text, _ in merged]
    assert texts == sorted(text for run in runs for text, *_ in run)
    for (_, before, _), (shared, text, _) in zip(merged, merged[1:]):
        common = next((i for i, (a, b) in enumerate(zip(before, text)) if a != b), min(len(before), len(text)))
        assert shared == common
    assert list(LoserTree([])) == []
