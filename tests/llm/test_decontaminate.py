import random

import numpy as np

from clusterloom.llm.decontaminate import GAP, MATCH, MISMATCH, align, find_leaks, plain_words, without_leaks
from tests.llm.rows import TEXTS, frame, sentence


def brute_align(item, passage):
    best, table = 0, [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            step = MATCH if a == b else MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] + GAP, table[i][j - 1] + GAP)
            best = max(best, table[i][j])
    return best


def test_alignment_equals_brute_force():
    rnd = random.Random(8)
    for _ in range(200):
        item, passage = ([rnd.randrange(6) for _ in range(rnd.randint(1, 25))] for _ in range(2))
        score, start, end = align(np.array(item, np.uint64), np.array(passage, np.uint64))
        assert score == brute_align(item, passage)
        if score:
            assert brute_align(item, passage[start:end]) == score


def items_and_documents():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("bcdfghklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(45))) for i in range(12)]
    docs, expected = [], set()
    for n in range(80):
        text = [word() for _ in range(rnd.randint(20, 200))]
        if n % 2:
            item, words = items[n % 12]
            copy = words.split()
            for at in range(len(copy)):  # an edited copy
                if rnd.random() < (n % 8) / 40:
                    copy[at] = word()
            text[10:10] = copy
            expected.add((n, item))
        docs.append((n, " ".join(text).upper() if n % 3 else ". ".join(text)))
    return items, docs, expected


def test_edited_copies_are_found_and_nothing_else(spark):
    items, docs, expected = items_and_documents()
    benchmark = spark.createDataFrame([(*i, "?") for i in items], "item_id long, text string, doc_id string")
    found = find_leaks(frame(spark, docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected
    words = {n: plain_words(text) for n, text in docs}
    for r in found:
        assert 0.5 <= r["score"] <= 1
        part = words[r["doc_id"]][r["start_word"] : r["end_word"]]
        item = plain_words(dict(items)[r["item_id"]])
        assert brute_align(item, part) == round(r["score"] * MATCH * len(item))
    clean = without_leaks(frame(spark, docs), benchmark)
    assert {r["doc_id"] for r in clean.collect()} == set(range(80)) - {n for n, _ in expected}


def test_every_row(spark):
    items = [(1, None), (2, ""), (3, "one two"), (4, sentence(0, 80)), (4, sentence(0, 80)), (None, sentence(3, 40)), (5, sentence(5, 700))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(frame(spark), benchmark).collect()}
    assert {(1, 4), (2, 4), (8, 5)} <= found and not {item for _, item in found} & {1, 2, 3, None}
    assert find_leaks(frame(spark, []), benchmark).collect() == []
    assert find_leaks(frame(spark), benchmark.limit(0)).collect() == []
    kept = without_leaks(frame(spark), benchmark.limit(0))
    assert kept.count() == len(TEXTS)


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    import clusterloom.llm.decontaminate as module

    items, docs, _ = items_and_documents()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, find_leaks(frame(spark, docs), benchmark).collect()))
    monkeypatch.setattr(module, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, find_leaks(frame(spark, docs), benchmark).collect())) == whole


def edited(rnd, words, share, word):
    """A copy with a share of its words replaced, deleted or preceded by a new one."""
    out = []
    for one in words:
        kind = rnd.choice("rrrdi") if rnd.random() < share else "k"
        out += {"k": [one], "r": [word()], "d": [], "i": [word(), one]}[kind]
    return out


def test_edits_of_15_to_33_percent_are_found_as_by_alignment_of_all_pairs(spark):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("bcdfghklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
    common = [word() for _ in range(30)]
    mixed = lambda: rnd.choice(common) if rnd.random() < 0.5 else word()
    items = [(i, " ".join(mixed() for _ in range(rnd.choice((3, 5, 8, 20, 45))))) for i in range(15)]
    items.append((15, " ".join(word() for _ in range(42))))
    docs = []
    for n in range(90):
        text = [mixed() for _ in range(rnd.randint(5, 120))]
        text[3:3] = edited(rnd, items[n % 15][1].split(), 0.15 + 0.18 * n / 90, mixed)
        docs.append((n, " ".join(text)))
    docs += [(100 + n, " ".join(w if at % 5 else word() for at, w in enumerate(items[15][1].split()))) for n in range(4)]
    docs.append((110, items[15][1]))
    docs.append((111, " ".join(f"{w} {word()}" for w in items[15][1].split())))  # as many new words as old ones
    expected = {}
    for n, text in docs:
        for item, words in items:
            score = brute_align(words.split(), text.split())
            if score >= max(len(words.split()), 3 * MATCH):
                expected[n, item] = score / (MATCH * len(words.split()))
    assert {(n, 15) for n in (100, 101, 102, 103, 110, 111)} <= set(expected) and len(expected) > 60
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(frame(spark, docs), benchmark).collect()}
    assert found == expected


def test_a_long_item_is_scored_as_a_whole(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("bcdfghklmnprst") + rnd.choice("aeiou") for _ in range(4))
    long = [[word() for _ in range(n)] for n in (259, 600)]
    long[0][-3:] = ["on", "the", "whole"]
    items = [(n, " ".join(words)) for n, words in enumerate(long)]
    docs = [
        (1, "it is on the whole a clean text"),
        (2, items[0][1]),
        (3, " ".join(long[1][:256])),  # less than half of the item
        (4, " ".join(long[1][100:460])),
        (5, " ".join(edited(rnd, long[1], 0.2, word))),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(frame(spark, docs), benchmark).collect()}
    assert set(found) == {(2, 0), (4, 1), (5, 1)}
    assert (found[2, 0], found[4, 1]) == (1, 0.6)
    assert found[5, 1] == brute_align(long[1], docs[4][1].split()) / (MATCH * 600)


def test_seeds_are_counted_in_all_documents(spark, monkeypatch):
    """And copies are found with whatever counts, none at all included."""
    import clusterloom.llm.decontaminate as module

    items, docs, expected = items_and_documents()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    held = {n: set(module.pair_hashes(module.WordHashes().of(plain_words(text)))[0].tolist()) for n, text in docs}
    seen, plain = [], module.seeds_of

    def watched(item, grams, counts, min_score):
        seen.append(dict(zip(grams.tolist(), counts.tolist())))
        return plain(item, grams, counts, min_score)

    monkeypatch.setattr(module, "seeds_of", watched)
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(frame(spark, docs), benchmark).collect()}
    assert found == expected and len(seen) == len(items)
    assert seen[0] == {gram: sum(gram in grams for grams in held.values()) for gram in seen[0]}
    monkeypatch.setattr(module, "seeds_of", lambda item, grams, counts, least: plain(item, grams, counts * 0, least))
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(frame(spark, docs), benchmark).collect()} == expected
