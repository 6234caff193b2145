import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clusterloom.llm import phrases
from clusterloom.llm.phrases import Filter, collocations, keys_of
from tests.llm.rows import sentence


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, n string, rank string, words string, prefix string, total string"
    return spark.createDataFrame([(n, text, lang, *"?????") for n, (lang, text) in enumerate(rows)], schema)


def brute(rows, least, keep=2000):
    """Counts every phrase in a dictionary."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in candidates.items():
            if inside[p] < a:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        for rank, row in enumerate(sorted(scored)[:keep], 1):
            found.add((lang, rank, row[2].decode(), *row[3:]))
    return found


def got(df):
    assert df.dtypes == [("lang", "string"), *[("rank", "bigint"), ("phrase", "string")], *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def texts(seed=1, n=300):
    rnd = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "The", "a", "a", "é", "Éa", "x", "日本"]
    rows = [
        (rnd.choice(["en", "en", "en", "de", None, "und", ""]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "\t", "  ", ".  ", "\n", ",", " ;\t "]) for _ in range(rnd.randint(0, 30))))
        for _ in range(n)
    ]
    return rows + [("en", None), ("en", ""), ("fr", " \t\n.,"), ("en", "new york city hall opens"), ("en", sentence(0, 3000))] * 9


@pytest.mark.parametrize("least, keep", [(1, 10**6), (4, 2000), (9, 7)])
def test_equals_brute_force(spark, least, keep):
    rows = texts()
    assert got(collocations(frame(spark, rows), least, keep)) == brute(rows, least, keep)


def test_chunks_parts_and_hot_prefixes_change_nothing(spark, monkeypatch):
    rows = texts(2, 80)
    expected = brute(rows, 3)
    # A filter that lets everything through, many small chunks, and texts in small parts.
    for name, value in (("CHUNK_WORDS", 97), ("TEXT_BYTES", 50), ("LEAST_BITS", 6), ("MOST_BITS", 6), ("HOT_PREFIXES", 3)):
        monkeypatch.setattr(phrases, name, value)
    assert got(collocations(frame(spark, rows), 3)) == expected


def test_words_of_one_hash_get_another_salt(spark, monkeypatch, tmp_path):
    rows = frame(spark, texts(3, 20)).select("lang", "text").fillna("und")
    real = phrases.Powers.hashes

    def hashes(self, *places):
        found = real(self, *places)
        return found % np.uint64(3) + np.uint64(1) if self.base in first_bases else found

    first_bases = [phrases.Powers(salt).base for salt in (0, 1)]
    monkeypatch.setattr(phrases.Powers, "hashes", hashes)
    words, salt = phrases.counted_words(rows, str(tmp_path))
    assert salt == 2 and words.select("lang", "hash").distinct().count() == words.count()


def test_no_rows(spark):
    assert got(collocations(frame(spark, []), 1)) == set()
    assert got(collocations(frame(spark, [("en", None), (None, "alone")]), 1)) == set()


def test_overlaps_and_ends_of_pieces(spark):
    rows = [("en", "a a a a"), ("en", "b c. c d")]
    assert got(collocations(frame(spark, rows), 1)) == brute(rows, 1)
    assert not any("c c" in row[2] for row in got(collocations(frame(spark, rows), 1)))


def test_filter_holds_what_it_was_given():
    keys = keys_of("en", np.arange(1000, dtype=np.uint64))
    held = Filter(16, np.zeros(1 << 10, np.uint64))
    slots = held.slots(keys[:500])
    np.bitwise_or.at(held.places, slots >> 6, np.uint64(1) << (slots & 63).astype(np.uint64))
    assert held.holds(keys[:500]).all() and held.holds(keys[500:]).sum() < 50
