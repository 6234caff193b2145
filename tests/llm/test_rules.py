import math
import random
import re

import pytest

from clusterloom.llm.rules import RULES, STEPS, Risk, counts_of, judge_documents, most_rejected
from tests.llm.rows import TEXTS, frame


def brute_counts(text):
    """The stated counts, from their definitions."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    repeated = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            repeated.update(range(i, i + 8))
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(repeated),
    }


def failed(counts):
    return counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]


def random_texts():
    rnd = random.Random(6)
    return [
        " ".join(rnd.choice(["a", "b", "é", "c#", "|", "\n", "\x0b", "\x85", "d e"]) for _ in range(rnd.randint(0, 90)))
        for _ in range(150)
    ]


def test_counts_equal_brute_force():
    for text in [*random_texts(), *[t for _, t in TEXTS if len(t or "") < 5000]]:
        found = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), counts_of((text or "").encode())))
        assert found == brute_counts(text)


@pytest.mark.parametrize("n", [1, 10, 100, 900])
@pytest.mark.parametrize("share", [0.01, 0.05, 0.3])
def test_exact_binomial_bound(n, share):
    for level in (0.001, 0.05):
        k = most_rejected(n, share, level)
        below = lambda k: sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))
        assert k == -1 or below(k) <= level
        assert below(k + 1) > level


def labelled(spark, n=4000, noise=0):
    """Clean documents and ones full of symbols; the first ``noise`` clean ones have symbols, too."""
    rnd = random.Random(7)
    clean = lambda: " ".join(rnd.choice("these are some plain words that make up a text here".split()) + str(rnd.randrange(99)) for _ in range(30))
    rows, labels = [], []
    for i in range(n):
        bad = i % 10 == 0
        text = clean()
        if bad or i % 10 == 1 and i // 10 < noise:
            text = " ".join(word + "***" for word in text.split())
        rows.append((i, text))
        labels.append((i, int(not bad), "?"))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, stratum string")


def verdicts(found):
    return {r["doc_id"]: r["kept"] for r in found.collect()}


def test_a_separating_cutoff_is_found_and_spares_the_good(spark):
    docs, labels = labelled(spark)
    found = verdicts(judge_documents(docs, labels))
    assert all(found[i] == (i % 10 != 0) for i in found)


def test_a_cutoff_that_rejects_too_many_good_ones_is_refused(spark):
    docs, labels = labelled(spark, noise=200)
    found = verdicts(judge_documents(docs, labels))
    assert all(found[i] for i in found if i % 10 == 1)


def test_without_labels_only_the_base_rules_reject(spark):
    docs, labels = labelled(spark, 300)
    for few in (labels.limit(0), labels.limit(40)):
        assert all(verdicts(judge_documents(docs, few)).values())


def test_at_most_the_stated_share_of_good_ones_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = judge_documents(docs, labels).filter("not base_failed").join(labels.filter("quality = 1"), "doc_id")
    rows = found.selectExpr("count(*)", "count_if(not kept)").first()
    assert rows[1] <= Risk().rejected * rows[0]


def test_every_row(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    rows = judge_documents(frame(spark), labels).collect()
    assert len(rows) == len(TEXTS)
    by_text = sorted((str(name), *sorted(brute_counts(text).items())) for name, text in TEXTS if len(text or "") < 9000)
    found = sorted((str(r["doc_id"]), *sorted((k, r[k]) for k in brute_counts(""))) for r in rows if r["doc_id"] != 8 and r["doc_id"] != 9)
    assert found == [row for row in by_text if row[0] not in ("8", "9")]
    for r in rows:
        assert r["base_failed"] == failed(r.asDict()) and r["kept"] == (not r["base_failed"])
    assert judge_documents(frame(spark, []), labels).collect() == []


def test_rules_name_counts():
    assert set(RULES) and STEPS > 1
