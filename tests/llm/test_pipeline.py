import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from clusterloom.llm.decontaminate import find_leaks
from clusterloom.llm.jaccard import Rule
from clusterloom.llm.secrets import spans_of
from tests.llm.rows import frame
from tests.llm.test_jaccard import brute as linked
from tests.llm.test_rules import brute_counts, failed

DIR = "/root/testdata/sf0.001"


def test_stages_in_order():
    names = ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "BPE encoding"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_brute_force(spark):
    """At this size no cutoff can be guaranteed, so only the base rules reject."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = {n: t for n, t in rows.items() if not failed(brute_counts(t))}
    component = {name: smallest for name, _, smallest in linked(sorted(rows.items()), Rule(5, 80))}
    rows = {n: t for n, t in rows.items() if component[n] == n}
    items = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    plain = {n: " ".join(re.findall(r"[^\W_]+", t.lower())) for n, t in rows.items()}
    rows = {n: t for n, t in rows.items() if not any(item in plain[n] for item in items)}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for n, text in rows.items():
        masks = bytearray(len(text))
        for _, start, end in spans_of(text.encode()):
            masks[start:end] = b"\1" * (end - start)
        masked = re.sub("\0+", "[SECRET]", "".join("\0" if m else c for c, m in zip(text, masks)))
        expected[n] = library.encode(masked, add_special_tokens=False).ids
    found = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, DIR).collect()}
    assert found == expected


def test_stages_take_every_row(spark):
    docs = frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, frame(spark, [])):
            result = stage(spark, rows, DIR)
            assert result.columns == list(corpus_pipeline.COLUMNS)
            assert (result.count() > 0) == (rows is docs)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert len(last) == docs.count() and all(len(r["ids"]) == r["n_tokens"] for r in last)


def test_decontamination_takes_effect(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    leaky = {r["doc_id"] for r in find_leaks(docs, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, DIR).select("doc_id").collect()}
    assert leaky and kept == {r["doc_id"] for r in docs.select("doc_id").collect()} - leaky


def test_only_the_judged_rows_are_dropped(spark):
    """Rows without an id, or with a shared one, do not go with a copy, junk or a leak among them."""
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").orderBy("item_id").first()["text"]
    # long enough for the base rules, and no two are near copies
    clean = [" ".join(f"{chr(97 + n)}{at}x" for at in range(60)) for n in range(5)]
    docs = frame(
        spark,
        [
            (1, clean[0]), (None, clean[0]), (None, clean[1]), (None, "junk"), (None, f"{clean[2]} {item}"),
            (2, clean[3]), (2, "junk"), (2, f"{clean[4]} {item}"), (2, clean[0]),
        ],
    )
    left = lambda df: {(r["doc_id"], r["text"]) for r in df.collect()}
    rows = left(docs)
    assert left(corpus_pipeline.quality_rules(spark, docs, DIR)) == {row for row in rows if row[1] != "junk"}
    assert left(corpus_pipeline.near_duplicates(spark, docs, DIR)) == rows - {(None, clean[0]), (2, clean[0]), (None, "junk")}
    assert left(corpus_pipeline.decontamination(spark, docs, DIR)) == {row for row in rows if item not in row[1]}
