import collections
import random
import re

import pytest

from clusterloom.llm.graph import components
from clusterloom.llm.jaccard import Rule, bitmap, grown, leaf, likeliest, one_of_each, similar_documents, tree_pairs
from tests.llm.rows import TEXTS, frame


def root_of(parent, node):
    while parent[node] != node:
        node = parent[node]
    return node


def brute(rows, rule):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        starts = range(max(1, len(words) - rule.words + 1)) if words else ()
        sets.append({tuple(words[i : i + rule.words]) for i in starts})
    parent = list(range(len(rows)))
    holders = collections.defaultdict(list)
    for at, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(at)
    for a, b in {(a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1 :]}:
        common = len(sets[a] & sets[b])
        if 100 * common >= rule.percent * (len(sets[a]) + len(sets[b]) - common):
            a, b = root_of(parent, a), root_of(parent, b)
            parent[max(a, b)] = min(a, b)
    ids = collections.defaultdict(list)
    for at, (name, _) in enumerate(rows):
        if name is not None:
            ids[root_of(parent, at)].append(name)
    return [
        (name, len(sets[at]), min(ids[root_of(parent, at)], default=name)) for at, (name, _) in enumerate(rows)
    ]


def near_copies():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 9, 12, 20, 40, 80, 200]))]
        for _ in range(rnd.randint(1, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 30))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append((len(rows) * 7 % 1009, " ".join(copy[:-1] or copy if rnd.random() < 0.3 else copy)))
    passage = " ".join(rnd.choice(words) for _ in range(60))
    for i in range(80):
        rows.append((2000 + i, f"{passage} {' '.join(rnd.choice(words) for _ in range(rnd.randint(5, 80)))}"))
    return [*rows, (3003, "a"), (3004, "A"), (3005, "a b"), (3006, "A  b")]


@pytest.mark.parametrize("rule", [Rule(3, 90), Rule(5, 80)])
def test_equals_brute_force(spark, rule):
    rows = near_copies()
    found = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, rule))


def test_every_row(spark):
    found = similar_documents(frame(spark)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(TEXTS, Rule())))
    assert similar_documents(frame(spark, [])).collect() == []


def test_one_document_of_each_stays(spark):
    kept = one_of_each(frame(spark), Rule(5, 80))
    assert kept.columns == frame(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(n) for n in [1, 3, 4, 5, 6, 7, 8, 9, None, 10, 10, -11])


def test_trees_lose_no_pair():
    import numpy as np

    rnd, rule = np.random.default_rng(1), Rule(3, 80)
    sets = []
    for _ in range(12):
        base = rnd.integers(0, 2**63, int(rnd.integers(2, 300)), dtype=np.uint64)
        sets += [np.unique(base[rnd.random(len(base)) > rnd.choice([0, 0.03, 0.1, 0.3])]) for _ in range(9)]
    sets = [s for s in sets if len(s)]
    leaves = [leaf(i, len(s), i % 40 if i < 60 else i, 0, bitmap(s)) for i, s in enumerate(sets)]
    found = {tuple(sorted((a.leaf[0], b.leaf[0]))) for a, b in tree_pairs(grown(leaves), rule, False)}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            linked = rule.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
            if linked and leaves[a].owner != leaves[b].owner:
                assert (a, b) in found
    assert len(found) < len(sets) * len(sets) / 4


def test_components_of_long_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 150), (150, 200), (199, 150), (7, 0)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, found)) == {**{i: 0 for i in range(61)}, 150: 150, 199: 150, 200: 150}
    assert len(found) == 64


def test_likeliest_pairs_tell_of_others():
    import numpy as np

    sets = [np.arange(100, dtype=np.uint64) + np.uint64(shift) for shift in (0, 1, 2, 3, 4)]
    leaves = [leaf(i, 100, i % 2, 0, bitmap(s)) for i, s in enumerate(sets)]
    pairs = list(tree_pairs(grown(leaves), Rule(3, 80), False))
    assert len(list(likeliest(iter(pairs), 99))) == 6 and not any(more for _, _, more in likeliest(iter(pairs), 6))
    (one,) = likeliest(iter(pairs), 1)
    assert abs(one[0] - one[1]) == 1 and one[2]


def test_chains_of_components_are_followed_to_the_end(spark):
    """Copies that drift: neighbours are linked, others not, and each block holds many of them."""
    rnd = random.Random(12)
    words = [f"v{i}" for i in range(400)]
    rows = []
    for chain in range(3):
        text = [rnd.choice(words) for _ in range(120)]
        for step in range(60):
            if step % 20 != 19:
                text = list(text)
                text[rnd.randrange(120)] = rnd.choice(words)
            else:
                for at in range(0, 120, 9):
                    text[at] = rnd.choice(words)
            rows.append((chain * 1000 + step * 13 % 997, " ".join(text)))
    found = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), Rule(3, 90)).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, Rule(3, 90)))
