import random

import public_tokenizers
import pytest

from clusterloom.llm.counts import SPACE, Counter, Pieces, PrefixWalk, count_tokens
from tests.llm.rows import TEXTS, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as file:
        return Pieces.from_model(file.read())


def brute(pieces, text):
    """Every segmentation of a short text, by recursion from the end; the shorter last piece wins ties."""
    if not text:
        return 0, 0, 0
    options = []
    for size in range(1, len(text) + 1):
        score = pieces.scores.get(text[-size:])
        if score is not None:
            total, tokens, raw = brute(pieces, text[:-size])
            options.append((total + score, tokens + 1, raw))
    size = len(text[-1].encode())
    total, tokens, raw = brute(pieces, text[:-1])
    best = max(options, key=lambda o: o[0], default=None)
    other = (total + size * pieces.byte_score, tokens + size, raw + size)
    return other if best is None or other[0] > best[0] else best


def test_walk_equals_brute_force(pieces):
    rnd = random.Random(2)
    texts = sorted({SPACE + "".join(rnd.choice("theinrés日9#") for _ in range(rnd.randint(0, 9))) for _ in range(150)})
    walk = PrefixWalk(pieces)
    assert [walk.to(text) for text in texts] == [brute(pieces, text) for text in texts]


def test_shared_prefixes_are_computed_once(pieces):
    walk = PrefixWalk(pieces)
    walk.to(SPACE + "there")
    kept = walk.best[:5]
    walk.to(SPACE + "them")
    assert all(a is b for a, b in zip(kept[:4], walk.best))


def test_every_row(spark, pieces):
    found = count_tokens(frame(spark), PATH).collect()
    counter = Counter(pieces)
    expected = [(name, *counter.count([(text or "").encode()])[0]) for name, text in TEXTS]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert {r["n_tokens"] for r in found if r["doc_id"] in (3, 4, 5)} == {0}
    assert count_tokens(frame(spark, []), PATH).collect() == []


def test_counts_do_not_depend_on_what_was_met_before(pieces):
    texts = [(text or "").encode() for _, text in TEXTS if len(text or "") < 1000]
    together = Counter(pieces).count(texts)
    assert together == [Counter(pieces).count([text])[0] for text in texts]
