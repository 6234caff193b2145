import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clusterloom.llm.bpe import Encoder, Vocabulary, encode_texts
from tests.llm.rows import TEXTS, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return Encoder(Vocabulary(file.read()))


def same(library, encoder, text):
    ids = library.encode(text, add_special_tokens=False).ids
    codes, decoded = encoder.encode(text)
    assert np.frombuffer(codes, "<u4").tolist() == ids
    assert decoded == library.decode(ids, skip_special_tokens=False)


def test_equals_the_library_on_random_texts(library, encoder):
    rnd = random.Random(1)
    signs = "ab cdE Éçß'sΣσς 'll't12٣½!?\x1c\x1d\x85  İIıǅ日本語한가\0\t\n…#*$́̈  　̦࣍"
    for _ in range(3000):
        parts = [rnd.choice([*signs, "<|endoftext|>", "<|startoftext|>"]) for _ in range(rnd.randint(0, 40))]
        same(library, encoder, "".join(parts))


def test_equals_the_library_on_every_code_point(library, encoder):
    """Each between letters, in blocks of a few hundred; surrogates are no characters."""
    points = [n for n in range(1, 0x110000) if not 0xD800 <= n < 0xE000]
    # Hangul, ideographs, private use and planes without characters are alike throughout.
    alike = [(0x3400, 0xA000), (0xAC00, 0xD7A4), (0xE000, 0xF900), (0x17000, 0x18D00), (0x20000, 0xE0000), (0xE0200, 0x110000)]
    chosen = [n for n in points if n % 97 == 0 or not any(a <= n < b for a, b in alike)]
    for at in range(0, len(chosen), 300):
        same(library, encoder, " ".join(f"a{chr(n)}b {chr(n)}" for n in chosen[at : at + 300]))


@pytest.mark.parametrize("text", ["a" * 5000, "'" * 300, "ΑΣ ΟΔΟΣ", "<|endoftext", "ab" * 40, "x!" * 99])
def test_equals_the_library_on_long_runs(library, encoder, text):
    same(library, encoder, text)


def test_cuts_only_where_no_token_crosses(encoder):
    assert ("t", "h") in encoder.v.inside
    assert not [pair for pair in encoder.v.ranks if len(pair[0]) == len(pair[1]) == 1 and pair not in encoder.v.inside]


def test_every_row(spark, library):
    found = encode_texts(frame(spark), PATH, outputs=("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"))
    expected = []
    for name, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        digests = hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        expected.append((name, ids, decoded, len(ids), *digests))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_empty_table(spark):
    assert encode_texts(frame(spark, []), PATH).collect() == []
