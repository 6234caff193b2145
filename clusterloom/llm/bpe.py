"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring symbols that occurs inside no vocabulary token can
never be merged over, whatever the merge order, so a text may be cut there.
Every fragment between cuts is encoded on its own and the ids are
concatenated. Since fragments recur, a task remembers their ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clusterloom.llm.batches import slices, small_file, text_frame

#: Words, and half as many runs without white space, that a task remembers unless told otherwise.
KNOWN_WORDS = 200_000

NO_RANK = 1 << 60
LONG_FRAGMENT = 64

#: Characters that Python splits at and Unicode does not count as white space.
_NO_SPACE = "\x1c\x1d\x1e\x1f"
_SPACE = regex.compile(r"\p{White_Space}+")

#: First and last of the letter ranges that Unicode 16 has and Python's 15.1 tables lack.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x113B7), (0x113D1, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5F0),
)

#: First and last of the ranges of combining marks that came after Unicode 9,
#: by whose tables the tokenizer composes texts.
_LATE_MARK_RANGES = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C),
    (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27),
    (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070),
    (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E),
    (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99),
    (0x11D42, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F),
    (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
)
_LATE_MARKS = regex.compile("([" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _LATE_MARK_RANGES) + "])")

#: Capitals that came after Unicode 15.1, with their small letters.
_LATE_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **dict(zip(range(0x10D50, 0x10D66), range(0x10D70, 0x10D86))),
    **dict(zip(range(0x16EA0, 0x16EB9), range(0x16EBB, 0x16ED4))),
}

OUTPUTS = {
    "ids": T.ArrayType(T.LongType()),
    "decoded": T.StringType(),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(byte if byte in shown else next(hidden)) for byte in range(256)]


def unassigned(char: str) -> bool:
    """Has Unicode 16 no character here?"""
    if unicodedata.category(char) != "Cn":
        return False
    return not any(first <= ord(char) <= last for first, last in _NEW_LETTERS)


class Vocabulary:
    """Tables of a tokenizer file with word ends; refuses settings it does not know."""

    def __init__(self, data: bytes):
        whole = json.loads(data)
        model = whole["model"]
        steps = [step["type"] for step in whole["normalizer"]["normalizers"]]
        splits = whole["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE"
            and steps == ["NFC", "Replace", "Lowercase"]
            and [split["type"] for split in splits] == ["Split", "ByteLevel"]
            and splits[0]["invert"]
            and not (splits[1]["add_prefix_space"] or splits[1]["use_regex"])
            and not (model["byte_fallback"] or model["ignore_merges"] or model["unk_token"])
            and whole["post_processor"] is None
            and whole["decoder"] is None
        )
        if not known:
            raise ValueError("this kind of tokenizer file is not supported")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.added = {token["content"]: token["id"] for token in whole["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.codes = {text: number.to_bytes(4, "little") for text, number in self.ids.items()}
        self.symbols = byte_symbols()
        self.inside = set()
        for token in self.ids:
            units = self.units(token)
            self.inside.update(zip(units, units[1:]))

    def units(self, token: str) -> list[str]:
        """Symbols of a token; the last one of a word carries the word end."""
        if token.endswith(self.end) and token != self.end:
            body = list(token[: -len(self.end)])
            return [*body[:-1], body[-1] + self.end]
        return list(token)


def composed(text: str) -> str:
    """NFC by the tables of Unicode 9: later combining marks neither move nor compose."""
    if unicodedata.is_normalized("NFC", text) and not _LATE_MARKS.search(text):
        return text
    return "".join([unicodedata.normalize("NFC", part) for part in _LATE_MARKS.split(text)])


def merged_everywhere(parts: list[str], first: str, second: str) -> list[str]:
    """One pair merged at all its places, from the left; keeps long fragments affordable."""
    merged, at = [], 0
    while at < len(parts):
        if parts[at] == first and at + 1 < len(parts) and parts[at + 1] == second:
            merged.append(first + second)
            at += 2
        else:
            merged.append(parts[at])
            at += 1
    return merged


class Memory(dict):
    """Results of a function for short keys, in two generations: what the older one knows and is asked for moves on."""

    def __init__(self, function):
        self.function = function
        self.older: dict = {}

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        if len(key) < 64:
            self[key] = found
        return found

    def bound(self, size: int) -> None:
        """Keep no more than about ``size`` keys, those asked for of late."""
        if len(self) > size // 2:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids and decoded text of whole texts, with the words and chunks met so far remembered.

    Ids are kept as bytes, little-endian in 32 bits, together with their texts.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int = KNOWN_WORDS):
        self.v, self.remembered = vocabulary, remembered
        self.known_words = Memory(self.word)
        self.known_chunks = Memory(self.chunk)

    def fragment(self, parts: list[str], found: list[int]) -> list[str]:
        """Merge the pair of lowest rank, leftmost first, until none is left.

        ``found`` holds the ranks of neighbours.
        """
        rank = self.v.ranks.get
        while found:
            lowest = min(found)
            if lowest == NO_RANK:
                break
            at = found.index(lowest)
            if len(parts) > LONG_FRAGMENT:
                parts = merged_everywhere(parts, parts[at], parts[at + 1])
                found = [rank(pair, NO_RANK) for pair in zip(parts, parts[1:])]
                continue
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
            if at < len(found):
                found[at] = rank((parts[at], parts[at + 1]), NO_RANK)
        return parts

    def tokens(self, word: str) -> list[str]:
        """Cut a word at its certain boundaries and join the tokens of the fragments."""
        symbols, rank, inside = self.v.symbols, self.v.ranks.get, self.v.inside
        units = [symbols[byte] for byte in word.encode()]
        units[-1] += self.v.end
        pairs = list(zip(units, units[1:]))
        ranks = [rank(pair, NO_RANK) for pair in pairs]
        if NO_RANK not in ranks:  # a pair that merges is inside a token
            return self.fragment(units, ranks)
        tokens, start = [], 0
        for at, pair in enumerate(pairs):
            if ranks[at] == NO_RANK and pair not in inside:
                tokens += self.fragment(units[start : at + 1], ranks[start:at])
                start = at + 1
        return tokens + self.fragment(units[start:], ranks[start:])

    def word(self, word: str) -> tuple[bytes, str]:
        tokens = self.tokens(word)
        return b"".join([self.v.codes[token] for token in tokens]), " ".join(tokens)

    def words(self, text: str) -> list[str]:
        """Words of the split pattern; a code point that has no assigned character is no letter."""
        if text.isascii() or not any(map(unassigned, text)):
            return self.v.words.findall(text)
        known = "".join("\ue000" if unassigned(c) else c for c in text)
        return [text[found.start() : found.end()] for found in self.v.words.finditer(known)]

    def chunk(self, raw: str) -> tuple[bytes, str]:
        """Ids and texts of a run without white space."""
        self.known_words.bound(self.remembered)
        if raw.isascii() and raw.isalpha():  # letters are one word
            return self.known_words[raw.lower()]
        # Lower-casing goes by character here, while str.lower() looks at a sigma's neighbours.
        text = raw if raw.isascii() else composed(raw).replace("Σ", "σ")
        lower = text.lower() if text.isascii() else text.lower().translate(_LATE_CAPITALS)
        words = [self.known_words[word] for word in self.words(lower)]
        if len(words) == 1:
            return words[0]
        return b"".join([codes for codes, _ in words]), " ".join([texts for _, texts in words])

    def plain(self, text: str) -> tuple[list[bytes], list[str]]:
        """The same for each chunk of a text without special tokens."""
        parts = _SPACE.split(text) if any(c in text for c in _NO_SPACE) else text.split()
        known = self.known_chunks
        known.bound(self.remembered // 2)
        found = [known[part] for part in parts]
        return [codes for codes, _ in found], [texts for _, texts in found if texts]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and what they decode to."""
        codes, texts, last = [], [], 0
        for found in self.v.special.finditer(text):
            before = self.plain(text[last : found.start()])
            codes += [*before[0], self.v.added[found.group()].to_bytes(4, "little")]
            texts += [*before[1], found.group()]
            last = found.end()
        rest = self.plain(text[last:])
        return b"".join(codes + rest[0]), " ".join(texts + rest[1])


def encode_in_batches(data, outputs: Sequence[str], remembered: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = data.value  # lives as long as the worker, and with it what the encoder remembers
        if "encoder" not in held:
            held["encoder"] = Encoder(Vocabulary(held["file"]), remembered)
        encoder = held["encoder"]
        for batch in slices(batches):
            columns = {name: [] for name in outputs}
            for text in batch["text"].to_pylist():
                codes, decoded = encoder.encode(text or "")
                for name, column in columns.items():
                    if name == "ids":
                        column.append(np.frombuffer(codes, "<u4").astype(np.int64))
                    elif name == "decoded":
                        column.append(decoded)
                    elif name == "n_tokens":
                        column.append(len(codes) // 4)
                    elif name == "ids_sha256":
                        column.append(hashlib.sha256(codes).hexdigest())
                    else:
                        column.append(hashlib.sha256(decoded.encode()).hexdigest())
            kinds = {"ids": pa.list_(pa.int64()), "n_tokens": pa.int64()}
            arrays = [pa.array(column, kinds.get(name, pa.string())) for name, column in columns.items()]
            yield pa.RecordBatch.from_arrays([batch["id"], *arrays], ["id", *columns])

    return encode


def encode_texts(
    df: DataFrame,
    vocabulary_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    outputs: Sequence[str] = ("ids", "decoded"),
    remembered: int = KNOWN_WORDS,
) -> DataFrame:
    """Ids of every text and the text they decode to, one row per input row.

    ``outputs`` chooses among ``OUTPUTS``; the digests are of the ids as
    little-endian unsigned 32-bit integers and of the decoded text in UTF-8.
    A missing or empty text has no ids and decodes to the empty text. Repeated
    rows are encoded each, other columns are ignored. ``remembered`` words
    of a task are encoded but once, at some 500 bytes each. One pass, no shuffle; the vocabulary file is read on the driver, and only if it is small.
    """
    if unknown := set(outputs) - set(OUTPUTS):
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    data = df.sparkSession.sparkContext.broadcast({"file": small_file(vocabulary_path)})
    rows = text_frame(df, id_column, text_column)
    fields = [rows.schema["id"], *[T.StructField(name, OUTPUTS[name]) for name in outputs]]
    encoded = rows.mapInArrow(encode_in_batches(data, list(outputs), remembered), T.StructType(fields))
    return encoded.withColumnRenamed("id", id_column)
