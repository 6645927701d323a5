"""Tables of a tokenizer file, and the cutting of text into the words its merges work on."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import regex
from tokenizers import Tokenizer

from adstrata.llm.frames import SLICE_BYTES

# Words kept in a worker's table of known words; a full table is emptied.
KNOWN_WORDS = 500_000
# The pattern that the byte-level tokenizer files apply when they name none.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in shown)
    shown |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [shown[b] for b in range(256)]


def load(path: str) -> dict:
    """Plain arrays and lists of a BPE file of the tokenizers library, small enough to broadcast.

    Their size is bounded by the file's: one entry a token and one a merge. Understood are
    byte-level vocabularies, with or without an end-of-word suffix.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, vocab = spec["model"], spec["model"]["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    shown = byte_characters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens: list[str | None] = [None] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in [*vocab.items(), *special.items()]:
        tokens[i] = token
    steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    split = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), BYTE_LEVEL_PATTERN)
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    return {
        "pair_keys": keys[order],
        "pair_ranks": order.astype(np.int64),
        "pair_made": made[order],
        "first": np.array([vocab[c] for c in shown], np.int64),
        "last": np.array([vocab[c + suffix] for c in shown], np.int64),
        "tokens": tokens,
        "special": special,
        "pattern": split,
        "normal": normal,
        "front": json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}),
        "byte_decoder": (spec["decoder"] or {}).get("type") == "ByteLevel",
    }


class Cutter:
    """Cuts a text free of special tokens into words, as the bytes that the merges start from.

    ASCII is cut here; other texts by the library's own normaliser and splitter, whose Unicode tables
    differ from those of the regex module.
    """

    def __init__(self, tables: dict):
        front = Tokenizer.from_str(tables["front"])
        self.normal, self.split = front.normalizer, front.pre_tokenizer
        self.lower = "Lowercase" in tables["normal"]
        self.find = regex.compile(tables["pattern"]).findall
        self.as_bytes = str.maketrans({c: chr(b) for b, c in enumerate(byte_characters())})

    def words(self, text: str) -> list[bytes]:
        if text.isascii():
            return list(map(str.encode, self.find(text.lower() if self.lower else text)))
        if self.normal:
            text = self.normal.normalize_str(text)
        parts = "\n".join(w for w, _ in self.split.pre_tokenize_str(text))
        return [w.encode("latin-1") for w in parts.translate(self.as_bytes).split("\n")] if parts else []


def chunks(raw: bytes) -> Iterator[list[bytes]]:
    """Parts between ASCII white space, in lists of bounded size. Needs a file that drops it."""
    begin = 0
    while begin < len(raw):
        end = begin + SLICE_BYTES
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[begin:end].split()
        begin = end


class Known(dict):
    """Numbers for distinct chunks, given on first sight; ``fresh`` lists those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number
