"""Byte-level BPE vocabularies of public tokenizers: loading, and splitting texts as their pre-tokenizer does."""

from __future__ import annotations

import json
import re
from typing import NamedTuple

import regex

#: The byte-level pre-tokenizer's pattern: fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts below U+0250 without U+001C-U+001F, with the letters, numbers and spaces there written out.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_NEAR = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_FAR = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
_BEYOND = re.compile("[^\x00-\x1b\x20-ɏ]")


class Vocabulary(NamedTuple):
    """tokens: bytes of each id; merges: (left id, right id) -> (rank, id); base: id of each byte; special: text -> id."""

    tokens: list[bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    base: list[int]
    special: dict[str, int]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for themselves, others counted from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE ``tokenizer.json`` on the driver; its size is that of a vocabulary, not of data."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters, ids = _byte_letters(), data["model"]["vocab"]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in ids.items():
        tokens[i] = bytes(letters[x] for x in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    merges = {}
    for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]):
        merges[ids[a], ids[b]] = (rank, ids[a + b])
    return Vocabulary(tokens, merges, [ids[x] for x, _ in sorted(letters.items(), key=lambda x: x[1])], special)


def special_pattern(vocabulary: Vocabulary) -> re.Pattern | None:
    """Special strings stand for themselves before anything else is split; longer ones first."""
    texts = sorted(vocabulary.special, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, texts)) + ")") if texts else None


def pieces(text: str) -> list[str]:
    """The parts of a text that are encoded one by one."""
    return (_FAR if _BEYOND.search(text) else _NEAR).findall(text)
