"""Ids of two public tokenizers, encoded word by word where that gives the ids of the whole text.

Arrow splits many texts at once and numbers their distinct words; each distinct word is
encoded once, and the ids of the texts are put together by number.  Ids are little-endian
16-bit numbers.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of the texts whose words are numbered together.
CHARACTERS = 1 << 22
#: Words that a piece model is given at a time; it takes more than their share of time for longer lines.
LINE = 200
#: Fixed value: the character that stands for a blank in pieces.
BLANK = "▁"


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u2").tobytes()


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _Words:
    """Encodes texts by their distinct words, each behind a blank."""

    #: Whether the first word of a text has no blank before it.
    headed = True

    def whole(self, text: str) -> bytes:
        """Ids of a text that cannot be taken apart."""
        raise NotImplementedError

    def apart(self, words: pa.Array) -> np.ndarray:
        """Which words have ids behind a blank that do not depend on the text around them."""
        raise NotImplementedError

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each behind a blank, and how many each has; none if it cannot be spelt."""
        raise NotImplementedError

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        out, begin, held = [], 0, 0
        for k, text in enumerate(texts):
            held += len(text)
            if held >= CHARACTERS or k + 1 == len(texts):
                out += self._some(texts[begin : k + 1])
                begin, held = k + 1, 0
        pa.default_memory_pool().release_unused()
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        numbered = lists.flatten().dictionary_encode()
        number, first = numbered.indices.to_numpy(), lists.offsets.to_numpy()
        apart = self.apart(numbered.dictionary)
        ids, sizes = self.encode_words(numbered.dictionary.filter(pa.array(apart)).to_pylist())
        # Numbers of 4 bytes: a batch has far fewer than 2^31 ids.
        size = np.zeros(len(apart), np.int32)
        size[apart] = sizes
        start = np.cumsum(size, dtype=np.int32) - size

        width, inner = size[number], np.ones(len(number), bool)
        if self.headed:
            width[first[:-1]], inner[first[:-1]] = 0, False
        # Every text has a word, if an empty one.
        some = lambda flag: np.add.reduceat((flag[number] & inner).astype(np.int32), first[:-1]) > 0
        entire, unspelt = some(~apart), some(apart & (size == 0))
        end = np.cumsum(width, dtype=np.int32)
        place = np.repeat(start[number] - end + width, width)
        place += np.arange(end[-1], dtype=np.int32)
        body = ids[place].tobytes()
        del place
        cut = 2 * np.append(0, end.astype(np.int64))[first]
        out = [body[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]
        for k in np.flatnonzero(unspelt):
            out[k] = b""
        for k in np.flatnonzero(entire):
            out[k] = self.whole(texts[k])
        return self.with_heads(texts, out, entire) if self.headed else out

    def with_heads(self, texts: list[str], out: list[bytes], entire: np.ndarray) -> list[bytes]:
        return out


def _sizes(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sizes of words one after another, each beginning where its id says."""
    return np.diff(np.append(np.flatnonzero(begins[ids]), len(ids)))


class ByteEncoder(_Words):
    """Byte-level BPE.

    The pattern never joins characters on both sides of a single blank between two other
    characters, so a text that begins with a blank is encoded word by word.  Texts with
    other white space beside a blank are encoded whole.  `special` are strings with an id of
    their own; they part a text.
    """

    def __init__(self, path: str, special: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        self.ranks = _ranks(path)
        self._encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens=special or {}
        )
        self.special = tuple(special or ())
        self._begins = np.array([s[:1] == b" " for s in self.spellings()])

    def apart(self, words: pa.Array) -> np.ndarray:
        return pc.and_(pc.equal(pc.utf8_trim_whitespace(words), words), pc.not_equal(words, "")).to_numpy(zero_copy_only=False)

    def whole(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return packed(self._encoding.encode(text, allowed_special="all"))
        return packed(self._encoding.encode_ordinary(text))

    def with_heads(self, texts: list[str], out: list[bytes], entire: np.ndarray) -> list[bytes]:
        for k, text in enumerate(texts):
            if text[:1] == " " and not self.special:
                continue
            head = text.partition(" ")[0]
            if head[-1:].isspace() or any(s in text for s in self.special):
                out[k] = self.whole(text)
            elif head and not entire[k]:
                out[k] = self.whole(head) + out[k]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self._encoding.encode_ordinary("".join(f" {w}" for w in words)), "<u2")
        sizes = _sizes(ids, self._begins)
        if len(sizes) != len(words):
            raise ValueError("words behind single blanks must begin with a blank's token")
        return ids, sizes

    def spellings(self) -> list[bytes]:
        """Bytes of each id, from 0 on."""
        out = [b""] * (max(self.ranks.values()) + 1)
        for spelling, k in self.ranks.items():
            out[k] = spelling
        return out


class PieceEncoder(_Words):
    """BPE pieces with byte fallback, after a blank that the tokenizer adds.

    No piece holds the mark of a blank behind another character, so nothing is joined across
    a single blank and a text is encoded word by word.  Other texts are encoded whole.  A
    text whose pieces do not spell it out has no ids.
    """

    headed = False

    def __init__(self, path: str):
        import sentencepiece

        self._pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._pieces.id_to_piece(k) for k in range(len(self._pieces))]
        self._apart = not any(BLANK in name.lstrip(BLANK) for name in names)
        self._begins = np.array([name[:1] == BLANK for name in names])
        self._spellings = [
            bytes([int(name[3:5], 16)]) if self._pieces.is_byte(k) else name.replace(BLANK, " ").encode()
            for k, name in enumerate(names)
        ]

    def spellings(self) -> list[bytes]:
        return self._spellings

    def apart(self, words: pa.Array) -> np.ndarray:
        return pc.not_equal(words, "").to_numpy(zero_copy_only=False) & self._apart

    def _spell(self, ids: list[int], text: str) -> bool:
        """Whether ids spell a blank and the text."""
        return b"".join(map(self._spellings.__getitem__, ids)) == b" " + text.encode("utf-8", "surrogatepass")

    def whole(self, text: str) -> bytes:
        ids = self._pieces.encode(text)
        return packed(ids) if self._spell(ids, text) else b""

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), LINE):
            line = words[k : k + LINE]
            text = " ".join(line)
            found = self._pieces.encode(text)
            flat = np.array(found, "<u2")
            size = _sizes(flat, self._begins)
            if len(size) != len(line) or not self._spell(found, text):
                each = [np.frombuffer(self.whole(w), "<u2") for w in line]
                flat, size = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(line))
            ids.append(flat)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)


@lru_cache(1)
def byte_encoder(path: str, special: tuple[tuple[str, int], ...] = ()) -> ByteEncoder:
    """One for each Python worker, whose tasks share what it remembers."""
    return ByteEncoder(path, dict(special))


@lru_cache(1)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def added_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """Strings that a tokenizer's JSON file gives an id of their own."""
    with open(path, encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])


def lengths(spellings: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, spellings), np.int64, len(spellings))
