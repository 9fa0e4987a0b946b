"""Token ids from the tokenizers library, one encoding per distinct word.

The tokenizers used here split a text at white space before they merge, and the
ids of a word depend on that word alone. A worker lets the library encode each
distinct word (what stands between spaces or line ends) once and joins the ids.
Texts with white space that could be split otherwise are encoded whole.
"""

from __future__ import annotations

import functools
import json
import os
from array import array

WIDTH = {"<u2": "H", "<u4": "I"}
LONGEST = 64


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """word -> ids as bytes. Of two generations the older goes when the younger is full;
    words of more than LONGEST characters are not kept, so its bytes are bounded."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


PUNCTUATION = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
#: Byte-level vocabularies write bytes that are no printable characters as further letters.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
REST = [b for b in range(256) if b not in PRINTABLE]
LETTER = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(REST)}
LATIN = str.maketrans({chr(c): "".join(LETTER[b] for b in chr(c).encode()) for c in range(0x80, 0x250)})


class Encoder:
    """encode(text): the ids of the library's encode(text, add_special_tokens=False), as bytes.

    A word of Latin letters and closing punctuation is two words to both tokenizers;
    the library's merge model takes its letters directly.
    """

    def __init__(self, path: str, dtype: str, memo_words: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.code = Tokenizer.from_file(path), WIDTH[dtype]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["type"]
        normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.lower = False
        if split == "ByteLevel" and not spec.get("normalizer") and not spec["pre_tokenizer"]["add_prefix_space"]:
            self.encode = self.spaced  # a word's ids hold the space before it
        elif split == "Sequence" and normal == ["NFC", "Replace", "Lowercase"]:
            self.encode, self.lower = self.dropped, True  # white space has no ids
        else:
            self.encode = self.whole
        self.merge = self.tokenizer.model.tokenize
        self.word = Memo(lambda w: self.split(w, self.word, "", w) if w else b"", memo_words)
        self.tail = Memo(self.after_space, memo_words)

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def split(self, word: str, memo: Memo, before: str, text: str) -> bytes:
        """Ids of `text`, which is `word` with the space before it if its ids hold one."""
        core = word.rstrip(PUNCTUATION)
        if not core.isalpha() or not core.isascii() and (max(core) >= "\u0250" or self.lower and "\u0130" in core):
            return self.whole(text)
        if len(core) < len(word):
            return memo[core] + self.word[word[len(core) :]]
        if self.lower and (small := core.lower()) != core:
            return memo[small]
        return array(self.code, [t.id for t in self.merge(before + core.translate(LATIN))]).tobytes()

    def after_space(self, word: str) -> bytes:
        if word[0] == "\n":
            return self.word["\n"] + self.word[word[1:]]
        return self.split(word, self.tail, LETTER[32], f" {word}")

    def dropped(self, text: str) -> bytes:
        return b"".join(map(self.word.__getitem__, text.replace("\n", " ").split(" ")))

    def spaced(self, text: str) -> bytes:
        words = text.replace("\n", " \n").split(" ")
        single = text.split()
        # each word is followed by exactly one space or line end, and the last by none
        if len(single) != len(words) or sum(map(len, single)) + len(words) - 1 != len(text):
            return self.whole(text)
        return self.word[words[0]] + b"".join(map(self.tail.__getitem__, words[1:]))


@functools.lru_cache(maxsize=2)
def encoder(path: str, dtype: str, memo_words: int = 400_000) -> Encoder:
    """The encoder of this worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, dtype, memo_words)


@functools.cache
def id_type(path: str) -> str:
    """The narrowest little-endian unsigned type for a vocabulary's ids."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
