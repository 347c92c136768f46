"""Token ids of texts with a public tokenizer, word by word from a cache.

Byte-level BPE never merges across the break before a blank that follows a
non-blank, so a text's ids are those of its words in order. Words repeat, so
a task encodes each distinct word once and looks the others up.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np

#: Words kept per worker process, about 130 MB. A full cache is emptied, which changes speed only.
CACHE_WORDS = 600_000
#: Longer words are not cached.
CACHE_CHARS = 64
#: New words that begin with a blank are encoded as one text of this many.
WORDS_AT_ONCE = 256

# Letters and digits before white space or common punctuation end a unit of
# their own; anything else goes up to the next white space.
_WORDS = re.compile(
    r"[ \t-\r]*[0-9A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ \t-\r.,;:!?*$%&#]|\Z)|[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"
)
# White space beyond the ASCII one takes part in the tokenizer's own splitting.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")


# A blank, as byte-level vocabularies write it.
_BLANK = "\u0120"


class Encoder:
    """Encodes whole texts with the ``tokenizers`` file at ``path``."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        # Ids of tokens with a blank in front; only a word's first token can be one.
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[n for token, n in vocabulary.items() if token.startswith(_BLANK)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words of one text are told apart by the blanks they begin with."""
        found: list[bytes] = []
        for low in range(0, len(words), WORDS_AT_ONCE):
            some = words[low : low + WORDS_AT_ONCE]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            at = np.flatnonzero(self.begins[ids]) * 4
            if len(at) != len(some) or at[0]:
                found += self._encode(some)
                continue
            content, at = ids.tobytes(), at.tolist()
            found += map(content.__getitem__, map(slice, at, [*at[1:], len(content)]))
        return found

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; none for a null text."""
        cache = self.words
        if len(cache) > CACHE_WORDS:
            cache.clear()
        split = [_WORDS.findall(t) if t and not _OTHER_SPACE.search(t) else None for t in texts]
        new = list(set().union(*(w for w in split if w)).difference(cache))
        plain = [w for w in new if w[0] == " " and not w[1:2].isspace() and len(w) > 1]
        other = list(set(new).difference(plain))
        cache.update(zip(plain, self._encode_words(plain)))
        cache.update(zip(other, self._encode(other)))
        ids = [b"".join(map(cache.__getitem__, w)) if w else b"" for w in split]
        for k, (text, words) in enumerate(zip(texts, split)):
            if text and words is None:
                ids[k] = self._encode([text])[0]
        for word in new:
            if len(word) > CACHE_CHARS:
                del cache[word]
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of one text."""
        return self.encode_many([text])[0]

    def encode_batch(self, texts: Iterable[str | None], step: int = 64) -> Iterator[bytes]:
        """As ``encode_many``, in steps, so that only some texts are held in words."""
        texts = iter(texts)
        while some := list(islice(texts, step)):
            yield from self.encode_many(some)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
