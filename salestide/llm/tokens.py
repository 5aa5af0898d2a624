"""Token ids of texts by a public byte-level BPE vocabulary, with a cache of words.

Between a word and a following single space the pattern of this vocabulary always splits, so a text whose
white space is single spaces and line feeds can be put together from the ids of its words. Texts with other
runs of white space are encoded whole. Texts that spell a token which the tokenizer's file adds to the vocabulary are
encoded by the tokenizer itself.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache
from itertools import islice

import numpy as np

# Words that a worker keeps, some 200 bytes each for as long as it lives; beyond, it goes on with those it met first, which are the
# common ones.
CACHED_WORDS = 250_000
KEPT_WORDS = 100_000
_SPACE = " "


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, ranks_path: str, pattern: str, tokenizer_path: str | None = None) -> None:
        import tiktoken

        self._tokenizer_path, self._tokenizer = tokenizer_path, None
        #: Strings of the tokens that the ranks do not have.
        self._added: tuple[str, ...] = ()
        if tokenizer_path:
            with open(tokenizer_path, encoding="utf-8") as file:
                self._added = tuple(token["content"] for token in json.load(file)["added_tokens"])

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._words: dict[str, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), "<u4").tobytes()

    def _by_tokenizer(self, text: str) -> bytes:
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self._tokenizer_path)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        for word in words:
            if len(self._words) >= CACHED_WORDS:
                self._words = dict(islice(self._words.items(), KEPT_WORDS))
            bare = word[1:] if word.startswith("\n") else word
            if not bare or bare != bare.strip():  # a run of white space: not the sum of its parts
                self._words[word] = None
            else:
                self._words[word] = self._whole(word if word.startswith("\n") else _SPACE + word)

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, without any end token, as bytes."""
        if any(token in text for token in self._added):
            return self._by_tokenizer(text)
        first, *rest = text.replace("\n", " \n").split(_SPACE)
        if not rest or not first or first != first.strip():
            return self._whole(text)
        words = self._words
        try:
            return self._whole(first) + b"".join(map(words.__getitem__, rest))
        except KeyError:
            self._learn(set(rest).difference(words))
        except TypeError:
            return self._whole(text)
        try:
            return self._whole(first) + b"".join(map(self._words.__getitem__, rest))
        except (KeyError, TypeError):  # a run of white space, or more words than the cache holds
            return self._whole(text)


@lru_cache(maxsize=1)
def encoder(vocabulary: str | None = None) -> WordEncoder:
    """The worker's encoder. ``vocabulary`` is the path of a tokenizer's file, the public byte-level one if not given.

    Its ranks lie beside it, in a file of the same name.
    """
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    return WordEncoder(f"{os.path.splitext(path)[0]}.tiktoken", public_tokenizers.PATTERN, path)
