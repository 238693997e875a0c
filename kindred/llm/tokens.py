"""Token ids by a public tokenizer, with a bounded cache of words.

The tokenizer never joins characters across white space, so a text's ids are the ids of
its space-separated words one after another. Words repeat; each worker encodes a word
once and keeps its ids as bytes. Case is folded before the look-up (the tokenizer folds it
too), and ASCII signs after a letter or digit are looked up on their own. Where a vocabulary
marks the ends of words, words of letters are encoded many to a text and told apart by these.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
from array import array
from contextlib import contextmanager

import numpy as np

END_ID = 1
CACHE_WORDS = 1_000_000  # words a worker keeps before it starts afresh

# Not the apostrophe, which begins a token of its own with some letters.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# U+00C0 to U+024F but the signs of product and division and the dotted I, in UTF-8.
_LATIN = re.compile(rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f]")
_JOINED = 500  # words of letters that are encoded as one text
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


@contextmanager
def _uncollected():
    """No search for cycles while many encodings, which have none, are made."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, end id included."""

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.end = np.array([end_id], "<u4").tobytes()
        self.cache_words = cache_words
        self.words: dict[bytes, bytes] = {}
        self.ends = self._ends()

    def _ends(self) -> np.ndarray | None:
        """For every id whether it ends a word, if the vocabulary marks that."""
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        if not suffix:
            return None
        known = self.tokenizer.get_vocab()
        ends = np.zeros(max(known.values()) + 1, bool)
        ends[[i for token, i in known.items() if token.endswith(suffix)]] = True
        return ends

    def _encode(self, words: list[bytes]) -> None:
        """Words one by one."""
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, encoding in zip(words, found):
            ids = array("I", encoding.ids)
            self.words[word] = (ids if _NATIVE else np.array(ids, "<u4")).tobytes()

    def _encode_joined(self, words: list[bytes]) -> list[bytes]:
        """Words of letters, many to a text. Each gives one end of a word at least, so if there are
        as many ends as words, each has one. Returns the words of texts where this is not so."""
        left, known = [], self.words
        groups = [words[at : at + _JOINED] for at in range(0, len(words), _JOINED)]
        found = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.array(array("I", encoding.ids), "<u4")
            after = np.flatnonzero(self.ends[ids]) + 1
            if len(after) != len(group) or after[-1] != len(ids):
                left += group
                continue
            data, start = ids.tobytes(), 0
            for word, end in zip(group, (4 * after).tolist()):
                known[word] = data[start:end]
                start = end
        return left

    def _learn(self, missing: set[bytes]) -> None:
        cores = {}
        for word in missing:
            core = word.rstrip(_SIGNS)
            # After a sign the others would be one token with it, and '<|' may begin a special
            # token, so only what follows a letter or an ASCII digit is split off. Letters beyond
            # ASCII are Latin ones that composing and folding leave letters.
            if len(core) != len(word) and b"<|" not in word:
                if core[-1:].isalnum() or _LATIN.search(core[-2:]):
                    cores[word] = core
        parts = missing.difference(cores)
        parts.update(cores.values(), {word[len(core) :] for word, core in cores.items()})
        parts -= self.words.keys()
        single = list(parts)
        if self.ends is not None:
            letters = [part for part in single if part.decode().isalpha()]
            single = list(parts.difference(letters)) + self._encode_joined(letters)
        self._encode(single)
        known = self.words
        for word, core in cores.items():
            known[word] = known[core] + known[word[len(core) :]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, given in UTF-8, followed by the end id."""
        if len(self.words) > self.cache_words:
            self.words.clear()
        # Special tokens are found before case is folded.
        split = [(raw if b"<|" in raw else raw.lower()).split() for raw in texts]
        known = self.words
        missing = set().union(*split) - known.keys()
        if missing:
            with _uncollected():
                self._learn(missing)
        return [b"".join(map(known.__getitem__, words)) + self.end for words in split]


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, end_id: int = END_ID) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
