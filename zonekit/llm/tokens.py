"""Token ids of whole texts by a ``tokenizers`` file, word by word with a cache (Python workers).

The vocabulary splits at white space, so a text's ids are its words' ids in
order.  Each distinct word is encoded once per worker; words of a block are
then looked up and their ids gathered in array passes.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain, repeat

import numpy as np
from public_tokenizers import path as vocabulary_path
from tokenizers import Tokenizer

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Distinct words kept by a worker before it starts afresh; bounds its memory only.
CACHED_WORDS = 1_000_000

# The letters a-z and the small Latin-1 letters, as UTF-8, and ASCII marks after them
# (an apostrophe can belong to the letters after it, and is left to the tokenizer).
_LETTERS_THEN_MARKS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies show a byte: printable ones as themselves, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _byte_letters()


class WordTokenizer:
    def __init__(self, vocabulary: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.size = self._tokenizer.get_vocab_size()
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self._specials = tuple(t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values())
        self._end = end_id
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        # entry 0 is the end of a text; each entry is a run of ids in one growing array
        self._ids, self._held = np.full(1 << 16, self._end, dtype=self.kind), 1
        self._first, self._lengths = np.zeros(1 << 16, dtype=np.int64), np.ones(1 << 16, dtype=np.int64)

    def _add(self, words: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        at, end = len(self._known) + 1, self._held + len(ids)
        while end > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while at + len(words) > len(self._first):
            self._first = np.concatenate([self._first, np.empty_like(self._first)])
            self._lengths = np.concatenate([self._lengths, np.empty_like(self._lengths)])
        self._ids[self._held : end] = ids
        self._lengths[at : at + len(words)] = lengths
        self._first[at : at + len(words)] = self._held + np.cumsum(lengths) - lengths
        self._held = end
        self._known.update(zip(words, range(at, at + len(words)), strict=True))

    def _learn(self, new: list[bytes]) -> None:
        """Learn words that are not of small letters alone: through the whole tokenizer."""
        for lo in range(0, len(new), 4000):
            part = new[lo : lo + 4000]
            texts = [w.decode() for w in part]
            begins = np.cumsum([0] + [len(w) + 1 for w in texts[:-1]])
            got = self._tokenizer.encode(" ".join(texts), add_special_tokens=False)
            places = np.fromiter((a for a, _ in got.offsets), dtype=np.int64, count=len(got))
            which = np.searchsorted(begins, places, side="right") - 1
            self._add(part, np.bincount(which, minlength=len(part)).astype(np.int64), np.array(got.ids, dtype=self.kind))

    def _learn_letters(self, new: list[bytes]) -> None:
        """Learn words of small letters: one piece each, so they go to the vocabulary's model directly."""
        model, ids, lengths = self._tokenizer.model.tokenize, array(self.kind().dtype.char), []
        for word in new:
            shown = word.decode("ascii") if word.isascii() else word.decode("latin-1").translate(_SHOWN)
            before = len(ids)
            ids.extend([t.id for t in model(shown)])
            lengths.append(len(ids) - before)
        self._add(new, np.array(lengths, dtype=np.int64), np.frombuffer(ids, dtype=self.kind))

    def _learn_all(self, new: set[bytes]) -> None:
        """Learn ``new``.

        The vocabulary parts letters from the marks after them, so letters
        followed by marks have the ids of both.
        """
        known = self._known
        letters = {w for w in new if w.isalpha() and w.islower()}
        rest = new.difference(letters)
        parted = {w: m.groups() for w in rest if (m := _LETTERS_THEN_MARKS(w))}
        other = rest.difference(parted)
        for stem, marks in parted.values():
            letters.add(stem)
            if marks:
                other.add(marks)
        self._learn_letters([w for w in letters if w not in known])
        self._learn([w for w in other if w not in known])
        marked = [(w, *pair) for w, pair in parted.items() if pair[1]]
        if marked:
            both = np.array([(known[stem], known[marks]) for _, stem, marks in marked], dtype=np.int64)
            lengths = self._lengths[both].sum(axis=1)
            self._add([w for w, _, _ in marked], lengths, self._gather(both.ravel()))

    def _gather(self, which: np.ndarray) -> np.ndarray:
        sizes = self._lengths[which]
        ends = np.cumsum(sizes)
        places = np.repeat(self._first[which] - (ends - sizes), sizes)
        places += np.arange(len(places))
        return self._ids[places]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); every text ends with the end id."""
        if len(self._known) > CACHED_WORDS:
            self._forget()
        # case does not matter to the vocabulary, save for its own special strings
        split = [(t if b"<" in t and any(s in t.lower() for s in self._specials) else t.lower()).split() for t in texts]
        words = list(chain.from_iterable(split))
        found = np.fromiter(map(self._known.get, words, repeat(0)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(found == 0).tolist()
        if missing:
            self._learn_all({words[i] for i in missing})
            found[missing] = np.fromiter((self._known[words[i]] for i in missing), dtype=np.int64, count=len(missing))
        n_words = np.array([len(text) + 1 for text in split], dtype=np.int64)
        last = np.cumsum(n_words) - 1
        which = np.zeros(len(words) + len(texts), dtype=np.int64)
        plain = np.ones(len(which), dtype=bool)
        plain[last] = False
        which[plain] = found
        totals = np.cumsum(self._lengths[which])[last] if len(last) else last
        return self._gather(which), np.diff(totals, prepend=0)


_LOADED: dict[tuple[str, int], WordTokenizer] = {}


def tokenizer(vocabulary: str, end_id: int) -> WordTokenizer:
    """One tokenizer per worker process."""
    if (vocabulary, end_id) not in _LOADED:
        _LOADED[vocabulary, end_id] = WordTokenizer(vocabulary, end_id)
    return _LOADED[vocabulary, end_id]
