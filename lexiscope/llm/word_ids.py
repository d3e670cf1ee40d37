"""Whole texts to the ids of a lower-casing BPE vocabulary with word ends, words encoded once.

Its pre-tokenizer never joins what a space or line end parts, and parts a run of letters from the
punctuation after it, so the ids of a text are those of its words in a row, and a word's those of its
letters and of its tail. A run of letters is a piece already, so only its merges are asked for.
"""

from __future__ import annotations

import functools
import os
from itertools import chain

import numpy as np

from lexiscope.llm.token_ids import byte_letters
from lexiscope.llm.word_table import WordTable, spread

#: Characters after a word's letters that are one piece together.
TAIL = ".,;:!?)]}#"
#: Words of a generation of the table.
WORDS = 400_000


class WordEncoder:
    def __init__(self, path: str, words: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.type = np.dtype("<u2" if max(vocab.values()) < 2**16 else "<u4")
        self.letters = byte_letters()
        self.marks = tuple({t.content[:2] for t in self.tok.get_added_tokens_decoder().values()})
        self.tails: dict[str, list[int]] = {}
        self.table = WordTable(self._learn, "H" if self.type.itemsize == 2 else "I", words)

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        core = word.rstrip(TAIL)
        if not core.isalpha() or not (core.isascii() or (max(core) < "ɐ" and "İ" not in core)):
            return self.ids(word)
        low = core.lower()  # a character for a character in this range, as the vocabulary has it
        spelt = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tok.model.tokenize(spelt)]
        if tail := word[len(core) :]:
            if tail not in self.tails:
                if len(self.tails) > 10_000:
                    self.tails.clear()
                self.tails[tail] = self.ids(tail)
            ids += self.tails[tail]
        return ids

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self._word, words))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.type, int(sizes.sum())), sizes

    def _words(self, text: str) -> list[str]:
        if not any(m in text for m in self.marks):
            try:
                text.encode("latin-1")
                text = text.lower()  # fewer words to learn
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._words(t) for t in texts]
        starts, sizes = self.table.look_up([w for s in split for w in s])
        if (odd := np.flatnonzero(sizes < 0)).size:  # a word of over a million ids
            return [np.array(self.ids(t), self.type) for t in texts] if len(texts) == 1 else [self.encode([t])[0] for t in texts]
        ids = self.table.pool()[spread(starts, sizes)]
        at = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, split)])]
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


@functools.cache
def shared_encoder(path: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(path)
