"""Encoding whole texts with a public tokenizer, word by word from a bounded memory."""

from __future__ import annotations

import functools
import json
import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .arrowtext import utf8

# U+180E counts as white space in some tables only.
_RUN = re.compile("[\\s\\u180e]{2}")


def _ends_in_letter(word: str) -> bool:
    """Whether the last character is a Latin letter that stays one letter in lower case."""
    last = word[-1:]
    return last.isalpha() and last < "\u0250" and len(last.lower()) == 1


def _is_latin(word: str) -> bool:
    """Whether a word is Latin letters that are composed and stay one letter in lower case."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0180" and "\u0130" not in word)


def _byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Without the line end, which parts words here.
_LETTERS = {b: c for b, c in _byte_letters().items() if b != 0x0A}


def _with_runs(texts: list[str]) -> list[int]:
    """The numbers of the texts with a run of white space."""
    data, at = utf8(pa.array(texts, pa.string()))
    white = (data == 0x20) | ((data >= 9) & (data <= 13)) | ((data >= 0x1C) & (data <= 0x1F))
    run = np.zeros(len(data), bool)
    run[1:] = white[1:] & white[:-1]
    run[at[:-1][at[:-1] < len(data)]] = False       # white space of the text before
    # First bytes that white space beyond ASCII may have: those texts are searched.
    wide = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
    runs, wides = (np.diff(np.concatenate([[0], np.cumsum(x)])[at]) for x in (run, wide))
    return [i for i, (sure, search) in enumerate(zip(runs.tolist(), wides.tolist()))
            if sure or search and _RUN.search(texts[i])]


def _words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The parts of the texts between spaces, back to back, and where each text's begin (n + 1)."""
    parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
    return parts.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(
        zero_copy_only=False))]).astype(np.int64)


class WordEncoder:
    """Gives for each text the ids that ``tokenizers`` gives for it, as little-endian unsigned
    32-bit numbers.

    Both public vocabularies split a text at a space between two words before they merge
    anything, so a text's ids are those of its words back to back. Each distinct word
    is encoded once and remembered, and texts are gathered from the ids of theirs by numpy; beyond half of ``keep`` words the memory starts anew
    and takes over from the one before what is met again.
    """

    def __init__(self, path: str, keep: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.spaces_count = described["pre_tokenizer"]["type"] == "ByteLevel"
        # Added tokens are matched before letters are lowered, so texts with "<|" stay as they are.
        self.lower_case = "Lowercase" in json.dumps(described["normalizer"])
        self.keep, self.first, self.later = keep, {}, {}
        self.older = {}     # what each memory held before it started anew
        self.unmerged = {x.content for x in self.tokenizer.get_added_tokens_decoder().values()}
        self.line_end = self._library(["\n"])[0]
        # Signs that are no part of "'s" and end no added token.
        self.marks = "".join(set(string.punctuation) - {"'"} - {x[-1:] for x in self.unmerged})
        self.signs = {}     # ids of runs of signs

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _merged(self, words: list[str], mark: str) -> list[bytes]:
        """Ids of words of Latin letters, which need no more than the vocabulary's merges."""
        merge = self.tokenizer.model.tokenize
        shown = "\n".join(words).encode().decode("latin-1").translate(_LETTERS).split("\n")
        return [array("I", [x.id for x in merge(mark + w)]).tobytes() for w in shown[:len(words)]]

    def _stem(self, word: str) -> str:
        """The word without the signs after its last letter if that is Latin: both vocabularies
        split them off. Else the whole word."""
        stem = word.rstrip(self.marks)
        return stem if len(stem) < len(word) and _ends_in_letter(stem) else word

    def _learn(self, known: dict, words: set, before: str) -> None:
        older, new = self.older.get(before, {}), words.difference(known)
        kept = new.intersection(older)
        known.update((w, older[w]) for w in kept)
        new -= kept
        # Words with one line end between them: the words, and the line end's own ids.
        lines = {w: w.split("\n") for w in new if "\n" in w}
        lines = {w: p for w, p in lines.items() if all(p) and all(x == x.strip() for x in p)
                 and len(w.split()) == len(p)}
        new.difference_update(lines)
        new.update(x for p in lines.values() for x in p if x not in known)
        stems = {w: self._stem(w) for w in new}
        ask = {s for s in stems.values() if s not in known}
        plain = [w for w in ask if _is_latin(w) and w not in self.unmerged]
        if self.spaces_count:
            known.update(zip(plain, self._merged(plain, "\u0120" if before else "")))
        else:
            known.update(zip(plain, self._merged([w.lower() for w in plain], "")))
        ask = list(ask.difference(plain))
        known.update(zip(ask, self._library([before + w for w in ask])))
        signed = {w: (s, w[len(s):]) for w, s in stems.items() if len(s) < len(w)}
        if len(self.signs) > self.keep // 2:
            self.signs = {}
        runs = list({run for _, run in signed.values()}.difference(self.signs))
        self.signs.update(zip(runs, self._library(runs)))
        known.update((w, known[s] + self.signs[run]) for w, (s, run) in signed.items())
        for w, parts in lines.items():
            known[w] = known[parts[0]] + b"".join(self.line_end + known[p] for p in parts[1:])

    @staticmethod
    def _looked_up(known: dict, different: list[str], index: np.ndarray, at: np.ndarray
                   ) -> list[bytes]:
        """The ids of texts whose words are ``different[index]``, text by text from ``at``."""
        found = [known[w] for w in different]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(found), "<u4")
        many = size[index]
        end = np.cumsum(many)
        ids = ids[np.repeat(first[index] - (end - many), many) + np.arange(end[-1] if len(end) else 0)]
        cut = np.concatenate([[0], end])[at].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.later) > self.keep // 2:
            # Words still in use are taken over from the memory before.
            self.older = {" ": self.later, "": self.first} if self.spaces_count else {
                "": self.later}
            self.first, self.later = {}, {}
        if self.spaces_count:
            return self._encode_spaced(texts)
        if self.lower_case:
            texts = [t.lower() if t.isascii() and "<|" not in t else t for t in texts]
        words, at = _words(texts)
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(self.later, set(different), "")
        return self._looked_up(self.later, different, coded.indices.to_numpy(), at)

    def _encode_spaced(self, texts: list[str]) -> list[bytes]:
        """For a vocabulary in which a space belongs to the word behind it, and a line end between
        two visible characters is a token of its own. Texts with a run of white space go to the
        library whole, as what a run becomes depends on what follows."""
        whole = _with_runs(texts)
        out = [b""] * len(texts)
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        rest = sorted(set(range(len(texts))).difference(whole))
        words, at = _words([texts[i].replace("\n", " \n") for i in rest])
        heads = words.take(pa.array(at[:-1])).to_pylist()
        inner = np.ones(len(words), bool)
        inner[at[:-1]] = False
        coded = words.filter(pa.array(inner)).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # A word that starts with a line end has no space before it.
        lines = [w for w in different if w[:1] == "\n" and w not in self.later]
        self._learn(self.first, set(heads).union(w[1:] for w in lines), "")
        self._learn(self.later, set(different).difference(lines), " ")
        self.later.update((w, self.line_end + self.first[w[1:]]) for w in lines)
        behind = self._looked_up(self.later, different, coded.indices.to_numpy(),
                                 at - np.arange(len(at)))
        for i, head, ids in zip(rest, heads, behind):
            out[i] = self.first[head] + ids
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per vocabulary and Python worker."""
    return WordEncoder(path)
