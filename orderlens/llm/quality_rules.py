"""Quality rules of texts: repetition and symbols, and how well a public vocabulary fits them.

A tokenizer's fertility tells prose from junk: characters per token, the share of tokens that are
single bytes because the vocabulary lacks the character, and the entropy of the tokens. Texts
outside the band of their script are rejected.
"""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrowtext import documents, slices, utf8

#: Fewer tokens say too little for a verdict.
LEAST_TOKENS = 40


@dataclass(frozen=True)
class Band:
    """Limits for texts of one script: characters of words per token (low, high), largest share
    of byte tokens, smallest entropy of the tokens in bits, relative to that of as many tokens
    of a text without repeats."""
    low: float
    high: float
    bytes: float
    entropy: float


#: Scripts in the order in which a tie is settled. Letters outside them count as "other".
SCRIPTS = {"latin": (0x41, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F),
           "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x6FF), "indic": (0x900, 0xDFF),
           "thai": (0xE00, 0xE7F), "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF),
           "hangul": (0xAC00, 0xD7AF)}
BANDS = {"latin": Band(1.25, 8.0, 0.10, 0.35), "greek": Band(0.7, 5.0, 0.20, 0.30),
         "cyrillic": Band(1.0, 6.0, 0.10, 0.30), "hebrew": Band(0.6, 4.0, 0.30, 0.25),
         "arabic": Band(0.6, 4.0, 0.30, 0.25), "indic": Band(0.3, 4.0, 0.90, 0.20),
         "thai": Band(0.3, 4.0, 0.90, 0.20), "kana": Band(0.3, 4.0, 0.90, 0.25),
         "han": Band(0.3, 4.0, 0.90, 0.25), "hangul": Band(0.3, 4.0, 0.90, 0.25),
         "other": Band(0.2, 8.0, 1.00, 0.20)}
NAMES = [*SCRIPTS, "other"]
#: Rejected from this share of symbol characters on.
MOST_SYMBOLS = 0.10

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_IS_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MEMORY = 400_000


class Fertility:
    """Counts tokens of texts with a sentencepiece vocabulary, word by word from a bounded memory.

    A word is encoded by itself, as the vocabulary's pieces begin at white space; its ids are
    remembered as 16-bit numbers."""

    def __init__(self, vocabulary: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        size = self.model.get_piece_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) > _MEMORY:
            self.known.clear()
            new = list(words)
        ids = self.model.encode(new, num_threads=1)
        code = "H" if self.kind is np.uint16 else "I"
        self.known.update(zip(new, [array(code, x).tobytes() for x in ids]))

    def of(self, words: list[str]) -> tuple[int, int, float]:
        """Number of tokens, of byte tokens, and entropy of the tokens in bits."""
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), self.kind)
        total = len(ids)
        if not total:
            return 0, 0, 0.0
        ordered = np.sort(ids)
        ends = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        counts = np.diff(np.concatenate([[0], ends, [total]]))
        entropy = math.log2(total) - float(counts @ np.log2(counts)) / total
        return total, int(self.is_byte[ids].sum()), max(entropy, 0.0)


@functools.lru_cache(maxsize=2)
def _fertility(vocabulary: str) -> Fertility:
    return Fertility(vocabulary)


@functools.lru_cache(maxsize=1)
def _script_table() -> np.ndarray:
    """Script of each code point: its place in :data:`NAMES`; letters of no listed script count
    as the last one, and what is no letter as one beyond."""
    table = np.full(0x110000, len(NAMES), np.uint8)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            table[cp] = len(NAMES) - 1
    for place, (low, high) in enumerate(SCRIPTS.values()):
        part = table[low:high + 1]
        part[part == len(NAMES) - 1] = place
    return table


def scripts_of(texts: list[str]) -> list[str]:
    """The script of most letters of each text; "other" if it has none."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    counts = np.bincount(owner * (len(NAMES) + 1) + _script_table()[flat],
                         minlength=len(texts) * (len(NAMES) + 1))
    counts = counts.reshape(len(texts), -1)[:, :-1]
    best = np.where(counts.any(axis=1), counts.argmax(axis=1), len(NAMES) - 1)
    return [NAMES[k] for k in best.tolist()]


def symbols_of(column: pa.Array) -> list[int]:
    """Symbol characters of each text. All are single bytes of UTF-8."""
    data, offsets = utf8(column)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_IS_SYMBOL[data], out=sums[1:])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).tolist()


def repeated_words(words: list[str], size: int = 5) -> int:
    """Words in windows of ``size`` words that occur twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(size))))
    distinct = set(windows)
    if len(distinct) == len(windows):
        return 0
    counts = Counter(windows)
    end = covered = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def duplicate_lines(text: str) -> int:
    """Lines (between line feeds) with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    worded = [line for line in lines if _WORDS.search(line)]
    return len(worded) - len(set(worded))


def _measure(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    fertility = _fertility(vocabulary)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "script", "n_tokens", "chars_per_token", "byte_share",
             "token_entropy"]
    for part in slices(batches):
        texts = part.column("text").to_pylist()
        split = [_WORDS.findall(t) for t in texts]
        fertility.learn(set().union(*split))
        rows = []
        for doc_id, text, words, script, symbols in zip(
                part.column("doc_id").to_pylist(), texts, split, scripts_of(texts),
                symbols_of(part.column("text"))):
            n, chars = len(words), sum(map(len, words))
            again = repeated_words(words)
            failed = n < 10 or 100 * again > 20 * n
            tokens, raw, entropy = fertility.of(words)
            per_token, share = chars / max(tokens, 1), raw / max(tokens, 1)
            fits = tokens < LEAST_TOKENS or (
                (b := BANDS[script]).low <= per_token <= b.high and share <= b.bytes
                and entropy >= b.entropy * math.log2(min(tokens, 4096)))
            rows.append((doc_id, n, chars, symbols, duplicate_lines(text), again, failed,
                         not failed and fits and symbols <= MOST_SYMBOLS * chars, script, tokens,
                         per_token, share, entropy))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)], names)


_KINDS = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string(), pa.int64()] + [pa.float64()] * 3


def quality_verdicts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: counts of words, their characters, symbols, repeated lines and
    repeated words; base_failed (under 10 words, or more than a fifth of them repeated); script,
    n_tokens, chars_per_token, byte_share, token_entropy; and kept.

    A document is kept if it didn't fail the base rules, at most a tenth of as many symbols as
    word characters, and its fertility lies in its script's band (:data:`BANDS`); texts of fewer
    than :data:`LEAST_TOKENS` tokens aren't judged by that. Null and empty texts have no words and
    fail. Rows are judged one by one, so ties and repeated rows are no case of their own; empty
    input gives no rows; other columns are ignored.
    """
    return documents(docs).mapInArrow(
        lambda it: _measure(it, vocabulary),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, script string, n_tokens long, "
        "chars_per_token double, byte_share double, token_entropy double")
