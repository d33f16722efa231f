"""Languages of texts as mixtures: shares by expectation-maximisation, the set by penalised likelihood.

Training counts letter n-grams of each language over all labelled texts. A text's n-grams are then
taken as draws from a mixture of the languages; expectation-maximisation finds the shares that make
them likeliest. Of the sets of languages, the one with the best likelihood less a penalty for each
language is grown one by one; mostly, the mixture of all languages shows at once that no second
one can pay for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import SLICE_BYTES, documents, mix, slices

#: n-grams of this many bytes of letters, counted in so many hashed cells.
NGRAM, CELLS = 3, 1 << 16
#: n-grams of the background that smooth each language's counts.
PRIOR = 2_000.0
#: Cost of a language more, in units of log(number of n-grams). An n-gram shares its bytes with the
#: two before it, so three of them tell about as much as one draw does.
PENALTY = 3 * NGRAM
ROUNDS = 30
#: Languages a task counts before it hands its counts on.
HELD_LANGUAGES = 64
UNKNOWN = "und"
_GAP = 0x20
_LETTERS = np.zeros(256, bool)
_LETTERS[0x61:0x7B] = True
_LETTERS[0x80:] = True


@dataclass(frozen=True)
class LanguageModel:
    """Languages in code point order, and log-probabilities of the n-gram cells of each
    (cells x languages). Its size is bounded by the cells times the number of languages."""
    names: tuple[str, ...]
    logs: np.ndarray


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts as bytes back to back, each run of other characters one
    gap, with a gap before each text and one at the end; and where each text starts."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    letter = _LETTERS[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]     # the first of a run of other characters
    keep[starts[:-1]] = True    # the gap before each text
    keep[starts[:-1] + 1] &= letter[starts[:-1] + 1]
    place = np.cumsum(keep) - 1
    return np.where(letter, data, _GAP).astype(np.uint8)[keep], place[starts[:-1]]


def ngram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, cell and count of the n-grams of letters of each text, sorted by text."""
    data, starts = _folded(texts)
    if len(data) < NGRAM:
        none = np.zeros(0, np.int64)
        return none, none, none
    code = np.zeros(len(data) - NGRAM + 1, np.uint64)
    for k in range(NGRAM):
        code = (code << np.uint64(8)) | data[k:len(data) - NGRAM + 1 + k].astype(np.uint64)
    first = np.arange(len(code))
    owner = np.searchsorted(starts, first, "right") - 1
    # An n-gram may end on the gap after its text, which is the next one's first byte.
    ends = np.append(starts[1:], len(data) - 1)[owner]
    # A gap inside an n-gram would join two words.
    inside = data[1:len(data) - 1] == _GAP
    within = ~inside[:len(code)] if NGRAM == 3 else np.ones(len(code), bool)
    fine = (first + NGRAM - 1 <= ends) & within
    cell = (mix(code[fine]) % np.uint64(CELLS)).astype(np.int64)
    both, counts = np.unique(owner[fine] * CELLS + cell, return_counts=True)
    return both // CELLS, both % CELLS, counts


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for name, counts in held.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells), pa.string()), pa.array(cells, pa.int32()),
                 pa.array(counts[cells], pa.int64())], ["lang", "cell", "n"])

    for part in slices(batches):
        owner, cell, counts = ngram_counts(part.column("text").to_pylist())
        names = part.column("lang").to_pylist()
        numbers = {name: k for k, name in enumerate(dict.fromkeys(names))}
        number = np.array([numbers[name] for name in names], np.int64)[owner]
        for name, k in numbers.items():
            if name not in held:
                if len(held) == HELD_LANGUAGES:
                    yield from counted()
                    held.clear()
                held[name] = np.zeros(CELLS, np.int64)
            mine = number == k
            held[name] += np.bincount(cell[mine], counts[mine], CELLS).astype(np.int64)
    yield from counted()


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the doc_id as text modulo 5 is 0; a null doc_id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Counts over all rows of ``docs`` with a text, a ``lang`` and a doc_id that isn't held out.
    Only sums come to the driver: a number per language and cell that occurs in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    known = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                       & ~held_out(F.col("doc_id")))
    summed = known.select("text", "lang").mapInArrow(
        _language_counts, "lang string, cell int, n long").groupBy("lang", "cell").agg(
        F.sum("n").alias("n")).toPandas()
    # A learned language has a labelled text, though it may not have a letter.
    names = tuple(sorted(r[0] for r in known.select("lang").distinct().collect()))
    counts = np.zeros((CELLS, len(names)))
    counts[summed["cell"], summed["lang"].map({n: k for k, n in enumerate(names)}).astype(int)] = \
        summed["n"]
    background = (counts.sum(1) + 1) / (counts.sum() + CELLS)
    return LanguageModel(names, np.log((counts + PRIOR * background[:, None])
                                       / (counts.sum(0) + PRIOR)))


def mixture(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS
            ) -> tuple[np.ndarray, np.ndarray]:
    """Shares (texts x languages) by expectation-maximisation, and log-likelihoods.

    ``logs`` has a row per n-gram of a text (texts back to back, each from its ``starts`` on, none
    without n-grams), ``counts`` says how often it occurs. All texts are fitted at once."""
    n_texts, n_languages = len(starts), logs.shape[1]
    sizes = np.diff(np.append(starts, len(logs)))
    top = logs.max(1)
    weight = np.exp(logs - top[:, None])
    total = np.add.reduceat(counts, starts).astype(float)
    shares = np.full((n_texts, n_languages), 1 / n_languages)
    for turn in range(rounds + 1):
        part = weight * np.repeat(shares, sizes, axis=0)
        whole = part.sum(1)
        if turn == rounds:
            break
        part *= (counts / whole)[:, None]
        shares = np.add.reduceat(part, starts, axis=0) / total[:, None]
    return shares, np.add.reduceat(counts * (np.log(whole) + top), starts)


def language_set(logs: np.ndarray, counts: np.ndarray, alone: np.ndarray
                 ) -> tuple[list[int], np.ndarray]:
    """The set of languages of one text and their shares: from the likeliest single one on
    (``alone`` has the likelihoods), the language that helps most is added while it pays."""
    price = PENALTY * np.log(counts.sum() + 1)
    chosen, best = [int(np.argmax(alone))], float(alone.max())
    shares = np.ones(1)
    start = np.zeros(1, np.int64)
    while len(chosen) < logs.shape[1]:
        tried = []
        for k in range(logs.shape[1]):
            if k not in chosen:
                s, found = mixture(logs[:, [*chosen, k]], counts, start)
                tried.append((float(found[0]), -k, s[0]))
        value, k, s = max(tried, key=lambda t: t[:2])
        if value - best <= price:
            break
        chosen, best, shares = [*chosen, -k], value, s
    return chosen, shares


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    n = len(model.names)
    limit = max(SLICE_BYTES * 4 // max(n, 4), 1 << 14)
    for part in slices(batches, limit=limit):
        texts = part.column("text").to_pylist()
        names, scores, sets, parts = [UNKNOWN] * len(texts), [0.0] * len(texts), \
            [""] * len(texts), [[] for _ in texts]
        owner, cell, counts = ngram_counts(texts) if n else (np.zeros(0, np.int64),) * 3
        if len(owner):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            logs = model.logs[cell]
            shares, full = mixture(logs, counts, starts)
            alone = np.add.reduceat(logs * counts[:, None], starts, axis=0)
            sums = np.add.reduceat(counts, starts)
            ends = np.append(starts[1:], len(owner))
            # No set of languages is likelier than all of them together.
            mixed = full - alone.max(1) > PENALTY * np.log(sums + 1)
            for t, k in enumerate(owner[starts].tolist()):
                if not any(map(str.isalpha, texts[k])):
                    continue
                chosen, share = [int(np.argmax(alone[t]))], np.ones(1)
                if mixed[t]:
                    here = slice(starts[t], ends[t])
                    chosen, share = language_set(logs[here], counts[here], alone[t])
                first = min(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
                names[k] = model.names[chosen[first]]
                # Sure as far as all languages together leave the text to this one.
                scores[k] = float(min(max(shares[t, chosen[first]], 0.0), 1.0))
                order = sorted(range(len(chosen)), key=lambda i: chosen[i])
                sets[k] = ",".join(model.names[chosen[i]] for i in order)
                parts[k] = [float(share[i]) for i in order]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
             pa.array(sets, pa.string()), pa.array(parts, pa.list_(pa.float64()))],
            ["doc_id", "lang_pred", "score", "languages", "shares"])


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred (the language with the largest share in the
    chosen set, ties to the first by code point), score (its share when all languages compete),
    languages (the set, comma-joined), shares (in that order).

    A text that is null, empty or without a letter, and any text if no language was learned, is
    ``und`` with score 0 and an empty set. Only letters count; case does not. Repeated rows, rows
    that share a doc_id and null doc_ids are rows of their own; other columns are ignored; an
    empty table gives no rows. Whole texts are read, in slices of bounded size.
    """
    return documents(docs).mapInArrow(
        lambda it: _predict(it, model), "doc_id long, lang_pred string, score double, "
                                        "languages string, shares array<double>")
