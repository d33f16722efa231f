"""Aligning the tokens of two public tokenizers, each distinct text once.

Both tokenizers cut a text into stretches of bytes. Where an A token and a B token end at the same
byte, a group ends; the tokens of a group are linked with each other. Copies are taken together by
a shuffle on the full text; every distinct text is encoded and aligned once, its pairs count as
often as the text occurs, and what is measured on it goes back to all documents that hold it.

Neither vocabulary has a token that crosses from a visible character to a following space or line
end, or from a letter to a comma or full stop, so a text's tokens are those of its stretches between
such places back to back. A worker encodes and aligns each distinct stretch once and remembers it.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import slices
from .tables import written

#: Stretches a Python worker remembers (about 500 bytes each), the bytes of those, and pairs a task
#: sums up before it hands them on.
MEMORY, MEMORY_BYTES, PAIRS = 160_000, 10 << 20, 500_000
#: Rows of whole texts that a task is handed at a time; many would fill its memory twice over.
BATCH_ROWS = 1_000
#: Pair counts that are sent to all tasks at a time (12 bytes each).
BLOCK_PAIRS = 4_000_000
#: A text that more than this share of all rows has goes to its documents by broadcast: there are
#: fewer than 1 / HOT such texts.
HOT = 0.001
# A place between a visible character and a space or line end (U+180E counts as white space in some
# tables only), and one between a letter and a comma or full stop.
_SPACES, _POINTS = "(?<=[^\\s\\u180e])(?=[ \n])", "(?<=[a-zß-öø-ÿ])(?=[.,])"
_LEARN = 8_000  # stretches encoded at a time
_SHIFT = 15     # of A ids in pair keys; B has fewer than 32,768 ids
_ROW = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, " \
       "groups_sha256 string, a_ids binary, b_ids binary, a_sizes binary, b_sizes binary, " \
       "pairs binary, counts binary"


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1, for all i, back to back."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Flat:
    """Lists of numbers back to back, to which more are added."""

    def __init__(self, kind):
        self.data, self.used, self.kind = np.zeros(1024, kind), 0, kind

    def add(self, more: np.ndarray) -> None:
        if self.used + len(more) > len(self.data):
            grown = np.zeros(2 * (self.used + len(more)), self.kind)
            grown[:self.used] = self.data[:self.used]
            self.data = grown
        self.data[self.used:self.used + len(more)] = more
        self.used += len(more)


class Tokenizers:
    """The two encoders, and the bytes of every entry of their vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True     # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [b""] * (max(entries) + 1)
        for i, token in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(
                c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.bytes_a) > 1 << 16 or len(self.bytes_b) > 1 << _SHIFT:
            raise ValueError("vocabularies of up to 65,536 (A) and 32,768 (B) entries")
        self.sizes_a, self.sizes_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.size_a, self.size_b = np.array(self.sizes_a, np.int64), np.array(self.sizes_b, np.int64)
        # The cuts are sound for vocabularies without a piece across them.
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.places = None
        if "ByteLevel" in type(self.a.pre_tokenizer).__name__ and not any(
                re.search("[^▁]▁|\n", p) for p in plain):
            crossed = any(re.search("[a-zß-öø-ÿ][.,]", p) for p in plain)
            self.places = re.compile(_SPACES if crossed else f"{_SPACES}|{_POINTS}")

    def stretches(self, text: str) -> list[str]:
        return self.places.split(" " + text) if self.places else [" " + text]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of stretches as they are inside a text; the first of a text starts with a space."""
        a = [x.ids for x in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        # B puts a space before whatever it is given. Where none is wanted, a line end goes between,
        # which no piece holds: the space and the line end are tokens of their own then.
        b = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in stretches], num_threads=1)
        return a, [ids if s[0] == " " else ids[2:] for s, ids in zip(stretches, b)]

    def lossless(self, stretches: list[str], a: list[list[int]], b: list[list[int]]) -> list[bool]:
        """Whether the ids of each stretch give back its bytes."""
        raw = [s.encode("utf-8", "replace") for s in stretches]
        whole = b"".join(raw)
        if b"".join([self.bytes_a[i] for ids in a for i in ids]) == whole \
                and b"".join([self.bytes_b[i] for ids in b for i in ids]) == whole \
                and all(map(self._same_size, raw, a, b)):
            return [True] * len(raw)
        return [b"".join([self.bytes_a[i] for i in x]) == r
                and b"".join([self.bytes_b[i] for i in y]) == r for r, x, y in zip(raw, a, b)]

    def _same_size(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return sum([self.sizes_a[i] for i in a]) == len(raw) == sum([self.sizes_b[i] for i in b])


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    for themselves, the others in ascending order from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair of encoders per Python worker."""
    return Tokenizers(path_a, path_b)


@dataclass
class Groups:
    """Groups of many stretches: for each stretch its number of A ids, B ids and groups; for each
    group its number of A and B ids."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    in_a: np.ndarray
    in_b: np.ndarray


def align(ids_a: np.ndarray, n_a: np.ndarray, size_a: np.ndarray, ids_b: np.ndarray,
          n_b: np.ndarray, size_b: np.ndarray) -> Groups:
    """Cuts the tokens of stretches at the byte offsets where tokens of both end. Both id lists
    cover the same bytes of each stretch, so the ends of stretches are such offsets too."""
    ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
    both = np.intersect1d(ends_a, ends_b)       # every token has a byte at least: no repeats
    in_a = np.diff(np.searchsorted(ends_a, both, "right"), prepend=0)
    in_b = np.diff(np.searchsorted(ends_b, both, "right"), prepend=0)
    last = np.concatenate([[0], ends_a])[np.cumsum(n_a)]     # where each stretch ends
    return Groups(n_a, n_b, np.diff(np.searchsorted(both, last, "right"), prepend=0), in_a, in_b)


def links(a: np.ndarray, in_a: np.ndarray, b: np.ndarray, in_b: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token of the same group: keys, and how many each group has."""
    sizes = in_a * in_b
    at = _spread(np.zeros(len(sizes), np.int64), sizes)
    width = np.repeat(in_b, sizes)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    left = a[np.repeat(first_a, sizes) + at // width].astype(np.int64)
    return (left << _SHIFT) + b[np.repeat(first_b, sizes) + at % width], sizes


class Aligned:
    """Stretches a task has aligned: ids, sizes of groups, distinct pairs, and the written form.

    Beyond ``MEMORY`` stretches or ``MEMORY_BYTES`` of them the memory starts anew."""

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.form: list[str | None] = []        # None: bytes are lost
        self.a, self.b = Flat(np.uint16), Flat(np.uint16)
        self.in_a, self.in_b, self.pairs = Flat(np.int32), Flat(np.int32), Flat(np.int32)
        self.sizes = {k: Flat(np.int64) for k in ("a", "b", "groups", "links", "pairs")}
        self.bytes = 0

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.number) > MEMORY or self.bytes > MEMORY_BYTES:
            self.clear()
        new = list(set().union(*texts).difference(self.number))
        for at in range(0, len(new), _LEARN):
            self._add(new[at:at + _LEARN])

    def _add(self, new: list[str]) -> None:
        a, b = self.tools.encode(new)
        fine = self.tools.lossless(new, a, b)
        if not all(fine):
            a = [x if ok else [] for x, ok in zip(a, fine)]
            b = [x if ok else [] for x, ok in zip(b, fine)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(new)) for x in (a, b))
        flat_a, flat_b = (np.fromiter(itertools.chain.from_iterable(x), np.int64, int(n.sum()))
                          for x, n in ((a, n_a), (b, n_b)))
        g = align(flat_a, n_a, self.tools.size_a, flat_b, n_b, self.tools.size_b)
        keys, per_group = links(flat_a, g.in_a, flat_b, g.in_b)
        owner = np.repeat(np.repeat(np.arange(len(new)), g.n_groups), per_group)
        once = distinct((owner << 32) + keys)
        for name, values in (("a", n_a), ("b", n_b), ("groups", g.n_groups),
                             ("links", np.bincount(owner, minlength=len(new))),
                             ("pairs", np.bincount(once >> 32, minlength=len(new)))):
            self.sizes[name].add(values)
        self.a.add(flat_a)
        self.b.add(flat_b)
        self.in_a.add(g.in_a)
        self.in_b.add(g.in_b)
        self.pairs.add(once & 0xFFFFFFFF)
        for stretch, form, ok in zip(new, written_groups(flat_a, flat_b, g), fine):
            self.number[stretch] = len(self.form)
            self.form.append(form if ok else None)
            self.bytes += len(stretch)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=-1))]


def written_groups(a: np.ndarray, b: np.ndarray, g: Groups) -> list[str]:
    """``a1,a2|b1;a3|b2`` for each stretch."""
    sizes = np.stack([g.in_a, g.in_b], axis=1).ravel()
    ends = np.cumsum(sizes)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    starts = ends - sizes
    ids[_spread(starts[0::2], g.in_a)] = a
    ids[_spread(starts[1::2], g.in_b)] = b
    mark[ends[0::2] - 1] = 1
    mark[ends[1::2] - 1] = 2
    parts = [""] * (2 * len(ids))
    parts[0::2] = map(str, ids.tolist())
    parts[1::2] = map(",|;".__getitem__, mark.tolist())
    at = np.concatenate([[0], ends[1::2]])[np.cumsum(g.n_groups)].tolist()
    return ["".join(parts[2 * i:2 * j])[:-1] for i, j in zip([0, *at], at)]


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligned:
    """One memory of stretches per Python worker."""
    return Aligned(tokenizers(path_a, path_b))


def _align_texts(batches: Iterator[pa.RecordBatch], path_a: str,
                 path_b: str) -> Iterator[pa.RecordBatch]:
    """One row per text, and rows of pair counts (pairs, counts; without a key)."""
    known = aligner(path_a, path_b)
    tools = known.tools
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def summed() -> None:
        nonlocal pending, waiting
        keys = np.concatenate([k for k, _ in pending])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in pending])[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        total = np.add.reduceat(counts, first) if len(first) else counts
        pending, waiting = [(keys[first], total)], len(first)

    def counted() -> pa.RecordBatch:
        nonlocal pending, waiting
        row = {"pairs": pending[0][0].astype("<i4").tobytes(),
               "counts": pending[0][1].astype("<i8").tobytes()}
        pending, waiting = [], 0
        return _arrow([row])

    for part in slices(batches):
        texts = part.column("text").to_pylist()
        cut = [tools.stretches(t) for t in texts]
        known.learn(cut)
        numbers = [list(map(known.number.__getitem__, stretches)) for stretches in cut]
        forms = [list(map(known.form.__getitem__, x)) for x in numbers]
        lost = [k for k, f in enumerate(forms) if None in f]
        # A stretch may lose bytes that its neighbour gains, so such texts are seen as one.
        again = [[" " + texts[k]] for k in lost]
        if any(a != cut[k] for a, k in zip(again, lost)):
            known.learn([*cut, *again])
            numbers = [list(map(known.number.__getitem__, stretches)) for stretches in cut]
        for k, whole in zip(lost, again):
            numbers[k] = [known.number[whole[0]]] if whole[0] in known.number else numbers[k]
            forms[k] = [known.form[i] for i in numbers[k]]
            if None in forms[k]:
                numbers[k], forms[k] = [], [None]
        sizes = np.array([len(x) for x in numbers], np.int64)
        unit = np.fromiter(itertools.chain.from_iterable(numbers), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        per_text, columns = {}, {}
        for name in ("a", "b", "groups", "links"):
            n = known.sizes[name].data[unit]
            per_text[name] = np.bincount(owner, n, len(texts)).astype(np.int64)
        for name, size, flat, kind in (("a_ids", "a", known.a, "<u2"), ("b_ids", "b", known.b, "<u2"),
                                       ("a_sizes", "groups", known.in_a, "<u4"),
                                       ("b_sizes", "groups", known.in_b, "<u4")):
            n = known.sizes[size]
            starts = (np.cumsum(n.data[:n.used]) - n.data[:n.used])[unit]
            values = flat.data[_spread(starts, n.data[unit])].astype(kind)
            ends = np.cumsum(per_text[size])
            columns[name] = [values[i:j].tobytes() for i, j in zip(ends - per_text[size], ends)]
        # Each pair of a text counts once, as often as the text occurs.
        copies = part.column("copies").to_numpy(zero_copy_only=False)
        seen = distinct((owner << 32) + unit)
        n = known.sizes["pairs"]
        starts = (np.cumsum(n.data[:n.used]) - n.data[:n.used])[seen & 0xFFFFFFFF]
        own = n.data[seen & 0xFFFFFFFF]
        pairs = distinct((np.repeat(seen >> 32, own) << 32) + known.pairs.data[_spread(starts, own)])
        pending.append((pairs & 0xFFFFFFFF, copies[pairs >> 32].astype(np.int64)))
        waiting += len(pairs)
        digests = ["" if f[0] is None else hashlib.sha256(";".join(f).encode()).hexdigest()
                   for f in forms]
        yield pa.RecordBatch.from_arrays(
            [part.column("key").cast(pa.binary()), pa.array(copies, pa.int64()),
             *[pa.array(per_text[c], pa.int64()) for c in ("a", "b", "groups", "links")],
             pa.array(digests), *[pa.array(columns[c], pa.binary()) for c in columns],
             pa.nulls(len(texts), pa.binary()), pa.nulls(len(texts), pa.binary())],
            schema=_SCHEMA)
        if waiting > PAIRS:
            summed()
            if waiting > PAIRS // 2:
                yield counted()
    if pending:
        summed()
        yield counted()


_SCHEMA = pa.schema([("key", pa.binary()), *[(c, pa.int64()) for c in (
    "copies", "n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), *[
    (c, pa.binary()) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes", "pairs", "counts")]])


def _arrow(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{c: r.get(c) for c in _SCHEMA.names} for r in rows],
                                      schema=_SCHEMA)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, counts in zip(batch.column("pairs"), batch.column("counts")):
            keys = np.frombuffer(pairs.as_py(), "<i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys >> _SHIFT, pa.int32()),
                 pa.array(keys & ((1 << _SHIFT) - 1), pa.int32()),
                 pa.array(np.frombuffer(counts.as_py(), "<i8"), pa.int64())], ["a", "b", "n"])


def _measures(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    """What a block of pair counts adds to each text's measures."""
    keys, counts, best = block.value
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("a_ids")).to_numpy())
        at = 0
        while at < batch.num_rows:      # about 1 MB of ids at a time
            done = sizes[at - 1] if at else 0
            end = max(int(np.searchsorted(sizes, done + (1 << 19), "right")), at + 1)
            part = batch.slice(at, end - at)
            at = end
            a, b, in_a, in_b = (np.frombuffer(b"".join(part.column(c).to_pylist()), kind)
                                for c, kind in (("a_ids", "<u2"), ("b_ids", "<u2"),
                                                ("a_sizes", "<u4"), ("b_sizes", "<u4")))
            found, per_group = links(a, in_a.astype(np.int64), b, in_b.astype(np.int64))
            n_groups = part.column("n_groups").to_numpy()
            owner = np.repeat(np.repeat(np.arange(part.num_rows), n_groups), per_group)
            place = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
            here = keys[place] == found if len(keys) else np.zeros(len(found), bool)
            worth = np.where(here, counts[place], 0) if len(keys) else np.zeros(len(found), np.int64)
            top = here & best[place] if len(keys) else here
            ends = np.searchsorted(owner, np.arange(part.num_rows), "right")
            sums = [np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends], prepend=0)
                    for x in (top, worth)]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *[pa.array(x, pa.int64()) for x in sums]],
                ["key", "n_best", "count_sum"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (no other b has more with this a)."""
    partial = aligned.where("key IS NULL").select("pairs", "counts").mapInArrow(
        _pair_rows, "a int, b int, n long")
    counts = partial.groupBy("a", "b").agg(F.sum("n").alias("n"))
    # A vocabulary has 65,536 ids at most, and no window holds more than 32,768 pairs.
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def _blocks(counts: DataFrame) -> list[tuple[int, int]]:
    """Ranges of A ids with about ``BLOCK_PAIRS`` pairs each, from one number per A id."""
    sizes = sorted((r["a"], r["pairs"]) for r in counts.groupBy("a").agg(
        F.count("*").alias("pairs")).collect())
    ranges, start, held = [], 0, 0
    for a, pairs in sizes:
        if held and held + pairs > BLOCK_PAIRS:
            ranges.append((start, a))
            start, held = a, 0
        held += pairs
    return [*ranges, (start, 1 << 30)]


def measured_texts(aligned: DataFrame) -> DataFrame:
    """Each aligned text's ``key`` and measures. The pair counts meet the texts' links in blocks
    of bounded size, each sent to all tasks once; a block more is a pass more over the stored ids,
    and no link is ever shuffled."""
    spark = aligned.sparkSession
    counts = written(pair_counts(aligned), "pair-counts")
    texts = aligned.where("key IS NOT NULL")
    measures = None
    for low, high in _blocks(counts):
        rows = counts.where(F.col("a").between(low, high - 1)).select(
            (F.shiftleft("a", _SHIFT) + F.col("b")).alias("pair"), "n", "best").toArrow()
        keys = rows.column("pair").to_numpy().astype(np.int32)
        order = np.argsort(keys)
        block = spark.sparkContext.broadcast(
            (keys[order].astype(np.int64), rows.column("n").to_numpy()[order],
             rows.column("best").to_numpy(zero_copy_only=False).astype(bool)[order]))
        part = texts.select("key", "n_groups", "a_ids", "b_ids", "a_sizes", "b_sizes").mapInArrow(
            lambda it, block=block: _measures(it, block), "key binary, n_best long, count_sum long")
        measures = part if measures is None else measures.union(part)
    summed = measures.groupBy("key").agg(F.sum("n_best").alias("n_best"),
                                         F.sum("count_sum").alias("count_sum"))
    return texts.select("key", "copies", "n_a", "n_b", "n_groups", "n_links",
                        "groups_sha256").join(summed, "key")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair
    is the most frequent of its A id, ties included), count_sum (documents that hold the pair,
    summed over links), groups_sha256 (of ``a1,a2|b1;a3|b2``).

    A text is encoded with a space before it; A is a byte-level vocabulary file, B a sentencepiece
    model, which puts the space there itself. Texts that are null, empty or don't come back byte
    for byte from both get zeros and an empty digest. Repeated rows and rows that share a doc_id
    are rows of their own; null doc_ids are kept; an empty table gives no rows; other columns are
    ignored. A text that many rows have is one row after the first shuffle's partial sums.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    distinct = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    aligned = written(keyed.mapInArrow(lambda it: _align_texts(it, path_a, path_b), _ROW),
                      "aligned-texts", BATCH_ROWS)
    measured = written(measured_texts(aligned), "measured-texts", BATCH_ROWS)
    total = measured.agg(F.sum("copies")).first()[0] or 0
    measures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    thin = rows.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
                       .alias("key"))
    # Texts that a notable share of all rows have: fewer than 1 / HOT, so they may be sent to all.
    frequent = F.col("copies") > F.lit(HOT * total)
    hot = measured.where(frequent).select("key", F.struct(*measures).alias("hot"))
    met = thin.join(F.broadcast(hot), "key", "left")
    # Rows that are served, or have no text, are dealt out evenly: 8 bytes never equal a digest.
    own = F.unhex(F.lpad(F.hex(F.xxhash64("doc_id")), 16, "0"))
    rest = measured.where(~frequent).select("key", F.struct(*measures).alias("found"))
    joined = met.withColumn("key", F.when(F.col("hot").isNull(), F.coalesce("key", own))
                            .otherwise(own)).join(rest, "key", "left")
    found = F.coalesce("hot", "found")
    return joined.select("doc_id", *[
        F.coalesce(found[c], F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in measures])
