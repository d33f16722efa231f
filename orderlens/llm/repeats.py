"""Removing every byte that a repeated string of a given length covers.

Equal strings of ``length`` bytes hold the same anchor, the k-gram with the smallest hash among
theirs, so a shuffle by anchor brings all of them together. An anchor's surroundings (the strings
whose anchor it is, in one piece) are compared by hash first: where they equal earlier ones, all
their strings are repeats. Each slice of texts finds those among its own before the shuffle, so of
a passage that very many texts share only one row per slice meets the others. Different surroundings of one anchor may still share some strings: for
these a Burrows-Wheeler transform is built, and common prefixes are derived from it in order of
increasing value, by backward extension of the suffix intervals, up to ``length``; suffixes that
are then still in one interval start with the same string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import RollingHash, documents, mix, partitions, slices, utf8
from .tables import written

GRAM = 36
#: Bytes of surroundings that one transform covers (an anchor with more has one of its own).
CHUNK_BYTES = 1 << 20
_HASHES: dict[int, RollingHash] = {}
_IN_SLICE = np.uint64(0xFFFFFFFF)


def _hash(seed: int) -> RollingHash:
    if seed not in _HASHES:
        _HASHES[seed] = RollingHash(seed)
    return _HASHES[seed]


def _sliding_minimum(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours, from running minima forward and back in blocks."""
    padded = np.concatenate([values, np.full(-len(values) % span, 2**64 - 1, np.uint64)])
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - span + 1
    return np.minimum(back[:n], ahead[span - 1:span - 1 + n])


def surroundings(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Text number, start, number of strings, anchor hash and hash of the surroundings, for each
    run of strings of one text that share an anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    grams = np.arange(len(data) - gram + 1)
    hashes = _hash(21).of(_hash(21).prefix(data), grams, grams + gram)
    # The smallest hash; of equal ones the leftmost, which depends on the string alone as well.
    lowest = _sliding_minimum((hashes & ~_IN_SLICE) | grams.astype(np.uint64), length - gram + 1)
    n = len(data) - length + 1
    starts = np.flatnonzero(text[:n] == text[length - 1:length - 1 + n])
    if not len(starts):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchor = (lowest[starts] & _IN_SLICE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    first = starts[at]
    last = starts[np.append(at[1:], len(starts)) - 1]
    anchor = anchor[at]
    whole = _hash(22).of(_hash(22).prefix(data), first, last + length)
    whole = mix(whole ^ mix((anchor - first).astype(np.uint64)))
    owner = text[first]
    return owner, first - offsets[owner], last - first + 1, hashes[anchor], whole


def _repeated_here(anchor: np.ndarray, whole: np.ndarray, valid: np.ndarray, docs: np.ndarray,
                   start: np.ndarray) -> np.ndarray:
    """Which rows have an earlier one of the same anchor and surroundings among these rows; no
    doc_id (not ``valid``) comes first."""
    order = np.lexsort((start, docs, valid, whole, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(whole[order]) != 0)
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    known = np.zeros(len(order), bool)
    known[order] = ((valid[order] != valid[head]) | (docs[order] != docs[head])
                    | (start[order] != start[head]))
    return known


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int,
                 gram: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        data, offsets = utf8(part.column("text"))
        owner, start, count, anchor, whole = surroundings(data, offsets, length, gram)
        doc_id, row = (part.column(c).take(pa.array(owner)) for c in ("doc_id", "row"))
        docs = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
        known = _repeated_here(anchor, whole, doc_id.is_valid().to_numpy(zero_copy_only=False),
                               docs, start)
        # What is known to be a repeat needn't meet the others: it goes to any task.
        text = row.to_numpy(zero_copy_only=False).view(np.uint64)
        spread = mix(text ^ mix(docs.view(np.uint64) ^ mix(start)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(known), pa.array(np.where(known, spread, anchor).view(np.int64)),
             pa.array(whole.view(np.int64)), doc_id, row, pa.array(start), pa.array(count)],
            ["known", "anchor", "whole", "doc_id", "row", "start", "strings"])


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least. Symbols lie below 512."""
    n, have = len(symbols), 7
    padded = np.concatenate([symbols, np.zeros(have, symbols.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(have):                                # seven symbols in one number
        key = (key << np.uint64(9)) | padded[k:k + n]
    while True:
        order = np.argsort(key)     # the order of equal keys doesn't matter
        ordered = key[order]
        step = np.zeros(n, np.int64)
        step[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(step).astype(np.uint64) + np.uint64(1)
        if have >= depth:
            return order
        later = np.zeros(n, np.uint64)
        later[:n - have] = rank[have:]
        key = (rank << np.uint64(32)) | later
        have *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``, as far as
    it is below ``stop``; ``stop`` otherwise.

    Breadth first over lengths: the ends of intervals of suffixes with a common prefix of length
    l - 1 are known. Extending such an interval backward by a symbol c maps its rows that have c
    in the transform to neighbours. So a row and the one before it that has the same symbol in the
    transform land in different intervals of length l exactly if an end of an interval lies
    between them; rows that land so get the value l and are done.
    """
    n = len(symbols)
    transform = symbols[order - 1]                       # the symbol before each suffix
    by_symbol = np.argsort(transform, kind="stable")     # row that each target row comes from
    came = transform[by_symbol]
    previous = np.full(n, -1, np.int64)
    previous[1:] = by_symbol[:-1]
    result = np.full(n, stop, np.int32)
    head = np.ones(n, bool)
    head[1:] = came[1:] != came[:-1]
    result[head] = 0
    ends = head.copy()
    open_rows = np.flatnonzero(~head)
    for value in range(1, stop):
        before = np.cumsum(ends, dtype=np.int32)
        between = before[by_symbol[open_rows]] != before[previous[open_rows]]
        found = open_rows[between]
        if not len(found):
            break
        result[found] = value
        ends[found] = True
        open_rows = open_rows[~between]
    return result


def repeated_strings(pieces: list[bytes], keys: np.ndarray, length: int) -> np.ndarray:
    """Which starts in the concatenated pieces begin a string of ``length`` bytes that also begins
    at a start with a smaller key. ``keys`` has a row (document, start) for each byte, both of them
    from 0 and below 2**31."""
    sizes = np.array([len(p) for p in pieces])
    flat = np.zeros(int(sizes.sum()) + len(pieces), np.uint16)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    within = np.arange(len(flat)) - np.repeat(begins, sizes + 1)
    size = np.repeat(sizes, sizes + 1)
    flat[within < size] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    order = suffix_array(flat, length)
    group = np.cumsum(common_prefixes(flat, order, length) < length)
    valid = (within + length <= size)[order]
    rows, group = order[valid], group[valid]
    found = np.zeros(len(keys), bool)
    if not len(rows):
        return found
    position = np.cumsum(within < size) - 1              # of each symbol among the bytes
    at = position[rows]
    key = (keys[:, 0] << 32 | keys[:, 1])[at]            # starts of a text lie below 2**31
    new = np.ones(len(rows), bool)                       # rows of a group stand together
    new[1:] = group[1:] != group[:-1]
    first = np.minimum.reduceat(key, np.flatnonzero(new))
    found[at[key != first[np.cumsum(new) - 1]]] = True
    return found


def _match(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans that repeats cover, from surroundings that come in order of their anchors."""
    def spans(rows: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(r[3]) for r in rows])
        ids = sorted({r[1] for r in rows}, key=lambda i: (i is not None, i or 0))
        place = {i: k for k, i in enumerate(ids)}        # no doc_id comes first
        docs = np.array([place[r[1]] for r in rows], np.int64)
        starts = np.array([r[2] for r in rows], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        within = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
        piece = np.repeat(np.arange(len(rows)), sizes)
        keys = np.stack([docs[piece], starts[piece] + within], axis=1)
        at = np.flatnonzero(repeated_strings([r[3] for r in rows], keys, length))
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (piece[at[1:]] != piece[at[:-1]])
        low = at[new]
        high = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[p][1] for p in piece[low]], pa.int64()),
             pa.array([rows[p][4] for p in piece[low]], pa.int64()),
             pa.array(keys[low, 1]), pa.array(keys[high, 1] + length)],
            ["doc_id", "row", "low", "high"])

    waiting, held, anchor = [], 0, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (
                "anchor", "doc_id", "start", "piece", "row"))):
            if held >= CHUNK_BYTES and row[0] != anchor:
                yield spans(waiting)
                waiting, held = [], 0
            anchor = row[0]
            waiting.append(row)
            held += len(row[3])
    if waiting:
        yield spans(waiting)


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out = {k: [] for k in ("anchor", "doc_id", "row", "start", "piece")}
        data, offsets = utf8(part.column("text"))
        for i, (doc_id, row, marks) in enumerate(zip(*(
                part.column(c).to_pylist() for c in ("doc_id", "row", "marks")))):
            for m in marks:
                low = offsets[i] + m["start"]
                out["anchor"].append(m["anchor"])
                out["doc_id"].append(doc_id)
                out["row"].append(row)
                out["start"].append(m["start"])
                out["piece"].append(data[low:low + m["strings"] - 1 + length].tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            (k, pa.binary() if k == "piece" else pa.int64()) for k in out]))


def _keep_rest(batches: Iterator[pa.RecordBatch], characters: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept"]
    for part in slices(batches):
        data, offsets = utf8(part.column("text"))
        found = part.column("spans").to_pylist()
        removed, spans, kept = [], [], []
        for i in range(len(found)):
            text = data[offsets[i]:offsets[i + 1]]
            if not found[i]:
                removed.append(0)
                spans.append(0)
                kept.append(text.tobytes())
                continue
            change = np.zeros(len(text) + 1, np.int32)
            low, high = np.array([(s["low"], s["high"]) for s in found[i]]).T
            np.add.at(change, low, 1)
            np.subtract.at(change, high, 1)
            gone = np.cumsum(change[:-1]) > 0
            if characters:
                # A character goes only if all of its bytes go.
                head = (text & 0xC0) != 0x80
                number = np.cumsum(head) - 1
                whole = np.bincount(number[~gone], minlength=number[-1] + 1) == 0
                gone = whole[number]
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append(text[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("row"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names)


def repeated_spans(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """Spans of bytes (doc_id, row, low, high) that strings of ``length`` bytes cover which also start
    earlier: in a smaller doc_id (null: smallest), or in the same one at a smaller start. Spans
    may overlap. ``docs`` comes from :func:`documents`, with a hash ``row`` of the text that
    tells apart rows of one doc_id."""
    anchors = docs.mapInArrow(
        lambda it: _anchor_rows(it, length, gram),
        "known boolean, anchor long, whole long, doc_id long, row long, start long, strings long")
    same = Window.partitionBy("known", "anchor", "whole").orderBy("doc_id", "start")
    around = Window.partitionBy("known", "anchor")
    marks = anchors.select("*", F.first("doc_id").over(same).alias("first_doc"),
                           F.first("start").over(same).alias("first_start"))
    marks = marks.select(
        "anchor", "doc_id", "row", "start", "strings",
        (~F.col("known") & F.col("first_doc").eqNullSafe(F.col("doc_id"))
         & (F.col("first_start") == F.col("start"))).alias("first"),
        (F.min("whole").over(around) != F.max("whole").over(around)).alias("varied"))
    marks = written(marks.where("NOT first OR varied"), "marks")
    again = marks.where("NOT first").select(
        "doc_id", "row", F.col("start").alias("low"),
        (F.col("start") + F.col("strings") + (length - 1)).alias("high"))
    chosen = marks.where("first").distinct().groupBy(
        F.col("doc_id").alias("of"), F.col("row").alias("of_row")).agg(
        F.collect_list(F.struct("anchor", "start", "strings")).alias("marks"))
    pieces = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("of")) & (
        F.col("row") == F.col("of_row"))).mapInArrow(
        lambda it: _cut_out(it, length),
        "anchor long, doc_id long, row long, start long, piece binary")
    dealt = pieces.repartition(partitions(docs), "anchor").sortWithinPartitions("anchor")
    matched = written(dealt.mapInArrow(lambda it: _match(it, length),
                                       "doc_id long, row long, low long, high long"),
                      "spans")
    return again.unionByName(matched)


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = GRAM,
                   characters: bool = False) -> DataFrame:
    """One row per document: doc_id, row (a hash of its text), n_bytes, n_removed, n_spans
    (maximal removed runs), kept (the remaining bytes of its UTF-8 text).

    Texts are compared as they are given, not as they are left. Null texts are empty; texts
    shorter than ``length`` stay as they are. Rows that share a doc_id count as one document: a
    start in any of them is earlier than a larger start in another, equal starts leave each other
    alone; equal rows get equal results. With ``characters``, only whole characters are removed.
    Empty input gives no rows; other columns are ignored.
    """
    texts = documents(docs).withColumn("row", F.xxhash64("text"))
    spans = written(repeated_spans(texts, length, gram).groupBy(
        F.col("doc_id").alias("of"), F.col("row").alias("of_row")).agg(
        F.collect_list(F.struct("low", "high")).alias("spans")), "document-spans")
    return texts.join(spans, F.col("doc_id").eqNullSafe(F.col("of")) & (
        F.col("row") == F.col("of_row")), "left").mapInArrow(
        lambda it: _keep_rest(it, characters),
        "doc_id long, row long, n_bytes long, n_removed long, n_spans long, kept binary")
