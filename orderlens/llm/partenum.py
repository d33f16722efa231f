"""Jaccard join of word n-gram sets with PartEnum signatures.

Two sets that are similar enough have sizes in the same or neighbouring bands and differ in at
most k elements, k being a bound of the band. The domain of elements is cut into parts: with more
than k / 2 parts, some part holds at most one difference. Each part is cut again in three; of the
three pairs of its sub-parts, one pair is then free of differences, and its elements, summed up
in a hash, are a signature that both sets have. All links are found; candidates are then compared
exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import RollingHash, documents, mix, partitions, slices, utf8
from .components import components
from .tables import written

#: Members of a candidate group that one task compares with their leader.
GROUP_ROWS = 2000
_SEED_WORDS, _SEED_SETS = 11, 12
_SKETCH = 8   # longs
ROUNDS = 3
_SURE = ("sure", "sure_next")
_LIGHT = 2   # signatures of fewer elements are left out where they aren't needed
_LEFT_OUT = ("spare", "spare_next", "whole", "whole_next")
#: Signatures that more sets have than this may be left out of the last join.
_RARE = 2


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word n-grams of every text as 64-bit hashes, sorted, back to back; and where each
    text's begin (n + 1 numbers). A-Z are lowered, words are runs of bytes other than space and
    0x09-0x0D; a text of fewer words is one n-gram, without words it has none."""
    data, offsets = utf8(texts)
    n = len(offsets) - 1
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    # A word starts at a letter whose neighbour is white space or another text's byte.
    before = np.ones(len(low), bool)
    before[1:] = space[:-1]
    after = np.ones(len(low), bool)
    after[:-1] = space[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(low))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    hashing = _hash(_SEED_WORDS)
    prefix = hashing.prefix(low)
    word = hashing.of(prefix, starts, ends)
    first = np.searchsorted(starts, offsets)          # words before each text
    counts = np.diff(first)
    grams = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    at = np.concatenate([[0], np.cumsum(grams)])
    owner = np.repeat(np.arange(n), grams)
    begin = first[:-1][owner] + (np.arange(at[-1]) - at[:-1][owner])
    length = np.minimum(counts[owner], words)
    total = length.astype(np.uint64)
    for k in range(words):
        there = np.minimum(begin + k, max(len(word) - 1, 0))
        turn = np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64)
        total = np.where(k < length, mix(total ^ (word[there] + turn)), total)
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.ones(len(total), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    owner, total = owner[new], total[new]
    return total, np.searchsorted(owner, np.arange(n + 1))


_HASHES: dict[int, RollingHash] = {}


def _hash(seed: int) -> RollingHash:
    if seed not in _HASHES:
        _HASHES[seed] = RollingHash(seed)
    return _HASHES[seed]


class Bands:
    """Size bands for a similarity: band i holds sizes low[i]..high[i]; ``differ[i]`` bounds the
    differences of similar sets of the band, or of it and the one before."""

    def __init__(self, similarity: Fraction, largest: int):
        p, q = similarity.numerator, similarity.denominator
        self.low, self.high = [1], [q // p]
        while self.high[-1] < largest:
            low = self.high[-1] + 1
            self.low.append(low)
            self.high.append(low * q // p)
        self.low.append(self.high[-1] + 1)
        self.high.append(self.low[-1] * q // p)
        high = np.array(self.high, np.int64)
        # q * common >= p * union, with common = (a + b - d) / 2, union = (a + b + d) / 2
        self.differ = (q - p) * 2 * high // (q + p)
        self.parts = self.differ // 2 + 2 + self.differ // 16

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.high), sizes)


_BOTH = ((0, 1), (0, 2), (1, 2))   # pairs of sub-parts


class _Cut(NamedTuple):
    """Sets cut into the parts of a band: per set its band, parts, light parts, the most differences
    from a similar set it meets in that band, and whether it keeps all signatures; per part its set and the elements in each pair of sub-parts; which elements
    have a sub-part, and its number."""
    tag: np.ndarray
    parts: np.ndarray
    light: np.ndarray
    differ: np.ndarray
    keep_all: np.ndarray
    pair_of: np.ndarray
    held: np.ndarray
    mine: np.ndarray
    cell: np.ndarray


def _cuts(sets: np.ndarray, at: np.ndarray, similarity: Fraction) -> Iterator[_Cut]:
    """The sets cut by their own band, then by the next one; nothing if all are empty."""
    if not len(sets):
        return
    sizes = np.diff(at)
    bands = Bands(similarity, int(sizes.max()))
    band, high_of = bands.of(sizes), np.array(bands.high)
    p, q = similarity.numerator, similarity.denominator
    spread = mix(sets + np.uint64(0x51ED270B))
    high, low = spread >> np.uint64(32), spread & np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for step in (0, 1):
        tag = band + step
        used = (sizes > 0) & (bands.differ[tag] > 0)
        parts = np.where(used, bands.parts[tag], 0)
        first = np.concatenate([[0], np.cumsum(3 * parts)])
        mine = used[owner]
        who = owner[mine]
        part = (high[mine] * parts[who].astype(np.uint64)) >> np.uint64(32)
        sub = (low[mine] * np.uint64(3)) >> np.uint64(32)
        cell = first[who] + (part * np.uint64(3) + sub).astype(np.int64)
        counts = np.bincount(cell, minlength=int(first[-1])).reshape(-1, 3)
        pair_of = np.repeat(np.arange(len(sizes)), parts)
        held = np.stack([counts[:, a] + counts[:, b] for a, b in _BOTH], axis=1)
        light = np.bincount(pair_of, (held < _LIGHT).any(axis=1), len(sizes)).astype(np.int64)
        differ = (sizes + np.minimum(high_of[tag], sizes * q // p)) * (q - p) // (q + p)
        yield _Cut(tag, parts, light, differ, light > parts - bands.differ[tag] // 2 - 1, pair_of,
                   held, mine, cell)


def signatures(sets: np.ndarray, at: np.ndarray, similarity: Fraction
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the sets, the number of the set each belongs to, and whether it is one for
    the next band (two sets that both have it so also meet in their own band).

    A part with a pair of sub-parts of fewer than two elements is light. A set with no more light
    parts than there are parts beyond differ / 2 + 1 has a full one among those it shares with any
    similar set, so signatures of less than two elements are left out, by both sets alike; a set
    with more light parts keeps all of its own. Signatures of less than two elements are odd
    numbers, others even.
    """
    found, owners, upper = [], [], []
    value = mix(sets ^ np.uint64(0xA0761D6478BD642F))
    for step, cut in enumerate(_cuts(sets, at, similarity)):
        v = value[cut.mine]
        n = 3 * len(cut.pair_of)
        lows = np.bincount(cut.cell, (v & np.uint64(0xFFFFFFFF)).astype(float), n).astype(np.uint64)
        highs = np.bincount(cut.cell, (v >> np.uint64(32)).astype(float), n).astype(np.uint64)
        sums = (lows + (highs << np.uint64(32))).reshape(-1, 3)
        first = np.cumsum(cut.parts) - cut.parts
        number = np.arange(len(cut.pair_of)) - first[cut.pair_of]
        label = (cut.tag[cut.pair_of].astype(np.uint64) << np.uint64(40)) \
            + number.astype(np.uint64) * np.uint64(3)
        for k, (a, b) in enumerate(_BOTH):
            few = cut.held[:, k] < _LIGHT
            keep = cut.keep_all[cut.pair_of] | ~few
            sig = mix(sums[keep, a] + sums[keep, b] + mix(label[keep] + np.uint64(k)))
            found.append(sig & ~np.uint64(1) | few[keep].astype(np.uint64))
            owners.append(cut.pair_of[keep])
            upper.append(np.full(len(owners[-1]), bool(step)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(found), np.concatenate(owners), np.concatenate(upper)


def sure_parts(sets: np.ndarray, at: np.ndarray, similarity: Fraction
               ) -> tuple[np.ndarray, np.ndarray]:
    """Per set, in its own band and in the next: parts less those whose signatures may be left out.

    Sets that differ in d elements share a signature in all parts but d // 2, and both leave it out
    only if the part is light in both. So they have at least the smaller of their two numbers, less
    d // 2, of signatures in common.
    """
    sure = [np.where(cut.keep_all, cut.parts, cut.parts - cut.light)
            for cut in _cuts(sets, at, similarity)]
    none = np.zeros(len(at) - 1, np.int64)
    return (sure[0], sure[1]) if sure else (none, none)


def spare_signatures(sets: np.ndarray, at: np.ndarray, similarity: Fraction
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per set, in its own band and in the next: how many of its signatures may be left out, if all
    sets leave out the first in one order; and whether it keeps all signatures up to then.

    A set with sure parts ``s`` that differs in at most ``d`` elements from a similar one shares at
    least ``s - d // 2`` signatures with it: all its signatures are there or, if it lacks the light
    ones, none of these are counted. With one order for all, the last of the shared ones is behind
    ``s - d // 2 - 1`` others in both sets, so that many of each set's first can go. Sets that lack
    light signatures share heavy ones only, so one that keeps all may leave out light ones alone.
    """
    cuts = list(_cuts(sets, at, similarity))
    none = np.zeros(len(at) - 1, np.int64)
    if not cuts:
        return none, none, none.astype(bool), none.astype(bool)
    spare = [np.maximum(sure - cut.differ // 2 - 1, 0)
             for sure, cut in zip(sure_parts(sets, at, similarity), cuts)]
    return spare[0], spare[1], cuts[0].keep_all, cuts[1].keep_all


def _fingerprint(sets: np.ndarray, owner: np.ndarray, n: int, salt: int = 0x1234567) -> np.ndarray:
    """A 64-bit number of each set that depends on all of its elements and nothing else."""
    v = mix(sets ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64))
    lows = np.bincount(owner, (v & np.uint64(0xFFFFFFFF)).astype(float), n)
    highs = np.bincount(owner, (v >> np.uint64(32)).astype(float), n)
    return mix(lows.astype(np.uint64) + (highs.astype(np.uint64) << np.uint64(32))).view(np.int64)


def long_sketches(sets: np.ndarray, at: np.ndarray, similarity: Fraction) -> list[bytes]:
    """Parities of the elements that fall on each bit, with at least four bits for every
    difference that a similar set may have. Twice the bits, folded, are half the bits' sketch."""
    p, q = similarity.numerator, similarity.denominator
    sizes = np.diff(at)
    wanted = np.maximum(4 * (2 * (q - p) * sizes // (q + p)), 64 * _SKETCH)
    bits = np.int64(1) << np.ceil(np.log2(wanted)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = (mix(sets + np.uint64(99)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(first[owner] + place, minlength=int(first[-1])) & 1).astype(np.uint8)
    packed, cut = np.packbits(odd).tobytes(), (first // 8).tolist()
    return [packed[i:j] for i, j in zip(cut[:-1], cut[1:])]


def _features(batches: Iterator[pa.RecordBatch], words: int,
              similarity: Fraction) -> Iterator[pa.RecordBatch]:
    """Per document: size of its set, a fingerprint of it, its sure parts and what it may leave out,
    and sketches: bits that are the parity of the elements that fall on them, so two sketches differ
    in no more bits than their sets. The short ones (512 bits) are compared in joins, the long ones
    before sets are."""
    for part in slices(batches):
        sets, at = shingle_sets(part.column("text"), words)
        n = len(at) - 1
        owner = np.repeat(np.arange(n), np.diff(at))
        columns = {"doc_id": part.column("doc_id"), "n": pa.array(np.diff(at), pa.int64())}
        for name, salt in (("f1", 0x1234567), ("f2", 0x89ABCDEF)):
            columns[name] = pa.array(_fingerprint(sets, owner, n, salt), pa.int64())
        bits = 64 * _SKETCH
        bit = (mix(sets + np.uint64(99)) % np.uint64(bits)).astype(np.int64)
        parity = (np.bincount(owner * bits + bit, minlength=n * bits) & 1).astype(np.uint8)
        longs = np.packbits(parity.reshape(n, bits), axis=1).view(np.int64).reshape(n, _SKETCH)
        for k in range(_SKETCH):
            columns[f"s{k}"] = pa.array(np.ascontiguousarray(longs[:, k]), pa.int64())
        for name, sure in zip(_SURE, sure_parts(sets, at, similarity)):
            columns[name] = pa.array(sure, pa.int64())
        for name, left_out in zip(_LEFT_OUT, spare_signatures(sets, at, similarity)):
            columns[name] = pa.array(left_out.astype(np.int64), pa.int64())
        columns["sketch"] = pa.array(long_sketches(sets, at, similarity), pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def _signature_rows(batches: Iterator[pa.RecordBatch], words: int,
                    similarity: Fraction) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        sets, at = shingle_sets(part.column("text"), words)
        n = len(at) - 1
        owner = np.repeat(np.arange(n), np.diff(at))
        f1 = _fingerprint(sets, owner, n)
        found, owners, upper = signatures(sets, at, similarity)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64), pa.int64()), pa.array(f1[owners], pa.int64()),
             pa.array(upper)], ["sig", "f1", "upper"])


def _limit(a, b, similarity: Fraction):
    """Most differences of similar sets of these sizes."""
    p, q = similarity.numerator, similarity.denominator
    return F.floor((a + b) * F.lit(q - p) / F.lit(q + p))


def _near(left: str, right: str, similarity: Fraction):
    """Whether sizes and sketches of two rows leave room for the similarity."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    bits = sum((F.bit_count(F.col(f"{left}.s{k}").bitwiseXOR(F.col(f"{right}.s{k}")))
                for k in range(1, _SKETCH)),
               F.bit_count(F.col(f"{left}.s0").bitwiseXOR(F.col(f"{right}.s0"))))
    p, q = similarity.numerator, similarity.denominator
    return (a * q >= b * p) & (b * q >= a * p) & (bits <= _limit(a, b, similarity)), bits


def _shared_by_similar(left: str, right: str, similarity: Fraction):
    """Signatures that two rows' sets have in common at least if they are similar."""
    differ = _limit(F.col(f"{left}.n"), F.col(f"{right}.n"), similarity)
    return F.least(F.col(f"{left}.sure"), F.col(f"{right}.sure")) - F.floor(differ / 2)


def open_signatures(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """Signatures that sets of different groups have, with the group and the sure parts of the set
    in that band; ``gone`` are the common ones that :func:`spare_signatures` lets it leave out.

    The order for all sets: light ones that several sets have, then others, common ones first.
    What chance gives to many sets is light as a rule, so few rows are left that meet by chance.
    """
    ends = shared.join(placed.select("f1", "group"), "f1").groupBy("sig").agg(
        F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("many")).where(
        "low < high").select("sig", "many")

    def of_band(name):
        return F.when(F.col("upper"), F.col(f"{name}_next")).otherwise(F.col(name)).alias(name)

    several, light = F.col("many") > _RARE, F.col("sig").bitwiseAND(F.lit(1)) == 1
    rows = shared.join(ends, "sig").join(placed.select("f1", "group", *_SURE, *_LEFT_OUT), "f1").select(
        "sig", "f1", "upper", "group", several.alias("several"), light.alias("light"), "many",
        *[of_band(c) for c in ("sure", "spare", "whole")])
    place = F.row_number().over(Window.partitionBy("f1", "upper").orderBy(
        (F.col("several") & F.col("light")).desc(), F.desc("many"), "sig"))
    gone = (place <= F.col("spare")) & F.col("several") & (F.col("light") | (F.col("whole") == 0))
    return rows.select("sig", "f1", "upper", "group", "sure", gone.alias("gone"))


def _shared_signatures(docs: DataFrame, words: int, similarity: Fraction) -> DataFrame:
    """Signatures that different sets have, and the sets' fingerprints: sig, f1, upper (distinct).

    The one large shuffle of the job. A set's signatures are many and all different, so near
    copies that make up a third of all rows spread over as many keys; exact copies have one f1.
    """
    rows = docs.mapInArrow(lambda it: _signature_rows(it, words, similarity),
                           "sig long, f1 long, upper boolean")
    by_sig = Window.partitionBy("sig")
    order = by_sig.orderBy("f1")
    seen = rows.withColumn("last", F.lag("f1").over(order)).where(
        F.col("last").isNull() | (F.col("last") != F.col("f1"))).drop("last")
    shared = seen.withColumn("most", F.max("f1").over(by_sig)).withColumn(
        "least", F.min("f1").over(by_sig)).where("least <> most").drop("most", "least")
    return written(shared, "shared-signatures")


def _compare(batches: Iterator[pa.RecordBatch], similarity: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows of a group follow each other, its leader's first: pairs that are similar."""
    p, q = similarity.numerator, similarity.denominator
    group = leader = lead_id = None
    for batch in batches:
        a, b = [], []
        for lead, salt, member, head, raw in zip(*(batch.column(c).to_pylist() for c in (
                "lead", "salt", "f1", "head", "elements"))):
            elements = np.frombuffer(raw, np.uint64)
            if group != (lead, salt):
                group, leader, lead_id = (lead, salt), None, lead
            if head:
                leader = elements
                continue
            common = len(np.intersect1d(leader, elements, assume_unique=True))
            if q * common >= p * (len(leader) + len(elements) - common):
                a.append(lead_id)
                b.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         ["a", "b"])


def _elements(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        sets, at = shingle_sets(part.column("text"), words)
        n = len(at) - 1
        f1 = _fingerprint(sets, np.repeat(np.arange(n), np.diff(at)), n)
        raw = [sets[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(f1, pa.int64()), pa.array(raw, pa.binary())],
                                         ["f1", "elements"])


def sketch_distance(x: bytes, y: bytes) -> int:
    """Bits in which two long sketches differ; the longer one is folded to the shorter's length."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _alike(batches: Iterator[pa.RecordBatch], similarity: Fraction) -> Iterator[pa.RecordBatch]:
    """Pairs whose long sketches leave room for the similarity."""
    p, q = similarity.numerator, similarity.denominator
    for batch in batches:
        keep = [sketch_distance(x, y) * (q + p) <= (m + n) * (q - p) for m, n, x, y in zip(
            *(batch.column(c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b")))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int,
             similarity: Fraction) -> DataFrame:
    """Those of the pairs (a, b) of classes (by fingerprint) whose sets are similar.

    Long sketches come first: they are a fiftieth of the sets and drop nearly all pairs that are
    not similar. The rest are grouped by a; groups are dealt out in slices of about
    :data:`GROUP_ROWS`, so a task holds one leader's set and the row at hand however large a group
    is. A class's set is made from one text that has it.
    """
    def side(name):
        return classes.select(F.col("f1").alias(name), F.col("n").alias(f"n_{name}"),
                              F.col("sketch").alias(f"sketch_{name}"))

    hopeful = written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        lambda it: _alike(it, similarity), "a long, b long"), "hopeful-pairs")
    sizes = hopeful.groupBy("a").agg(F.count("*").alias("members"))
    salted = written(hopeful.join(sizes, "a").select(
        F.col("a").alias("lead"), F.col("b").alias("f1"), F.lit(False).alias("head"),
        F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / GROUP_ROWS)).cast("int").alias("salt")),
        "pairs")
    heads = salted.select("lead", "salt").distinct().select(
        "lead", F.col("lead").alias("f1"), F.lit(True).alias("head"), "salt")
    wanted = salted.select("f1").union(heads.select("f1")).distinct().join(
        classes.select("f1", F.col("rep").alias("doc_id")), "f1")
    # Rows that share a doc_id may have other sets than the one that is wanted.
    held = docs.join(wanted.select("doc_id").distinct(), "doc_id").mapInArrow(
        lambda it: _elements(it, words), "f1 long, elements binary")
    sets = held.join(wanted.select("f1"), "f1", "left_semi").groupBy("f1").agg(
        F.first("elements").alias("elements"))
    roles = salted.unionByName(heads).join(sets, "f1")
    grouped = roles.repartition(partitions(docs), "lead", "salt") \
        .sortWithinPartitions("lead", "salt", F.desc("head"), "f1")
    return written(grouped.mapInArrow(lambda it: _compare(it, similarity), "a long, b long"),
                   "links")


def _placed(firsts: DataFrame, joined: DataFrame) -> DataFrame:
    return firsts.join(joined, firsts["f1"] == joined["node"], "left").select(
        *[firsts[c] for c in firsts.columns], F.coalesce("component", "f1").alias("group"))


def similarity_classes(docs: DataFrame, words: int = 4,
                       similarity: Fraction = Fraction(85, 100)) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set of word n-grams), component_id
    (the smallest doc_id that links reach, its own included).

    Two documents link if their sets' Jaccard similarity reaches ``similarity``, which is compared
    in whole numbers. Documents of equal sets link and are one class, unless the sets are empty:
    null and empty texts, and texts of white space, link with nothing. Repeated rows give repeated
    results; rows that share a doc_id are taken as one node; a null doc_id is kept, with itself as
    component, and links with nothing. Empty input gives no rows; other columns are ignored.
    """
    texts = documents(docs)
    sketch = [f"s{k}" for k in range(_SKETCH)]
    features = written(texts.mapInArrow(
        lambda it: _features(it, words, similarity), "doc_id long, n long, f1 long, f2 long, " +
        ", ".join(f"{c} long" for c in (*sketch, *_SURE, *_LEFT_OUT)) + ", sketch binary"), "features")
    known = features.where("doc_id IS NOT NULL AND n > 0")
    # A class is a set; its fingerprint stands for it.
    classes = written(known.groupBy("f1").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in (
            "n", *sketch, *_SURE, *_LEFT_OUT, "sketch")]), "classes")
    # Rows that share a doc_id are one node, so their classes belong together.
    ids = known.select("doc_id", "f1")
    several = ids.groupBy("doc_id").agg(F.min("f1").alias("b"), F.max("f1").alias("most")).where(
        "b <> most")
    one_node = written(ids.join(several, "doc_id").select(F.col("f1").alias("a"), "b").where(
        "a <> b").distinct(), "shared-ids")
    shared = _shared_signatures(texts.where("doc_id IS NOT NULL"), words, similarity)
    firsts = classes.select("f1", "n", *sketch, *_SURE, *_LEFT_OUT)
    near, bits = _near("x", "y", similarity)

    # Some rounds: in each signature, sets of another component than its leader's (another one in
    # each round) may link to the leader; of a set's leaders, the two most alike are compared.
    placed = written(firsts.withColumn("group", F.col("f1")), "placed")
    links = one_node
    for turn in range(ROUNDS):
        lead = F.struct(F.xxhash64("f1", F.lit(turn)), "f1", "group")
        rows = shared.select("sig", "f1").join(placed.select("f1", "group"), "f1")
        leads = rows.withColumn("lead", F.min(lead).over(Window.partitionBy("sig"))).where(
            "group <> lead.group").select("f1", F.col("lead.f1").alias("lead")).distinct()
        met = leads.join(firsts.alias("x"), "f1").select(
            F.col("lead").alias("f1"), F.struct(F.col("x.f1").alias("f1"), "n", *sketch).alias("x"))
        met = met.join(firsts.alias("y"), "f1").where(near).select(
            F.col("y.f1").alias("a"), F.col("x.f1").alias("b"), bits.alias("bits"))
        alike = F.row_number().over(Window.partitionBy("b").orderBy("bits", "a"))
        best = written(met.withColumn("place", alike).where("place <= 2").select("a", "b"), "best")
        links = links.union(verified(best, classes, texts, words, similarity))
        placed = written(_placed(firsts, components(links)), "placed")

    # All pairs of a signature that are still in different components and may be alike, if they
    # share as many signatures as similar sets do: large sets have many, and chance shares few.
    open_rows = written(open_signatures(shared, placed).join(
        placed.select("f1", "n", *sketch), "f1"), "open-signatures")
    kept = open_rows.where("NOT gone")
    met = written(kept.alias("x").join(kept.alias("y"), (
        F.col("x.sig") == F.col("y.sig")) & (F.col("x.group") < F.col("y.group")) & near
        & ~(F.col("x.upper") & F.col("y.upper"))).select(
        F.struct("x.f1", "x.upper").alias("x"), F.struct("y.f1", "y.upper").alias("y"),
        _shared_by_similar("x", "y", similarity).alias("wanted")).distinct(), "met-pairs")
    # All open signatures of the sets that met count, also those left out of the join.
    some = met.select("x.*").union(met.select("y.*")).distinct()
    lists = open_rows.join(some, ["f1", "upper"], "left_semi").groupBy("f1", "upper").agg(
        F.collect_list("sig").alias("sigs")).select(F.struct("f1", "upper").alias("set"), "sigs")
    pairs = met.join(lists.select(F.col("set").alias("x"), F.col("sigs").alias("of_x")), "x").join(
        lists.select(F.col("set").alias("y"), F.col("sigs").alias("of_y")), "y").where(
        F.size(F.array_intersect("of_x", "of_y")) >= F.col("wanted")).select(
        F.least("x.f1", "y.f1").alias("a"), F.greatest("x.f1", "y.f1").alias("b"))
    more = verified(pairs, classes, texts, words, similarity)
    final = components(links.union(more))

    grouped = written(classes.select("f1", "rep").join(
        final, F.col("f1") == F.col("node"), "left").select(
        "f1", "rep", F.coalesce("component", "f1").alias("group")), "groups")
    smallest = grouped.groupBy("group").agg(F.min("rep").alias("component_id"))
    named = grouped.select("f1", "group").join(smallest, "group").select("f1", "component_id")
    linked = known.select("doc_id", "n", "f1").join(named, "f1").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = features.where("doc_id IS NULL OR n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
