"""Token alignment against both libraries on whole texts, pair by pair."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlens.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_of_letter():
    """The published table of byte-level vocabularies."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
            *range(ord("®"), ord("ÿ") + 1)]
    table, more = {chr(b): b for b in kept}, 0
    for b in range(256):
        if b not in kept:
            table[chr(256 + more)] = b
            more += 1
    return table


def groups(text, libraries, letters=byte_of_letter()):
    """Groups of whole-text encodings; None if there are no tokens."""
    if not text:
        return None
    a, b = libraries
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
             else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum(list(map(len, raw_a))), np.cumsum(list(map(len, raw_b)))
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        k, m = i + int((ends_a[i:] <= end).sum()), j + int((ends_b[j:] <= end).sum())
        out.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return out


def expected(rows, libraries):
    distinct = {t: groups(t, libraries) for _, t in rows}
    pairs = {t: [(x, y) for p, q in g for x in p for y in q] if g else []
             for t, g in distinct.items()}
    counts, best = Counter(), defaultdict(int)
    for _, t in rows:
        counts.update(set(pairs[t]))
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for i, t in rows:
        g, found = distinct[t], pairs[t]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q))
                           for p, q in g or [])
        out.append((i, sum(len(p) for p, _ in g or []), sum(len(q) for _, q in g or []),
                    len(g or []), len(found), sum(counts[x] == best[x[0]] for x in found),
                    sum(counts[x] for x in found),
                    hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return out


def hostile():
    rng = random.Random(4)
    letters = " \n\t᠎▁ab.'s\x85 \r　\x1c漢"
    texts = ["", "  ", "\n", "\n\nx", "a  b", "x \n y", "▁x y", "a<|endoftext|>b <s> </s>",
             "᠎ a", "x᠎ b", "\x1c b", "漢字 \U0001F600 z", "don't we'll", "é ½ ﬁ",
             "<0x41> x", "\r\n x\r\n", "a\x00b c", "x y　 z", "trail ", None, "y" * 5000,
             " ".join(f"w{k % 97}" for k in range(30_000))]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(600)]
    return [(k, t) for k, t in enumerate(texts)] + \
        [(5000 + k, "the very same text, often") for k in range(400)] + \
        [(7, "another text of row seven"), (7, "another text of row seven"), (None, "no id"),
         (None, None)]


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_against_libraries(spark, libraries):
    rows = hostile()
    clashes = ("key", "copies", "hot", "found", "n", "a", "b")
    frame = spark.createDataFrame(
        [(i, t, *["c"] * len(clashes)) for i, t in rows],
        "doc_id long, text string, " + ", ".join(f"{c} string" for c in clashes)).repartition(4)
    got = alignment.align_documents(frame, A, B).select("doc_id", *COLUMNS).collect()
    assert sort(map(tuple, got)) == sort(expected(rows, libraries))


def test_several_blocks_of_pairs(spark, libraries, monkeypatch):
    """More pairs than one broadcast holds are taken in more passes, with the same result."""
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 40)
    rows = [(k, t) for k, t in enumerate(["one two three", "three two one", "zwölf Boxkämpfer",
                                          "quick brown fox", "quick brown fox", "漢字"] * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.align_documents(frame, A, B).select("doc_id", *COLUMNS).collect()
    assert sort(map(tuple, got)) == sort(expected(rows, libraries))


def test_memory_starts_anew(monkeypatch, libraries):
    """Bounded memories change nothing in what a task gives."""
    import pyarrow as pa
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "übel\n", "x" * 9])
                      + str(rng.randint(0, 300)) for _ in range(60)) for _ in range(80)]

    def run():
        batches = [pa.RecordBatch.from_pydict(
            {"key": [t.encode() for t in texts[k:k + 10]], "copies": [2] * 10,
             "text": texts[k:k + 10]}) for k in range(0, 80, 10)]
        rows = [r for b in alignment._align_texts(iter(batches), A, B) for r in b.to_pylist()]
        counts = Counter()
        for r in rows:
            if r["key"] is None:
                counts.update(dict(zip(np.frombuffer(r["pairs"], "<i4").tolist(),
                                       np.frombuffer(r["counts"], "<i8").tolist())))
        return {r["key"]: r["groups_sha256"] for r in rows if r["key"]}, counts

    whole = run()
    monkeypatch.setattr(alignment, "MEMORY", 50)
    monkeypatch.setattr(alignment, "PAIRS", 100)
    assert run() == whole


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(frame, A, B).collect() == []
    frame = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    rows = alignment.align_documents(frame, A, B).select("doc_id", *COLUMNS).collect()
    assert sort(map(tuple, rows)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
