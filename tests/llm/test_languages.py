"""Language mixtures: counts and likelihoods by hand, held-out accuracy, edge cases."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import languages

SF = "/root/testdata/sf0.01"


def test_counts_against_plain_python():
    rng = random.Random(3)
    texts = ["", "a", "ab", "Abc", "  ab--cd EF", "漢字漢", "x\n\ny", "ÉTÉ été", "1234 !?", "ſ İ"]
    texts += ["".join(rng.choice("aBc é.-1") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    owner, cell, counts = languages.ngram_counts(texts)
    got = {}
    for o, c, n in zip(owner.tolist(), cell.tolist(), counts.tolist()):
        got.setdefault(o, Counter())[c] += n
    assert (np.diff(owner) >= 0).all()
    for k, text in enumerate(texts):
        folded, gap = b" ", True
        for b in text.lower().encode():
            if 0x61 <= b <= 0x7A or b >= 0x80:
                folded, gap = folded + bytes([b]), False
            elif not gap:
                folded, gap = folded + b" ", True
        folded += b"" if gap else b" "
        want = Counter()
        for i in range(len(folded) - 2):
            if folded[i + 1:i + 2] != b" ":
                code = np.array([int.from_bytes(folded[i:i + 3], "big")], np.uint64)
                want[int(languages.mix(code)[0] % np.uint64(languages.CELLS))] += 1
        assert got.get(k, Counter()) == want, text


def test_shares_reach_the_maximum():
    """No shares on a fine grid are likelier than those found."""
    rng = np.random.default_rng(1)
    logs = np.log(rng.dirichlet(np.ones(40), 2).T)
    counts = rng.integers(1, 9, 40)
    shares, found = languages.mixture(logs, counts, np.zeros(1, np.int64), rounds=400)
    grid = np.linspace(0, 1, 2001)[:, None]
    values = (counts * np.log(grid * np.exp(logs[:, 0]) + (1 - grid) * np.exp(logs[:, 1]))).sum(1)
    assert found[0] >= values.max() - 1e-6
    assert abs(shares[0, 0] - grid[values.argmax(), 0]) < 2e-3


def test_several_texts_at_once_are_as_one_by_one():
    rng = np.random.default_rng(2)
    logs, counts = np.log(rng.dirichlet(np.ones(30), 3).T), rng.integers(1, 9, 30)
    starts = np.array([0, 4, 19])
    together = languages.mixture(logs, counts, starts)
    for t, (i, j) in enumerate(zip(starts, [4, 19, 30])):
        alone = languages.mixture(logs[i:j], counts[i:j], np.zeros(1, np.int64))
        assert np.allclose(together[0][t], alone[0][0]) and np.isclose(together[1][t], alone[1][0])


@pytest.fixture(scope="module")
def model(spark):
    return languages.fit_languages(spark.read.parquet(f"{SF}/documents.parquet"))


def test_counts_cover_all_learning_rows_and_no_held_out_one(spark, model):
    import zlib
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    learn = [r for r in docs if r["text"] and r["lang"]
             and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0]
    counts = np.zeros((languages.CELLS, len(model.names)))
    owner, cell, n = languages.ngram_counts([r["text"] for r in learn])
    lang = np.array([model.names.index(r["lang"]) for r in learn])[owner]
    np.add.at(counts, (cell, lang), n)
    background = (counts.sum(1) + 1) / (counts.sum() + languages.CELLS)
    want = (counts + languages.PRIOR * background[:, None]) / (counts.sum(0) + languages.PRIOR)
    assert np.allclose(np.exp(model.logs), want)
    assert np.allclose(np.exp(model.logs).sum(0), 1)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = languages.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.withColumn("out", languages.held_out(found["doc_id"])).collect()
            if r["out"]]
    assert len(rows) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.99 * len(rows)
    assert sum("," not in r["languages"] for r in rows) >= 0.95 * len(rows)


def test_mixed_texts(spark, model):
    """Halves of two languages: both are found, with shares near their lengths."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 500").collect()
    by = {}
    for r in docs:
        by.setdefault(r["lang"], []).append(r["text"])
    rng, texts, want = random.Random(6), [], []
    for _ in range(60):
        a, b = rng.sample(sorted(by), 2)
        texts.append(rng.choice(by[a])[:400] + " " + rng.choice(by[b])[:400])
        want.append(",".join(sorted([a, b])))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})
    rows = [r for b in languages._predict(iter([batch]), model) for r in b.to_pylist()]
    right = [r for r, w in zip(rows, want) if r["languages"] == w]
    assert len(right) >= 55
    assert all(0.25 < min(r["shares"]) and abs(sum(r["shares"]) - 1) < 1e-9 for r in right)


def test_edge_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "1234 $$$ ...!"), (5, "the"), (5, "the"),
            (None, "und die nicht der " * 20_000), (6, "漢字"), (7, "a" * 300_000), (8, "x"), (9, "²½")]
    frame = spark.createDataFrame([(*r, "xx", "c", "c") for r in rows],
                                  "doc_id long, text string, lang string, score string, "
                                  "languages string")
    got = languages.predict_languages(frame, model).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(r[0] or 0 for r in rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (1, 2, 3, 4, 9))
    assert by[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all(r["lang_pred"] in model.names for r in got if r["doc_id"] not in (1, 2, 3, 4, 9))


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    found = languages.predict_languages(docs, languages.fit_languages(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)]
    empty = docs.limit(0)
    assert languages.predict_languages(empty, languages.fit_languages(empty)).collect() == []
