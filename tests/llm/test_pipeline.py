"""Stages of the pipeline on a small table: what goes, what stays, and the columns."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402

WORDS = [f"word{k}" for k in range(300)]


def test_stages(spark, tmp_path):
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    passage = prose(30)
    rows = [(k, prose(40) + (" grumplestink" if k % 5 == 0 else "")) for k in range(200)]
    rows += [(500, rows[1][1]), (501, rows[2][1] + " more"), (502, None), (503, ""),
             (504, "ä" + passage + " one " + prose(20)), (505, "é" + passage + " two " + prose(20))]
    docs = spark.createDataFrame([(i, t, None, f"s{i % 2}", 1, "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars int, row string")
    spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(0, 150)],
                          "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = {}
    for name, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
        docs = pipeline.written(docs, name)
        ids[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(ids["toxicity"]) == {i for i, _ in rows if i >= 200 or i % 5}
    assert set(ids["toxicity"]) - set(ids["near_duplicates"]) == {500, 501}
    before, after = ids["near_duplicates"], ids["suffix_array_dedup"]
    assert set(before) == set(after) and after[502] is None and after[503] == ""
    assert {i for i in before if before[i] != after[i]} == {505}
    assert passage[1:] not in after[505] and after[505].startswith("é")
    pieces = pipeline.best_fit_packing(spark, docs, str(tmp_path)).toPandas()
    assert len(pieces) == docs.count()
    assert (pieces.groupby("sequence_id")["length"].sum() <= 4096).all()


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, "
                                     "n_chars int")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_clashing_columns_pass_through(spark, tmp_path):
    """Columns of any name come out of every stage as they went in, null ids and repeated rows too."""
    names = ["_row", "_id", "_n", "_toxic", "_gone", "_kept", "_cut", "rejected", "copy", "kept",
             "text_hash", "cut_id", "n", "id", "document", "copies", "component_id", "score"]
    rng = random.Random(5)
    texts = {k: " ".join(rng.choice(WORDS) for _ in range(45)) for k in range(40)}
    rows = [(k, texts[k], "en", "s", len(texts[k]), *[f"{n}{k}" for n in names]) for k in texts]
    rows += [rows[3], rows[3], (None, "no id at all", None, None, 1, *["x"] * len(names)),
             (50, "word1 " * 30_000, "en", "s", 1, *["y"] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars int, " + ", ".join(f"`{n}` string" for n in names))
    spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(40)],
                          "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    columns, known = docs.columns, {r[5:] for r in rows}
    for name, stage in pipeline.STAGES[:4]:
        docs = pipeline.written(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
        found = docs.collect()
        assert found and {tuple(r)[5:] for r in found} <= known
        assert {r["doc_id"]: r["_row"] for r in found if r["doc_id"] is not None} == {
            r["doc_id"]: (f"_row{r['doc_id']}" if r["doc_id"] < 50 else "y")
            for r in found if r["doc_id"] is not None}


def test_run(spark, tmp_path):
    """The whole chain, as registered: every piece lies in a sequence without gap or overlap."""
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(60)), "en", f"s{k % 2}", 1)
            for k in range(80)]
    spark.createDataFrame(rows + [(100, rows[0][1], "en", "s0", 1)],
                          "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    pieces = pipeline.run(spark, str(tmp_path)).toPandas()
    assert 100 not in set(pieces["doc_id"])
    for _, group in pieces.sort_values("offset").groupby("sequence_id"):
        ends = group["offset"] + group["length"]
        assert group["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 4096
