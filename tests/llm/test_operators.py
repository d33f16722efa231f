"""The ten operators against brute force on small tables with nulls, empty and long texts, ties,
repeated rows and extra columns of clashing names."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import (extraction, licences, mixing, packing, page_tree, partenum,
                           quality_rules, repeats, token_planes, topk, toxicity)

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = [f"word{k}" for k in range(400)]
#: Names that operators use inside, as columns of the input.
CLASHES = ("row", "size", "words", "n", "rep", "component", "hits", "spans", "bin", "of", "lead")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHES)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts():
    rng = random.Random(3)
    base = [sentence(rng, rng.randint(1, 120)) for _ in range(25)]
    passage = sentence(rng, 30)
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100, base[3]), (101, base[3] + " tail"), (102, "ä " + base[4].replace("word9", "x")),
             (103, None), (104, ""), (105, "   \n\t"), (106, passage + " one " + passage),
             (107, "é" + passage + " two"), (108, "a b c"), (109, "a b c"),
             (110, sentence(rng, 9000)), (110, base[5]), (111, base[6]), (111, base[6]),
             (112, "x" * 500), (None, base[7]), (None, None),
             (113, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights reserved"),
             (114, "GNU General Public License, version 3"), (115, "Ünïcode 漢字 ✓ <|x|> #tag")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, f"s{(i or 0) % 3}" if i else None, None, *["c"] * len(CLASHES))
         for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, texts())


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, texts()).limit(0)


def ordered(rows):
    return sorted(map(repr, rows))


def brute_repeats(rows):
    """doc_id, bytes, removed bytes, removed runs and hash of the rest of every row."""
    starts = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 99):
            key = (-1 if i is None else i, p)
            starts[data[p:p + 100]] = min(starts.get(data[p:p + 100], key), key)
    want = []
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 99):
            if starts[data[p:p + 100]] < (-1 if i is None else i, p):
                gone[p:p + 100] = [True] * 100
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return want


def repeat_digests(docs):
    return map(tuple, repeats.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def test_repeats(docs, empty):
    want = brute_repeats(texts())
    assert ordered(repeat_digests(docs)) == ordered(want)
    assert sum(w[2] for w in want) > 0
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_of_many_copies(spark):
    """A passage of a third of all rows, in falling, negative and missing doc_ids, next to and far
    from each other, alone and within other text."""
    rng = random.Random(8)
    passage = sentence(rng, 60)
    rows = [(150 - k, passage if k % 9 == 0 else f"{sentence(rng, k % 7)} {passage} {k % 5}"
             if k % 3 == 0 else sentence(rng, 25)) for k in range(300)]
    rows += [(None, passage), (-2**63, passage), (None, "x " + passage), (-2**63, passage + passage)]
    want = [(None if i == -2**64 else i, *rest) for i, *rest in brute_repeats(
        [(-2**64 if i is None else i, t) for i, t in rows])]
    assert ordered(repeat_digests(frame(spark, rows))) == ordered(want)


def test_known_repeats_leave_the_first_row():
    """Of each group the smallest (doc_id, start) stays, equal ones too; no doc_id comes first."""
    a = np.array([7, 7, 7, 7, 5, 7, 7], np.uint64)
    w = np.array([1, 1, 1, 2, 1, 1, 2], np.uint64)
    known = repeats._repeated_here(a, w, np.array([True, True, False, True, True, False, True]),
                                   np.array([3, -4, 0, 9, 3, 0, 9]), np.array([0, 0, 6, 1, 0, 6, 0]))
    assert known.tolist() == [True, True, False, True, False, False, False]
    assert repeats._repeated_here(*[x[:0] for x in (a, w, a > 0, a, a)]).tolist() == []


def test_repeated_strings_without_sorting_keys(monkeypatch):
    """Rows of equal strings stand together, so the earliest start is a minimum, not a sort."""
    monkeypatch.setattr(repeats.np, "lexsort", None)
    rng = np.random.default_rng(4)
    for length in (2, 3, 5, 9):
        parts = [bytes(rng.integers(97, 99, rng.integers(0, 12), dtype=np.uint8)) for _ in range(4)]
        pieces = [b"".join(parts[i] for i in rng.integers(0, 4, 3)) for _ in range(12)]
        keys = [(k // 2, 5 * (k % 2) + i) for k, p in enumerate(pieces) for i in range(len(p))]
        strings = [p[i:i + length] for p in pieces for i in range(len(p))]
        first = {}
        for text, key in zip(strings, keys):
            if len(text) == length:
                first[text] = min(key, first.get(text, key))
        want = [len(text) == length and first[text] < key for text, key in zip(strings, keys)]
        assert repeats.repeated_strings(pieces, np.array(keys), length).tolist() == want
    assert repeats.repeated_strings([b"ab"], np.array([[0, 0], [0, 1]]), 3).tolist() == [False] * 2


def test_mixing(docs, empty):
    got = mixing.mix_sources(docs).toPandas()
    again = mixing.mix_sources(docs).toPandas()
    key = ["doc_id", "row", "copies"]
    assert ordered(got[key].values.tolist()) == ordered(again[key].values.tolist())
    assert len(got) == len(texts())
    counted = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts()]
    assert sorted(got["size"]) == sorted(counted)
    assert (got["taken"] <= 3 * got["size"]).all()
    for _, part in got.groupby(got["source"].fillna("")):
        assert part["target"].iloc[0] <= 3 * part["size"].sum() + 1e-6
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 2 * part["size"].max()
    assert math.isclose(got.groupby(got["source"].fillna(""))["target"].first().sum(),
                        sum(counted))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == got["copies"].sum()
    assert mixing.mix_sources(empty).count() == 0


def test_toxicity_held_out(spark, empty):
    rng = random.Random(1)
    insults = ["blorkhead", "snarfwit", "grumplestink"]
    rows, labels = [], []
    for k in range(400):
        words = sentence(rng, 30).split()
        if k % 4 == 1:
            bad = rng.choice(insults)
            cut = rng.randrange(1, len(bad))
            words[rng.randrange(30)] = bad[:cut] + rng.choice(["", "x", "-"]) + bad[cut:]
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 1)))
    rows += [(1000, None), (1001, ""), (1001, "")]
    docs = frame(spark, rows)
    model = toxicity.fit_labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [tuple(r) for r in toxicity.toxicity_scores(docs, model).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    held = [(s >= 0.3) == (i % 4 == 1) for i, s in got
            if i < 400 and zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 60 and np.mean(held) > 0.9
    nothing = toxicity.fit_labelled(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.toxicity_scores(empty, nothing).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for i, text in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            here = np.array(ids[start:start + 4096], "<u4")
            want.append((i, piece, start, len(here), zlib.crc32(here.tobytes())))
    got = packing.pack_documents(docs, path, 1).toPandas()
    found = [(None if math.isnan(r[0]) else int(r[0]), *map(int, r[1:])) for r in got[
        ["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert ordered(found) == ordered(want)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum()[:-1].tolist()]
        assert part["length"].sum() <= 4096
    lengths = got["length"].to_numpy()
    assert packing.lower_bound(lengths, 4096) <= got["sequence_id"].nunique() <= \
        packing.lower_bound(lengths, 4096) + 1
    assert packing.pack_documents(empty, path, 1).count() == 0


def test_token_planes(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [r for r in texts() if r[0] is not None]
    token_planes.write_tokens(docs.where("doc_id IS NOT NULL"), str(tmp_path / "t"), path, 0)
    got = [tuple(r)[:4] for r in token_planes.document_checksums(
        spark, str(tmp_path / "t")).collect()]
    want = [(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in (
        (i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)]
    assert ordered((i, n, crc) for i, _, n, crc in got) == ordered(want)
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(r[0] for r in got)
    token_planes.write_tokens(empty, str(tmp_path / "e"), path, 0)
    assert token_planes.document_checksums(spark, str(tmp_path / "e")).count() == 0
    ids = np.array([0, 1, 2**32 - 1, 77], np.uint32)
    for width in (1, 8):
        assert (token_planes.from_planes(token_planes.to_planes(ids, width), 4, width)
                == ids).all()


def test_licences(docs, empty):
    want = []
    for i, text in texts():
        lowered = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places, base, every, most = [], set(), set(), {}
        for p in licences.PHRASES:
            parts = p.words.split()
            found = [k for k in range(len(words)) if words[k:k + len(parts)] == parts]
            if found:
                every.add(p.label)
                most[p.label] = max(most.get(p.label, 0), len(parts))
                if p.base:
                    base.add(p.label)
                    places += found
        e = sum(most.values())
        want.append((i, len(words), len(places), min(places, default=None),
                     max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)),
                     e / (e + 4)))
    got = licences.licence_phrases(docs).drop("found")
    assert ordered(map(tuple, got.collect())) == ordered(want)
    assert "python" not in got._jdf.queryExecution().executedPlan().toString().lower()
    assert licences.licence_phrases(empty).count() == 0


PAGES = {
    "<html><body><nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>A &amp; B</h1><p>One "
    "<b>bold</b>\n  text<br>more<p>Short.<div class='ad'>Buy now</div><ul><li>item one<li>item two"
    "</ul></article><footer>&copy; site</footer></body></html>":
    "A & B\nOne bold text more\nShort.\nitem one\nitem two",
    "<div class=sidebar><p>Most read stories</p></div><div class=\"post-content\"><p>Plain words "
    "of an article that goes on for a while.</p><script>x='<p>no</p>'</script><p>The end.</p></div>"
    "<div id=comments><h3>Comments</h3><p>Nice one</p></div>":
    "Plain words of an article that goes on for a while.\nThe end.",
    "": "", None: "", "<<<>< a <b": None, "<p " + "a=\"" * 500: None, "<div>" * 3000 + "x": None}


def test_pages(spark):
    rng = random.Random(2)
    prose = ["\n".join(sentence(rng, rng.randint(3, 60)).capitalize() + "."
                       for _ in range(rng.randint(1, 12))) for _ in range(80)]
    model = extraction.train(list(extraction.labelled_pages(prose, 500)))
    pages = spark.createDataFrame([(k, None, h, "x") for k, h in enumerate(PAGES)] * 2,
                                  "page_id long, url string, html string, text string")
    got = extraction.extracted_pages(pages, model).collect()
    assert len(got) == 2 * len(PAGES)
    for row in got:
        want = list(PAGES.values())[row["page_id"]]
        assert want is None or row["text"] == want
        assert row["n_chars"] == len(row["text"])
    assert extraction.extracted_pages(pages.limit(0), model).count() == 0
    right = total = 0
    for nodes, labels in extraction.labelled_pages(prose, 150, seed=77):
        odds = np.array(model.marginals(nodes))
        own = np.array([bool(n.runs) for n in nodes])
        right += ((odds > 0) == labels)[own].sum()
        total += own.sum()
    assert right / total > 0.97


def test_marginals_are_exact():
    nodes = page_tree.parse("<div><p>a</p><ul class=menu><li>b<li>c</ul></div><p>d</p>")
    rng = np.random.default_rng(1)
    model = extraction.Model({"menu": 0}, rng.normal(size=page_tree.N_FEATURES + 1),
                             np.array([0.7, 1.1, 0.4]))
    fields = [model.weights[f].sum() for f in page_tree.features(nodes, model.names)]
    mass = np.zeros((len(nodes), 2))
    for code in range(2 ** len(nodes)):
        s = np.array([code >> k & 1 for k in range(len(nodes))])
        energy = sum(h * v for h, v in zip(fields, s)) + sum(
            model.coupling[page_tree.GROUPS.get(n.tag, 2)] * (2 * s[k] - 1) * (2 * s[n.parent] - 1)
            for k, n in enumerate(nodes) if k)
        mass[np.arange(len(nodes)), s] += math.exp(energy)
    assert np.allclose(model.marginals(nodes), np.log(mass[:, 1] / mass[:, 0]), atol=1e-6)


def test_quality(docs, empty):
    want = []
    for i, text in texts():
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        lines = text.split("\n")
        again = sum(bool(x.strip()) and x in lines[:k] for k, x in enumerate(lines))
        want.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                     again, len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)))
    got = quality_rules.quality_verdicts(
        docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert ordered(tuple(r)[:7] for r in got) == ordered(want)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.quality_verdicts(
        empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_quality_of_junk(spark):
    rng = random.Random(4)
    rows = [(1, "The sun rose over the quiet hills while farmers walked to their distant fields, "
                "carrying tools and bread for a long day of work under the warm summer sky."),
            (2, " ".join("".join(rng.choice("\x80\x81ꙮ꙰𐎠𐎡") for _ in range(6)) for _ in range(40)))]
    got = {r["doc_id"]: r for r in quality_rules.quality_verdicts(
        frame(spark, rows), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got[1]["kept"] and got[2]["byte_share"] > 0.5


@pytest.mark.parametrize("words, similarity", [(4, Fraction(85, 100)), (5, Fraction(8, 10))])
def test_similarity_classes(spark, empty, words, similarity):
    rng = random.Random(9)
    rows = texts()
    for g in range(12):
        parts = sentence(rng, rng.randint(10, 150)).split()
        for k in range(6):
            changed = parts[:]
            for _ in range(rng.randint(0, 2)):
                changed[rng.randrange(len(changed))] = rng.choice(WORDS)
            rows.append((1000 + 10 * g + k, " ".join(changed)))
    # A near copy of a long text, and ids that several rows share, with other texts or none.
    long = [t for i, t in rows if i == 110][0].split()
    rows += [(2000, " ".join(long[:4000] + ["word0"] * 40 + long[4000:])), (2001, " ".join(long[3000:]))]
    for k in range(40):
        base = sentence(rng, 90)
        rows += [(3000 + k % 13, base), (4000 + k, base + " tail"), (3000 + k % 7, None)]
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c.group().lower(),
                                                     text or ""))
        sets.append({tuple(w[k:k + words]) for k in range(max(len(w) - words + 1, 1))}
                    if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    full = [(i, s) for (i, _), s in zip(rows, sets) if i is not None and s]
    for k, (a, x) in enumerate(full):
        for b, y in full[:k]:
            if similarity * max(len(x), len(y)) <= min(len(x), len(y)) \
                    and len(x & y) >= similarity * len(x | y):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    got = partenum.similarity_classes(frame(spark, rows), words, similarity).collect()
    want = [(i, len(s), None if i is None else top(i) if s else i) for (i, _), s in zip(rows, sets)]
    assert ordered(tuple(r)[:2] + (r["component_id"],) for r in got) == ordered(want)
    assert top(2000) == top(110) and partenum.similarity_classes(
        empty, words, similarity).count() == 0


def test_sketches_never_reject_similar_sets():
    """Folded sketches of sets of neighbouring sizes differ in no more bits than the sets."""
    rng = np.random.default_rng(8)
    for n in (3, 40, 130, 700, 5000):
        for similarity in (Fraction(8, 10), Fraction(85, 100)):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[len(a) // 12:], rng.integers(0, 2**63, n // 14 + 1,
                                                                         dtype=np.uint64)]))
            x, y = partenum.long_sketches(np.concatenate([a, b]),
                                          np.array([0, len(a), len(a) + len(b)]), similarity)
            apart = len(np.setxor1d(a, b))
            assert partenum.sketch_distance(x, y) <= apart
            assert partenum.sketch_distance(x, y) >= 0.7 * apart - 3


def test_similar_sets_share_as_many_signatures_as_asked():
    rng, similarity, seen = np.random.default_rng(6), Fraction(8, 10), 0
    for n in (3, 12, 40, 150, 900, 2500):
        for _ in range(12):
            base = rng.integers(0, 2**63, n, dtype=np.uint64)
            more = rng.integers(0, 2**63, rng.integers(0, n // 9 + 2), dtype=np.uint64)
            pair = [base[rng.integers(0, n // 9 + 1):], np.concatenate([base, more])]
            pair = [np.unique(x) for x in pair]
            sizes = [len(x) for x in pair]
            common, sets = len(np.intersect1d(*pair)), np.concatenate(pair)
            if common * 5 < 4 * (sum(sizes) - common) or common == max(sizes):
                continue
            at = np.array([0, sizes[0], sum(sizes)])
            found, owner, upper = partenum.signatures(sets, at, similarity)
            sure = partenum.sure_parts(sets, at, similarity)
            mine, other = (dict(zip(found[owner == k].tolist(), upper[owner == k].tolist()))
                           for k in (0, 1))
            met = [(mine[x], other[x]) for x in mine if x in other and not (mine[x] and other[x])]
            (a, b), = set(met)
            assert len(met) >= min(sure[int(a)][0], sure[int(b)][1]) - sum(sizes) // 9 // 2
            seen += 1
    assert seen > 30


def test_chance_signatures_make_no_pairs(spark, monkeypatch):
    """Large sets with a passage in common share a few signatures; similar ones share many."""
    rng, asked, real = random.Random(9), [], partenum.verified

    def verified(pairs, *more):
        asked.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(partenum, "verified", verified)
    words = [f"w{k}" for k in range(100_000)]
    shared = rng.sample(words, 900)
    rows = [(k, " ".join(shared + rng.sample(words, 600))) for k in range(30)]
    found = partenum.similarity_classes(frame(spark, rows), 5, Fraction(8, 10)).collect()
    assert all(r["doc_id"] == r["component_id"] for r in found)
    assert sum(asked[:-1]) > 0 and asked[-1] == 0


def test_common_signatures_are_left_out_and_no_link(spark, monkeypatch):
    """The last join alone finds all links, though what chance gives to many sets isn't joined."""
    rng, held, real = random.Random(12), [], partenum.written

    def written(df, name, *more):
        out = real(df, name, *more)
        held.extend([out] if name == "open-signatures" else [])
        return out

    monkeypatch.setattr(partenum, "written", written)
    monkeypatch.setattr(partenum, "ROUNDS", 0)
    words, rows = [f"w{k}" for k in range(100_000)], []
    for k in range(150):
        text = rng.sample(words, rng.choice((60, 250, 1150, 1150, 1150)))
        near = text[:len(text) - rng.randint(0, 20)]
        for at in rng.sample(range(len(near)), max(len(near) // 60 + rng.randint(-3, 6), 0)):
            near[at] = "changed"
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(near))]
    found = {r["doc_id"]: r["component_id"] for r in partenum.similarity_classes(
        frame(spark, rows), 5, Fraction(8, 10)).collect()}
    linked = 0
    for (a, x), (b, y) in zip(rows[::2], rows[1::2]):
        x, y = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (x.split(), y.split()))
        alike = 5 * len(x & y) >= 4 * len(x | y)
        assert found[a] == a and found[b] == (a if alike else b)
        linked += alike
    assert 30 < linked < 140
    table, = held
    table = table.where("NOT gone") if "gone" in table.columns else table
    met = table.groupBy("sig").count().where("count > 2").selectExpr(
        "coalesce(sum(count * (count - 1) / 2), 0)").first()[0]
    assert met < 1000


def test_top_k(spark):
    rng = np.random.default_rng(5)
    data = [(k, rng.normal(size=16).astype(float).tolist()) for k in range(300)]
    data[7] = (7, data[8][1])
    data += [(1000, None), (1001, [None] * 16), (1002, [float("nan")] * 16)]
    vectors = topk.integer_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, 5)
    whole = np.floor(np.array([v for _, v in data[:300]]) * 256).astype(int)
    want = []
    for q in range(0, 300, 50):
        best = sorted((-int(whole[q] @ whole[x]), x) for x in range(300) if x != q)[:5]
        want += [(q, r + 1, x, -s) for r, (s, x) in enumerate(best)]
    assert ordered(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) \
        == ordered(want)
    assert topk.top_k(vectors.limit(0), vectors, 5).count() == 0
