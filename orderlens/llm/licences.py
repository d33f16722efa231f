"""Licence phrases in texts by a positional index of rare words.

Every phrase is posted under its words of highest inverse document frequency in the corpus, each
with its place in the phrase. A file's words that are posted are looked up; the starts they imply
are intersected by relative position; at the starts that are left, all words of the phrase, which
are mandatory, are verified. All of it is column expressions on one row; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Everything but letters, digits and characters beyond ASCII parts words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words under which a phrase is posted.
RARE_WORDS = 2


@dataclass(frozen=True)
class Phrase:
    """Words that stand consecutively, in lower case, parted by spaces; ``base`` phrases count
    towards places."""
    words: str
    label: str
    base: bool = False


# Wording of well-known licences.
PHRASES = (
    Phrase("cc by", "cc-by", True),
    Phrase("general public license", "gpl", True),
    Phrase("all rights reserved", "reserved", True),
    Phrase("cc by nc", "cc-by-nc"),
    Phrase("cc by sa", "cc-by-sa"),
    Phrase("cc by nd", "cc-by-nd"),
    Phrase("creative commons attribution", "cc-by"),
    Phrase("creative commons zero", "cc0"),
    Phrase("gnu general public license", "gnu-gpl"),
    Phrase("general public license version 2", "gpl-2"),
    Phrase("general public license version 3", "gpl-3"),
    Phrase("lesser general public license", "lgpl"),
    Phrase("affero general public license", "agpl"),
    Phrase("under the mit license", "mit"),
    Phrase("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    Phrase("under the apache license", "apache"),
    Phrase("apache license version 2 0", "apache-2"),
    Phrase("mozilla public license", "mpl"),
    Phrase("eclipse public license", "epl"),
    Phrase("redistribution and use in source and binary forms with or without modification",
           "bsd"),
    Phrase("released into the public domain", "public-domain"),
)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null: none.

    ``lower`` also lowers letters beyond ASCII, which are in no phrase; the one that would become
    a letter of ASCII (the Kelvin sign) is first made another."""
    plain = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("Å"))
    return F.array_remove(F.split(F.lower(plain), BETWEEN_WORDS), "")


def document_frequencies(docs: DataFrame, phrases=PHRASES) -> dict[str, int]:
    """Documents with each word of the phrases, counted over all documents. One number per word
    of the phrases comes to the driver."""
    known = sorted({w for p in phrases for w in p.words.split()})
    found = F.explode(F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, known))))
    counts = docs.select(found.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return dict.fromkeys(known, 0) | {r["word"]: r["n"] for r in counts.collect()}


def postings(frequencies: dict[str, int], phrases=PHRASES) -> list[list[tuple[int, str]]]:
    """Per phrase its rarest words with their places in it, rarest first. A smaller document
    frequency is a higher inverse one; ties go to the earlier word."""
    result = []
    for phrase in phrases:
        places: dict[str, int] = {}
        for at, word in enumerate(phrase.words.split()):
            places.setdefault(word, at)
        ranked = sorted((frequencies.get(w, 0), at, w) for w, at in places.items())
        # A word that stands twice in the phrase has no one place in it.
        single = [(at, w) for _, at, w in ranked if phrase.words.split().count(w) == 1]
        result.append(single[:RARE_WORDS])
    return result


def _implied(at: int, word: str) -> Column:
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - F.lit(at))


def _starts(phrase: Phrase, posted: list[tuple[int, str]]) -> Column:
    """Starts of the phrase in ``words``, ascending, from the looked-up places in ``hits``."""
    parts = phrase.words.split()
    implied = [_implied(at, word) for at, word in posted]
    both = implied[0]
    for more in implied[1:]:
        both = F.array_intersect(both, more)
    whole = F.array(*map(F.lit, parts))
    return F.filter(both, lambda s: (s >= 0) & (F.slice("words", s + 1, len(parts)) == whole))


def licence_phrases(docs: DataFrame, phrases=PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (all places of the base phrases), first_word
    and last_word (their smallest and largest start, words from 0; null if none), base_labels and
    labels (distinct, sorted, comma-joined; empty if none), score, found (label, phrase, starts).

    The score is e / (e + 4), where e sums up, over the labels, the words of the longest phrase
    found: 0 without a label, nearer 1 the more is found. Document frequencies are counted over
    all rows given; they decide where a phrase is looked up, not what is found. Null and empty
    texts have no words. Rows are judged one by one, so ties and repeated rows are no case of
    their own; empty input gives no rows; other columns are ignored.
    """
    posted = postings(document_frequencies(docs, phrases), phrases)
    anchors = sorted({w for one in posted for _, w in one})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    last = F.greatest(F.col("n_words"), F.lit(1)) - 1
    at = F.filter(F.sequence(F.lit(0).cast("long"), last),
                  lambda i: F.get("words", i.cast("int")).isin(anchors))
    rows = rows.withColumn("hits", F.transform(at, lambda i: F.struct(
        i.cast("int").alias("at"), F.get("words", i.cast("int")).alias("word"))))
    names = [f"p{k}" for k in range(len(phrases))]
    nothing = F.array().cast("array<int>")
    some = F.size("hits") > 0
    rows = rows.select("doc_id", "n_words", *[
        F.when(some, _starts(p, one)).otherwise(nothing).alias(name)
        for name, p, one in zip(names, phrases, posted)])

    base = [name for name, p in zip(names, phrases) if p.base]
    places = F.flatten(F.array(*base))

    def labels(chosen):
        each = [F.when(F.size(n) > 0, F.lit(p.label)) for n, p in zip(names, phrases) if chosen(p)]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*each)))), ",")

    evidence = F.lit(0)
    for label in sorted({p.label for p in phrases}):
        sizes = [F.when(F.size(n) > 0, len(p.words.split())).otherwise(0)
                 for n, p in zip(names, phrases) if p.label == label]
        evidence = evidence + (F.greatest(*sizes) if len(sizes) > 1 else sizes[0])
    found = F.filter(F.array(*[
        F.struct(F.lit(p.label).alias("label"), F.lit(p.words).alias("phrase"),
                 F.col(n).alias("starts")) for n, p in zip(names, phrases)]),
        lambda x: F.size(x["starts"]) > 0)
    return rows.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(lambda p: p.base).alias("base_labels"), labels(lambda p: True).alias("labels"),
        (evidence / (evidence + 4)).cast("double").alias("score"), found.alias("found"))


def oracle(phrases=PHRASES) -> str:
    """DuckDB SQL for the digest of :func:`licence_phrases`, by plain search for each phrase."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    starts, labels, base, evidence = [], [], [], {}
    for k, p in enumerate(phrases):
        parts = p.words.split()
        tests = " AND ".join(f"words[i + {j + 1}] = '{w}'" for j, w in enumerate(parts))
        starts.append(f"[i FOR i IN range(len(words)) IF {tests}] AS p{k}")
        one = f"CASE WHEN len(p{k}) > 0 THEN '{p.label}' END"
        labels.append(one)
        if p.base:
            base.append((k, one))
        evidence.setdefault(p.label, []).append(
            f"CASE WHEN len(p{k}) > 0 THEN {len(parts)} ELSE 0 END")
    places = " || ".join(f"p{k}" for k, _ in base)
    total = " + ".join(f"greatest({', '.join(x)})" if len(x) > 1 else x[0]
                       for x in evidence.values())

    def joined(each):
        inside = f"[x FOR x IN [{', '.join(each)}] IF x IS NOT NULL]"
        return f"coalesce(array_to_string(list_sort(list_distinct({inside})), ','), '')"

    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
f AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, {', '.join(starts)} FROM w),
g AS (SELECT *, {places} AS places, {total} AS evidence FROM f)
SELECT doc_id, n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  {joined(x for _, x in base)} AS base_labels, {joined(labels)} AS labels,
  CAST(evidence AS DOUBLE) / (evidence + 4) AS score FROM g"""
