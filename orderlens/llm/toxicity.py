"""Toxicity of texts by a string-kernel support vector machine.

The kernel counts common subsequences of four characters of two tokens, gaps allowed within seven
and discounted by their length, so inserted or dropped characters cost little. Landmark tokens
give the Nystroem features of a token; a linear machine on them is trained on labelled sentences.
A sentence is as toxic as its worst token, which the training looks for itself. As the kernel is
a sum over subsequences, the machine folds into one weight per subsequence: scoring a token takes
neither landmarks nor kernels, and gives the same number.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import documents, slices

#: Labelled documents of each class that the training reads at most, and the longest it takes.
SAMPLE_PER_CLASS = 3000
SAMPLE_CHARS = 100_000
LANDMARKS = 160
_PICK, _SPAN, _DECAY = 4, 7, 0.75
_START, _END, _CODES = 62, 63, 64
_NUMBERS = 20   # bits of a subsequence's number
_WINDOW, _STEP = 14, 5
_MEMORY = 400_000


def _code_table() -> np.ndarray:
    """Code of a character: one for each of a-z (also for the digit that resembles it), one of 33
    for other letters, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x80, 0x110000):
        if chr(cp).isalpha():
            table[cp] = 27 + cp * 7 % 33
    for k in range(26):
        table[97 + k] = table[65 + k] = 1 + k
    for digit, letter in zip("013457", "oieast"):
        table[ord(digit)] = ord(letter) - 96
    return table


_TABLE: list[np.ndarray] = []
_PLACES: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}


def _places(n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """All choices of four places within seven of n, their discounts, and the discounts' norm."""
    if n not in _PLACES:
        chosen = [(i, i + a, i + b, i + c) for i in range(n)
                  for a, b, c in combinations(range(1, _SPAN), 3) if i + c < n]
        places = np.array(chosen, np.int64).reshape(-1, 4)
        weight = _DECAY ** (places[:, 3] - places[:, 0] - 3).astype(np.float32)
        _PLACES[n] = places, weight, float(np.sqrt((weight * weight).sum())) or 1.0
    return _PLACES[n]


def token_codes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letters of every token, back to back, and where each begins (n + 1 numbers)."""
    if not _TABLE:
        _TABLE.append(_code_table())
    flat = np.frombuffer("\n".join(tokens).encode("utf-32-le", "surrogatepass"), "<u4")
    line = np.cumsum(flat == 10)
    codes = _TABLE[0][flat]
    kept = codes > 0
    return codes[kept], np.searchsorted(line[kept], np.arange(len(tokens) + 1))


def _windows(codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens with their end marks, in groups of one length: owners, matrix of codes. Tokens of
    more than ``_WINDOW`` letters go in windows that overlap."""
    sizes = np.diff(at)
    groups: dict[int, tuple[list, list]] = {}
    for n in np.unique(sizes):
        who = np.flatnonzero(sizes == n)
        rows = np.empty((len(who), n + 2), np.uint8)
        rows[:, 0], rows[:, -1] = _START, _END
        rows[:, 1:-1] = codes[at[who][:, None] + np.arange(n)]
        cuts = range(0, max(n + 2 - _WINDOW, 0) + _STEP, _STEP) if n + 2 > _WINDOW else (0,)
        for low in cuts:
            piece = rows[:, max(min(low, n + 2 - _WINDOW), 0):][:, :_WINDOW]
            owners, pieces = groups.setdefault(piece.shape[1], ([], []))
            owners.append(who)
            pieces.append(piece)
    for owners, pieces in groups.values():
        yield np.concatenate(owners), np.concatenate(pieces)


def _subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of tokens of one length, as hashed numbers, and their normed discounts."""
    places, weight, norm = _places(rows.shape[1])
    wide = rows.astype(np.int32)
    found = wide[:, places[:, 0]]
    for k in range(1, _PICK):
        found = found * _CODES + wide[:, places[:, k]]
    found = (found * np.int32(-1640531535)).view(np.uint32) >> np.uint32(32 - _NUMBERS)
    return found.astype(np.int32), weight / norm


def token_scores(tokens: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision value of every token: that of its worst window."""
    result = np.full(len(tokens), bias, np.float32)
    codes, at = token_codes(tokens)
    for owners, rows in _windows(codes, at):
        for low in range(0, len(rows), 4096):
            found, weight = _subsequences(rows[low:low + 4096])
            if found.shape[1]:
                np.maximum.at(result, owners[low:low + 4096], weights[found] @ weight + bias)
    return result


def _landmark_features(tokens: list[str], index: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel of every token with the landmarks (of a long token, its window with the largest)."""
    result = np.zeros((len(tokens), table.shape[1]), np.float32)
    codes, at = token_codes(tokens)
    for owners, rows in _windows(codes, at):
        found, weight = _subsequences(rows)
        where = index[found]
        for i, owner in enumerate(owners):
            values = weight[where[i] >= 0] @ table[where[i][where[i] >= 0]]
            if values.sum() >= result[owner].sum():
                result[owner] = values
    return result


@dataclass
class Model:
    """Weight of each subsequence that has one, bias, and the line from decision to log odds.
    ``numbers`` is None if the labels had only one class; then every text scores ``constant``."""
    numbers: np.ndarray | None
    values: np.ndarray
    bias: float
    slope: float
    offset: float
    constant: float = 0.0

    def weights(self) -> np.ndarray:
        full = np.zeros(1 << _NUMBERS, np.float32)
        full[self.numbers] = self.values
        return full


def _machine(x: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float = 5e-4) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(float)
    penalty = np.diag([ridge * c.sum()] * (x.shape[1] - 1) + [1e-9])
    w, active = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(30):
        a = x[active] * c[active, None]
        w = np.linalg.solve(x[active].T @ a + penalty, a.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def train(texts: list[str], labels: list[int], shares: tuple[float, float] = (1.0, 1.0),
          rounds: int = 3) -> Model:
    """Trains on labelled texts, cut into sentences. ``shares`` says how many labelled texts each
    text of class 0 and 1 stands for."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return Model(None, np.zeros(0), 0.0, 0.0, 0.0, float(y.mean()) if len(y) else 0.0)
    bags, names = [], {}
    for text in texts:
        tokens = [t for sentence in sentences(text) for t in tokens_of(sentence)]
        bags.append(np.unique([names.setdefault(t, len(names)) for t in tokens]).astype(int))
    tokens = list(names)
    toxic, clean = np.zeros(len(tokens)), np.zeros(len(tokens))
    for bag, label in zip(bags, y):
        (toxic if label else clean)[bag] += 1
    value = _first_guess(tokens, bags, y)
    # Tokens that may have made a text toxic: all that look so and that no clean text has.
    likely = (value > 0) & (clean == 0)
    witness = Counter({int(t): int(toxic[t]) for t in np.flatnonzero(likely)}) \
        or Counter(int(b[np.argmax(value[b])]) for b, label in zip(bags, y) if label and len(b))
    negatives = np.flatnonzero(clean > 0)
    model = None
    for turn in range(rounds):
        hard = negatives[np.argsort(-value[negatives], kind="stable")[:3000]]
        usual = negatives[np.argsort(-clean[negatives], kind="stable")[:2000]]
        even = negatives[np.linspace(0, len(negatives) - 1, min(3000, len(negatives))).astype(int)]
        no = np.setdiff1d(np.unique(np.concatenate([hard, usual, even])), list(witness))
        yes = np.array([t for t, _ in witness.most_common(4000)])
        marks = [t for t, _ in witness.most_common(LANDMARKS * 3 // 4)]
        marks += no[np.argsort(-value[no], kind="stable")[:LANDMARKS - len(marks)]].tolist()
        bad = [tokens[t] for t in yes]
        weight = [float(min(witness[t], 20)) for t in yes]
        # What often makes texts toxic also does with a character put in.
        for t in [t for t in yes if witness[t] >= 5][:200]:
            varied = [v for v in _with_insertions(tokens[t]) if v not in names]
            bad += varied
            weight += [min(witness[t], 20) / max(len(varied), 1)] * len(varied)
        model = _fit([tokens[t] for t in marks], bad, np.array(weight), [tokens[t] for t in no])
        value = token_scores(tokens, model.weights(), model.bias)
    worst = np.array([value[b].max() if len(b) else model.bias for b in bags], float)
    # Log odds are a line in the decision value: weighted logistic regression, by Newton steps.
    share = np.where(y == 1, shares[1], shares[0])
    x = np.stack([worst, np.ones(len(worst))], axis=1)
    line = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        slope = x.T @ (share * (p - y)) + 1e-2 * share.sum() / len(y) * line
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-2 * share.sum() / len(y) * np.eye(2)
        step = np.linalg.solve(curve, slope)
        line -= np.clip(step, -2, 2)
    model.slope, model.offset = float(line[0]), float(line[1])
    return model


def _grams(token: str) -> set[str]:
    marked = f"^{''.join(c for c in token if c.isalpha())}$"
    return {marked[i:i + n] for n in range(5, 9) for i in range(max(len(marked) - n + 1, 1))}


def _with_insertions(token: str) -> list[str]:
    """The token with one letter put in, at each place; the letters differ from place to place."""
    return [token[:i] + chr(97 + (7 * i + 23) % 26) + token[i:] for i in range(1, len(token))]


def _first_guess(tokens: list[str], bags: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """How telling the most telling run of five to eight characters of each token is: log odds of
    toxic texts beyond eight to one, below zero if less than an eightieth of the toxic texts (or
    fewer than five) have it."""
    names: dict[str, int] = {}
    grams = [np.array([names.setdefault(g, len(names)) for g in _grams(t)]) for t in tokens]
    seen = np.zeros((2, len(names)))
    for bag, label in zip(bags, y):
        if len(bag):
            seen[label, np.unique(np.concatenate([grams[t] for t in bag]))] += 1
    odds = np.log((seen[1] + 0.1) / (y.sum() + 1)) - np.log((seen[0] + 1) / ((1 - y).sum() + 1))
    telling = np.where(seen[1] >= max(5, y.sum() / 80), odds - np.log(8.0), -9.0)
    return np.array([telling[g].max() for g in grams])


def _fit(landmarks: list[str], yes: list[str], counts: np.ndarray, no: list[str]) -> Model:
    """A machine on Nystroem features, folded into weights of subsequences."""
    parts: dict[int, dict[int, float]] = {}
    codes, at = token_codes(landmarks)
    for owners, rows in _windows(codes, at):
        found, weight = _subsequences(rows)
        for owner, numbers in zip(owners, found):
            mine = parts.setdefault(int(owner), {})
            for number, w in zip(numbers.tolist(), weight.tolist()):
                mine[number] = mine.get(number, 0.0) + w
    numbers = np.array(sorted({n for mine in parts.values() for n in mine}), np.int64)
    index = np.full(1 << _NUMBERS, -1, np.int32)
    index[numbers] = np.arange(len(numbers))
    table = np.zeros((len(numbers), len(landmarks)), np.float32)
    for owner, mine in parts.items():
        values = np.array(list(mine.values()))
        table[index[list(mine)], owner] = values / np.sqrt((values * values).sum())
    gram = (table.T @ table).astype(float)
    strength, axes = np.linalg.eigh(gram)
    keep = strength > 1e-6 * strength.max()
    whiten = axes[:, keep] / np.sqrt(strength[keep])
    x = _landmark_features(yes + no, index, table) @ whiten
    y = np.array([1.0] * len(yes) + [-1.0] * len(no))
    c = np.concatenate([counts / counts.sum(), np.full(len(no), 1.0 / max(len(no), 1))])
    w = _machine(x.astype(np.float32), y, c * len(y) / 2)
    return Model(numbers, (table @ (whiten @ w[:-1])).astype(np.float32), float(w[-1]), 1.0, 0.0)


_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def sentences(text: str) -> list[str]:
    return _SENTENCE.findall(text)


def _is_letter(token: str) -> bool:
    return sum(c.isalpha() for c in token) == 1


def tokens_of(text: str) -> list[str]:
    """Tokens between white space; three or more single letters in a row also make one together."""
    tokens = text.lower().split()
    return tokens + _spelled(tokens)


def _spelled(tokens: list[str]) -> list[str]:
    found, run = [], []
    for token in [*tokens, "--"]:
        if len(token) < 4 and _is_letter(token):
            run.append(token)
            continue
        if len(run) > 2:
            found.append("".join(run))
        run = []
    return found


class Scorer:
    """Scores whole texts; remembers the tokens it has seen, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.weights = None if model.numbers is None else model.weights()

    def __call__(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.model.constant)
        bags = []
        for text in texts:
            tokens = text.lower().split()
            if sum(map(_SHORT, map(len, tokens))) > 2:
                tokens += _spelled(tokens)
            bags.append(tokens)
        new = [t for t in set().union(*bags) if t not in self.known]
        if len(self.known) + len(new) > _MEMORY:
            self.known.clear()
            new = list(set().union(*bags))
        self.known.update(zip(new, token_scores(new, self.weights, self.model.bias).tolist()))
        get = self.known.__getitem__
        worst = np.array([max(map(get, bag)) if bag else self.model.bias for bag in bags])
        line = self.model.slope * worst + self.model.offset
        return 1 / (1 + np.exp(-np.clip(line, -30, 30)))


_SHORT = (4).__gt__


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    for part in slices(batches):
        scores = scorer(part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())],
                                         ["doc_id", "score"])


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _fit_rows(batches: Iterator[pa.RecordBatch], counts: dict[int, int]
              ) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
    taken = Counter(r[2] for r in rows)
    shares = tuple(counts.get(k, 0) / max(taken.get(k, 0), 1) for k in (0, 1))
    model = train([r[1] for r in rows], [r[2] for r in rows], shares)
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})


def fit_labelled(docs: DataFrame, labels: DataFrame,
                 per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from the labelled documents that aren't held out: of each class the ``per_class``
    first by a hash of the doc_id, texts up to :data:`SAMPLE_CHARS` long. Null labels don't count.

    The classes' counts set a threshold on the hash, so tasks offer little more than the sample.
    One task fits on those bounded rows; the driver gets two counts and the model.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n"))
              .collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]

    def first(toxic: int) -> DataFrame:
        # Ten standard deviations more than wanted lie below the threshold on average.
        share = min(1.0, (per_class + 10 * per_class ** 0.5 + 10) / max(counts.get(toxic, 0), 1))
        low = known.where(F.col("toxic") == toxic).where(
            F.xxhash64("doc_id") <= F.lit(int(-2**63 + share * (2**64 - 2**12))))
        return low.orderBy(*order).limit(per_class)

    rows = documents(docs).where(F.length("text") <= SAMPLE_CHARS).join(
        F.broadcast(first(0).union(first(1))), "doc_id").select("text", "toxic", "doc_id")
    fitted = rows.repartition(1).mapInArrow(lambda it: _fit_rows(it, counts), "model binary").collect()
    return pickle.loads(bytes(fitted[0]["model"])) if fitted else train([], [], (0.0, 0.0))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row. Only texts are scored: null and empty ones, and
    texts without letters, get the score of a text without a toxic token. Repeated rows get equal
    scores; empty input gives no rows; other columns are ignored."""
    return documents(docs).mapInArrow(lambda it: _score(it, model), "doc_id long, score double")
