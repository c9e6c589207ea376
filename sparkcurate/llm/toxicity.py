"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

The kernel of two words is the gap-weighted subsequence kernel (Lodhi et al., 2002): common character
subsequences of 3 and 4 letters, each weighted by decay to the power of the length it spans, normalised.
Insults with inserted characters ("id-i.ot") keep most of it; letters spread by blanks ("i d i o t") are
put together first. A sentence is compared through the sum over its words. The kernel is approximated
with landmark words (Nyström), so a sentence becomes a short vector and the machine is linear in it.

Training: a bounded sample of labelled documents (`fit_rows`, the least hashes of the id). A document's label
belongs to one of its sentences at least, so each document takes part with its most suspicious sentence
(by word evidence in the first round, by the machine in the second) and one drawn sentence of a clean
document. The margin of a document is that of its worst sentence; a logistic fit turns it into a score.

Scale: scoring is one pass over the scan without a shuffle. As the machine is linear, a word adds one
number, which a Python worker computes once and remembers (`MEMORY` words). Whole texts are scored.

Edge cases: null and blank texts get the score of a text without evidence; a word of less than 3 letters
has no subsequences and adds nothing; long words are cut into overlapping pieces; rows with null labels
are not trained on; repeated rows are scored each. Without labelled rows of both classes all scores are
the share of toxic rows seen (0 if none).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, text_or_empty

DECAY = 0.6
PIECE, OVERLAP = 20, 8
SENTENCE_WORDS = 32
MEMORY = 250_000
#: Hashed letter pairs of the kernel's filter, and the share of a landmark's pairs that a word must have.
PAIR_SLOTS = 256
SHARED = 0.6
#: Power of the kernel of two words: the power of a kernel is one, and a high one keeps words apart that share an ending.
SHARPNESS = 2
ENDS = re.compile(r"[.!?]+(?=\s|$)|\n")
INSERTED = re.compile(r"[\W_]+")
SPREAD = re.compile(r"(?<!\w)\w(?:[\W_]{1,2}\w){2,}(?!\w)")


@dataclass(frozen=True)
class ToxicityRules:
    fit_rows: int = 8_000
    landmarks: int = 96
    suspicious: float = 0.85  # share of the landmarks that come from toxic documents
    penalty: float = 1.0
    rounds: int = 2
    miss_cost: float = 4.0  # a toxic document that is missed counts as so many clean ones rejected
    threshold: float = 0.3


@dataclass
class Model:
    """Landmark words, their weights after Nyström projection, bias, and the logistic fit."""

    words: list[str] = field(default_factory=list)
    alpha: list[float] = field(default_factory=list)
    bias: float = 0.0
    slope: float = 0.0
    shift: float = -40.0


def sentences(text: str) -> Iterator[list[str]]:
    """Lower-case words of each sentence, at most SENTENCE_WORDS at a time."""
    for part in ENDS.split(text.lower()):
        if not part or part.isspace():
            continue
        if SPREAD.search(part):
            part = SPREAD.sub(lambda m: re.sub(r"[\W_]", "", m[0]), part)
        words = part.split()
        for i in range(0, len(words), SENTENCE_WORDS):
            yield words[i : i + SENTENCE_WORDS]


def pieces(word: str) -> list[str]:
    """A word without signs inside and around it, cut where it is long."""
    if not word.isalnum():
        word = INSERTED.sub("", word)
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - OVERLAP, PIECE - OVERLAP)]


def codes(words: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(words), width), pad, np.int32)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def pair_kernel(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gap-weighted subsequence kernels of order 3 and 4 of row k of left with row k of right.

    Rows are padded character codes; the two sides use different padding, so padding never matches.
    """
    rows, n = left.shape
    t = right.shape[1]
    square, decay = np.float32(DECAY * DECAY), np.float32(DECAY)
    # inner[p][j]: weight of common subsequences of length p in left[:i] and right[:j], counted to both ends
    inner = np.zeros((4, t + 1, rows), np.float32)
    inner[0] = 1.0
    total = np.zeros((5, rows), np.float32)
    columns = np.ascontiguousarray(right.T)
    for i in range(n):
        match = (columns == left[:, i]) * square
        for p in (3, 2, 1, 0):  # from long to short: each step uses the values of the row before
            steps = match * inner[p, :t]
            if p >= 2:
                total[p + 1] += steps.sum(axis=0)
            if p == 3:
                continue
            along = np.zeros(rows, np.float32)
            inner[p + 1] *= decay
            for j in range(t):
                along *= decay
                along += steps[j]
                inner[p + 1, j + 1] += along
    return total[3], total[4]


def letter_pairs(rows: np.ndarray) -> np.ndarray:
    """Which of PAIR_SLOTS hashed pairs of letters, at most three apart, occur in each row (padding < 0)."""
    out = np.zeros((len(rows), PAIR_SLOTS + 1), np.float32)
    at = np.arange(len(rows))[:, None]
    for gap in range(1, min(4, rows.shape[1])):
        a, b = rows[:, :-gap].astype(np.int64), rows[:, gap:].astype(np.int64)
        out[at, np.where((a < 0) | (b < 0), PAIR_SLOTS, (a * 31 + b * 7919) % PAIR_SLOTS)] = 1
    return out[:, :PAIR_SLOTS]


def word_kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Mean of the normalised kernels of order 3 and 4 of all words with all landmarks, to the power SHARPNESS.

    It is 0 for a pair that shares less than SHARED of the landmark's letter pairs, which spares the
    recursion for words that have little in common; the power leaves little of such pairs in any case.
    """
    out = np.zeros((len(words), len(landmarks)), np.float32)
    if not words or not landmarks:
        return out
    marks = codes(landmarks, max(3, *map(len, landmarks)), -1)
    mark_pairs = letter_pairs(marks)
    needed = np.maximum(SHARED * mark_pairs.sum(axis=1), 1.0)
    own = [np.sqrt(k) for k in pair_kernel(marks, np.where(marks < 0, -2, marks))]
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for start in range(0, len(order), 4096):
        part = np.array(order[start : start + 4096])
        rows = codes([words[i] for i in part], max(3, len(words[part[-1]])), -2)
        left, right = np.nonzero(letter_pairs(rows) @ mark_pairs.T >= needed)
        if not len(left):
            continue
        used, back = np.unique(left, return_inverse=True)
        selves = [np.sqrt(k)[back] for k in pair_kernel(rows[used], np.where(rows[used] < 0, -1, rows[used]))]
        both = pair_kernel(rows[left], marks[right])
        # Where a side has no subsequence of that length, its kernel with anything is 0.
        value = sum(k / np.maximum(a * c[right], 1e-12) for k, a, c in zip(both, selves, own)) / 2
        out[part[left], right] = value**SHARPNESS
    return out


class WordScores:
    """Remembers what each word adds to the margin."""

    def __init__(self, model: Model):
        self.model, self.known, self.alpha = model, {}, np.array(model.alpha, np.float32)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) > MEMORY:
            self.known.clear()
            new = list(words)
        cut = [pieces(w) for w in new]
        flat = sorted({p for c in cut for p in c})
        worth = dict(zip(flat, (word_kernel(flat, self.model.words) @ self.alpha).tolist()))
        for w, c in zip(new, cut):
            self.known[w] = max(worth[p] for p in c)

    def margins(self, texts: list[str]) -> list[float]:
        """The largest sentence margin of each text; the bias alone where there is no sentence."""
        split = [list(sentences(t)) for t in texts]
        self.learn({w for s in split for words in s for w in words})
        known = self.known
        return [max((sum(map(known.__getitem__, words)) for words in s), default=0.0) + self.model.bias for s in split]


_SCORERS: dict[tuple, WordScores] = {}


def scorer(model: Model) -> WordScores:
    """The scorer of a model, kept for the life of a Python worker."""
    key = (tuple(model.words), tuple(model.alpha), model.bias)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = WordScores(model)
    return _SCORERS[key]


def _decode(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    for start, piece in slices(batch.column("__text")):
        yield start, [t.decode("utf-8", "replace") for t in piece]


def _margins(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [m for _, texts in _decode(batch) for m in scorer(model).margins(texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(values, pa.float64())], [*keep, "margin"])

    return run


def with_margins(rows: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """rows: `keep` columns and __text."""
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "__text").mapInArrow(_margins(model, keep), f"{schema}, margin double")


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word pieces of each document with its label."""
    for batch in batches:
        labels = batch.column("toxic").to_pylist()
        words, toxic = [], []
        for start, texts in _decode(batch):
            for i, text in enumerate(texts):
                found = {p for s in sentences(text) for w in s for p in pieces(w) if len(p) >= 3}
                words.extend(found)
                toxic.extend([labels[start + i]] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])


def _witnesses(evidence: dict[str, float], landmarks: list[str], model: Model | None):
    """The most suspicious sentence of each document, and for clean ones a drawn one, as landmark kernels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, rows, toxic = batch.column("toxic").to_pylist(), [], []
            for start, texts in _decode(batch):
                for i, text in enumerate(texts):
                    parts = list(sentences(text))
                    if not parts:
                        continue
                    if model is None:
                        worth = [sum(evidence.get(p, 0.0) for w in s for p in pieces(w)) for s in parts]
                    else:
                        score = scorer(model)
                        score.learn({w for s in parts for w in s})
                        worth = [sum(map(score.known.__getitem__, s)) for s in parts]
                    picks = [int(np.argmax(worth))] + ([len(text) % len(parts)] if not labels[start + i] else [])
                    for k in picks:
                        rows.append([p for w in parts[k] for p in pieces(w)])
                        toxic.append(labels[start + i])
            new = sorted({p for r in rows for p in r} - seen.keys())
            seen.update(zip(new, word_kernel(new, landmarks)))
            sums = [np.sum([seen[p] for p in r], axis=0).tolist() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.list_(pa.float32())), pa.array(toxic, pa.int32())], ["sums", "toxic"])

    return run


def _spaced(candidates: list[str], chosen: list[str], wanted: int) -> list[str]:
    """Candidates in order, without near copies of what is chosen, until there are `wanted`."""
    pool = [*chosen, *(w for w in candidates if w not in set(chosen))]
    alike = word_kernel(pool, pool)
    picked = list(range(len(chosen)))
    for i in range(len(chosen), len(pool)):
        if len(picked) < wanted and (not picked or alike[i, picked].max() < 0.9):
            picked.append(i)
    return [pool[i] for i in picked]


def choose_landmarks(counts: list[tuple[str, int, int]], positives: int, negatives: int, rules: ToxicityRules):
    """(landmarks, evidence per word): words most tied to toxic documents, then frequent clean words."""
    evidence = {
        w: float(np.log((a + 0.5) / (positives + 1.0)) - np.log((b + 0.5) / (negatives + 1.0))) for w, a, b in counts}
    weight = {w: a * evidence[w] for w, a, _ in counts}
    tied = sorted((w for w, v in evidence.items() if v > 0), key=lambda w: (-weight[w], w))
    wanted = int(rules.landmarks * rules.suspicious)
    chosen = _spaced(tied[: 8 * wanted], [], wanted)
    clean = [w for _, w in sorted((-b, w) for w, _, b in counts if evidence[w] <= 0)]
    chosen = _spaced(clean[: 4 * rules.landmarks], chosen, rules.landmarks)
    return chosen, {w: v for w, v in evidence.items() if abs(v) > 1.0}


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighted evenly; Newton steps on the active rows."""
    n, m = x.shape
    sign = np.where(y > 0, 1.0, -1.0)
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * penalty * 1000
    full = np.hstack([x, np.ones((n, 1))])
    beta = np.zeros(m + 1)
    ridge = np.eye(m + 1)
    ridge[m, m] = 1e-6
    for _ in range(min(steps, 50)):
        margin = sign * (full @ beta)
        active = margin < 1
        if not active.any():
            break
        part, weight = full[active], cost[active]
        new = np.linalg.solve(ridge + (part * weight[:, None]).T @ part, (part * weight[:, None]).T @ sign[active])
        if np.abs(new - beta).max() < 1e-8:
            break
        beta = new
    return beta[:m], float(beta[m])


def fit_logistic(margin: np.ndarray, y: np.ndarray, miss_cost: float = 1.0) -> tuple[float, float]:
    """Slope and shift of the score, by Newton steps with Platt's smoothed targets; toxic rows count miss_cost times."""
    pos, neg = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    weight = np.where(y > 0, miss_cost, 1.0)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (weight * (p - target)) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, rules: ToxicityRules, scratch: Scratch, id_column: str = "doc_id") -> Model:
    """Fit on a bounded sample of labelled rows. docs: id_column, text. labels: id_column, toxic."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    some = known.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(rules.fit_rows)
    texts = docs.select(F.col(id_column).alias("__id"), text_or_empty("text").alias("__text"))
    # The sample has at most fit_rows short rows, so it is broadcast and the texts are not shuffled.
    rows = texts.join(F.broadcast(scratch.store(some)), "__id").drop("__id")
    sample = scratch.store(rows.repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism)))
    classes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positives, negatives = classes.get(1, 0), classes.get(0, 0)
    if not positives or not negatives:
        share = positives / max(1, positives + negatives)
        return Model(shift=float(np.log((share + 1e-12) / (1 - share + 1e-12))))
    counted = sample.mapInArrow(_document_words, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    # Words that could be landmarks or evidence: the strongest in either direction, a bounded number.
    strength = F.abs(F.log((F.col("a") + 0.5) / (positives + 1.0)) - F.log((F.col("n") - F.col("a") + 0.5) / (negatives + 1.0)))
    counted = scratch.store(counted.filter("n >= 2").withColumn("s", strength * F.sqrt(F.greatest("a", F.col("n") * 0.05))))
    strong = counted.orderBy(F.desc("s"), "word").limit(4000)
    common = counted.orderBy(F.desc("n"), "word").limit(400)
    counts = [(r["word"], r["a"], r["n"] - r["a"]) for r in strong.union(common).distinct().orderBy("word").collect()]
    landmarks, evidence = choose_landmarks(counts, positives, negatives, rules)
    gram = word_kernel(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2 + 1e-3 * np.eye(len(landmarks)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    model = None
    for _ in range(rules.rounds):
        found = sample.mapInArrow(_witnesses(evidence, landmarks, model), "sums array<float>, toxic int").toPandas()
        x, y = np.stack(found["sums"].to_numpy()).astype(np.float64), found["toxic"].to_numpy()
        order = np.lexsort([*x.T[:3], y])  # the fit doesn't depend on the order of the tasks
        beta, bias = fit_svm((x @ root)[order], y[order], rules.penalty)
        model = Model(landmarks, (root @ beta).tolist(), bias)
    fitted = with_margins(sample, ["toxic"], model).toPandas().sort_values(["toxic", "margin"])
    model.slope, model.shift = fit_logistic(
        fitted["margin"].to_numpy(), fitted["toxic"].to_numpy(), rules.miss_cost)
    return model


def score_documents(
    docs: DataFrame, keep: list[str], model: Model, rules: ToxicityRules = ToxicityRules(), text: str = "text"
) -> DataFrame:
    """Columns `keep` of docs with score (0 to 1) and predicted."""
    names = {c: f"k{i}" for i, c in enumerate(keep)}  # any names may stand in `keep`, also those used here
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), text_or_empty(text).alias("__text"))
    exponent = -(F.lit(model.slope) * F.col("margin") + F.lit(model.shift))
    score = 1.0 / (1.0 + F.exp(F.least(F.greatest(exponent, F.lit(-700.0)), F.lit(700.0))))
    scored = with_margins(rows, list(names.values()), model).withColumn("__score", score)
    return scored.select(
        *(F.col(n).alias(c) for c, n in names.items()), F.col("__score").alias("score"),
        (F.col("__score") >= rules.threshold).cast("int").alias("predicted"))


def held_out(id_column: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from: a fixed quarter by the CRC of the id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
