"""Toxicity with noisy-channel deobfuscation.

Text that looks disguised (look-alike signs inside a word, stretched letters, letters
set apart) is read as the output of a noisy channel. Every sign becomes a set of
letters it may stand for, a stretched letter one or two letters, a gap nothing or a
word end. A Viterbi search over this lattice finds the likeliest original under a
character trigram model of the corpus. The restored words are scored along with the
words as written.

Scores come from evidence: words and word beginnings that are more frequent in
toxic than in other labelled documents, by a lower confidence bound of the log odds.
A logistic model of the strongest pieces of evidence, fitted on labelled documents
that the evidence was not taken from, gives the probability.

Character counts cover all documents; those with a share of 1 in ``SHARE`` of all letters
at least, so at most that many, are held by every worker, others are smoothed. Labels are read from a bounded sample
(``LABELLED`` rows in hash order), so the sample can be broadcast and no text is
shuffled. Language, source and id of a document are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import TEXT, map_text, pieces, stored

LABELLED = 100_000  # labelled rows the classifier is fitted on, at most
SHARE = 1 << 19  # trigrams and pairs with a share of 1 / SHARE of all letters are kept
PRIOR = 0.05  # score of a text without evidence, where labels say nothing
_CACHED = 100_000  # words or pieces a Python worker holds; of pieces as many older ones

# fixed values: signs and the letters they are used for
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
             "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "€": "e", "£": "l"}
_GAPS = " ._-*~'"

_LETTERS = re.compile(r"[^\W\d_]+")
_SIGNS = "".join(map(re.escape, LOOKALIKE))
_MIXED = re.compile(rf"[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(rf"[\w{_SIGNS}](?:[._*~-]+[\w{_SIGNS}]){{2,}}")
_SIGN, _BETWEEN = rf"(?:[^\W_]|[{_SIGNS}])", rf"[\s{re.escape(_GAPS)}]"
# single signs with white space, and any other gaps, between
_SPACED = re.compile(rf"(?<!\S){_SIGN}(?:{_BETWEEN}+{_SIGN}){{2,}}(?!\S)")
# what every run of them holds: a sign between two gaps, and one more sign before a gap
_TWO = re.compile(rf"{_BETWEEN}[\w{_SIGNS}]{_BETWEEN}+[\w{_SIGNS}](?:{_BETWEEN}|\Z)")
_ENDS = ".,;:?()[]{}<>\"“”„«»‘’…"  # signs around a word that are no letters of it


# ---- character model ------------------------------------------------------

def trigram_counts(docs: DataFrame, share: int = SHARE) -> tuple[dict[str, int], ...]:
    """Letter trigrams of all words of all documents, and their last and first pairs.

    A blank stands at word ends. Grams below 1 / ``share`` of all letters are left out, so
    at most ``share`` of each kind come to the driver, whatever scripts the texts have.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in pieces(batches, 2000):
            for text in batch.column(0):
                words.update((text.as_py() or b"").decode(errors="replace").lower().split())
            if len(words) > _CACHED:
                yield _trigrams(words)
                words = Counter()
        if words:
            yield _trigrams(words)

    every = stored(docs.select(F.col(TEXT)).mapInArrow(run, "key bigint, n bigint")
                   .groupBy("key").agg(F.sum("n").alias("n")), "trigrams")
    total = every.agg(F.sum("n")).first()[0] or 0
    sign = lambda k, shift: chr(k >> shift & 0x1FFFFF)

    def kept(grams: DataFrame) -> list:
        return grams.filter(F.col("n") * share >= total).collect()

    def pairs(key: str) -> dict[str, int]:
        found = every.groupBy(F.expr(key).alias("key")).agg(F.sum("n").alias("n"))
        return {sign(r["key"], 21) + sign(r["key"], 0): r["n"] for r in kept(found)}

    return ({sign(r["key"], 42) + sign(r["key"], 21) + sign(r["key"], 0): r["n"]
             for r in kept(every)},
            pairs(f"key & {(1 << 42) - 1}"), pairs("shiftright(key, 21)"))


def _trigrams(words: Counter) -> pa.RecordBatch:
    kept: Counter = Counter()
    for word, n in words.items():
        bare = word.strip(_ENDS)
        for letters in (bare,) if bare.isalpha() else _LETTERS.findall(word):
            kept[letters] += n
    # two blanks between words: every trigram lies in one word
    signs = np.frombuffer(("  " + "  ".join(kept) + "  ").encode("utf-32-le", "replace"),
                          np.uint32).astype(np.int64)
    blank = signs == 32
    owner = np.cumsum(blank[1:-1] & blank[:-2]) - 1
    key = signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:]
    values, place = np.unique(key, return_inverse=True)
    counts = np.bincount(place, np.array([*kept.values(), 0], float)[
        np.minimum(owner, len(kept))]).astype(np.int64)
    some = counts > 0
    return pa.RecordBatch.from_arrays([pa.array(values[some]), pa.array(counts[some])],
                                      ["key", "n"])


class CharModel:
    """Interpolated trigram probabilities, as logarithms."""

    def __init__(self, counts: dict[str, int], two: dict[str, int] | None = None,
                 after: dict[str, int] | None = None):
        """``two`` and ``after`` count last and first pairs, by default those of ``counts``."""
        self.three = counts
        self.two, self.after = Counter(two), Counter(after)
        for gram, n in counts.items() if two is None else ():
            self.two[gram[1:]] += n
            self.after[gram[:2]] += n
        self.before, self.one = Counter(), Counter()
        for gram, n in self.two.items():
            self.before[gram[0]] += n
            self.one[gram[1]] += n
        self.total = sum(self.one.values())
        self.known: dict[str, float] = {}

    def cost(self, context: str, sign: str) -> float:
        gram = context + sign
        found = self.known.get(gram)
        if found is None:
            p = (self.one[sign] + 0.1) / (self.total + 0.1 * (len(self.one) + 1))
            p = (self.two[gram[1:]] + 4 * p) / (self.before[context[1]] + 4)
            p = (self.three.get(gram, 0) + 4 * p) / (self.after[context] + 4)
            found = self.known[gram] = math.log(p)
        return found


def lattice(text: str) -> list[list[tuple[str, float]]]:
    """What each sign, run or gap of ``text`` may stand for, with channel log probability."""
    steps, at = [], 0
    while at < len(text):
        sign, end = text[at], at + 1
        while end < len(text) and text[end] == sign:
            end += 1
        width = end - at
        meant = LOOKALIKE.get(sign, sign if sign.isalpha() else "")
        if sign in _GAPS or not meant:
            steps.append([("", -0.3), (" ", -1.4)])
        else:
            each = -math.log(len(meant)) - (0.0 if sign.isalpha() else 0.3)
            if width >= 3:
                steps.append([(m * k, each - 0.7) for m in meant for k in (1, 2)])
            else:
                steps.extend([[(m, each) for m in meant]] * width)
        at = end
    return steps


def restore(text: str, model: CharModel) -> str:
    """The likeliest original of ``text``: Viterbi over the lattice, states are two letters."""
    best: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for options in lattice(text.lower()):
        new: dict[str, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for letters, channel in options:
                value, context = score + channel, state
                for letter in letters:
                    if letter == " " and context[1] == " ":
                        continue
                    value += model.cost(context, letter)
                    context = context[1] + letter
                    if letter == " ":
                        context = "  "
                if context not in new or new[context][0] < value:
                    new[context] = value, (path, letters)
        best = new  # two letters each: as many as the last two signs may stand for
    ends = ((score + (0.0 if state[1] == " " else model.cost(state, " ")), path)
            for state, (score, path) in best.items())
    path, out = max(ends, key=lambda x: x[0])[1], []
    while path is not None:
        path, letters = path
        out.append(letters)
    return " ".join("".join(reversed(out)).split())


# ---- evidence -------------------------------------------------------------

def marks(word: str) -> list[str]:
    """A word and its beginnings, which stand for words that were never seen."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)]


def chunk_words(chunk: str, model: CharModel) -> list[str]:
    """Words of a piece without white space, as written and as restored."""
    low = chunk.lower()
    words = _LETTERS.findall(low)
    if _MIXED.search(low) or _STRETCHED.search(low) or _APART.search(low):
        words += _LETTERS.findall(restore(low, model))
    return words


def spaced_words(text: str, model: CharModel) -> Iterator[list[str]]:
    """Restored words of every run of letters that blanks, line ends or gaps set apart."""
    for span in set(_SPACED.findall(text)) if _TWO.search(text) else ():
        yield _LETTERS.findall(restore(span, model))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


@dataclass
class Model:
    trigrams: dict[str, int]
    weights: dict[str, float] = field(default_factory=dict)
    # without fitting: the prior, and evidence as it is
    scale: list[float] = field(default_factory=lambda: [1.0, 0.5, 0.0, _logit(PRIOR)])
    two: dict[str, int] | None = None
    after: dict[str, int] | None = None

    def reader(self) -> CharModel:
        return CharModel(self.trigrams, self.two, self.after)


class Reader:
    """Finds the wanted marks of texts, and remembers which pieces hold none.

    A piece is looked at once: plain words are known by their first four letters, and
    only a piece with other signs inside goes through the lattice.
    """

    def __init__(self, chars: CharModel, wanted: Container[str] | None, joins: bool = False):
        """``wanted`` None finds all marks. With weights, the heaviest mark of each word counts.

        ``joins`` reads neighbours as one word that is split, too.
        """
        self.chars, self.wanted = chars, wanted
        self.weights = wanted if isinstance(wanted, dict) else None
        self.first = None if wanted is None else {m.rstrip("*")[:4] for m in wanted}
        self.starts = {m[:k] for m in wanted for k in range(1, len(m.rstrip("*")))} if joins else ()
        self.hits: dict[str, tuple[str, ...]] = {}
        self.some: set[str] = set()
        self.seen, self.older = set(), set()

    def _marks(self, words: Iterable[str]) -> tuple[str, ...]:
        if self.weights is not None:
            heavy = (max(marks(w), key=lambda m: self.weights.get(m, 0.0)) for w in words)
            return tuple({m for m in heavy if m in self.weights})
        return tuple({m for w in words for m in marks(w)
                      if self.wanted is None or m in self.wanted})

    def _learn(self, new: set[str]) -> None:
        for piece in new:
            bare = piece.strip(_ENDS)
            if bare.isalpha() and not _STRETCHED.search(bare):
                if self.first is not None and bare[:4] not in self.first:
                    continue
                found = self._marks((bare,))
            else:
                found = self._marks(chunk_words(piece, self.chars))
            if found:
                self.hits[piece] = found
                self.some.add(piece)
        self.seen |= new

    def _forget(self) -> None:
        """Drop the older half of the pieces without marks, and all where those with are many."""
        self.older, self.seen = self.seen, set()
        if len(self.hits) > _CACHED:
            self.hits, self.some, self.older = {}, set(), set()

    def _joined(self, a: str, b: str) -> tuple[str, ...]:
        """The word that two neighbours make, if it counts as a whole and not by its beginning."""
        word = a.lstrip(_ENDS) + b.rstrip(_ENDS + "!")
        return (word,) if len(word) > 3 and word in self.wanted else ()

    def find(self, text: str) -> set[str]:
        if len(self.seen) > _CACHED:
            self._forget()
        text = text.lower()
        pieces_ = text.split()
        distinct = set(pieces_)
        new = distinct - self.seen - self.older
        if new:
            self._learn(new)
        found: set[str] = set()
        for piece in distinct & self.some:
            found.update(self.hits[piece])
        if self.starts and not distinct.isdisjoint(self.starts):
            opens, last = self.starts, len(pieces_) - 1
            for i in [i for i, p in enumerate(pieces_) if p in opens]:
                if i < last:
                    found.update(self._joined(pieces_[i], pieces_[i + 1]))
        for words in spaced_words(text, self.chars):
            found.update(self._marks(words))
        return found


class Scorer:
    """Evidence and score of a text."""

    def __init__(self, model: Model):
        self.model = model
        self.reader = Reader(model.reader(), model.weights, joins=True)

    def evidence(self, text: bytes | None) -> list[float]:
        """Strongest and second strongest weight, and how much evidence there is."""
        if not self.model.weights:
            return [0.0, 0.0, 0.0]
        found = self.reader.find((text or b"").decode(errors="replace"))
        top = sorted((self.model.weights[m] for m in found), reverse=True)[:2] + [0.0, 0.0]
        return [top[0], top[1], math.log1p(len(found))]

    def score(self, text: bytes | None) -> float:
        z = self.model.scale[-1] + sum(a * b for a, b in zip(self.model.scale,
                                                             self.evidence(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _mark_counts(rows: DataFrame, shared, wanted) -> DataFrame:
    """(mark, toxic, other): in how many documents each mark stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value.reader(), None if wanted is None else wanted.value)
        for batch in pieces(batches, 1000):
            counts = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[0 if label else 1].update(
                    reader.find((text.as_py() or b"").decode(errors="replace")))
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 *[pa.array([c[m] for m in names], pa.int64()) for c in counts]],
                ["mark", "toxic", "other"])

    return (rows.mapInArrow(run, "mark string, toxic bigint, other bigint").groupBy("mark")
            .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps for a ridge-penalised logistic model; the last value is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", usable=None, sample: int = LABELLED, least: int = 4) -> Model:
    """Fit on labelled rows for which ``usable`` (a condition on the label table) holds.

    Evidence is counted on two thirds of the sampled labels, by a hash of the id, and
    the logistic model is fitted on the rest. Rows without label, id or document say
    nothing. Where the labels hold one class only, or none, every score is ``PRIOR``, which
    is below the limit, so nothing is predicted toxic. Every mark of at least ``least``
    toxic documents is weighed: only the sample bounds their number.
    """
    sc = docs.sparkSession.sparkContext
    source = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("binary").alias(TEXT))
    trigrams, two, after = trigram_counts(source)
    model = Model(trigrams, two=two, after=after)
    usable = F.lit(True) if usable is None else usable
    chosen = (labels.filter(usable).select(F.col(doc_id).alias("_id"), F.col(label).alias("_y"))
              .filter("_id is not null and _y is not null").distinct()
              .orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample)
              .withColumn("_fold", F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(3))))
    joined = source.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    rows = joined.filter("_fold < 2").select("_y", TEXT)
    shared = sc.broadcast(model)
    sizes = chosen.filter("_fold < 2").agg(F.sum((F.col("_y") == 1).cast("long")),
                                           F.sum((F.col("_y") != 1).cast("long"))).first()
    toxic, other = (n or 0 for n in sizes)
    if not toxic or not other:  # nothing to tell apart: every text gets the prior
        return model
    names = [r["mark"] for r in _mark_counts(rows.filter("_y = 1"), shared, None)
             .filter(F.col("toxic") >= least).collect()]
    wanted = sc.broadcast(frozenset(names))
    weights = {}
    for r in _mark_counts(rows, shared, wanted).collect():
        a, b = r["toxic"] + 0.5, r["other"] + 0.5
        weight = (math.log(a / (toxic + 1)) - math.log(b / (other + 1))
                  - 1.64 * math.sqrt(1 / a + 1 / b))
        if weight > 0.5:
            weights[r["mark"]] = weight
    model.weights = weights
    weighted = sc.broadcast(model)

    def evidence():
        scorer = Scorer(weighted.value)
        return lambda value: (scorer.evidence(value),)

    data = map_text(joined.filter("_fold = 2"), "e array<double>", evidence, TEXT,
                    ["_y"]).collect()
    y = np.array([float(r["_y"] == 1) for r in data])
    if len(y) and 0 < y.sum() < len(y):
        model.scale = _logistic(np.array([r["e"] for r in data]), y)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep=None,
          limit: float = 0.3, clean_only: bool = False) -> DataFrame:
    """Rows with ``score`` (0 to 1) and ``predicted`` (1 from ``limit`` on).

    One row per input row, with the ``keep`` columns (all when None; columns named
    like a result give way). Null and empty texts hold no evidence and get the score
    of a document without any. ``clean_only`` drops predicted rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows():
        scorer = Scorer(shared.value)

        def one(value: bytes | None) -> tuple:
            p = scorer.score(value)
            return p, int(p >= limit)
        return one

    return map_text(docs, "score double, predicted int", rows, text, keep,
                    (lambda r: not r[1]) if clean_only else None)
