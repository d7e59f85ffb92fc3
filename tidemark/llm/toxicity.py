"""Toxicity by a weighted finite-state grammar over clauses.

A text is read as clauses, a clause as a string of word classes. A lexical transducer maps words to classes: insult stems, which are
learned from labels, and small fixed sets of threats, targets, negations and reporting verbs. Four small transducers read
that string side by side; their product says of every insult or threat whether it is aimed at someone, negated or reported. A clause that
holds one is a match, weighted by its kind; weights come from a logistic fit. Words outside a match count for nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import held_out

#: Rows a model is fitted on, for each label, chosen by a hash of the id.
SAMPLE_ROWS = 4000
#: Most stems taken, the share and number of toxic sample rows that must hold a stem, and the least logarithm of the odds of its uses
#: (of the rows that hold it: half).
STEMS, LEAST_SHARE, LEAST_ROWS, LEAST_ODDS = 1000, 0.01, 4, 3.0
#: What a clean row counts for in the fit, for each toxic one.
CLEAN_WEIGHT = 3.0
_STEM_LENGTHS = (4, 5, 6, 7)

# Closed word classes of the grammar.
THREATS = "kill hurt destroy beat burn shoot stab töten umbringen verletzen tuer frapper détruire matar herir golpear".split()
TARGETS = (
    "you your yourself he she they him her them this these those du dich dir ihr euch sie er tu toi vous te votre il elle ils ellos tú usted "
    "ustedes él ella ellas"
).split()
NEGATIONS = "not no never without isn't aren't don't nicht kein keine nie pas jamais aucun nunca ningún sin".split()
REPORTING = "said says called calls quoted wrote claimed alleged sagte nannte schrieb behauptete dit appelé écrit dijo llamó escribió".split()

WORD = re.compile(r"\w+(?:['’]\w+)*")
CLAUSE_END = re.compile(r"[.!?;:\n]+")


class Transducer:
    """A deterministic machine over word classes; ``step`` gives the next state, ``accepts`` says whether a state holds."""

    def __init__(self, starts: str, reach: int, stops: str = ""):
        #: Class letters that open the state, how many words it lasts (0: to the end of the clause), and letters that close it.
        self.starts, self.reach, self.stops = starts, reach, stops
        self.full = reach or 1

    def step(self, state: int, letter: str) -> int:
        if letter in self.starts:
            return self.full
        if letter in self.stops:
            return 0
        return state - 1 if state and self.reach else state

    @staticmethod
    def accepts(state: int) -> bool:
        return state > 0


class Product:
    """The composition of transducers that read one string side by side; its table is filled as states come up."""

    def __init__(self, *parts: Transducer):
        self.parts, self.table = parts, {}
        self.start = (0,) * len(parts)

    def step(self, state: tuple[int, ...], letter: str) -> tuple[int, ...]:
        key = state, letter
        if key not in self.table:
            self.table[key] = tuple(p.step(s, letter) for p, s in zip(self.parts, state, strict=True))
        return self.table[key]


#: Letters of the class string: I insult, H threat, Y target, N negation, R reporting, o other.
NEGATION, REPORT, TARGET = Transducer("N", 4), Transducer("R", 0), Transducer("Y", 6)
KINDS = ("negated", "reported", "aimed", "threat", "plain")
#: Of each kind the strength of its matches, and that strength for the length of the text.
FEATURES = 2 * len(KINDS)
_FIXED = {w: c for c, ws in (("H", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTING)) for w in ws}


@dataclass(frozen=True)
class Model:
    stems: tuple[tuple[str, float], ...]  # with the logarithm of their odds
    weights: tuple[float, ...]  # of the features
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.machine = Product(NEGATION, REPORT, TARGET)
        self.stems = {n: {s: v for s, v in model.stems if len(s) == n} for n in _STEM_LENGTHS}
        parts = [re.escape(s) for s, _ in model.stems] + [re.escape(w) + r"\b" for w in THREATS]
        self.hit = re.compile(r"\b(?:" + "|".join(sorted(parts)) + ")")

    def letter(self, word: str) -> tuple[str, float]:
        """Class and weight of a word."""
        for n, stems in self.stems.items():
            if word[:n] in stems:
                return "I", stems[word[:n]]
        return _FIXED.get(word, "o"), 1.0

    def clause(self, clause: str) -> dict[str, float]:
        """The strongest match of each kind in a lower-cased clause.

        A target may also follow its insult ("idiot you are"), so the string is read from both ends for targets.
        """
        letters = [self.letter(m[0]) for m in WORD.finditer(clause)]
        after, state = [], 0
        for x, _ in reversed(letters):
            state = TARGET.step(state, x)
            after.append(TARGET.accepts(state))
        after.reverse()
        kinds: dict[str, float] = {}
        state = self.machine.start
        for (x, weight), aimed in zip(letters, after, strict=True):
            state = self.machine.step(state, x)
            if x not in "IH":
                continue
            negated, reported, before = map(Transducer.accepts, state)
            aimed = aimed or before
            if x == "H" and not aimed:
                continue
            kind = "negated" if negated else "reported" if reported else "threat" if x == "H" else "aimed" if aimed else "plain"
            kinds[kind] = kinds.get(kind, 0.0) + weight
        return kinds

    def features(self, text: str | None) -> np.ndarray:
        """Strength of the matched clauses of each kind, plain and per 500 letters, each as log(1 + x)."""
        found, done = dict.fromkeys(KINDS, 0.0), 0
        low = (text or "").lower()
        for m in self.hit.finditer(low):
            if m.start() < done:
                continue
            begin = max(low.rfind(c, done, m.start()) for c in ".!?;:\n") + 1
            end = CLAUSE_END.search(low, m.end())
            start, done = max(begin, done), end.start() if end else len(low)
            for kind, weight in self.clause(low[start:done]).items():
                found[kind] += weight
        sums = np.array([found[k] for k in KINDS])
        return np.log1p(np.concatenate([sums, sums * 500 / max(len(low), 100)]))

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.model.weights) + self.model.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def stems_of(text: str) -> Counter[str]:
    """How often words begin with which 4 to 7 letters."""
    words = Counter(WORD.findall(text.lower()))
    out: Counter[str] = Counter()
    for word, n in words.items():
        for k in _STEM_LENGTHS:
            if len(word) >= k:
                out[word[:k]] += n
    return out


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic`` of at most ``rows`` labelled documents of each label outside the held-out fifth.

    Ids are drawn by hash before texts are touched; at most ``2 * rows`` ids are broadcast to the scan of the texts. Texts that
    begin and end alike are near copies and count once, else words of a much-copied text would look like signs of toxicity.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    ids = drawn[0].unionAll(drawn[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    ends = F.xxhash64("toxic", F.substring("text", 1, 40), F.substring("text", -40, 40))
    return texts.withColumn("ends", ends).dropDuplicates(["ends"]).select("text", "toxic")


_COUNTS = ("bad_rows", "good_rows", "bad", "good")


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and uses of each stem for either label."""
    rows, uses = (Counter(), Counter()), (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                found = stems_of(text)
                rows[toxic].update(found.keys())
                uses[toxic].update(found)
    stems = list(rows[1].keys() | rows[0].keys())
    columns = [[c[s] for s in stems] for c in (rows[1], rows[0], uses[1], uses[0])]
    yield pa.RecordBatch.from_arrays(
        [pa.array(stems, pa.string()), *[pa.array(c, pa.int64()) for c in columns]], names=["stem", *_COUNTS]
    )


def _families(stems: Iterable[tuple[str, float]]) -> tuple[tuple[str, float], ...]:
    """Of stems, best first, those that neither begin with one already taken nor begin one."""
    taken: list[tuple[str, float]] = []
    for stem, odds in stems:
        if not any(stem.startswith(t) or t.startswith(stem) for t, _ in taken):
            taken.append((stem, odds))
    return tuple(sorted(taken))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps, the clean class weighted ``CLEAN_WEIGHT`` times the toxic one; weights are kept at 0 or more."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 * CLEAN_WEIGHT / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge * len(y) / 100] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, grad)
        w -= step
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn stems and weights from a bounded sample of labelled rows. Without rows of both labels nothing scores over 0.5."""
    sample = training_sample(docs, labels, rows).repartition(16).cache()
    size = {r.toxic: r for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("letters")).collect()}
    if len(size) < 2:
        sample.unpersist()
        return Model((), (0.0,) * FEATURES, -2.0)
    ratio = (size[0].letters or 1) / (size[1].letters or 1)
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5) * ratio)
    row_odds = F.log((F.col("bad_rows") + 0.5) / (F.col("good_rows") + 0.5) * (size[0].rows / size[1].rows))
    kind = "stem string, " + ", ".join(f"{c} long" for c in _COUNTS)
    counted = sample.mapInArrow(_count_stems, kind).groupBy("stem").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    enough = (F.col("bad_rows") >= max(LEAST_ROWS, LEAST_SHARE * size[1].rows)) & (row_odds >= LEAST_ODDS / 2)
    likely = counted.withColumn("odds", odds).filter(enough & (F.col("odds") >= LEAST_ODDS))
    stems = _families((r.stem, r.odds) for r in likely.orderBy(F.desc("odds"), F.length("stem"), "stem").limit(STEMS).collect())
    blank = Model(stems, (0.0,) * FEATURES, 0.0)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = blank.scorer()
        for batch in batches:
            found = [scorer.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1).cast(pa.int32())], names=["x", "toxic"])

    table = sample.mapInArrow(measured, "x array<double>, toxic int").collect()  # at most 2 * rows
    sample.unpersist()
    weights, bias = _logistic(np.array([r.x for r in table]), np.array([r.toxic for r in table], float))
    return Model(stems, tuple(weights.tolist()), bias)


def toxicity(model: Model, text: str = "text") -> Column:
    """The score of a text column, 0 to 1; a null counts as empty."""
    scorers: list[Scorer] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not scorers:
            scorers.append(model.scorer())
        return pa.array([scorers[0].score(t.as_py()) for t in texts], pa.float64())

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``. Null and empty texts have the score of no match."""
    score = toxicity(fit(docs, labels))
    out = docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with their columns."""
    return docs.filter(toxicity(fit(docs, labels)) < 0.5)
