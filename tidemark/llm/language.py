"""Language identification by cross-parsing: the language whose sample text needs the fewest phrases to spell a document.

A suffix automaton of a language's sample recognizes exactly its substrings. Reading a document with it, the longest run that still is a
substring is a phrase; where it ends the next begins. Related text parses into few long phrases. Automata are laid out as
transition tables that also carry the phrase ends, so that all windows of a batch advance by one letter in one array step.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import held_out
from tidemark.llm.words import blocks

#: Labelled documents that a language's sample takes, and the letters up to which a document is preferred for it; symbols that have a column of their
#: own in the tables, others being looked up; letters of a window. The first two bound the sample, the others steer speed alone.
SAMPLE_DOCS, SAMPLE_LETTERS, DENSE, WINDOW = 16, 1600, 120, 256
_END = 1 << 30  # marks a transition that begins a new phrase
_SYMBOL_BITS = 21


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``, by state."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Parser:
    """The automata of all languages over one alphabet: 0 for what is no letter, 1 for letters no sample has, then every letter of a sample.

    A state is its place in the table of frequent symbols. Transitions by other symbols lie in a sorted list of (state, symbol), so a
    script of thousands of letters costs what its sample holds.
    """

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        seen = Counter(c for parts in samples.values() for part in parts for c in part.lower() if c.isalpha())
        letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]
        self.width = min(len(letters), DENSE) + 2
        self.symbol = np.where(_is_letter(), 1, 0).astype(np.int32)
        for k, c in enumerate(letters):
            self.symbol[ord(c)] = k + 2
        tables, roots, keys, values, self.bits, base = [], [], [], [], [], 0
        for language in self.languages:
            text = np.concatenate([np.append(self._symbols(part), 0) for part in samples[language]] or [np.zeros(1, np.int32)])
            moves = suffix_automaton(text.tolist())
            if base + len(moves) * self.width >= _END:
                raise ValueError("the samples of all languages together need over 2^30 transitions; take fewer documents of each")
            table = np.full((len(moves), self.width), -1, np.int64)
            for state, found in enumerate(moves):
                for symbol, target in found.items():
                    if symbol < self.width:
                        table[state, symbol] = target
                    else:  # what is read in the first state begins a phrase
                        keys.append((base // self.width + state) << _SYMBOL_BITS | symbol)
                        values.append((base + target * self.width) | (0 if state else _END))
            table[:, 1] = -1  # an unknown letter is a phrase of its own
            first = np.where(table[0] >= 0, table[0], 0)
            table = np.where(table >= 0, base + table * self.width, (base + first * self.width) | _END)
            table[0] |= _END  # what is read in the first state, after an unknown letter as well, begins a phrase
            tables.append(table.astype(np.int32).ravel())
            roots.append(base)
            self.bits.append(math.log2(len(text) + 1))
            base += table.size
        self.roots = np.array(roots, np.int32)[:, None]
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(values, np.int32)[order], 0).astype(np.int32)

    def _symbols(self, text: str) -> np.ndarray:
        """The letters of a text, each run of other characters as one 0."""
        s = self.symbol[codes(text)]
        return s[(s > 0) | np.concatenate(([False], s[:-1] > 0))]

    def _look_up(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (states.astype(np.int64) // self.width) << _SYMBOL_BITS | symbols
        at = np.searchsorted(self.keys, wanted)
        return self.values[at], self.keys[at] == wanted

    def _step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states, by language and window, after one symbol of each window, with ``_END`` where it begins a phrase."""
        rare = symbols >= self.width
        if not rare.any():
            return self.table[states + symbols]
        found = self.table[states + np.where(rare, 0, symbols)]
        at = np.flatnonzero(rare)
        inside, known = self._look_up(states[:, at], symbols[at])
        fresh, begins = self._look_up(np.broadcast_to(self.roots, inside.shape), symbols[at])
        found[:, at] = np.where(known, inside, np.where(begins, fresh | _END, self.roots | _END))
        return found

    def _read(self, windows: np.ndarray, left: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state in which each window ends, and the phrases that begin in it, given the state it is entered with."""
        order = np.argsort(-left, kind="stable")
        steps = np.ascontiguousarray(windows[order].T)
        alive = np.searchsorted(-left[order], -np.arange(WINDOW), "left")  # windows longer than each step
        state, total = np.ascontiguousarray(states[:, order]), np.zeros(states.shape, np.int32)
        for k in range(WINDOW):
            n = alive[k]
            if not n:
                break
            found = self._step(state[:, :n], steps[k, :n])
            total[:, :n] += found >> 30
            state[:, :n] = found & (_END - 1)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[:, back], total[:, back]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, and the phrases of the whole text by language.

        Texts are cut into windows of ``WINDOW`` symbols that are read side by side, at first as if each began a phrase. A window whose
        predecessor turns out to end in another state than it was entered with is read again from that state, until none is left. Readings
        from different states soon meet in one, so this takes few rounds; the counts are those of reading every text in one go.
        """
        rows = [self._symbols(t) for t in texts]
        sizes = np.array([len(r) for r in rows], np.int64)
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        windows = -(-sizes // WINDOW)
        if windows.sum() and self.languages:
            padded, left = np.zeros((windows.sum(), WINDOW), np.int32), np.zeros(windows.sum(), np.int64)
            ends = np.cumsum(windows)
            for k, r in enumerate(rows):
                if len(r):
                    padded[ends[k] - windows[k] : ends[k]].reshape(-1)[: len(r)] = r
                    left[ends[k] - windows[k] : ends[k]] = np.minimum(WINDOW, len(r) - WINDOW * np.arange(windows[k]))
            row = np.repeat(np.arange(len(texts)), windows)
            follows = np.append(row[1:] == row[:-1], False)
            entered = np.repeat(self.roots, len(left), 1)
            ended, total, open_ = entered.copy(), np.zeros(entered.shape, np.int32), np.arange(len(left))
            while len(open_):
                ended[:, open_], total[:, open_] = self._read(padded[open_], left[open_], entered[:, open_])
                before = open_[follows[open_]]
                before = before[(entered[:, before + 1] != ended[:, before]).any(axis=0)]
                entered[:, before + 1] = ended[:, before]
                open_ = before + 1
            for k in range(len(self.languages)):
                counts[:, k] = np.bincount(row, total[k], len(texts))
        return sizes, counts

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` and 0 without a letter."""
        _, counts = self.phrases(texts)
        out = []
        for text, count in zip(texts, counts, strict=True):
            if not self.languages or not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            cost = count * self.bits
            order = np.argsort(cost, kind="stable")
            second = cost[order[1]] if len(order) > 1 else math.inf
            out.append((self.languages[order[0]], float(1 - cost[order[0]] / second) if second else 0.0))
        return out


def samples(docs: DataFrame, per_language: int = SAMPLE_DOCS, letters: int = SAMPLE_LETTERS) -> dict[str, list[str]]:
    """The whole texts of at most ``per_language`` documents of each language outside the held-out fifth.

    Documents of up to ``letters`` letters come first, in the order of a hash of their id, then longer ones, the shortest first. So the sample is
    bounded by its number of documents, and in letters wherever a language has enough documents of that size. Ids are drawn before
    texts are touched and broadcast to the scan; a label of documents without ids is not learned.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & (F.length("text") > 0))
    size = F.greatest(F.length("text"), F.lit(letters))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("size", F.xxhash64("doc_id"), "doc_id"))
    drawn = usable.select("doc_id", "lang", size.alias("size")).withColumn("rank", rank).filter(F.col("rank") <= per_language).drop("size")
    texts = docs.select("doc_id", "text", F.col("lang").alias("l")).join(F.broadcast(drawn), "doc_id").filter("l = lang")
    out: dict[str, list[str]] = {}
    for r in sorted(texts.select("lang", "rank", "text").collect(), key=lambda r: (r.lang, r.rank, r.text or "")):
        out.setdefault(r.lang, []).append(r.text or "")
    return {language: parts[:per_language] for language, parts in out.items()}


def language_of(sample: dict[str, list[str]], text: str = "text"):
    """``struct<lang, score>`` of a text column; null counts as empty."""
    made: list[Parser] = []

    @F.arrow_udf("struct<lang:string, score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Parser(sample))
        found: list[tuple[str, float]] = []
        for first, last in blocks(texts):
            found += made[0].predict([t or "" for t in texts.slice(first, last - first).to_pylist()])
        return pa.StructArray.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], names=["lang", "score"])

    return predict(text)


def predict_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text, lang, any others).

    Whole texts are parsed. The score is what the best language saves against the second. Texts that are null or
    have no letter are ``und``, and so is every text if nothing is labelled. Ties go to the first label by name. Null, repeated and equal
    rows each give their row; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), language_of(samples(docs)).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
