"""Token counts from a finite-state transducer compiled from a BPE vocabulary with word-end symbols.

The counting machine reads one symbol at a time. Which token ends at a place depends only on the tokens that could end shortly
before it, so a state holds those tokens for the places a later token may still begin at, and a transition is annotated with
the number of tokens it adds (which may be 0 or negative, when a longer token replaces shorter ones). States are made when they are first met.

White space puts every machine into its start state. A chunk of text therefore maps any entering state to one leaving state, and is
kept as (text before the first white space, tokens between, text after the last). Such maps compose associatively; the maps
of a long text are combined pairwise in a scan, so memory is bounded by the chunk.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of the vocabulary file, and characters of a chunk.
VOCABULARY, CHUNK = "word_bpe_49k.json", 1 << 16
_SPACE = regex.compile(r"\s")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for a byte: itself if printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Vocabulary:
    """What the compiled machine needs of a vocabulary file: its words' pattern, tokens, merges and special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = _byte_letters()
        self.known: set[str] = set()

    def _new(self, c: str) -> bool:
        """Whether this Python's character tables do not know a character; the library's may."""
        return unicodedata.category(c) == "Cn"

    @lru_cache(maxsize=4096)  # noqa: B019
    def _ask(self, c: str) -> tuple[str, str]:
        """Lower-case form of a character and one of its class, by the library's own normalizer and splitter."""
        from tokenizers import Tokenizer

        if not hasattr(self, "library"):
            self.library = Tokenizer.from_file(self.path)
        low = self.library.normalizer.normalize_str(c)
        splitter = self.library.pre_tokenizer
        shadow = []
        for x in low:
            first = len(splitter.pre_tokenize_str("a" + x)) == 1
            shadow.append("я" if first else "१" if len(splitter.pre_tokenize_str(x + "!")) == 2 else "¤")
        return low, "".join(shadow)

    def words(self, text: str) -> list[str]:
        """The words of a text after normalization; a special string is a word of its own."""
        if self.cut and "<|" in text:
            out: list[str] = []
            for part in self.cut.split(text):
                out.extend([part] if part in self.special else self._plain(part))
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.pattern.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        letters = set(text)
        if not self.known.issuperset(letters):
            self.known.update(c for c in letters if not self._new(c))
        if not self.known.issuperset(letters):
            asked = [self._ask(c) if self._new(c) else (lower(c),) * 2 for c in text]
            low, shadow = "".join(a for a, _ in asked), "".join(b for _, b in asked)
            return [low[slice(*m.span())] for m in self.pattern.finditer(shadow)]
        return self.pattern.findall(lower(text))

    def symbols(self, word: str) -> list[str]:
        """The letters of a word's bytes, the last with the word's end."""
        out = [self.letters[b] for b in word.encode()]
        out[-1] += self.end
        return out


def lower(text: str) -> str:
    """Lower case letter by letter: a capital sigma does not look at its neighbours."""
    return text.replace("Σ", "σ").lower()


class CountingTransducer:
    """Deterministic machine over the symbols of a word; see the module's text."""

    #: States kept before the table starts anew; the table is a cache of what the vocabulary implies.
    STATES = 300_000

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.parts: dict[str, tuple[str, ...]] = {}
        self.heads: set[tuple[str, ...]] = set()
        self.standing: dict[tuple[str, ...], str] = {}
        self.compatible: dict[tuple[str, str], bool] = {}
        for token in vocabulary.ids:
            self.parts[token] = self._cut(token)
        for token, parts in self.parts.items():
            if self._merge(parts) == [token]:
                self.standing[parts] = token
                for k in range(1, len(parts) + 1):
                    self.heads.add(parts[:k])
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.start = self._state((), ((None, 0),))

    def _cut(self, token: str) -> tuple[str, ...]:
        end = self.v.end
        if token.endswith(end) and len(token) > len(end):
            body = token[: -len(end)]
            return (*body[:-1], body[-1] + end)
        return tuple(token)

    def _merge(self, parts: tuple[str, ...]) -> list[str]:
        """The tokens of a run of symbols: its lowest-ranked pair merges until none is left."""
        out, get = list(parts), self.v.ranks.get
        while len(out) > 1:
            best, at = None, -1
            for k in range(len(out) - 1):
                rank = get((out[k], out[k + 1]))
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def _follows(self, left: str | None, right: str) -> bool:
        """Whether two tokens may stand side by side, which decides whole words as well."""
        if left is None:
            return True
        key = left, right
        if key not in self.compatible:
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            self.compatible[key] = self._merge(self.parts[left] + self.parts[right]) == [left, right]
        return self.compatible[key]

    def _state(self, recent: tuple[str, ...], ends: tuple) -> int:
        key = recent, ends
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return self.number[key]

    def _move(self, state: int, symbol: str) -> tuple[int, int]:
        """``recent``: the last symbols that may begin a longer token; ``ends``: for each place there that a token may still begin
        at, the token that ends at it and the tokens so far, less those at the newest place."""
        recent, ends = self.states[state]
        recent = (*recent, symbol)
        for k in range(len(recent)):
            token = self.standing.get(recent[k:])
            if token is not None and ends[k] is not None and self._follows(ends[k][0], token):
                added = ends[k][1] + 1
                break
        else:
            raise ValueError(f"no token of the vocabulary ends with {symbol!r}")
        if symbol.endswith(self.v.end) and len(symbol) > len(self.v.end):
            return self.start, added
        open_at = [recent[k:] in self.heads for k in range(len(recent))]
        keep = next((k for k, is_open in enumerate(open_at) if is_open), len(recent))
        ends = tuple((ends[k][0], ends[k][1] - added) if open_at[k] else None for k in range(keep, len(recent)))
        return self._state(recent[keep:], (*ends, (token, 0))), added

    def count(self, word: str) -> int:
        if len(self.states) > self.STATES:
            self._reset()
        state, total = self.start, 0
        for symbol in self.v.symbols(word):
            moves = self.moves[state]
            move = moves.get(symbol)
            if move is None:
                move = moves[symbol] = self._move(state, symbol)
            state, added = move
            total += added
        return total


class WordTable(dict):
    """Values of words, computed when first asked for; starts anew beyond ``LIMIT`` words."""

    LIMIT = 400_000

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, word: str):
        if len(self) > self.LIMIT:
            self.clear()
        self[word] = found = self.value(word)
        return found


class TokenCounter:
    def __init__(self, path: str, chunk: int = CHUNK):
        self.v, self.chunk = Vocabulary(path), chunk
        machine = CountingTransducer(self.v)
        self.table = WordTable(lambda w: 1 if w in self.v.special else machine.count(w))

    def tokens(self, text: str) -> int:
        return sum(map(self.table.__getitem__, self.v.words(text)))

    def chunk_map(self, piece: str) -> tuple[str, int, str] | str:
        """The map of a chunk; one without white space stays text, to be joined with its neighbours."""
        first = _SPACE.search(piece)
        if first is None:
            return piece
        last = next(k for k in range(len(piece) - 1, -1, -1) if _SPACE.match(piece, k))
        return piece[: first.start()], self.tokens(piece[first.start() : last]), piece[last + 1 :]

    def compose(self, a: tuple[str, int, str] | str, b: tuple[str, int, str] | str) -> tuple[str, int, str] | str:
        if isinstance(a, str):
            return a + b if isinstance(b, str) else (a + b[0], b[1], b[2])
        if isinstance(b, str):
            return a[0], a[1], a[2] + b
        return a[0], a[1] + self.tokens(a[2] + b[0]) + b[1], b[2]

    def count(self, text: str | None) -> int:
        """Tokens of a text of any length; null is empty."""
        if not text:
            return 0
        if len(text) <= self.chunk:
            return self.tokens(text)
        maps = [self.chunk_map(text[k : k + self.chunk]) for k in range(0, len(text), self.chunk)]
        while len(maps) > 1:  # neighbours combine, level by level
            maps = [self.compose(*maps[k : k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        whole = maps[0]
        return self.tokens(whole) if isinstance(whole, str) else self.tokens(whole[0]) + whole[1] + self.tokens(whole[2])


def token_count(text: str = "text", path: str | None = None, chunk: int = CHUNK) -> Column:
    """Tokens of a text column, as the vocabulary's own library counts them without added special tokens."""
    path, made = path or vocabulary_path(), []

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(TokenCounter(path, chunk))
        return pa.array([made[0].count(t.as_py()) for t in texts], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (doc_id, text, any others); null counts as empty.

    One scan and no shuffle. Repeated rows are counted each; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_count("text", path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
