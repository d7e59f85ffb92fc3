"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

A document's length is cut into pieces whose sizes fit reciprocals of the capacity. Whole sequences come first, then halves,
quarters, eighths ... while they fill their share exactly; a remainder shorter than ``capacity / FINE`` falls into the class k with
capacity / (k + 1) < length <= capacity / k. A bin of class k holds k pieces. Classes are filled apart from each other, and a class
with many pieces by many workers, none of which needs to know of another's bins. What would be a worker's part-filled last bins is put together by
first fit over its classes: a bounded number of pieces, since each class leaves less than one bin.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import stored
from tidemark.llm.tokens import Vocabulary, WordTable, vocabulary_path

#: Tokens of a sequence, the id after each document, the first class that may waste room, and the pieces one worker numbers.
CAPACITY, END_ID, FINE, WORKER_PIECES = 4096, 2, 16, 100_000


def cuts(length: int, capacity: int = CAPACITY, fine: int = FINE) -> Iterator[tuple[int, int]]:
    """Length and class of each piece of a document: class 1 fills a sequence, class k a k-th of one at most."""
    while length >= capacity:
        yield capacity, 1
        length -= capacity
    k = 2
    while length and k < fine:
        if length >= capacity // k:
            yield capacity // k, k
            length -= capacity // k
        k *= 2
    if length:
        yield length, capacity // length


#: Characters of most texts; among them the vocabulary's pattern for words needs no table of all letters. The pattern, the
#: characters, and the same words by a pattern over these characters alone.
_GENERAL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_COMMON = frozenset([*map(chr, range(32, 127)), "\n", "\t", *(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)), *"–—‘’“”…"])
_NARROW = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")


def words(vocabulary: Vocabulary, text: str) -> list[str]:
    """The words of a text, as :meth:`Vocabulary.words` finds them."""
    if vocabulary.pattern.pattern == _GENERAL and "<|" not in text and _COMMON.issuperset(text):
        return _NARROW.findall(text.lower())
    return vocabulary.words(text)


def _pieces(path: str, capacity: int, end_id: int, fine: int, with_ids: bool):
    made: list[tuple] = []

    def table() -> tuple:
        from tokenizers import Tokenizer

        vocabulary = Vocabulary(path)
        model = Tokenizer.from_file(path).model

        def ids(word: str) -> bytes:
            if word in vocabulary.special:
                found = [vocabulary.special[word]]
            else:
                found = [t.id for t in model.tokenize("".join(vocabulary.letters[b] for b in word.encode()))]
            return struct.pack(f"<{len(found)}I", *found)

        return vocabulary, WordTable(ids)

    kind = "struct<doc_tokens:long, pieces:array<struct<start:long, length:long, class:int, ids_crc32:long" + ", ids:binary" * with_ids + ">>>"

    @F.arrow_udf(kind)
    def cut(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(table())
        vocabulary, ids_of = made[0]
        close = struct.pack("<I", end_id)
        totals, first, starts, lengths, classes, sums, parts = [], [0], [], [], [], [], []
        for value in texts:
            ids = memoryview(b"".join([*map(ids_of.__getitem__, words(vocabulary, value.as_py() or "")), close]))
            totals.append(len(ids) // 4)
            at = 0
            for length, k in cuts(totals[-1], capacity, fine):
                part = ids[4 * at : 4 * (at + length)]
                starts.append(at)
                lengths.append(length)
                classes.append(k)
                sums.append(zlib.crc32(part))
                if with_ids:
                    parts.append(bytes(part))
                at += length
            first.append(len(starts))
        columns = {"start": pa.array(starts, pa.int64()), "length": pa.array(lengths, pa.int64()), "class": pa.array(classes, pa.int32())}
        columns |= {"ids_crc32": pa.array(sums, pa.int64())} | ({"ids": pa.array(parts, pa.binary())} if with_ids else {})
        pieces = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pieces)
        return pa.StructArray.from_arrays([pa.array(totals, pa.int64()), lists], names=["doc_tokens", "pieces"])

    return cut


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    fine: int = FINE,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece of every row of ``docs`` (doc_id, text, any others).

    ``with_ids`` adds the ids of the piece as little-endian 32-bit numbers. Every id of a document and its end id lie in one
    piece. Null and empty texts are the end id alone. Rows are packed each, repeated ones too. An empty table gives no pieces.

    Pieces of a class are dealt to enough workers that each numbers about ``WORKER_PIECES``; a class that holds a third of all
    pieces is many groups. Only the last sequence of a worker's left-over pieces stays part-filled.
    """
    cut = _pieces(path or vocabulary_path(), capacity, end_id, fine, with_ids)("text")
    cut = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), cut.alias("c"))
    rows = cut.select("doc_id", "key", "c.doc_tokens", F.explode("c.pieces").alias("p"))
    pieces = stored(rows.select("doc_id", "key", "doc_tokens", "p.*"), "pieces")
    workers = pieces.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / WORKER_PIECES).alias("workers"))  # at most ``capacity`` rows
    dealt = pieces.join(F.broadcast(workers), "class").withColumn("worker", F.pmod(F.xxhash64("key", "start"), F.col("workers")))
    dealt = dealt.drop("workers")
    group = Window.partitionBy("class", "worker")
    placed = dealt.withColumn("place", F.row_number().over(group.orderBy("key", "doc_id", "start", "ids_crc32")) - 1)
    placed = placed.withColumn("bin", (F.col("place") / F.col("class")).cast("long"))
    placed = placed.withColumn("full", (F.col("bin") + 1) * F.col("class") <= F.count(F.lit(1)).over(group))
    rest = placed.filter(~F.col("full")).drop("full", "place")
    rest = rest.groupBy("worker").applyInPandas(_first_fit(capacity), rest.schema)
    kept = placed.filter("full").drop("full", "place")
    both = kept.unionByName(rest)
    inside = Window.partitionBy("class", "worker", "bin").orderBy("key", "doc_id", "start", "ids_crc32")
    offset = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sequence = F.shiftleft(F.shiftleft(F.col("class").cast("long"), 20) + F.col("worker"), 30) + F.col("bin")
    both = both.withColumn("sequence_id", sequence).withColumn("offset", offset)
    return both.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))


def _first_fit(capacity: int):
    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        """Bins of class 0 for a worker's left-over pieces, longest first, each into the fullest bin that takes it."""
        rows = rows.sort_values(["length", "key", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True, True])
        room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
        bins, used = [], 0
        for length in rows["length"]:
            at = bisect.bisect_left(room, (length, -1))
            if at < len(room):
                free, number = room.pop(at)
            else:
                free, number, used = capacity, used, used + 1
            bisect.insort(room, (free - length, number))
            bins.append(number)
        return rows.assign(bin=bins, **{"class": 0})

    return fill
