"""Benchmark passages in documents: a set join that only looks up the rarest shingle of each window.

A document that holds a window of an item holds all of the window's shingles, so for containment one shingle is a sufficient
prefix, and the best one is the rarest in the documents. Documents emit the places where such an anchor may stand; a join on
the anchor, bounds on position and length and a comparison word by word leave the real occurrences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import words
from tidemark.llm.store import bitmap, document_key, stored

#: Words of a window and of a shingle; a document is contaminated if at least one in ``SHARE`` of its words is hit.
WINDOW, SHINGLE, SHARE = 13, 3, 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``win, size, item_id``: every run of ``window`` words of an item, joined by spaces; a shorter item is one run."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    each = items.select("item_id", F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0)).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    each = each.withColumn("size", size).withColumn("at", at)
    return each.select(F.concat_ws(" ", F.slice("w", F.col("at"), F.col("size"))).alias("win"), "size", "item_id").distinct()


def _shingles_of(shingle: int):
    @F.arrow_udf("array<struct<hash:long, skip:int>>")
    def of(wins: pa.Array) -> pa.Array:
        _, _, _, hashes, rows = words.row_words(wins, words.ALPHANUMERIC)
        out = []
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            found = words.shingles(hashes[a:b], min(shingle, b - a)).view(np.int64)
            out.append([{"hash": int(h), "skip": k} for k, h in enumerate(found)])
        return pa.array(out, pa.list_(pa.struct([("hash", pa.int64()), ("skip", pa.int32())])))

    return of


def _places(hashes: np.ndarray, rows: np.ndarray, widths: list[int], bits: words.Bits) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word position of the shingles of a block that may be looked for, none across rows."""
    found, places = [], []
    for width in widths:
        runs = words.shingles(hashes, width)
        at = np.flatnonzero(bits.has(runs))
        at = at[at + width <= rows[np.searchsorted(rows, at, "right")]] if len(at) else at
        found.append(runs[at])
        places.append(at)
    return np.concatenate(found), np.concatenate(places)


def _frequencies(docs: DataFrame, bits, widths: list[int]) -> DataFrame:
    """``hash, df``: in how many documents the shingles in question stand."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            texts = batch.column(0)
            for first, last in words.blocks(texts):
                _, _, _, hashes, rows = words.row_words(texts.slice(first, last - first), words.ALPHANUMERIC)
                found, at = _places(hashes, rows, widths, bits.value)
                row = np.searchsorted(rows, at, "right")
                pairs = np.unique(np.stack([row.astype(np.uint64), found]), axis=1)[1]
                seen.update(pairs.view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["hash", "n"])

    return docs.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("df"))


def _candidates(bits, widths: list[int], window: int):
    kind = "struct<n_words:long, found:array<struct<hash:long, pos:long, first:long, context:string>>>"
    entry = pa.struct([("hash", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()), ("context", pa.string())])

    @F.arrow_udf(kind)
    def find(texts: pa.Array) -> pa.Array:
        """Words of a text and the places of possible anchors, with the words around them that a window could cover."""
        counts, out = [], []
        for begin, end in words.blocks(texts):
            raw, starts, ends, hashes, rows = words.row_words(texts.slice(begin, end - begin), words.ALPHANUMERIC)
            counts.append(np.diff(rows))
            found, at = _places(hashes, rows, widths, bits.value)
            per_row: list[list[dict]] = [[] for _ in range(end - begin)]
            for h, p in zip(found.view(np.int64).tolist(), at.tolist(), strict=True):
                row = int(np.searchsorted(rows, p, "right")) - 1
                a, b = max(rows[row], p - window + 1), min(rows[row + 1], p + window)
                context = b" ".join(raw[starts[k] : ends[k]].tobytes() for k in range(a, b)).lower().decode()
                per_row[row].append({"hash": h, "pos": p - rows[row], "first": a - rows[row], "context": context})
            out.extend(per_row)
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(out, pa.list_(entry))], names=["n_words", "found"])

    return find


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}.key") == F.col(f"{b}.key")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """``doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs`` (doc_id, text, any others).

    ``items`` has item_id and text. Words are runs of digits, letters a-z after lower-casing A-Z, and non-ASCII characters. A window is
    ``window`` consecutive words of an item, or a whole shorter item; a document word inside any occurrence is hit.

    Null and empty texts have no words and are clean. Items without an id mark words but are not listed. Repeated items are one item, repeated
    rows of ``docs`` get the same result each; ``key`` tells rows of one id with different texts apart. Empty tables are fine.
    """
    listed = stored(windows_of(items, window), "windows")
    wins = listed.select("win", "size").distinct()
    parts = wins.select("win", "size", F.explode(_shingles_of(shingle)("win")).alias("s")).select("win", "size", "s.*")
    parts = stored(parts, "shingles")
    widths = sorted({min(shingle, r.size) for r in wins.select("size").distinct().collect()})  # at most ``window`` values
    if not widths:
        empty = docs.select("doc_id", document_key().alias("key"), _candidates_none().alias("n_words"))
        return _verdict(empty.withColumns({"n_hit": F.lit(None).cast("long"), "ids": F.array().cast("array<string>")}), share)
    hashes = parts.select("hash").distinct()
    wanted = bitmap(hashes, "hash", hashes.count())
    rarity = parts.join(_frequencies(docs, wanted, widths), "hash")  # a shingle in no document drops out: so may its windows
    present = rarity.groupBy("win", "size").agg(F.min(F.struct("df", "hash", "skip")).alias("a"), F.countDistinct("hash").alias("n"))
    all_of = parts.groupBy("win").agg(F.countDistinct("hash").alias("all"))
    anchors = present.join(all_of, "win").filter("n = all").select("win", "size", "a.hash", "a.skip")
    anchors = stored(anchors, "anchors")
    looked_up = bitmap(anchors.select("hash").distinct(), "hash", anchors.count())
    scanned = docs.select("doc_id", document_key().alias("key"), _candidates(looked_up, widths, window)("text").alias("c"))
    scanned = stored(scanned.select("doc_id", "key", "c.*"), "candidates")
    places = scanned.filter(F.size("found") > 0).select("doc_id", "key", "n_words", F.explode("found").alias("f")).select("doc_id", "key", "n_words", "f.*")
    start = F.col("pos") - F.col("skip")
    fits = (start >= F.col("first")) & (start + F.col("size") <= F.col("n_words"))
    taken = F.concat_ws(" ", F.slice(F.split("context", " "), (start - F.col("first") + 1).cast("int"), F.col("size")))
    hits = places.join(anchors, "hash").filter(fits).filter(taken == F.col("win"))
    hits = stored(hits.select("doc_id", "key", start.alias("start"), (start + F.col("size")).alias("stop"), "win").distinct(), "hits")
    before = F.max("stop").over(Window.partitionBy("key", "doc_id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    gained = F.greatest(F.col("stop") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    covered = hits.select("doc_id", "key", gained.alias("gained")).groupBy("key", "doc_id").agg(F.sum("gained").alias("n_hit"))
    named = hits.select("doc_id", "key", "win").distinct().join(listed.select("win", "item_id"), "win")
    named = named.filter(F.col("item_id").isNotNull()).select("doc_id", "key", F.col("item_id").cast("string").alias("id")).distinct()
    named = named.groupBy("key", "doc_id").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    found = covered.alias("c").join(named.alias("m"), _same("c", "m"), "left").select("c.*", "m.ids")
    rows = scanned.select("doc_id", "key", "n_words").alias("r").join(found.alias("f"), _same("r", "f"), "left")
    return _verdict(rows.select("r.*", "f.n_hit", F.coalesce("f.ids", F.array().cast("array<string>")).alias("ids")), share)


def _candidates_none() -> Column:
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    return F.size(F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))).cast("long")


def _verdict(rows: DataFrame, share: int) -> DataFrame:
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = contamination(docs, items).filter("contaminated").select("doc_id", "key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), document_key().alias("key"))
    same = (F.col("r.key") == F.col("b.key")) & F.col("r.row.doc_id").eqNullSafe(F.col("b.doc_id"))
    return rows.alias("r").join(bad.alias("b"), same, "left_anti").select("r.row.*")
