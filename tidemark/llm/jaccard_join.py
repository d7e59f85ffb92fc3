"""Grouped prefix join: documents whose sets of word shingles overlap by a given Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words
from tidemark.llm.linking import connect
from tidemark.llm.store import bitmap, document_key, stored

#: Words of a shingle and the similarity, in percent, from which two documents link.
WIDTH, PERCENT = 5, 80
#: Prefixes are this many percent of a set longer than needed to share one shingle, so partners share as many more.
SLACK = 6
_SKETCH = 1 << 20


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer than ``width`` words make one shingle, none make none."""
    for first, last in words.blocks(texts):
        _, _, _, hashes, rows = words.row_words(texts.slice(first, last - first), words.SPACED)
        runs = words.shingles(hashes, width)
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            else:
                yield np.full(int(b > a), words.sequence_hash(hashes[a:b]), np.uint64)


def _common(docs: DataFrame, width: int):
    """Broadcast array of frequency classes: of each of 2^20 hash buckets the rounded binary logarithm of its heavy use, else 0.

    Tasks report buckets far above their own average, so what is sent does not grow with the text read. The classes only
    order the shingles; any order gives the same result, this one keeps passages that many documents share out of prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_SKETCH, np.int64)
        for batch in batches:
            for found in shingle_sets(batch.column(0), width):
                seen[(found & np.uint64(_SKETCH - 1)).astype(np.int64)] += 1
        heavy = np.flatnonzero(seen >= max(3, 6 * seen.mean() + 2))
        yield pa.RecordBatch.from_arrays([pa.array(heavy), pa.array(seen[heavy])], names=["bucket", "n"])

    total = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = total.toArrow()  # at most 2^20 rows
    classes = np.zeros(_SKETCH, np.uint64)
    classes[found["bucket"].to_numpy()] = np.log2(found["n"].to_numpy()).astype(np.uint64) + np.uint64(1)
    return docs.sparkSession.sparkContext.broadcast(classes)


def _surplus(n: int) -> int:
    """How many shingles of two partners' prefixes are common at least, if the smaller has ``n``."""
    return 1 + n * SLACK // 100


def _marks(found: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that tell a set of hashes from others."""
    return words.mix(found).sum(dtype=np.uint64), words.mix(~found).sum(dtype=np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _signatures(docs: DataFrame, common, width: int, percent: int) -> DataFrame:
    """``doc_id, at`` (a hash of it), size, set signature, its first half, and the prefix with its own signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in words.blocks(batch.column(2)):
                rows = batch.slice(first, last - first)
                sizes, sigs, marks, leads, prefixes = [], [], [], [], []
                for found in shingle_sets(rows.column(2), width):
                    n = len(found)
                    token = found >> np.uint64(8) | common.value[(found & np.uint64(_SKETCH - 1)).astype(np.int64)] << np.uint64(56)
                    needed = n - -(-percent * n // 100) + _surplus(n) if n else 0
                    prefix = np.sort(np.partition(token, needed - 1)[:needed]) if needed else token
                    one, two = _marks(found)
                    sizes.append(n)
                    sigs.append(np.array([one, two]).tobytes())
                    marks.append(one)
                    one, two = _marks(prefix)
                    leads.append(np.array([one, two + np.uint64(n)]).tobytes())
                    prefixes.append(prefix)
                made = [
                    pa.array(sizes, pa.int64()),
                    pa.array(sigs, pa.binary()),
                    pa.array(np.array(marks, np.uint64).view(np.int64)),
                    pa.array(leads, pa.binary()),
                    _lists(prefixes),
                ]
                names = ["doc_id", "at", "n", "sig", "mark", "lead", "prefix", "key"]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *made, rows.column(3)], names=names)

    long = T.LongType()
    types = {"at": long, "n": long, "sig": T.BinaryType(), "mark": long, "lead": T.BinaryType(), "prefix": T.ArrayType(long), "key": long}
    fields = [T.StructField(n, t) for n, t in types.items()]
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *fields])
    return docs.select("doc_id", F.xxhash64("doc_id").alias("at"), "text", document_key().alias("key")).mapInArrow(sign, kind)


def _shared(bits):
    @F.arrow_udf("array<struct<token:long, pos:long>>")
    def shared(prefixes: pa.Array) -> pa.Array:
        """The tokens of a prefix that other documents may have, with their positions from 1."""
        prefixes = prefixes.cast(pa.large_list(pa.int64()))
        ends = prefixes.offsets.to_numpy()
        tokens = prefixes.values.to_numpy()[ends[0] : ends[-1]]
        ends = ends - ends[0]
        keep = bits.value.has(tokens.view(np.uint64)) if len(tokens) else np.zeros(0, bool)
        at = np.arange(1, len(tokens) + 1) - np.repeat(ends[:-1], np.diff(ends))
        inside = np.concatenate(([0], np.cumsum(keep)))[ends].astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(tokens[keep]), pa.array(at[keep], pa.int64())], names=["token", "pos"])
        return pa.ListArray.from_arrays(pa.array(inside), rows)

    return shared


def _sets(docs: DataFrame, bits, width: int) -> DataFrame:
    """``sig, items``: the whole sets of the documents whose id may be in a bitmap."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(bits.value.has(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
            for first, last in words.blocks(chosen.column(1)):
                sets = list(shingle_sets(chosen.column(1).slice(first, last - first), width))
                sigs = [np.array(_marks(s)).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), _lists(sets)], names=["sig", "items"])

    return docs.select(F.xxhash64("doc_id").alias("at"), "text", document_key().alias("key")).mapInArrow(whole, "sig binary, items array<bigint>")


def similar_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text, any others); see :func:`_components`."""
    return _components(docs, width, percent).drop("key")


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, key`` for every row of ``docs``; ``key`` tells texts of one id apart.

    1. One scan finds heavily used shingles, a second orders every document's shingles, rare first, and stores size, signature and
       the prefix that a partner must share some shingles with.
    2. Shingles in the prefixes of two different sets are the shared ones. Only they go further, found through a bitmap
       of bounded size, and only documents with as many of them as a partner must share: a common passage is not enough. Documents with the same prefix and size form one group.
    3. Groups meet in the buckets of their shared shingles; size and position bounds reject pairs of groups. Pairs that pass are
       expanded to members, must share enough of their prefixes, and are verified on whole sets (see :mod:`tidemark.llm.linking` for how hot buckets are handled).

    Nulls and empty texts have no shingles and link with nothing. Equal sets are one class from the start. Rows with one id are one
    document in ``component_id``; a null id is never the smallest. An empty table gives an empty result.
    """
    common = _common(docs, width)
    whole = stored(_signatures(docs, common, width, percent), "signatures")
    some = whole.filter("n > 0")
    tokens = some.select("mark", F.explode("prefix").alias("token"))
    several = tokens.groupBy("token").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).filter("lo <> hi").select("token")
    several = stored(several, "shared")
    bits = bitmap(several, "token", several.count())
    smallest = F.ceil(F.col("n") * percent / 100)  # of a partner
    near = some.select("doc_id", "at", "n", "sig", "lead", F.element_at("prefix", -1).alias("last"), _shared(bits)("prefix").alias("tokens"))
    near = near.filter(F.size("tokens") >= 1 + F.floor(smallest * SLACK / 100))
    classes = near.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("at", "n", "lead", "last", "tokens")])
    classes = stored(classes, "classes")
    groups = classes.groupBy("lead").agg(F.min("sig").alias("gid"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("size"))
    groups = stored(groups, "groups")
    members = groups.select("gid", "n", "size", F.explode("tokens").alias("t"))
    members = members.select(F.col("t.token").alias("bucket"), "gid", "size", "n", "t.pos")
    membership = stored(classes.select("lead", F.col("sig").alias("id")).join(groups.select("lead", "gid"), "lead").select("gid", "id"), "membership")
    prefixes = classes.select("sig", "n", "last", F.col("tokens.token").alias("shared"))

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs whose prefixes share so much that the sets still may.

        What two sets share beyond their prefixes lies behind the end of the prefix that ends first, in the order of shingles.
        """
        for side in "ab":
            columns = [F.col(c).alias(f"{c}_{side}") for c in ("n", "last", "shared")]
            pairs = pairs.join(prefixes.select(F.col("sig").alias(side), *columns), side)
        behind = {x: F.ceil(F.col(f"n_{x}") * percent / 100) - 1 - F.floor(F.col(f"n_{x}") * SLACK / 100) for x in "ab"}
        behind = F.when(F.col("last_a") <= F.col("last_b"), behind["a"]).otherwise(behind["b"])
        most = F.size(F.array_intersect("shared_a", "shared_b")) + behind
        return pairs.filter((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs that link, by their whole sets; those are made anew for the documents in question only."""
        pairs = stored(possible(pairs), "possible")
        ids = pairs.select(F.col("a").alias("sig")).unionAll(pairs.select("b")).distinct()
        wanted = stored(ids.join(classes.select("sig", "at"), "sig"), "wanted")
        sets = _sets(docs, bitmap(wanted, "at", wanted.count()), width)
        sets = sets.join(wanted.select("sig"), "sig", "left_semi").groupBy("sig").agg(F.first("items").alias("items"))
        sets = stored(sets, "sets")
        left = sets.select(F.col("sig").alias("a"), F.col("items").alias("x"))
        right = sets.select(F.col("sig").alias("b"), F.col("items").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        return (
            pairs.join(left, "a")
            .join(right, "b")
            .select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).alias("t"))
            .filter(100 * F.col("c") >= percent * (F.col("t") - F.col("c")))
            .select("a", "b")
        )

    def admissible(a, b) -> Column:
        """Sizes can reach the similarity, and so can what is left behind the first shared shingle."""
        need = percent * (a("n") + b("n"))  # of (100 + percent) * common shingles
        return (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n"))) & (
            (100 + percent) * (F.least(a("n") - a("pos"), b("n") - b("pos")) + 1) >= need
        )

    roots = connect(members, verify, rank=("pos",), payload=("n",), admissible=admissible, membership=membership)
    lowest = some.groupBy("sig").agg(F.min("doc_id").alias("lo"))
    linked = lowest.join(roots.withColumnRenamed("id", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    linked = stored(linked, "linked")
    named = linked.groupBy("root").agg(F.min("lo").alias("component_id"))
    named = linked.join(named, "root").select(F.col("sig").alias("s"), "component_id")
    out = whole.withColumn("s", F.when(F.col("n") > 0, F.col("sig"))).join(named, "s", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "key")


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when every linked group keeps one document, that with the smallest id.

    Rows without words stay, and so do rows without an id and equal rows of the document that stays. Columns are those of ``docs``.
    """
    found = _components(docs, width, percent).filter("n_shingles > 0 and doc_id is not null and doc_id <> component_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), document_key().alias("key"))
    same = (F.col("r.key") == F.col("f.key")) & (F.col("r.row.doc_id") == F.col("f.doc_id"))
    return rows.alias("r").join(found.select("doc_id", "key").distinct().alias("f"), same, "left_anti").select("r.row.*")
