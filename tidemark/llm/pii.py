"""Personal data by pattern, and the words around it that give it away, by what the corpus says of them. SQL functions only.

A word reveals a protected value if the two are seen together far more often than apart. With N documents and counts of the
documents that hold a word t, a value c, and t next to c, the word carries ``PMI(t; c) = log2(N * n(t, c) / (n(t) * n(c)))`` bits of the
``IC(c) = log2(N / n(c))`` bits it takes to name c. Where the share PMI / IC exceeds a threshold, t is generalised to its first
letters if these stay under the threshold, else removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

#: Share of a value's information that a word may carry, and the distinct texts that must show the two together.
DISCLOSURE, SUPPORT = 0.9, 3
#: Characters on each side of a value in which words count as next to it, and letters of a generalised word.
REACH, STEM = 200, 3
#: Characters of the pieces texts are cut into, so that the surroundings of a value are found without reading the text again.
_PIECE = 512

#: The kinds in their listed order. Each pattern finds what the plain one of the contract finds: a match can only start where the
#: last one ended or a run starts, and runs are taken whole, so nothing is read twice and long runs cost no more than their length.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind cannot occur; most texts lack it and skip the pattern.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """True if every second digit from the right, doubled and cast out of nines, and the others add up to a multiple of ten."""
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is one of the kind; matches that are not are dropped."""
    if kind == "ip":
        return match.rlike(_OCTETS)
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def ends(gaps: Column, matches: Column) -> Column:
    """Where each match ends, in characters, from the texts between matches and the matches. Blocks of 256 keep it near linear."""
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
    empty = F.expr("cast(array() as array<int>)")

    def running(values: Column, start: Column, before: bool) -> Column:
        def add(state: Column, x: Column) -> Column:
            upto = state["at"] + x
            return F.struct(upto.alias("at"), F.concat(state["all"], F.array(state["at"] if before else upto)).alias("all"))

        return F.aggregate(values, F.struct(start.alias("at"), empty.alias("all")), add)["all"]

    def blocks(steps: Column) -> Column:
        def block(b: Column) -> Column:
            return F.slice(steps, b * 256 + 1, F.lit(256))

        last = F.floor((F.size(steps) - 1) / 256).cast("int")
        sums = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.aggregate(block(b), F.lit(0), lambda s, x: s + x))
        starts = running(sums, F.lit(0), True)
        return F.flatten(F.transform(starts, lambda start, b: running(block(b), start, False)))

    return F.transform(F.array(steps), blocks)[0]  # an array of one, so that the steps are worked out once


def _matches(kind: str) -> Column:
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    empty = F.expr("cast(array() as array<string>)")
    return F.when(F.contains("text", F.lit(_NEEDS[kind])), found).otherwise(empty) if kind in _NEEDS else found


def _spans(kind: str) -> Column:
    """The valid matches of a kind with their places."""
    found = F.col(kind)
    gaps = F.split("text", PATTERNS[kind], -1)
    placed = F.zip_with(
        found,
        ends(gaps, found),
        lambda m, e: F.struct((e - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), e.alias("end"), m.alias("value")),
    )
    return F.when(F.size(found) > 0, F.filter(placed, lambda s: valid(kind, s["value"]))).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, base``: the values of every text by kind, start, end (exclusive, in characters), the array empty where there are none.

    Leftmost matches of each kind that do not overlap; matches that fail their kind's test are dropped, not tried again.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.select("doc_id", "text", *[_matches(kind).alias(kind) for kind in PATTERNS])
    return found.select("doc_id", "text", F.array_sort(F.concat(*[_spans(kind) for kind in PATTERNS])).alias("base"))


def _plain() -> Column:
    """The text with its emails blanked, character for character, so that their letters are no words."""
    gaps = F.split("text", PATTERNS["email"], -1)
    blank = F.transform(F.regexp_extract_all("text", F.lit(PATTERNS["email"]), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    joined = F.concat_ws("", F.flatten(F.zip_with(gaps, blank, lambda g, b: F.array(g, F.coalesce(b, F.lit(""))))))
    return F.when(F.contains("text", F.lit("@")), joined).otherwise(F.col("text"))


def _words(text: Column) -> Column:
    """The distinct lower-case words (runs of two or more letters) of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"\P{L}+"), lambda w: F.length(w) > 1))


def stem(word: Column) -> Column:
    """The general form of a word: its first letters and an asterisk."""
    return F.concat(F.substring(word, 1, STEM), F.lit("*"))


def _nearby(span: Column) -> Column:
    """The text within ``REACH`` characters of a span, without words the reach cuts; ``pieces`` are the text in pieces of ``_PIECE``."""

    def piece(k: Column) -> Column:
        return F.coalesce(F.try_element_at("pieces", F.when(k >= 0, k + 1).otherwise(F.size("pieces") + 1)), F.lit(""))

    k = F.floor(span["start"] / _PIECE).cast("int")
    left = F.concat(piece(k - 1), F.substring(piece(k), F.lit(1), span["start"] - k * _PIECE))
    left = F.when(F.length(left) > REACH, F.regexp_replace(F.substring(left, -REACH - 1, REACH + 1), r"^\p{L}*", "")).otherwise(left)
    k = F.floor(span["end"] / _PIECE).cast("int")
    right = F.concat(F.substring(piece(k), span["end"] - k * _PIECE + 1, F.lit(_PIECE)), piece(k + 1))
    right = F.when(F.length(right) > REACH, F.regexp_replace(F.substring(right, 1, REACH + 1), r"\p{L}*$", "")).otherwise(right)
    return F.concat_ws(" ", left, right)


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, n``: of every word and every general form, by its hash, the number of documents that hold it. Folded per task first."""
    words = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(_words(_plain()).alias("words"))
    terms = words.select(F.explode(F.concat("words", F.array_distinct(F.transform("words", stem)))).alias("t"))
    return terms.groupBy(F.xxhash64("t").alias("h")).agg(F.count(F.lit(1)).alias("n"))


def disclosing_words(docs: DataFrame, texts: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``key, term, replacement``: the words of each text that reveal a value next to them beyond the threshold.

    ``texts`` (key, n, text, base) are the distinct texts with values, each standing for ``n`` documents. Counts run over all documents.
    Only words next to a value in ``support`` distinct texts or more are judged; a value in fewer texts has none. ``replacement`` is the
    general form if that stays under the threshold, else empty.
    """
    cut = texts.select("key", "n", "base", _plain().alias("text"))
    cut = cut.select("key", "n", "base", F.regexp_extract_all("text", F.lit(r"(?s).{1,%d}" % _PIECE), F.lit(0)).alias("pieces"))
    near = cut.select("key", "n", F.explode(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), _nearby(s).alias("near")))).alias("s"))
    near = stored(near.select("key", "n", F.xxhash64("s.kind", "s.value").alias("c"), F.col("s.near").alias("near")), "near")
    values = near.select("key", "n", "c").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n_c"))
    values = values.filter(F.col("texts") >= support).select("c", "n_c")
    beside = near.join(values, "c").select("key", "n", "c", "n_c", F.explode(_words(F.col("near"))).alias("term")).distinct()
    beside = stored(beside, "beside")
    both = beside.select("key", "n", "c", "n_c", F.explode(F.array("term", stem(F.col("term")))).alias("t")).distinct()
    both = both.groupBy("c", "n_c", "t").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n_tc"))
    both = stored(both.filter(F.col("texts") >= support).withColumn("h", F.xxhash64("t")), "both")
    counts = word_counts(docs).join(both.select("h").distinct(), "h", "left_semi")
    total = docs.count()
    pmi = F.log2(F.col("n_tc") * F.lit(float(total)) / (F.col("n") * F.col("n_c")))
    told = both.join(counts, "h").select("c", "t", (pmi > disclosure * F.log2(F.lit(float(total)) / F.col("n_c"))).alias("reveals"))
    told = stored(told.filter("reveals").select("c", "t"), "told")
    found = beside.join(told.withColumnRenamed("t", "term"), ["c", "term"]).select("key", "c", "term", stem(F.col("term")).alias("general"))
    stems = told.select("c", F.col("t").alias("general"), F.lit(True).alias("known"))
    found = found.join(stems, ["c", "general"], "left").groupBy("key", "term").agg(F.max("known").alias("known"), F.first("general").alias("general"))
    return found.select("key", "term", F.when(F.col("known"), "").otherwise(F.col("general")).alias("replacement"))


def _term_spans(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``key, terms``: every place of a text's revealing words."""
    found = texts.join(terms.select("key").distinct(), "key", "left_semi").select("key", _plain().alias("text"))
    found = found.select("key", F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)).alias("w"), F.split("text", r"\p{L}+", -1).alias("gaps"))
    words = found.select("key", F.explode(F.arrays_zip(F.col("w"), ends(F.col("gaps"), F.col("w")).alias("end"))).alias("x"))
    words = words.select("key", F.lower("x.w").alias("term"), F.length("x.w").alias("length"), F.col("x.end").alias("end"))
    hit = words.join(terms, ["key", "term"])
    start, kind = F.col("end") - F.col("length"), F.lit(KINDS.index("term"))
    span = F.struct(start.alias("start"), kind.alias("kind"), "end", F.col("replacement").alias("value"))
    return hit.groupBy("key").agg(F.collect_list(span).alias("terms"))


def _marked(docs: DataFrame, disclosure: float, support: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, base`` of every document, and ``key, spans`` of every text with values; the key is a hash of the text."""
    held = F.size("base") > 0
    marked = base_spans(docs).select("doc_id", F.when(held, _key()).alias("key"), F.when(held, F.col("text")).alias("text"), "base")
    marked = stored(marked, "marked")
    texts = marked.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text", "base")).alias("x"))
    texts = stored(texts.select("key", "n", "x.text", "x.base"), "texts")
    terms = stored(disclosing_words(docs, texts, disclosure, support), "terms")
    both = texts.select("key", "base").join(_term_spans(texts, terms), "key", "left")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms")))
    return marked.drop("text"), both.select("key", spans.alias("spans"))


def _key() -> Column:
    return F.unhex(F.md5("text"))


def find_spans(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, base, spans``: the personal data of every document, and with it the words that reveal it.

    ``docs`` (doc_id, text, any others). A span is a struct of start, kind (its place in ``KINDS``), end (exclusive; characters of the text)
    and value: the matched text, or for a word its replacement, empty where it is to be removed. Spans are sorted by start, then kind; kinds may
    overlap. ``spans`` holds all of ``base``.

    A null text is an empty one and has no spans; null and repeated ids and equal rows each give their row, and every row counts as a
    document, but equal texts support a word once. Long texts are read whole. An empty table gives an empty result.

    Texts are read twice: once for the patterns, once for the words, of which one row per word and task is shuffled. Texts with values are
    stored once; all else that moves is words next to values. Every join can be split.
    """
    marked, found = _marked(docs, disclosure, support)
    held = marked.filter("key is not null").join(found, "key").select("doc_id", "base", "spans")
    return marked.filter("key is null").select("doc_id", "base", F.col("base").alias("spans")).unionByName(held)


def sanitised(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, text, sanitised``: texts with values replaced by ``[kind]`` and revealing words by their general form or nothing.

    Of spans that overlap, the one that comes first in :func:`find_spans` names the replacement, and the characters of all go. Rows, nulls
    and repeats as there; the sanitised form of a null text is an empty one.
    """
    _, found = _marked(docs, disclosure, support)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def cut(state: Column, s: Column) -> Column:
        name = F.when(s["kind"] == KINDS.index("term"), s["value"]).otherwise(names[s["kind"]])
        kept = F.substring("full", state["at"] + 1, s["start"] - state["at"])
        out = F.when(s["start"] < state["at"], state["out"]).otherwise(F.concat(state["out"], kept, name))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    whole = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut)
    done = F.concat(whole["out"], F.substring("full", whole["at"] + 1, F.length("full")))
    rows = docs.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("full"))
    rows = rows.withColumn("key", F.unhex(F.md5("full"))).join(found, "key", "left")
    return rows.select("doc_id", "text", F.when(F.col("spans").isNull(), F.col("full")).otherwise(done).alias("sanitised"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every document."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    found = find_spans(docs)
    return found.select("doc_id", *[number(kind) for kind in PATTERNS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
