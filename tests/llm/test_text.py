import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import HARD, components, documents, lower
from tidemark.llm import chat, decontamination, fuzzy_lines, language, licences, meetings, packing, tokens, toxicity, words
from tidemark.llm.line_keys import line_keys


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def odd_text(r, n):
    return "".join(r.choice("abcdeABC 12'!?<|éÉßΣσςİ日本語ก́՘\U00010d50Ɤ\n\t  😀") for _ in range(n))


@pytest.mark.parametrize("members, pattern", [(words.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (words.SPACED, r"[^\x20\x09-\x0D]+")])
def test_words_as_arrays(monkeypatch, members, pattern):
    monkeypatch.setattr(words, "BLOCK", 64)
    r = random.Random(1)
    texts = [odd_text(r, r.choice([0, 1, 5, 40, 300])) for _ in range(100)] + [None, "", "x" * 500]
    raw, starts, ends, hashes, rows = words.row_words(pa.array(texts), members)
    seen = {}
    for i, text in enumerate(texts):
        found = [lower(raw[a:b].tobytes().decode()) for a, b in zip(starts[rows[i] : rows[i + 1]], ends[rows[i] : rows[i + 1]])]
        assert found == re.findall(pattern, lower(text))
        for w, h in zip(found, hashes[rows[i] : rows[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# -- tokens ---------------------------------------------------------------------------------------------------------


def test_counts_equal_the_library(library):
    counter, r = tokens.TokenCounter(tokens.vocabulary_path()), random.Random(2)
    small = tokens.TokenCounter(tokens.vocabulary_path(), chunk=23)
    for _ in range(600):
        text = odd_text(r, r.choice([3, 10, 60])) + r.choice(["", "<|endoftext|>", "it's we'll I'M", "hello world"])
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == small.count(text) == expected, text


def test_transducer_states_can_start_anew(library):
    counter = tokens.CountingTransducer(tokens.Vocabulary(tokens.vocabulary_path()))
    counter.STATES = 20
    for w in ("reconsideration", "internationalization", "zzzqqxy", "aaaaaaaaaaaaa", "thonderings"):
        assert counter.count(w) == len(library.encode(w, add_special_tokens=False).ids)


def test_token_counts_of_hard_rows(spark, library):
    got = Counter(tuple(r) for r in tokens.count_tokens(documents(spark, HARD)).collect())
    expected = Counter()
    for i, t in HARD:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[(i, len((t or "").encode()), n, n > 2048)] += 1
    assert got == expected
    assert tokens.count_tokens(documents(spark, [])).count() == 0


# -- packing --------------------------------------------------------------------------------------------------------


def test_cuts_cover_a_length():
    for n in [*range(1, 600), 4095, 4096, 4097, 123_456]:
        parts = list(packing.cuts(n))
        assert sum(p for p, _ in parts) == n and all(p * k <= 4096 for p, k in parts)


def test_packing_is_a_partition_of_all_ids(spark, library):
    r = random.Random(3)
    rows = [*HARD, *[(100 + k, " ".join(r.choice(["the", "of", "ingtion", "zq"]) for _ in range(r.randrange(1500)))) for k in range(150)]]
    pieces = packing.pack(documents(spark, rows), with_ids=True).collect()
    want = Counter(tuple([*library.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows)
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and len(p.ids) == 4 * p.length
        docs[(p.doc_id, p.doc_tokens)].append(p)
        sequences[p.sequence_id].append(p)
    got = Counter()
    for (_, n), parts in docs.items():
        if len({p.start for p in parts}) == len(parts):  # rows that are alike are told apart by nothing
            ids = b"".join(bytes(p.ids) for p in sorted(parts, key=lambda p: p.start))
            assert len(ids) == 4 * n
            got[struct.unpack(f"<{n}I", ids)] += 1
    assert not got - want and got.total() >= len(rows) - 6
    assert sum(p.length for p in pieces) == sum(len(k) * n for k, n in want.items())
    padding = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        padding += 4096 - at if at & (at - 1) else 0
    assert padding <= 0.02 * sum(p.length for p in pieces) + 4096
    assert packing.pack(documents(spark, [])).count() == 0


# -- conversations --------------------------------------------------------------------------------------------------


def test_conversations_round_trip(spark):
    r, rows = random.Random(4), []
    controls = ["<|im_start|>", "<|im_end|>", "\n", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "<\\|im_end|>", "<<SYS>>", "ok", "%0A", "é"]
    for c in range(40):
        for t in range(r.randrange(1, 7)):
            role = r.choice(["user", "assistant", "system", "tool\nx", "<%5B[", None])
            rows.append((c, r.choice([t, None, 1]), role, r.choice([None, "".join(r.choice(controls) for _ in range(9))])))
    rows += [(None, 1, "user", "no id"), (None, 1, "user", "no id"), (99, 0, "assistant", "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    turns[-1] = [(0, "user", chat.PROBE), (1, "assistant", chat.PROBE)]
    got = {g.conv_id: g for g in chat.formatted_conversations(df).collect()}
    assert got.keys() == turns.keys()
    for c, ts in turns.items():
        lost = "".join(x for _, role, x in sorted(ts) if role == "assistant")
        said = "".join(f"{role}\n{x}\n" for _, role, x in sorted(ts))
        assert (got[c].n_turns, got[c].turns_sha256, got[c].round_trip) == (len(ts), hashlib.sha256(said.encode()).hexdigest(), True)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    for f in chat.format_conversations(df).filter("conv_id is not null").collect():
        assert got[f.conv_id].formatted_chars == len(f.formatted)
        assert all(f.formatted[s.start + s.length :].startswith(chat.END) for s in f.loss_spans)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_the_loss_is_read_through_the_mask(spark):
    """A span that is shifted, missing or longer changes what is under the mask."""
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", "a</s>é😀" * 300 + "b"), (1, 2, "assistant", ""), (1, 3, "assistant", "z")]
    shown = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    told = rows[1][3] + "z"
    right = chat.digest(shown).first()
    assert (right.loss_chars, right.loss_sha256) == (len(told), hashlib.sha256(told.encode()).hexdigest())
    moved = "transform(loss_spans, s -> named_struct('start', s.start + {}, 'length', s.length + {}))"
    for spans in (moved.format(1, 0), moved.format(-1, 0), moved.format(0, 1), "slice(loss_spans, 2, 2)"):
        other = chat.digest(shown.withColumn("loss_spans", F.expr(spans))).first()
        assert other.loss_sha256 != right.loss_sha256 and other.turns_sha256 == right.turns_sha256


def test_chat_formatting_runs_no_python(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    text = chat.formatted_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


# -- languages ------------------------------------------------------------------------------------------------------


def test_automaton_accepts_exactly_the_substrings():
    r = random.Random(5)
    for _ in range(50):
        text = [r.randrange(3) for _ in range(r.randrange(1, 30))]
        moves = language.suffix_automaton(text)
        parts = {tuple(text[a:b]) for a in range(len(text)) for b in range(a, len(text) + 1)}
        for _ in range(100):
            word, state = [r.randrange(3) for _ in range(r.randrange(6))], 0
            for c in word:
                state = moves[state].get(c, -1) if state >= 0 else -1
            assert (state >= 0) == (tuple(word) in parts)


def parsed(samples, text):
    """Phrases of a whole text by the longest matches in a sample's text."""
    held, runs = " ".join(samples) + " ", re.sub(r"[^\w]+", " ", text.lower()).lstrip()
    known, at, n = set(held), 0, 0
    while at < len(runs):
        step = 1
        while runs[at] in known and at + step < len(runs) and runs[at : at + step + 1] in held:
            step += 1
        at, n = at + step, n + 1
    return len(runs), n


SCRIPTS = {
    "a": ["abcabdabe", "xyz"],
    "b": ["zzyx cab"],
    "zh": ["中文测试语言识别的样本文字", "我们在这里写一些汉字用于测试 语言"],
    "ja": ["日本語のテキストを識別するための見本です", "漢字とかな"],
}


@pytest.mark.parametrize("dense", [120, 3])
def test_phrases_are_longest_matches_over_whole_texts(monkeypatch, dense):
    monkeypatch.setattr(language, "DENSE", dense)
    parser, r = language.Parser(SCRIPTS), random.Random(6)
    letters = "abcxyzé. " + "".join(sorted(set("".join(SCRIPTS["zh"] + SCRIPTS["ja"])))) + "龍"
    pieces = [p for parts in SCRIPTS.values() for p in parts]
    texts = ["".join(r.choice("abcxyzé. ") for _ in range(r.randrange(900))) for _ in range(20)]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(900))) for _ in range(10)]
    texts += ["".join(p[r.randrange(5) :] for p in r.choices(pieces, k=r.randrange(90))) for _ in range(20)]
    texts += ["", " ", "abcabdabe " * 400, "龍" * 700]
    sizes, counts = parser.phrases(texts)
    for k, name in enumerate(parser.languages):
        for text, n, got in zip(texts, sizes, counts[:, k]):
            assert (n, got) == parsed(SCRIPTS[name], text)


def test_predictions_and_scores_follow_from_the_phrases():
    parser = language.Parser(SCRIPTS)
    texts = ["abcabd xyz", "zyx", "语言识别的测试", "日本語の見本", "12 !", "漢字 测试", "q"]
    for text, (found, score) in zip(texts, parser.predict(texts), strict=True):
        if not any(map(str.isalpha, text)):
            assert (found, score) == ("und", 0.0)
            continue
        cost = {}
        for name in sorted(SCRIPTS):
            size = sum(len(re.sub(r"[^\w]+", " ", p.lower()).lstrip()) + 1 for p in SCRIPTS[name])
            cost[name] = parsed(SCRIPTS[name], text)[1] * math.log2(size + 1)
        best, second = sorted(cost.values())[:2]
        assert found == min(sorted(cost), key=cost.get) and score == pytest.approx(1 - best / second)
    assert [parser.predict([t])[0][0] for t in texts[2:4]] == ["zh", "ja"]


def test_samples_hold_whole_texts(spark):
    rows = [(i, "w" * (10 + i)) for i in range(1, 60)] + [(100, "long " * 5000)]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") == 100, "fr").otherwise("en"))
    found = language.samples(docs, per_language=4, letters=30)
    assert len(found["en"]) == 4 and all(t in {x for _, x in rows} and len(t) <= 30 for t in found["en"])
    assert found.get("fr", ["long " * 5000]) == ["long " * 5000]


def test_languages_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.filter("lang = lang_pred").count() >= 0.95 * found.count() > 0


def test_languages_of_hard_rows(spark):
    rows = [*HARD, *[(50 + k, "the cat and the dog went to the house " * 3) for k in range(20)], (99, "12 34 !?")]
    got = Counter((r.doc_id, r.lang_pred, 0 <= r.score <= 1) for r in language.predict_documents(documents(spark, rows)).collect())
    assert got[(1, "und", True)] == got[(2, "und", True)] == got[(3, "und", True)] == got[(99, "und", True)] == 1
    assert got[(8, "en", True)] == 2 and sum(got.values()) == len(rows)
    nothing = documents(spark, HARD).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict_documents(nothing).collect()} == {"und"}


# -- benchmark ------------------------------------------------------------------------------------------------------


def test_contamination_equals_brute_force(spark, sf):
    docs = [*HARD, (40, "x one two y one TWO"), (41, "a " * 30), *[tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(777, "One, two"), (778, "a " * 14), (779, None), (780, "..."), (781, "one"), (777, "One, two"), (None, "and again")]
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for i, t in items:
        w = find(lower(t))
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[k : k + m])].add(i)
    expected = Counter()
    for i, t in docs:
        w, hit, named = find(lower(t)), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit.update(range(k, k + m))
                    named |= windows[tuple(w[k : k + m])]
        ids = sorted(str(x) for x in named if x is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        expected[(i, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w))] += 1
    df, bench = documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r) for r in decontamination.contamination(df, bench).drop("key").collect()) == expected
    kept = decontamination.without_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(n for e, n in expected.items() if not e[5])
    assert decontamination.contamination(df, bench.limit(0)).filter("contaminated or n_hit > 0").count() == 0
    assert decontamination.contamination(df.limit(0), bench).count() == 0


# -- licences -------------------------------------------------------------------------------------------------------


def dice(a, b):
    bags = [Counter(zip(w, w[1:])) for w in (a, b)]
    total = sum(x.total() for x in bags)
    return 2 * (bags[0] & bags[1]).total() / total if total else 0


def test_licences_equal_brute_force(spark):
    r, find = random.Random(7), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    texts = [t for _, t in licences.TEMPLATES]
    rows = list(HARD)
    for k in range(60):
        w = r.choice(texts).split(" ")
        for _ in range(r.choice([0, 0, 1, 3])):
            w[r.randrange(len(w))] = "other"
        lines = ["some words before it"] * r.randrange(3) + [" ".join(w)] + [""] * r.randrange(2) + ["and words after"] * r.randrange(3)
        rows.append((200 + k, "\n".join(lines)))
    rows.append((300, "Permission is hereby granted, free of\ncharge, to any person obtaining a copy\n\nof this"))
    expected = Counter()
    for i, t in rows:
        parts = {t or "", *(t or "").split("\n"), *re.split(r"\n[^\n0-9A-Za-z\x80-\U0010ffff]*\n", t or "")}
        best = min(((-dice(find(lower(p)), find(lower(x))), n) for p in parts for n, x in licences.TEMPLATES), default=(0, None))
        expected[(i, best[1] if -best[0] >= 0.8 else None, round(-best[0], 9) if -best[0] >= 0.8 else 0.0)] += 1
    got = Counter((x.doc_id, x.licence, round(x.dice, 9)) for x in licences.scan_documents(documents(spark, rows)).collect())
    assert got == expected
    assert licences.scan_documents(documents(spark, [])).count() == 0


def test_licences_inside_other_text(spark):
    bsd = next(t for n, t in licences.TEMPLATES if n == "BSD-3-Clause" and len(t) > 1000)
    w = bsd.split(" ")
    broken = "\n\n".join(" ".join(w[k : k + 11]) for k in range(0, len(w), 11))
    rows = [
        (1, "Copyright 2020 Foo. Released under the MIT License. See the LICENSE file for details."),
        (2, "some words before it " * 30 + broken + " and words after" * 30),
        (3, "Copyright 2020 Foo. See the file for details of the thing."),
    ]
    got = {r.doc_id: (r.licence, r.dice, r.n_passages) for r in licences.scan_documents(documents(spark, rows)).collect()}
    assert got == {1: ("MIT", 1.0, 1), 2: ("BSD-3-Clause", 1.0, 1), 3: (None, 0.0, 0)}


# -- lines ----------------------------------------------------------------------------------------------------------


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    r = random.Random(8)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(14))) for _ in range(2))
        assert fuzzy_lines.edit_distance(a, b) == plain(a, b)


def test_lines_equal_brute_force(spark):
    r, rows = random.Random(10), [(1, None), (2, ""), (3, "short\nshort"), (4, "x" * 100_000)]
    base = [f"word{k}" for k in range(80)]
    for i in range(60):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 6])):
            w[r.randrange(80)] = "zz" + r.choice("abcdefgh")
        rows.append((10 + i, " ".join(w) + "\nshort\n" + " ".join(w[:30]) + " 1234"))
    lines = [
        (i, k, re.sub(r"\s+", " ", x.lower()).strip(" "))
        for i, t in rows
        for k, x in enumerate((t or "").split("\n"))
    ]
    lines = [x for x in lines if len(x[2]) >= fuzzy_lines.SHORTEST]
    norms = sorted({x[2] for x in lines})
    parent = {n: n for n in norms}
    for a in range(len(norms)):
        for b in range(a):
            x, y = norms[a], norms[b]
            longest = max(len(x), len(y))
            if fuzzy_lines.edit_distance(x, y) <= longest - math.ceil(fuzzy_lines.SIMILAR * longest):
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[x] = y

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first, dropped = {}, defaultdict(list)
    for i, k, n in lines:
        first[root(n)] = min(first.get(root(n), (i, k)), (i, k))
    for i, k, n in lines:
        if first[root(n)] != (i, k):
            dropped[i].append(k)
    df = documents(spark, rows)
    got = {x.doc_id: (x.n_lines, x.n_dropped, x.dropped) for x in fuzzy_lines.line_report(df).collect()}
    assert got == {i: ((t or "").count("\n") + 1, len(dropped[i]), dropped[i]) for i, t in rows}
    assert sum(map(len, dropped.values())) > 50
    left = fuzzy_lines.without_repeated_lines(df)
    assert left.columns == df.columns
    for x in left.collect():
        t = dict(rows)[x.doc_id]
        assert x.text == (t if not dropped[x.doc_id] else "\n".join(y for k, y in enumerate(t.split("\n")) if k not in dropped[x.doc_id]))
    assert fuzzy_lines.line_report(df.limit(0)).count() == 0


def test_lines_link_by_edit_similarity_alone(spark):
    r, rows = random.Random(11), []
    vocab = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 10))) for _ in range(400)]
    for i in range(120):
        line = r.choices(vocab, k=r.choice([1, 2, 3, 5, 8, 10, 12, 20, 40]))
        other = list(line)
        other[r.randrange(len(line))] = r.choice(vocab)
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other) + r.choice(["", ",", "!"]))]
    links = [(a, b) for a, x in rows for b, y in rows if a < b and fuzzy_lines.edit_distance(x, y) <= max(len(x), len(y)) // 5]
    found = components([i for i, _ in rows], links)
    got = {x.doc_id: x.n_dropped for x in fuzzy_lines.line_report(documents(spark, rows)).collect()}
    assert got == {i: int(found[i] != i) for i, _ in rows} and sum(got.values()) > 60


def test_short_lines_and_figures(spark):
    rows = [
        (1, "Menu\nSubscribe now!\n12.50 17.30 44.10 98.20\n\n2021-03-04 11:22:33 ok"),
        (2, "menu\nSubscribe  now!\n98.11 22.22 33.33 44.44\n\n1987-11-25 04:05:56 ok"),
    ]
    got = {x.doc_id: x.dropped for x in fuzzy_lines.line_report(documents(spark, rows)).collect()}
    assert got == {1: [], 2: [0, 1]}


def test_keys_of_lines_that_differ_in_one_place():
    r = random.Random(12)
    for _ in range(3000):
        x = "".join(r.choice("abcdeé 日😀") for _ in range(r.randrange(1, 128)))
        at, most = r.randrange(len(x) + 1), len(x) // 5
        y = x[:at] + "".join(r.choice("xyz") for _ in range(r.randrange(most + 1))) + x[at + r.randrange(most + 1) :]
        if fuzzy_lines.close(x, y) and len(y) < 128 and (len(x) > 14) == (len(y) > 14):
            keys, ends = line_keys([x, y])
            assert set(keys[: ends[1]]) & set(keys[ends[1] :])


def some_lines(r, n, least, most):
    names = [f"{''.join(r.choice('abcdeé日😀') for _ in range(r.randrange(1, 9)))}" for _ in range(400)]
    return [" ".join(r.choice(names) for _ in range(r.randrange(least, most))) for _ in range(n)]


def test_bounds_and_distances_of_many_pairs():
    r = random.Random(31)
    xs = ["", "a", "", "ab" * 40, "x" * 64, "x" * 128, *some_lines(r, 500, 0, 70)]
    ys = ["", "", "b", "ab" * 33, "x" * 65, "y" * 130]
    for x in xs[6:]:
        parts = x.split(" ")
        for _ in range(r.randrange(len(parts) // 3 + 2)):
            parts[r.randrange(len(parts))] = r.choice(["", "b", "日本", parts[0]])
        ys.append(" ".join(reversed(parts) if r.random() < 0.1 else parts))
    want = [fuzzy_lines.edit_distance(x, y) for x, y in zip(xs, ys)]
    low, high = fuzzy_lines.bounds(xs, ys)
    assert all(a <= d <= b for a, d, b in zip(low, want, high)) and any(a == d for a, d in zip(low, want) if d)
    assert fuzzy_lines.distances(*zip(*sorted(zip(xs, ys), key=lambda p: len(p[0])))).tolist() == [
        d for _, d in sorted(zip(map(len, xs), want), key=lambda p: p[0])
    ]
    assert fuzzy_lines.close_pairs(xs, ys).tolist() == [fuzzy_lines.close(x, y) for x, y in zip(xs, ys)]


@pytest.mark.parametrize("common", [3, meetings.COMMON])
def test_lines_that_share_a_key_meet(common, monkeypatch):
    monkeypatch.setattr(meetings, "PACKED", 5000)
    r = random.Random(5)
    lines = [x for x in dict.fromkeys(some_lines(r, 300, 1, 20)) if x]
    lines += [f"{x} {r.choice('abc')}" for x in lines[:200] for _ in range(r.randrange(4))]
    names = {x: hashlib.md5(x.encode()).digest() for x in lines}
    want, rows, size = defaultdict(set), defaultdict(list), 0
    for x in lines:
        for k in line_keys([x])[0]:
            want[k].add(int.from_bytes(names[x][:8], "big") >> 64 - meetings.MARK_BITS)
    # Two tasks that share lines, of several packs each.
    for task in (lines[: len(lines) * 2 // 3], lines[len(lines) // 3 :]):
        blocks = [(task[k : k + 50], [names[x] for x in task[k : k + 50]]) for k in range(0, len(task), 50)]
        for batch in meetings.packed(blocks, common):
            for row in batch.to_pylist():
                rows[row["part"]].append(row)
                size += len(row["keys"]) + len(row["marks"])
    schema = pa.schema([("part", pa.int32()), ("known", pa.bool_()), ("keys", pa.binary()), ("marks", pa.binary())])
    got = defaultdict(set)
    for some in rows.values():
        for row in meetings._met(pa.Table.from_pylist(some, schema)).to_pylist():
            got[row["bucket"]].add(row["mark"])
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values() if len(x) > 1}
    if common == meetings.COMMON:  # nine bytes a key
        assert size <= 9 * 4 / 3 * sum(map(len, (line_keys([x])[0] for x in lines))) + 1000


def test_empty_bins_are_no_key():
    r = random.Random(8)
    lines = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(64, 72))) for _ in range(2000)]
    assert max(Counter(line_keys(lines)[0].tolist()).values()) < 10


def test_lines_are_stored_without_keys(spark):
    assert "keys" not in fuzzy_lines.lines_of(documents(spark, [(1, "a line")])).columns


def test_lines_of_hard_rows(spark):
    got = Counter((r.doc_id, r.n_lines, r.n_dropped) for r in fuzzy_lines.line_report(documents(spark, HARD)).collect())
    assert got[(8, 1, 0)] == 2 and got[(3, 2, 0)] == 1 and got[(None, 1, 0)] == 2 and sum(got.values()) == len(HARD)


# -- toxicity -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scorer():
    return toxicity.Model((("idio", 5.0), ("scum", 5.0)), (1.0,) * toxicity.FEATURES, -2.0).scorer()


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("you idiot", {"aimed"}),
        ("what an idiot", {"plain"}),
        ("idiots you are", {"aimed"}),
        ("this is not an idiot", {"negated"}),
        ("she said he is an idiot", {"reported"}),
        ("i will kill you", {"threat"}),
        ("kill the process", set()),
        ("i will not kill you", {"negated"}),
        ("a fine day", set()),
    ],
)
def test_clauses(scorer, text, kinds):
    assert set(scorer.clause(text)) == kinds


def test_a_match_ends_with_its_clause(scorer):
    found = dict(zip(toxicity.KINDS, scorer.features("She said so. What an idiot! Not here; scum")))
    assert found["plain"] > 0 and found["reported"] == found["negated"] == found["aimed"] == 0
    assert scorer.score(None) == scorer.score("") == scorer.score("nothing of the kind") < 0.5 < scorer.score("idiot scum")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[(1, 1)] >= 0.85 * (n[(1, 1)] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[(0, 0)]


def test_toxicity_of_hard_rows(spark):
    df = documents(spark, HARD)
    some = spark.createDataFrame([(None, 1, "x"), (4, None, "x"), (5, 1, "x"), (5, 0, "x"), (77, 7, "x")], "doc_id long, toxic int, text string")
    for labels in (some, some.limit(0)):
        got = toxicity.score_documents(df, labels).collect()
        assert len(got) == len(HARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
        assert toxicity.without_toxic(df, labels).columns == df.columns
    assert toxicity.score_documents(df.limit(0), some).count() == 0
