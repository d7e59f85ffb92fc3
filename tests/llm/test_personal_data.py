"""Personal data against plain Python: patterns, disclosure, spans of words and sanitised texts."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.brute import HARD, documents
from tidemark.llm import pii
from tidemark.llm.queries import op13_personal_data
from tidemark.llm.store import read

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(m.start(), n, m.end(), m[0]) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if good(k, m[0])]
    return sorted(found)


def words(text):
    return {w for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) > 1}


def plain(text):
    return re.sub(PATTERNS["email"], lambda m: " " * len(m[0]), text or "")


def revealing(rows, disclosure=pii.DISCLOSURE, support=pii.SUPPORT):
    """text -> word -> replacement, straight from the definition."""
    copies, held = Counter(t or "" for _, t in rows), defaultdict(Counter)
    for text, n in copies.items():
        for w in words(plain(text)) | {w[:3] + "*" for w in words(plain(text))}:
            held[w][text] = n
    near, values = defaultdict(set), defaultdict(set)
    for text in copies:
        blank = plain(text)
        for start, kind, end, value in base(text):
            left, right = blank[max(0, start - 201) : start], blank[end : end + 201]
            left = re.sub(r"^[^\W\d_]+", "", left) if len(left) > 200 else left
            right = re.sub(r"[^\W\d_]+$", "", right) if len(right) > 200 else right
            values[kind, value].add(text)
            for w in words(left + " " + right):
                near[kind, value, w].add(text)
    for (kind, value, w), texts in [*near.items()]:
        near[kind, value, w[:3] + "*"] = near[kind, value, w[:3] + "*"] | texts if "*" not in w else texts
    total = len(rows)

    def reveals(c, w):
        if len(values[c]) < support or len(near[(*c, w)]) < support:
            return False
        n_c, n_tc, n_t = (sum(copies[t] for t in ts) for ts in (values[c], near[(*c, w)], held[w]))
        return math.log2(n_tc * total / (n_t * n_c)) > disclosure * math.log2(total / n_c)

    out = defaultdict(dict)
    for (kind, value, w), texts in [*near.items()]:
        if "*" not in w and reveals((kind, value), w):
            general = "" if reveals((kind, value), w[:3] + "*") else w[:3] + "*"
            for t in texts:
                out[t][w] = "" if out[t].get(w) == "" else general
    return out


def all_spans(text, told):
    spans = [(s, k, e) for s, k, e, _ in base(text)]
    spans += [(m.start(), 4, m.end()) for m in re.finditer(r"[^\W\d_]+", plain(text)) if m[0].lower() in told.get(text or "", {})]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(spark, rows):
    told = revealing(rows)
    got = sorted(map(tuple, pii.report(documents(spark, rows)).collect()), key=repr)
    want = []
    for i, t in rows:
        found = base(t)
        n = Counter(k for _, k, _, _ in found)
        digest = hashlib.sha256(listed([f[:3] for f in found]).encode()).hexdigest()
        want.append((i, n[0], n[1], n[2], n[3], digest, listed(all_spans(t, told))))
    assert got == sorted(want, key=repr)
    return told


EDGES = [
    "a@b.c_d@e.f x@y.zz.yy. @no.pe q@-.- a@b",
    "10.0.0.1.5 999.1.1.1 1.2.3.4.5.6.7.8 007.08.09.010 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111 5500005555555559 " + "4" * 30,
    "+1 (640) 555-0953 +12 +1().- +1 2345678 +123456789012345678 ++44 20 7946 0958.",
    "1 4111111111111111 4222222222222 2 3",
    "é@ü.de ä+b@c.de 😀x@y.z 😀 +49 (0) 30 1234567 😀",
    "a@b.cc\n" * 600,
]


def long_runs(n):
    return "x" * n + "@" + "a." * n + "b " + "1" * n + " " + "1.2:" * n + "+1" + " (" * n


def test_patterns_on_edges(spark):
    check(spark, [*HARD[:7], *HARD[9:], *enumerate(EDGES, 100), (200, long_runs(500))])


def test_long_runs_take_no_longer_than_their_length(spark):
    n = 100_000
    rows = [(101, long_runs(n)), (102, "1.2.3.4 " * n), *HARD]
    got = {r.doc_id: r for r in pii.report(documents(spark, rows)).collect()}
    assert got[101].spans == f"email:0:{n + 1 + 2 * n + 1}"
    assert got[102].n_ip == n and got[102].spans.startswith("ip:0:7,ip:8:15,") and got[102].spans.endswith(f"ip:{8 * n - 8}:{8 * n - 1}")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a1@.+-_ ()5é4\n", max_size=60), min_size=40, max_size=60))
def test_patterns_on_made_up_texts(spark, texts):
    got = pii.base_spans(documents(spark, list(enumerate(texts)))).select("doc_id", pii.listed(pii.F.col("base"))).collect()
    assert dict(map(tuple, got)) == {i: listed([f[:3] for f in base(t)]) for i, t in enumerate(texts)}


def people():
    rows = [(i, f"letter {i} from the office about water, roads and parks. Nothing else was said today {'x' * (i % 5 + 2)}.") for i in range(200)]
    for i in range(6):
        filler = "so it went on and on " * 30
        rows.append((300 + i, f"Dear Zorblatt the {'first second third fourth fifth sixth'.split()[i]} offer, write to zorb@mail.example.com. {filler} Zorblatt!"))
    rows += [(400 + i, "Zorro and Zoran met near the roads and the office") for i in range(40)]
    rows += [(500 + i, "call Quimby at +1 (640) 555-0953 of the office") for i in range(9)]  # one text, so no support
    return rows


def test_words_that_reveal_a_value_are_spans_in_its_texts(spark):
    told = check(spark, people())
    found = {w: g for t in told for w, g in told[t].items()}
    assert found["zorblatt"] == "zor*" and "office" not in found and "quimby" not in found
    assert "the" not in found


def test_copies_and_hard_rows_count_as_documents(spark):
    rows = people() + people()[200:203] * 30 + HARD[:7] + HARD[9:]
    check(spark, rows)


def test_sanitised_texts(spark):
    rows = people()
    got = {r.doc_id: r for r in pii.sanitised(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        assert (got[i].sanitised == text) == (not base(text))
    assert "zor* the first" in got[300].sanitised and "[email]" in got[300].sanitised and "orb" not in got[300].sanitised
    assert got[500].sanitised == "call Quimby at [phone] of the office"


def test_empty_table(spark):
    assert pii.report(documents(spark, [])).collect() == []
    assert pii.sanitised(documents(spark, [])).collect() == []


def test_plan_is_native(spark):
    plan = pii.report(documents(spark, HARD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("table", ["documents"])
def test_query_on_the_test_table(spark, table):
    rows = [(r.doc_id, r.text) for r in read(spark, "/root/testdata/sf0.01", table).collect()]
    told = revealing(rows)
    got = {r.doc_id: r.spans for r in op13_personal_data(spark, "/root/testdata/sf0.01").collect()}
    assert got == {i: listed(all_spans(t, told)) for i, t in rows}
