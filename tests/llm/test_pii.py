from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from daybook.llm import pii
from tests.llm.conftest import ODD

# The base patterns as they are asked for.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(w - 9 if w > 9 else w for w in worth) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute_force(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def check_base(rows, got):
    want = sorted(
        (d if d is not None else -1, hashlib.sha256(",".join(brute_force(t)).encode()).hexdigest(), *(
            sum(s.startswith(kind) for s in brute_force(t)) for kind in PATTERNS
        ))
        for d, t in rows
    )
    assert want == sorted(
        (r.doc_id if r.doc_id is not None else -1, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got
    )


TRICKY = [
    "a@b.c_d@e.f x@@y.z a@b a@b. .@-.-",
    "x@y.com@z.org p.q+r%s-t_u@v-w.x-y.z.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 4.5.6.7.",
    "1.2.3.1234567890123 99999.1.1.1",
    "4111111111111111 4111-1111-1111-1111 4111  1111 1111 1111 4111 1111 1111 1112",
    "0 4111111111111111 5 +1 (234) 555-6789 +1(23)4 +12345678901234567890",
    "+1 (269) 555-3296 4524132264652876 and",
    "+1--...  2 + 3 +4 5",
    "\U0001f600 é a@b.cc \U0001f600 1.2.3.4 ñ +44 20 7946 0958",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
]


def test_base_spans_equal_brute_force(documents):
    rng = random.Random(3)
    rows = list(enumerate(TRICKY, 20)) + ODD
    alphabet = "aB1 2.3@-+()._ 4\n5"
    rows += [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))) for k in range(400)]
    rows += [(1000, " ".join(f"10.0.{k % 300}.{k % 7} u{k}@h{k}.org" for k in range(1500)))]
    rows += [(1001, "9" * 20_000), (1002, "a" * 200_000 + "@"), (1003, "1-" * 20_000)]
    got = pii.found(documents(rows)).collect()
    check_base(rows, got)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[1000].split(",")[:3] == brute_force(rows[-4][1])[:3]


def context_rows():
    """Badges after the words of known identifiers, and numbers after ordinary words."""
    rng = random.Random(9)
    rows = []
    for k in range(30):
        rows.append((k, f"please write contact address u{k}@mail.example.org today"))
        rows.append((100 + k, f"we counted about {rng.randrange(10**6)} of the things, the lot {k}@ was of the best"))
    rows.append((200, "please write contact address BADGE-77341 today"))
    rows.append((201, "later BADGE-77341, was seen"))
    rows.append((202, "they paid about 5512345 of it"))
    return rows


def test_unseen_identifiers_follow_known_contexts(documents):
    rows = context_rows()
    got = {r.doc_id: r.spans for r in pii.found(documents(rows)).collect()}
    text = dict(rows)
    assert got[200] == f"context:{text[200].index('BADGE')}:{text[200].index(' today')}"
    # What became known is known wherever it stands, without the punctuation around it.
    assert got[201] == f"context:{text[201].index('BADGE')}:{text[201].index(', was')}"
    assert got[202] == ""
    assert all("context" not in spans for doc_id, spans in got.items() if doc_id < 200)


def test_words_before_ordinary_words_are_no_pattern(documents):
    rows = context_rows()
    rows += [(300 + k, "the contact address book of the house") for k in range(60)]
    got = {r.doc_id: r.spans for r in pii.found(documents(rows)).collect()}
    assert got[200] == "" and got[201] == ""


def test_redaction_keeps_rows_columns_and_the_rest_of_a_text(documents):
    rows = context_rows() + list(enumerate(TRICKY, 1020)) + [(500, None), (501, ""), (None, "x a@b.cc"), (None, None)]
    docs = documents(rows)
    got = pii.redacted(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    by_id = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert by_id[0].text == "please write contact address [EMAIL] today"
    assert by_id[0].n_chars == len(by_id[0].text)
    assert by_id[200].text == "please write contact address [CONTEXT] today"
    assert by_id[500].text is None and by_id[501].text == ""
    assert {r.text for r in got.filter("doc_id IS NULL").collect()} == {"x [EMAIL]", None}
    assert by_id[100].text == dict(rows)[100] and by_id[100].n_chars == -1
    for doc_id, text in enumerate(TRICKY, 1020):
        spans = [tuple(map(int, s.split(":")[1:])) for s in brute_force(text)]
        outside = [c for k, c in enumerate(text) if not any(a <= k < z for a, z in spans)]
        plain = re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "", by_id[doc_id].text)
        assert plain == "".join(outside)


def test_empty_table(documents):
    assert pii.found(documents([])).collect() == []
    assert pii.redacted(documents([])).collect() == []


def test_plans_have_no_python(documents):
    plan = pii.found(documents(context_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_running_sums(spark):
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: (x % 7).cast("int")).alias("a"))
    got = rows.select(F.expr(pii._running("a")).alias("s")).first().s
    total = 0
    for k, value in enumerate(got, 1):
        total += k % 7
        assert value == total


WORD = r"[^\s0-9@]*[0-9@]\S*"
MARKS_BEFORE, MARKS_AFTER = "([{<\"'", ".,;:!?)]}>\"'"


def runs(line):
    """Start and end of the runs of identifier-like words of a line, without punctuation around them."""
    out, last = [], None
    for word in re.finditer(r"\S+", line):
        if not re.search("[0-9@]", word[0]):
            last = None
            continue
        joins = last is not None and line[word.start() - 1] in " \t" and line[last - 1] not in ",;:!?."
        joins = joins and not line[last : word.start()].strip(" \t")
        if joins:
            out[-1][1] = word.end()
        else:
            out.append([word.start(), word.end()])
        last = word.end()
    return out


def context_brute_force(rows):
    """Spans by context of each row, by plain loops over lines."""
    from collections import Counter, defaultdict

    mentions, totals = [], Counter()
    for number, (_, text) in enumerate(rows):
        base = [tuple(s.split(":")[1:]) for s in brute_force(text)]
        base = [(int(a), int(b)) for a, b in base]
        offset = 0
        for line in (text or "").split("\n"):
            words = line.lower().split()
            totals.update(words)
            totals.update(zip(["\n", *words], words))
            before = 0
            for start, end in runs(line):
                gap, first = line[before:start].lower().split(), before == 0
                before = end
                hit = line[start:end]
                inner = hit.lstrip(MARKS_BEFORE)
                a = offset + start + len(hit) - len(inner)
                value = inner.rstrip(MARKS_AFTER)
                b = a + len(value)
                seeds = [s for s in base if s[0] < b and s[1] > a]
                contexts = []
                if gap and (not seeds or seeds[0][0] <= a):
                    contexts = [gap[-1]]
                    if len(gap) > 1:
                        contexts.append((gap[-2], gap[-1]))
                    elif first:
                        contexts.append(("\n", gap[-1]))
                if seeds and seeds[0][0] <= a:
                    value = text[seeds[0][0] : min(seeds[0][1], offset + end)]
                mentions.append((number, a, b, value.lower(), contexts, bool(seeds)))
            offset += len(line) + 1
    edges, known = Counter(), defaultdict(bool)
    for _, _, _, value, contexts, seed in mentions:
        for context in contexts:
            edges[context, value] += 1
            known[context, value] |= seed
    of_context = defaultdict(list)
    for context, value in edges:
        of_context[context].append(value)
    usual = {c for c, v in of_context.items() if len(v) >= 3}
    score, patterns = {e: float(known[e]) for e in edges if e[0] in usual}, {}
    for _ in range(100):
        patterns = {}
        for c in usual:
            p = sum(edges[c, v] * score[c, v] for v in of_context[c]) / (totals[c] + 1)
            if p >= 0.7 and sum(score[c, v] >= 0.7 for v in of_context[c]) >= 3:
                patterns[c] = p
        doubt = defaultdict(lambda: 1.0)
        for c, p in patterns.items():
            for v in of_context[c]:
                doubt[v] *= 1 - min(p, 0.999)
        score = {(c, v): float(known[c, v] or 1 - doubt[v] >= 0.7) for c, v in score}
    values = {v for (c, v), s in score.items() if s >= 0.7 and not known[c, v] and len(v) >= 6}
    spans = defaultdict(set)
    for number, a, b, value, contexts, seed in mentions:
        if not seed and value and (value in values or any(c in patterns for c in contexts)):
            spans[number].add((a, b))
    return [sorted(spans[number]) for number in range(len(rows))]


def labelled_rows():
    """Identifiers of each base kind after words of their own, and unseen ones after the same words."""
    rng = random.Random(12)
    rows = []
    for k in range(12):
        card = f"4{rng.randrange(10**14):014d}"
        digits = [int(c) for c in card]
        total = sum(d if n % 2 else (2 * d - 9 * (d > 4)) for n, d in enumerate(digits))
        card += str(-total % 10)
        rows.append((k, f"call phone number +1 (415) 555-10{k:02d} today"))
        rows.append((20 + k, f"Server: 10.0.0.{k}\nmore text\nServer: 10.0.1.{k}"))
        rows.append((40 + k, f"the bill went to card {' '.join(card[n : n + 4] for n in range(0, 16, 4))}, they said"))
        rows.append((60 + k, f"\tMail\tu{k}@mail.example.org and some longer words of a text"))
    word = "w" * 90
    rows += [(80 + k, f"{word} {word} u{k}@long.example.org") for k in range(5)]
    rows += [
        (100, "call phone number 0441-555-7788 today"),
        (101, "Server: host7.local"),
        (102, "so the bill went to card (DE89 3704 0044 0532 0130 00), they said"),
        (103, "Mail bob.at.home@intranet"),
        (104, f"{word} {word} TICKET-44"),
        (105, "member id AB1771X"),
        (106, f"x{word[1:]} {word} TICKET-45, room 12"),
        (107, "then DE89 3704 0044 0532 0130 00 again"),
        (108, "they call 5 of the 12 server: host8.local"),
    ]
    return rows


def test_contexts_of_each_kind_equal_brute_force(documents):
    rows = labelled_rows() + context_rows()[:40] + [(None, "call phone number X-1"), (300, None), (301, "")]
    rows = [(n, text) for n, (_, text) in enumerate(rows)]
    got = {r.doc_id: r.spans for r in pii.found(documents(rows)).collect()}
    want = context_brute_force(rows)
    for n, text in rows:
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[n].split(",") if s.startswith("context")]
        assert spans == want[n], text
    held = {text[a:b] for (_, text), spans in zip(rows, want) for a, b in spans}
    assert {"0441-555-7788", "host7.local", "DE89 3704 0044 0532 0130 00", "bob.at.home@intranet", "TICKET-44"} <= held
    assert not any("AB1771X" in value for value in held)


def test_redaction_takes_the_whole_run(documents):
    by_id = {r.doc_id: r.text for r in pii.redacted(documents(labelled_rows())).collect()}
    assert by_id[102] == "so the bill went to card ([CONTEXT]), they said"
    assert by_id[107] == "then [CONTEXT] again"
    assert by_id[105] == "member id AB1771X"
