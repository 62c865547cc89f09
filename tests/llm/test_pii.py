from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from edge import edge_docs, edge_rows, no_docs

from tierstone.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        own = re.sub(r"[ -]", "", m.group())
        if 12 <= len(own) <= 19 and luhn(own):
            spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


SAMPLES = [
    "", "a@b.c@d.e x@y", "mail me.now+tag@mail.example.com, or a@b..c", "@a.b a@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.255.0 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (582) 555-8400 and +49-30-1234567.", "call +1 (843) 555-7672 170.1.2.3 now", "+12 +1 2 3",
    "é\U0001f600 x@y.zz 10.0.0.1", "0" * 5000, "9" * 19, "a" * 3000 + "@" + "b.c" * 400,
]


@pytest.mark.parametrize("text", SAMPLES)
def test_strict_spans(text):
    assert pii.strict_spans(text) == brute(text)


def test_strict_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("a1.2-@+ ()9é0") for _ in range(rng.randint(0, 60)))
        assert pii.strict_spans(text) == brute(text), text


def test_edges(spark):
    rows = edge_rows() + [(500 + k, t) for k, t in enumerate(SAMPLES)]
    found = {r["doc_id"]: r for r in pii.find_personal_data(edge_docs(spark, rows)).collect()}
    assert len(found) == len({i for i, _ in rows})
    for doc_id, text in rows[-len(SAMPLES) :]:
        base = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = found[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_loose_spans_near_context_are_added_and_others_not(spark):
    rows = []
    for k in range(300):
        rows.append((k, f"my phone: +1 (582) 555-{8000 + k}, e-mail: user{k}@mail.example.com"))
        rows.append((1000 + k, "version 555 123-4567 of the build and nothing else"))
    rows.append((5000, "phone: (582) 555-8400 999.1"))
    rows.append((5001, "write an email to jane.doe [at] mail [dot] example.com please"))
    found = {r["doc_id"]: r for r in pii.find_personal_data(edge_docs(spark, rows)).collect()}
    assert found[5001]["spans"] == "email:18:54"
    assert sum(found[1000 + k]["n_added"] for k in range(300)) == 0


def test_nothing_to_find(spark):
    assert pii.find_personal_data(no_docs(spark)).count() == 0
    rows = pii.find_personal_data(edge_docs(spark, [(1, "no data"), (2, None)])).collect()
    assert {(r["spans"], r["n_email"]) for r in rows} == {("", 0)}


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    vote = lambda right: np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    votes = np.stack([vote(0.95), vote(0.85), vote(0.6), 0 * truth.astype(int)], axis=1)
    rows, count = np.unique(votes, axis=0, return_counts=True)
    prior, table = pii.estimate(rows, count.astype(float))
    assert abs(prior - 0.4) < 0.1
    right = [(table[1, k, 2] + table[0, k, 0]) / 2 for k in range(3)]
    assert right[0] > right[1] > right[2]
    assert np.mean((pii.posterior(prior, table, votes) > 0.5) == truth) > 0.93
