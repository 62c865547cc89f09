from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge import edge_docs, edge_rows, no_docs
from tokenizers import Tokenizer

from tierstone.llm import alignment

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    "plain text", " leading and trailing ", "<|endoftext|> <s>x</s>", "a▁b", "é́ ﬁ  x",
    "\U0001f600\U0001f468‍\U0001f469", "\x00\x01", "tab\tnew\nline\r\n", "x" * 3000, " " * 999,
    "don't WE'LL 12345678901 ...", "日本語のテキスト", "ａｂｃ", "�", "\u0000", "　wide",
]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


def brute(tools, rows):
    """Links by comparing sets of byte offsets."""
    a, b = tools
    letters = byte_letters()
    found = []
    for doc_id, text in rows:
        text = text or ""
        a_ids = a.encode(" " + text, add_special_tokens=False).ids
        b_ids = b.encode(text)
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in b_ids
        ]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, [], [], []))
            continue
        a_end = np.cumsum([len(x) for x in a_bytes]).tolist()
        b_end = np.cumsum([len(x) for x in b_bytes]).tolist()
        at = {e: j for j, e in enumerate(b_end)}
        links = [(i, at[e]) for i, e in enumerate(a_end) if e in at]
        found.append((doc_id, a_ids, b_ids, links))
    count = Counter((a_ids[i], b_ids[j]) for _, a_ids, b_ids, links in found for i, j in links)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for doc_id, a_ids, b_ids, links in found:
        pairs = [(a_ids[i], b_ids[j]) for i, j in links]
        text, i0, j0 = [], 0, 0
        for i, j in links:
            text.append(",".join(map(str, a_ids[i0 : i + 1])) + "|" + ",".join(map(str, b_ids[j0 : j + 1])))
            i0, j0 = i + 1, j + 1
        text = ";".join(text)
        out.append((
            doc_id, len(a_ids), len(b_ids), len(links), len(links),
            sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs), text,
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4_000_000, 700])
def test_rows_are_those_of_brute_force(spark, tools, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    rows = edge_rows() + [(200 + k, t) for k, t in enumerate(TEXTS + TEXTS[:3])]
    docs = edge_docs(spark, rows).repartition(3)
    found = alignment.align(docs, *PATHS, keep_groups=True).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(tools, rows)


def test_given_documents(spark, sf_dir, tools):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = alignment.align(docs, *PATHS).drop("groups").collect()
    expected = [(*r[:7], r[8]) for r in brute(tools, rows)]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(expected, key=repr)


def test_lanes_change_nothing():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a_end, b_end, a_from, base = [], [], [], 0
        for _ in range(rng.integers(1, 6)):
            end = int(rng.integers(1, 60))
            inner = np.arange(1, end)
            a_from.append(len(a_end))
            for ends in (a_end, b_end):
                cuts = inner[rng.random(end - 1) < rng.random()]
                ends.extend((base + cuts).tolist() + [base + end])
            base += end
        a_end, b_end = np.array(a_end), np.array(b_end)
        common = np.intersect1d(a_end, b_end)
        for lane in (1, 3, 512):
            links = alignment.lockstep(a_end, b_end, np.array(a_from), lane)
            assert (a_end[links.a] == common).all() and (b_end[links.b] == common).all()


def test_fast_and_whole_vocabulary_agree(monkeypatch):
    encoder = alignment.ByteLevel(PATHS[0])
    texts = [t or "" for _, t in edge_rows()] + TEXTS
    fast = encoder.encode(texts)
    monkeypatch.setattr(alignment, "LONG_TEXT", -1)
    assert encoder.encode(texts) == fast


def test_very_long_texts(spark):
    long = ("word and \U0001f600 word, " * 100_000) + " " * 200_000
    row = alignment.align(edge_docs(spark, [(1, long)]), *PATHS).collect()[0]
    assert row["n_a"] > 200_000 and row["n_links"] > 100_000
    assert alignment.align(no_docs(spark), *PATHS).count() == 0
