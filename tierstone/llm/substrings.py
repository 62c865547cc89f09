"""Removal of repeated substrings by bucket-pointer refinement.

As in bucket-pointer refinement of a suffix array, suffixes are first put into buckets by
a q-gram, and a bucket is refined by the identifiers that the buckets of later offsets have
got meanwhile: the identifier of depth 16 comes from two of depth 8, that of depth 24 from
those of depth 16 and 8, and so on up to the depth that matters. Only suffixes that can
matter are kept: every ``LENGTH``-byte string holds an anchor, the least of its ``GRAM``-byte
buckets, so equal strings have equal anchors.

1. Buckets of anchors. Those of a single document are settled: nothing repeats there.
2. The others are refined to the whole surroundings of the anchor, which hold all strings
   with that anchor. A suffix whose refined bucket holds a smaller doc_id is settled: all
   its strings repeat. So is a bucket with one refined bucket.
3. What is left, the ends of repeated passages, is refined string by string.

Texts are stored in blocks of bounded size, which never move, with the places of their anchors,
which are sought once. In each step a block sends
the sorted, distinct identifiers with the smallest doc_id of each to the tasks that own
their range, and gets one bit for each back. So a string that a third of all documents hold
reaches a task once a block.

Defined cases
* Null and empty texts have no bytes. Texts under ``LENGTH`` bytes lose none.
* A null ``doc_id`` counts as larger than any other. Rows with equal ids, or without, do
  not take from each other.
* Repeats inside a document are no reason to remove. Other columns are ignored.
* Empty tables give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import Stored, shuffle_partitions
from tierstone.sources.storage import fresh_path

LENGTH, GRAM = 50, 24
SIDE = LENGTH - GRAM  # an anchor's strings reach so far to either side of it
SPAN = SIDE + 1  # buckets in a string
#: Bytes of a block, and of the texts that are looked at together; ranges of identifiers
#: for each shuffle partition of the session.
BLOCK_BYTES, CHUNK_BYTES, RANGES = 1 << 20, 1 << 18, 4
PAD = 80
NO_ID = 2**63 - 1
U = np.uint64
_MIX = [(U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)), (U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93))]


def _refined(a: np.ndarray, b: np.ndarray, family: int = 0) -> np.ndarray:
    """Identifiers of the buckets that hold a and, at the later offset, b."""
    one, two = _MIX[family]
    x, y = a * one, b + two
    x ^= y
    x ^= np.right_shift(x, U(32), out=y)
    x *= two
    x ^= np.right_shift(x, U(29), out=y)
    return x


class Chunk:
    """Anchors and strings of some texts, laid out with padding between them.

    ``marks`` are those of the same texts, if known: where the anchors are is then not sought
    again.
    """

    def __init__(self, texts: list[bytes], marks: bytes | None = None):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = PAD + np.concatenate([[0], np.cumsum(sizes + PAD)[:-1]]).astype(np.int64)
        room = int(sizes.sum()) + PAD * (len(texts) + 1)
        room += -room % 8 + 8
        self.raw = np.zeros(room, dtype=np.uint8)
        inside = np.zeros(room, dtype=np.uint8)
        for at, text in zip(self.starts.tolist(), texts):
            self.raw[at : at + len(text)] = np.frombuffer(text, np.uint8)
            inside[at : at + len(text)] = 1
        self.sizes = sizes
        words = np.empty(room - 8, dtype=U)
        for r in range(8):
            own = words[r::8]
            own[:] = self.raw[r : r + 8 * len(own)].view("<u8")
        held = inside
        for width in (1, 2, 4):
            held = held[:-width] + held[width:]
        edge = np.flatnonzero((missing := 8 - held[:-1]) > 0)
        words[edge] = _refined(words[edge], missing[edge].astype(U), 1)
        self.words = words
        each = np.maximum(sizes - (LENGTH - 1), 0)
        self.strings = np.repeat(self.starts - np.cumsum(each) + each, each) + np.arange(each.sum())
        self._place(marks or self._find())

    def _find(self) -> bytes:
        """For each anchor how many strings after the one before its first string comes, then
        for each how far inside that string it is: both at most ``SPAN``."""
        depth16 = _refined(self.words[:-8], self.words[8:])
        depth24 = _refined(depth16[:-8], self.words[16:])
        n = len(depth24) - SIDE
        place = np.arange(len(depth24), dtype=U)
        depth24 &= ~U(63)
        first, second = (self._least(depth24 | ((place + U(s)) & U(63)), n) for s in (0, 32))
        # of equal buckets in a string the first counts: pick the key that does not wrap in it
        at = self.strings
        own = at & 63
        wraps = own > 63 - SIDE
        least = np.where(wraps, second[at] - U(32), first[at]).astype(np.int64)
        inside = (least - own) & 63
        anchor = at + inside
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = anchor[1:] != anchor[:-1]
        begin = np.flatnonzero(new)
        marks = np.diff(begin, prepend=0), inside[begin]
        return b"".join(m.astype(np.uint8).tobytes() for m in marks)

    def _place(self, marks: bytes) -> None:
        steps, inside = np.frombuffer(marks, np.uint8).astype(np.int64).reshape(2, -1)
        begin = np.cumsum(steps)
        self.marks = marks
        self.anchors = self.strings[begin] + inside
        self.of_string = np.repeat(
            np.arange(len(begin)), np.diff(begin, append=len(self.strings)) if len(begin) else begin
        )
        self.buckets = self.deep(self.anchors, GRAM, 0)

    @staticmethod
    def _least(key: np.ndarray, n: int) -> np.ndarray:
        width = 1
        while width * 2 <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        return np.minimum(key[:n], key[SPAN - width : SPAN - width + n])

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def deep(self, at: np.ndarray, depth: int, family: int) -> np.ndarray:
        """Identifiers of the buckets of that depth at the given places."""
        found = self.words[at]
        for offset in [*range(8, depth - 8, 8), depth - 8]:
            found = _refined(found, self.words[at + offset], family)
        return found


class Groups:
    """Rows that share all keys, numbered in the order of the keys."""

    def __init__(self, keys: list[np.ndarray], doc: np.ndarray):
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for key in keys:
            k = key[order]
            new[1:] |= k[1:] != k[:-1]
        self.first = np.flatnonzero(new)
        self.of = np.empty(len(order), dtype=np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.keys = [key[order][self.first] for key in keys]
        own = doc[order]
        self.least, self.most = (
            f.reduceat(own, self.first) if len(own) else own for f in (np.minimum, np.maximum)
        )


def _cut(sizes: list[int]) -> list[tuple[int, int]]:
    """The texts, from and to, of each chunk of a block."""
    cuts, begin, held = [], 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= CHUNK_BYTES or k + 1 == len(sizes):
            cuts.append((begin, k + 1))
            begin, held = k + 1, 0
    return cuts


class Block:
    """The texts of a stored block, and what the steps so far have settled."""

    def __init__(self, docs, sizes, body: bytes, marks: list[bytes], bits: list[dict], parts: int):
        ids = [NO_ID if d is None else d for d in docs]
        self.doc = np.array(ids, dtype=np.int64)
        self.parts = parts
        cuts = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))]).astype(int)
        texts = [body[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        chunks = _cut(sizes)
        self.chunks = [Chunk(texts[a:b], known) for (a, b), known in zip(chunks, marks)]
        self.at = [a for a, _ in chunks]
        self.bucket = self._all(lambda c: c.buckets)
        self.owner = self._all(lambda c: c.text_of(c.anchors), ids=True)
        self.buckets = Groups([self.bucket], self.owner)
        self.bits = bits

    def _all(self, of, ids: bool = False) -> np.ndarray:
        found = [of(c) for c in self.chunks]
        if ids:
            found = [self.doc[f + at] for f, at in zip(found, self.at)]
        return np.concatenate(found) if found else np.zeros(0, np.int64 if ids else U)

    # step 1
    def send_buckets(self) -> Iterator[tuple]:
        g = self.buckets
        key = g.keys[0]
        return self._sent(key, {"a": (key >> U(32)).astype("<u4"), "b": (key >> U(16)).astype("<u2"),
                                "least": g.least, "most": g.most})

    # step 2
    def refine(self) -> None:
        shared = _bits(self.bits[0], 0)[self.buckets.of]
        self.open = np.flatnonzero(shared)
        deep = self._all(lambda c: c.deep(c.anchors - SIDE, LENGTH + SIDE, 1))[self.open]
        self.refined = Groups([self.bucket[self.open], deep], self.owner[self.open])

    def send_refined(self) -> Iterator[tuple]:
        g = self.refined
        key, deep = g.keys
        return self._sent(key, {"a": (key >> U(16)).astype("<u4"), "b": deep, "least": g.least})

    # step 3
    def pick_strings(self) -> None:
        g = self.refined
        known, mixed = _bits(self.bits[1], 0), _bits(self.bits[1], 1)
        later = self.owner[self.open] > g.least[g.of]
        self.repeats = np.zeros(len(self.bucket), dtype=bool)
        self.repeats[self.open] = later | known[g.of]
        unsettled = np.zeros(len(self.bucket), dtype=bool)
        unsettled[self.open] = ~self.repeats[self.open] & mixed[g.of]
        one, two, docs, base = [], [], [], 0
        self.picked = []
        for chunk, first in zip(self.chunks, self.at):
            n = len(chunk.anchors)
            take = np.flatnonzero(unsettled[base : base + n][chunk.of_string])
            at = chunk.strings[take]
            self.picked.append(take)
            one.append(chunk.deep(at, LENGTH, 0))
            two.append(chunk.deep(at, LENGTH, 1))
            docs.append(self.doc[chunk.text_of(at) + first])
            base += n
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.string_doc = join(docs, np.int64)
        self.strings = Groups([join(one, U), join(two, U)], self.string_doc)

    def send_strings(self) -> Iterator[tuple]:
        g = self.strings
        one, two = g.keys
        return self._sent(one, {"a": (one >> U(16)).astype("<u4"), "b": two, "least": g.least})

    # the result
    def covered(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text, its bytes, which of them are covered)."""
        g = self.strings
        late = (self.string_doc > g.least[g.of]) | _bits(self.bits[2], 0)[g.of]
        base = seen = 0
        for chunk, first, take in zip(self.chunks, self.at, self.picked):
            n = len(chunk.anchors)
            repeats = self.repeats[base : base + n][chunk.of_string]
            repeats[take] |= late[seen : seen + len(take)]
            base, seen = base + n, seen + len(take)
            steps = np.zeros(len(chunk.raw) + 1, dtype=np.int32)
            steps[chunk.strings[repeats]] += 1
            steps[chunk.strings[repeats] + LENGTH] -= 1
            inside = np.cumsum(steps) > 0
            for k, (at, size) in enumerate(zip(chunk.starts.tolist(), chunk.sizes.tolist())):
                yield first + k, chunk.raw[at : at + size], inside[at : at + size]

    def _sent(self, key: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple]:
        """The rows for each part: the parts are ranges of the key."""
        part = ((key >> U(32)) * U(self.parts)) >> U(32)
        cuts = np.searchsorted(part, np.arange(self.parts + 1, dtype=U))
        for p in range(self.parts):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                own = {n: c[a:b] for n, c in columns.items()}
                base = int(own["least"].min())
                for n in ("least", "most"):
                    if n in own:
                        own[n] = _packed(own[n] - base)
                yield p, base, {n: own[n].tobytes() if n in own else None for n in ("a", "b", "least", "most")}


def _packed(x: np.ndarray) -> np.ndarray:
    """Offsets in the narrowest of three widths that the reader can tell by the length."""
    top = int(x.max(initial=0))
    return x.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _unpacked(raw: bytes, n: int, base: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) + base


def _bits(rows: list, kind: int) -> np.ndarray:
    """The answers to a block's identifiers, in their order."""
    found = [np.unpackbits(np.frombuffer(r[2 + kind], np.uint8))[: r[1]] for r in rows]
    return np.concatenate(found).astype(bool) if found else np.zeros(0, dtype=bool)


SENT = "part int, block long, n int, base long, a binary, b binary, least binary, most binary"
ANSWER = "block long, part int, n int, one binary, two binary"


def _entries(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = rows["n"].to_numpy()
    a = np.frombuffer(b"".join(rows["a"]), "<u4")
    wide = len(rows["b"].iloc[0]) // int(n[0])
    b = np.frombuffer(b"".join(rows["b"]), f"<u{wide}").astype(U)
    least, most = (
        np.concatenate([
            _unpacked(raw if raw is not None else own, k, base)
            for raw, own, k, base in zip(rows[c], rows["least"], n, rows["base"])
        ])
        for c in ("least", "most")
    )
    return a, b, least, most


def _answers(rows: pd.DataFrame, one: np.ndarray, two: np.ndarray) -> pd.DataFrame:
    cuts = np.cumsum(rows["n"].to_numpy())[:-1]
    pack = lambda x: [np.packbits(p).tobytes() for p in np.split(x, cuts)]
    return pd.DataFrame({
        "block": rows["block"].to_numpy(), "part": rows["part"].to_numpy(),
        "n": rows["n"].to_numpy(), "one": pack(one), "two": pack(two),
    })


def shared_buckets(rows: pd.DataFrame) -> pd.DataFrame:
    """Which buckets are held by more than one doc_id."""
    a, b, least, most = _entries(rows)
    key = (a.astype(U) << U(16)) | b
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    group = np.empty(len(key), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(key))))
    several = np.minimum.reduceat(least[order], new) < np.maximum.reduceat(most[order], new)
    return _answers(rows, several[group], several[group])


def settled_buckets(rows: pd.DataFrame) -> pd.DataFrame:
    """Which refined buckets are held by a smaller doc_id than the block's smallest, and
    which are left in a bucket with others that are not."""
    a, b, least, _ = _entries(rows)
    g = Groups([a, b], least)
    known = g.least[g.of] < least
    left = np.flatnonzero(~known)
    bucket = np.unique(a, return_inverse=True)[1]
    mixed = np.bincount(bucket[left], minlength=bucket.max() + 1) > 1
    return _answers(rows, known, mixed[bucket])


def repeated_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """Which strings are held by a smaller doc_id than the block's smallest."""
    a, b, least, _ = _entries(rows)
    g = Groups([a, b], least)
    known = g.least[g.of] < least
    return _answers(rows, known, known)


# --- on Spark ------------------------------------------------------------------------


class Blocks:
    """Texts in blocks, kept by block so that answers can be joined without moving them."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES):
        self.spark, self.parts = docs.sparkSession, RANGES * shuffle_partitions(docs)

        def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            docs, texts, held = [], [], 0

            def block():
                sizes = [len(t) for t in texts]
                marks = [Chunk(texts[a:b]).marks for a, b in _cut(sizes)]
                names = ["block", "docs", "sizes", "body", "marks"]
                values = [[number], [docs], [sizes], [b"".join(texts)], [marks]]
                longs = pa.list_(pa.int64())
                kinds = [pa.int64(), longs, longs, pa.binary(), pa.list_(pa.binary())]
                columns = [pa.array(v, k) for v, k in zip(values, kinds)]
                return pa.RecordBatch.from_arrays(columns, names)

            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    body = text.as_buffer().to_pybytes() if text.is_valid else b""
                    docs.append(doc_id)
                    texts.append(body)
                    held += len(body)
                    if held >= block_bytes:
                        yield block()
                        number, docs, texts, held = number + 1, [], [], 0
            if docs:
                yield block()

        source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        blocks = source.mapInArrow(
            gathered, "block long, docs array<long>, sizes array<long>, body binary, marks array<binary>"
        )
        self.name = f"text_blocks_{uuid.uuid4().hex}"
        (
            blocks.write.bucketBy(self.parts, "block")
            .option("path", fresh_path(self.spark, "text-blocks"))
            .saveAsTable(self.name)
        )
        self.answers: list[Stored] = []

    def _with_answers(self) -> DataFrame:
        rows = self.spark.table(self.name)
        for k, answer in enumerate(self.answers):
            own = answer.df.withColumnRenamed("bits", f"bits{k}")
            rows = rows.join(own.hint("shuffle_hash"), "block", "left")
        return rows

    def _mapped(self, use, schema: str) -> DataFrame:
        parts, steps = self.parts, len(self.answers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1).to_pylist()[0]
                    bits = [
                        sorted(
                            (x["part"], x["n"], x["one"], x["two"]) for x in row[f"bits{step}"] or []
                        )
                        for step in range(steps)
                    ]
                    block = Block(row["docs"], row["sizes"], row["body"], row["marks"], bits, parts)
                    rows = use(block, row)
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        kinds = to_arrow_schema(StructType.fromDDL(schema))
        return self._with_answers().mapInArrow(run, schema)

    def ask(self, use, answer) -> None:
        """One step: send, answer, and keep the answers by block."""

        def send(block: Block, row: dict) -> list[dict]:
            return [
                {"part": p, "block": row["block"], "n": len(c["a"]) // 4, "base": base, **c}
                for p, base, c in use(block)
            ]

        told = self._mapped(send, SENT).groupBy("part").applyInPandas(answer, ANSWER)
        bits = told.groupBy("block").agg(
            F.collect_list(F.struct("part", "n", "one", "two")).alias("bits")
        )
        self.answers.append(Stored(bits, "answers"))

    def result(self) -> DataFrame:
        def found(block: Block, row: dict) -> list[dict]:
            block.refine()
            block.pick_strings()
            out = []
            for k, raw, gone in block.covered():
                edges = np.diff(np.concatenate([[0], gone.view(np.int8)]))
                out.append({
                    "doc_id": row["docs"][k], "n_bytes": len(raw), "n_removed": int(gone.sum()),
                    "n_spans": int((edges == 1).sum()), "kept": raw[~gone].tobytes(),
                })
            return out

        return self._mapped(
            found, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
        )


def _first(block: Block):
    return block.send_buckets()


def _second(block: Block):
    block.refine()
    return block.send_refined()


def _third(block: Block):
    block.refine()
    block.pick_strings()
    return block.send_strings()


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of ``docs``: every byte
    goes that a ``LENGTH``-byte string covers which also starts in a smaller doc_id."""
    blocks = Blocks(docs, block_bytes)
    blocks.ask(_first, shared_buckets)
    blocks.ask(_second, settled_buckets)
    blocks.ask(_third, repeated_strings)
    return blocks.result()
