"""Personal data by weak supervision.

Candidates are the strict matches of four kinds and looser shapes beside them (spelled-out
mail addresses, grouped card numbers, national phone numbers, IPv6). Regex, gazetteer,
context and checksum labelers vote on each, for, against or not at all. Expectation
maximisation over the counts of all vote patterns of the corpus estimates how reliable every
labeler is; a logistic span classifier is trained on the resulting probabilities and decides
which loose candidates become spans. Strict matches always stay.

Defined cases
* Null and empty texts have no spans. Whole texts are searched, of any length.
* Rows that repeat a doc_id are each searched; a null doc_id is passed through.
* A corpus without candidates needs no model. Other columns are ignored. Empty tables give
  no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.llm.common import Stored, hash_sample

KINDS = ("email", "ip", "card", "phone")
#: Candidates the span classifier is trained on, at most; what a loose one needs to be added.
SAMPLE_SPANS, ADD_FROM = 20_000, 0.9
ROUNDS, NEAR = 50, 28

_AT = re.compile("@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LOOSE = {
    "email": re.compile(
        r"\b[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{2,63})+"
        r"|\b[A-Za-z0-9._%+-]{1,64}+ at [A-Za-z0-9-]{1,63}+(?: dot [A-Za-z0-9-]{2,63})+", re.I),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9])"),
}
#: What a text must hold for a loose shape to be looked for: cheap to see.
_HINT = {
    "email": re.compile(r"[(\[]at[)\]]| dot ", re.I),
    "ip": re.compile(r":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"),
    "card": re.compile(r"[0-9]{4}[._/][0-9]{4}"),
    "phone": re.compile(r"[0-9]{3}[ .-][0-9]{4}"),
}
# Gazetteers and context words.
_ENDINGS = frozenset("com org net edu gov io info biz co uk de fr es it nl eu us ca au ch at be test example".split())
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44",
            "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63",
            "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98", "212", "351", "352",
            "353", "358", "420", "421", "971", "972")
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|62")
_FOR = {
    "email": re.compile(r"mail|contact|write|reach|address|correo|courriel|kontakt", re.I),
    "ip": re.compile(r"\bip\b|address|server|host|from|login|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|pay|carte|karte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|cell|fax|sms|whatsapp|tél|telefon|rufen", re.I),
}
_AGAINST = re.compile(r"version|\bv\.? ?$|isbn|issn|order|invoice|build|release|sku|serial|part no|doi", re.I)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for at in _AT.finditer(text):
        place = at.start()
        begin = place
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, place + 1) if begin < place else None
        if domain:
            done = domain.end()
            yield begin, done


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """The base matches, by start and then kind."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        own = _digits(m.group())
        if 12 <= len(own) <= 19 and luhn(own):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def loose_spans(text: str, strict: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser candidates that no strict match overlaps, nor an earlier loose one."""
    taken = sorted((a, b) for _, a, b in strict)
    shapes = [k for k in KINDS if _HINT[k].search(text)]
    found = sorted(((k, *m.span()) for k in shapes for m in _LOOSE[k].finditer(text)), key=lambda s: s[1])
    out, last, t = [], 0, 0
    for kind, a, b in found:
        while t < len(taken) and taken[t][1] <= a:
            t += 1
        if a >= last and not any(x < b and y > a for x, y in taken[t : t + 8]):
            out.append((kind, a, b))
            last = b
    return out


def votes_on(text: str, kind: str, a: int, b: int, strict: bool) -> list[int]:
    """For (1), against (-1) or no vote (0): strict regex, gazetteer, shape, checksum,
    context for, context against."""
    own, before = text[a:b], text[max(0, a - NEAR) : a]
    digits = _digits(own)
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9]+", own.rstrip(")]"))[-1].lower()
        known, shape = last in _ENDINGS, any(c.isalpha() for c in own.split("@")[0])
        check = 1 if own.count("@") == 1 else 0
    elif kind == "ip":
        parts = own.split(".") if "." in own else own.split(":")
        known = own.startswith(("10.", "192.168.", "172.", "127.")) or parts[0] not in ("0", "00")
        shape, check = len(parts) in (4, 8), 1 if all(p == "0" or not p.startswith("0") for p in parts) else -1
    elif kind == "card":
        known, shape = bool(_ISSUERS.match(digits)), 13 <= len(digits) <= 19
        check = 1 if luhn(digits) else -1
    else:
        known = own.startswith("+") and digits.startswith(_CALLING)
        shape, check = 9 <= len(digits) <= 13, 1 if own.startswith("+") else 0
    return [
        1 if strict else 0, 1 if known else -1, 1 if shape else -1, check,
        1 if _FOR[kind].search(before) else 0, -1 if _AGAINST.search(before) else 0,
    ]


N_VOTES = 6
SPAN = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("a", T.IntegerType()),
    T.StructField("b", T.IntegerType()), T.StructField("strict", T.BooleanType()),
    T.StructField("votes", T.ArrayType(T.IntegerType())),
])


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, found): all candidates of each text with their votes."""

    @F.pandas_udf(T.ArrayType(SPAN))
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            out = []
            for text in part:
                text = text or ""
                strict = strict_spans(text)
                spans = [(s, True) for s in strict] + [(s, False) for s in loose_spans(text, strict)]
                out.append([
                    {"kind": KINDS.index(k), "a": a, "b": b, "strict": base, "votes": votes_on(text, k, a, b, base)}
                    for (k, a, b), base in spans
                ])
            yield pd.Series(out, dtype=object)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text")).alias("found"))


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """(prior, table): table[y, labeler, vote + 1] is P(vote | y), from counted patterns."""
    start = votes.sum(axis=1) + votes[:, 0]
    p = 1 / (1 + np.exp(-start.astype(float)))
    for _ in range(rounds):
        prior = (count @ p + 1) / (count.sum() + 2)
        table = np.empty((2, votes.shape[1], 3))
        for y, weight in ((0, count * (1 - p)), (1, count * p)):
            for v in (-1, 0, 1):
                table[y, :, v + 1] = (votes == v).T @ weight + 0.5
        table /= table.sum(axis=2, keepdims=True)
        p = posterior(prior, table, votes)
    return float(prior), table


def posterior(prior: float, table: np.ndarray, votes: np.ndarray) -> np.ndarray:
    log = [np.log(table[y][np.arange(votes.shape[1]), votes + 1]).sum(axis=1) for y in (0, 1)]
    odds = np.log(prior) - np.log(1 - prior) + log[1] - log[0]
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def features(kind: np.ndarray, size: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """Each labeler's vote for each kind, and the kind's length."""
    x = np.zeros((len(kind), len(KINDS), N_VOTES + 2))
    x[np.arange(len(kind)), kind] = np.concatenate(
        [votes, np.ones((len(kind), 1)), np.log1p(size)[:, None] / 4], axis=1
    )
    return x.reshape(len(kind), -1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Newton's method on soft labels."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(x) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(found: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier, or None without candidates."""
    rows = found.select("doc_id", F.explode("found").alias("s"))
    patterns = rows.groupBy("s.kind", "s.votes").agg(F.count("*").alias("n")).toPandas()
    if not len(patterns):  # there are at most 4 * 3^6 patterns
        return None
    models = {}
    for kind, part in patterns.groupby("kind"):
        votes = np.array(part["votes"].tolist(), dtype=int)
        models[kind] = estimate(votes, part["n"].to_numpy(float))
    size = F.col("s.b") - F.col("s.a")
    spans = rows.select("doc_id", "s.a", "s.kind", size.alias("size"), "s.votes")
    sample = hash_sample(spans, ["doc_id", "a"], SAMPLE_SPANS, int(patterns["n"].sum())).toPandas()
    votes = np.array(sample["votes"].tolist(), dtype=int)
    kind = sample["kind"].to_numpy()
    y = np.empty(len(sample))
    for k in np.unique(kind):
        y[kind == k] = posterior(*models[k], votes[kind == k])
    return fit_logistic(features(kind, sample["size"].to_numpy(float), votes), y)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in spans))


RESULT = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField(n, T.StringType()) for n in ("base", "base_sha256", "spans")]
    + [T.StructField("n_added", T.LongType())]
)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, base_sha256, spans, n_added); the
    counts are those of the strict matches, spans has the added ones too."""
    found = Stored(candidates(docs), "candidates").df
    weights = train(found)

    @F.pandas_udf(RESULT)
    def decided(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for own in part:
                base = [(s["kind"], s["a"], s["b"]) for s in own if s["strict"]]
                loose = [s for s in own if not s["strict"]]
                added = []
                if loose:
                    x = features(
                        np.array([s["kind"] for s in loose]),
                        np.array([float(s["b"] - s["a"]) for s in loose]),
                        np.array([list(s["votes"]) for s in loose], dtype=int),
                    )
                    sure = 1 / (1 + np.exp(-(x @ weights))) >= ADD_FROM
                    added = [(s["kind"], s["a"], s["b"]) for s, y in zip(loose, sure) if y]
                text = _joined(base)
                out.append((
                    *(sum(k == n for k, _, _ in base) for n in range(len(KINDS))), text,
                    hashlib.sha256(text.encode()).hexdigest(), _joined(base + added), len(added),
                ))
            yield pd.DataFrame(out, columns=RESULT.names)

    return found.select("doc_id", decided(F.col("found")).alias("r")).select("doc_id", "r.*")
