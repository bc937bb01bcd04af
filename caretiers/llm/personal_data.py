"""Personal data: weak labelers vote on candidate spans, EM weighs them, a classifier decides.

Every candidate span gets votes (for, against, none) of labelers that look at its form, its check
digits, word lists and the words before it. Expectation-maximisation over all candidates of the
corpus estimates how reliable each labeler is and how likely each candidate is personal; a logistic
regression on votes and form is trained on those soft labels and decides about spans beyond the base
rules. Spans of the base rules always stay.

Candidates fall into a fixed number of patterns (kind, votes, form), so Spark counts the patterns of
all documents and the estimation sees one row per pattern.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

BASE = ("email", "ip", "card", "phone")
EXTRA = ("email_written", "phone_local", "id_number", "name")
KINDS = (*BASE, *EXTRA)
LABELERS = ("form", "check", "words", "context", "digits")
FORMS = 4
#: Least probability at which a span beyond the base rules is reported.
THRESHOLD = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A number that does not lead to a match does not do so from its later digits either.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WRITTEN = re.compile(r"(?i)[a-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[a-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[a-z0-9-]{1,63}){1,8}")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
_ID = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_NAME = re.compile(r"\b[A-Z][a-z]{1,20}\.? [A-Z][a-z]{1,20}\b")
_WORD = re.compile(r"[^\W\d_]+")

# Word lists of the labelers (fixed values).
TITLES = frozenset("Mr Mrs Ms Dr Prof Mr. Mrs. Ms. Dr. Prof. Herr Frau Madame Monsieur".split())
GIVEN = frozenset(
    "James Mary John Robert Patricia Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas "
    "Sarah Charles Karen Daniel Anna Peter Hans Klaus Sabine Monika Jean Pierre Marie Claire Luis Carlos Carmen Lucia".split()
)
DOMAINS = frozenset("com org net edu gov io de fr es uk eu info".split())
NEAR = {
    "email": frozenset("email mail e contact write correo courriel".split()),
    "ip": frozenset("ip address host server login client".split()),
    "card": frozenset("card visa mastercard credit karte tarjeta carte".split()),
    "phone": frozenset("phone tel call mobile fax telefon telefono".split()),
    "email_written": frozenset("email mail e contact write correo courriel".split()),
    "phone_local": frozenset("phone tel call mobile fax telefon telefono".split()),
    "id_number": frozenset("ssn social security id passport number".split()),
    "name": frozenset("name named called dear by from mr mrs dr".split()),
}
AGAINST = frozenset("version release section chapter isbn figure build license edition".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @, in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of the base patterns; those that are not valid are no base spans."""
    for start, end in _emails(text):
        yield "email", start, end, True
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19:
                yield "card", m.start(), m.end(), luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15


def _beyond(text: str) -> Iterator[tuple[str, int, int]]:
    low = text.lower() if "at]" in text or "at)" in text or "AT" in text else ""
    if "[at]" in low or "(at)" in low:
        for m in _WRITTEN.finditer(text):
            yield "email_written", m.start(), m.end()
    if _DIGIT.search(text):
        for m in _LOCAL_PHONE.finditer(text):
            yield "phone_local", m.start(), m.end()
        for m in _ID.finditer(text):
            yield "id_number", m.start(), m.end()
    words = text.split()
    if not GIVEN.isdisjoint(words) or not TITLES.isdisjoint(words):
        for m in _NAME.finditer(text):
            if m[0].split()[0] in GIVEN or m[0].split()[0] in TITLES:
                yield "name", m.start(), m.end()


def votes(text: str, kind: str, start: int, end: int, valid: bool) -> tuple[list[int], int]:
    """One vote (1, -1, or 0 for none) of each labeler, and the form of the span."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 60) : start])[-4:]]
    form = 1 if kind in ("email", "email_written", "id_number") else 0
    check = 0
    if kind in ("ip", "card", "phone"):
        check = 1 if valid else -1
    elif kind == "id_number":
        check = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind == "phone_local":
        check = -1 if digits[0] in "01" or digits[3] in "01" else 1
    words = 0
    if kind in ("email", "email_written"):
        words = 1 if re.split(r"[^A-Za-z]+", span.rstrip(".-])"))[-1].lower() in DOMAINS else -1
    elif kind == "name":
        first, last = span.split()
        words = 1 if first in GIVEN or first in TITLES and last in GIVEN else 0
        form = 1 if first in TITLES else 0
    elif kind == "card":
        words = 1 if digits[0] in "3456" else -1
    elif kind == "ip":
        words = -1 if span.startswith(("0.", "127.")) else 0
    context = 1 if any(w in NEAR[kind] for w in before) else -1 if any(w in AGAINST for w in before) else 0
    variety = len(set(digits))
    even = 0 if kind in ("email", "email_written", "name") else -1 if variety <= 2 else 0
    edge = (start == 0 or text[start - 1].isspace()) + 2 * (end == len(text) or not (text[end].isalnum() or text[end] in "-_/"))
    return [form, check, words, context, even], edge


def pattern(kind: str, cast: list[int], form: int) -> int:
    code = KINDS.index(kind)
    for v in cast:
        code = code * 3 + v + 1
    return code * FORMS + form


def unpattern(code: int) -> tuple[str, list[int], int]:
    code, form = divmod(code, FORMS)
    cast = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        cast.append(v - 1)
    return KINDS[code], cast[::-1], form


def estimate(counts: dict[int, int], rounds: int = 60) -> dict[int, float]:
    """Probability of each pattern being personal, by EM over the labelers' votes."""
    codes = sorted(counts)
    seen = [unpattern(c) for c in codes]
    weight = np.array([counts[c] for c in codes], float)
    cast = np.array([v for _, v, _ in seen]).reshape(len(codes), len(LABELERS)) + 1
    kind = np.array([KINDS.index(k) for k, _, _ in seen], int)
    chance = np.clip(0.5 + 0.2 * (cast - 1).sum(1), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.array([(1 + (weight * chance)[kind == k].sum()) / (2 + weight[kind == k].sum()) for k in range(len(KINDS))])
        likely = [np.log(1 - prior[kind]), np.log(prior[kind])]
        for y, share in enumerate((1 - chance, chance)):
            for l in range(len(LABELERS)):
                table = np.bincount(cast[:, l], weight * share, 3)
                # Prior counts in favour of labelers that are better than chance tell the classes apart.
                table = table + (1 + weight.sum() / 4) * np.array([0.1, 0.3, 0.6] if y else [0.6, 0.3, 0.1])
                likely[y] = likely[y] + np.log(table[cast[:, l]] / table.sum())
        chance = 1 / (1 + np.exp(np.clip(likely[0] - likely[1], -50, 50)))
    return dict(zip(codes, chance.tolist(), strict=True))


def _features(code: int) -> list[float]:
    kind, cast, form = unpattern(code)
    return [
        1.0,
        *[float(v == s) for v in cast for s in (-1, 1)],
        *[float(kind == k) for k in KINDS],
        *[float(form == f) for f in range(FORMS)],
    ]


def train(counts: dict[int, int], rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps with a ridge of 1."""
    if not counts:
        return np.zeros(len(_features(0)))
    soft = estimate(counts)
    codes = sorted(counts)
    x = np.array([_features(c) for c in codes])
    y = np.array([soft[c] for c in codes])
    n = np.array([counts[c] for c in codes], float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def accepted(counts: dict[int, int], threshold: float = THRESHOLD) -> set[int]:
    """Patterns of the kinds beyond the base rules that the classifier reports."""
    weights = train(counts)
    return {
        c
        for c in counts
        if unpattern(c)[0] in EXTRA and 1 / (1 + np.exp(-np.clip(np.dot(weights, _features(c)), -30, 30))) >= threshold
    }


_SPAN = pa.struct([("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())])


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all candidate spans of each row of docs with their patterns. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                found = list(matches(text))
                base = [(s, e) for _, s, e, valid in found if valid]
                found += [(k, s, e, True) for k, s, e in _beyond(text) if not any(a < e and s < b for a, b in base)]
                rows.append(
                    [
                        {"kind": KINDS.index(k), "first": s, "last": e, "base": v and k in BASE, "code": pattern(k, *votes(text, k, s, e, v))}
                        for k, s, e, v in found
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "spans"])

    read = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind: int, first: long, last: long, base: boolean, code: int>>"
    )
    return materialize(read, "spans")


def _written(spans: list[dict]) -> str:
    spans = sorted(spans, key=lambda s: (s["first"], s["kind"], s["last"]))
    return ",".join(f"{KINDS[s['kind']]}:{s['first']}:{s['last']}" for s in spans)


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, base_sha256, spans), a row per row of docs.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows get
    equal results; ids may be null; other columns are not read. Spans beyond the base rules do not
    overlap these. The patterns that the driver sees are at most a few thousand, at any size.
    """
    found = candidates(docs)
    counted = found.select(F.explode("spans").alias("s")).groupBy("s.code").count()
    good = accepted({r["code"]: r["count"] for r in counted.collect()}, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, written, sums, full = [], [], [], []
            for spans in batch.column("spans").to_pylist():
                base = [s for s in spans if s["base"]]
                more = [s for s in spans if s["code"] in good]
                counts.append([sum(s["kind"] == k for s in base) for k in range(len(BASE))])
                written.append(_written(base))
                sums.append(hashlib.sha256(written[-1].encode()).hexdigest())
                full.append(_written(base + more))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE))],
                    pa.array(written, pa.string()),
                    pa.array(sums, pa.string()),
                    pa.array(full, pa.string()),
                ],
                ["doc_id", *[f"n_{k}" for k in BASE], "base_spans", "base_sha256", "spans"],
            )

    return found.mapInArrow(
        run, f"doc_id long, {', '.join(f'n_{k} long' for k in BASE)}, base_spans string, base_sha256 string, spans string"
    )
