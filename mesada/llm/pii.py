"""Personal data in texts: proposed by regular expressions, confirmed by checksums, weighed by
the words nearby.

The base kinds (email, ip, card, phone) stand by their own rules: what matches and passes its
check is a span whatever its score, and its score is reported. The method's kinds (iban, secret,
account) need a score of ``THRESHOLD``, so an unconfirmed proposal counts only beside a context
word. Spans of one kind do not overlap; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import fresh, id_and_text, map_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "account")
THRESHOLD = 0.5
NEAR = 48  # code points on either side in which context words count

# Each pattern consumes whole runs, so that no text makes it walk a run twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}|[0-9a-f]{16,64})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Words that raise a proposal's score, by kind.
CONTEXT = {
    "email": ("mail", "contact", "write to", "@"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "secret": ("password", "passwd", "token", "secret", "api_key", "apikey", "api-key"),
    "account": ("ssn", "social security", "social-security"),
}
#: Base score of a proposal whose check holds (or that has none), by kind.
SCORES = {
    "email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "secret": 0.3, "account": 0.3,
}
BONUS = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Country and check digits to the end, letters as 10 to 35, remainder 1."""
    held = iban.replace(" ", "")
    if not 15 <= len(held) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in held[4:] + held[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A domain from each @ on, and the local part as far left as the last match allows."""
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        # Leading zeros do not matter, and long runs are not turned into numbers.
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A proposal may run into the words after an IBAN: its longest part, cut before a blank, that
    passes. The search goes on behind that part, or behind the first word of a proposal in vain."""
    at = 0
    while m := _IBAN.search(text, at):
        start, end = m.span()
        while end > start and not mod97(text[start:end]):
            end = max(start, text.rfind(" ", start, end))
        if end > start:
            yield start, end
            at = end
        else:
            at = m.end() if " " not in m[0] else text.index(" ", start)


def _matches(pattern: re.Pattern):
    return lambda text: (m.span() for m in pattern.finditer(text))


_FINDERS = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "secret": _matches(_SECRET),
    "account": _matches(_ACCOUNT),
}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    raised = any(w in near for w in CONTEXT[kind])
    return min(1.0, SCORES[kind] + BONUS * raised)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind as in KINDS, then by start."""
    out = []
    for kind in KINDS:
        for start, end in _FINDERS[kind](text):
            score = _score(text, kind, start, end)
            if kind in BASE_KINDS or score >= THRESHOLD:
                out.append((kind, start, end, score))
    return out


def mask(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span as <KIND>; of overlapping spans one mask, that of the first."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores): a row per row of docs.

    ``spans`` is kind:start:end, comma-joined, by kind and start; ``scores`` goes with it.
    Null and empty texts have no spans; ids are handed on as they are, null or repeated; an
    empty table gives an empty result.
    """

    def work(texts: pa.Array) -> list:
        counts, digests, spans, scores = [[] for _ in BASE_KINDS], [], [], []
        for text in texts.to_pylist():
            found = find(text)
            kinds = [f[0] for f in found]
            for n, kind in zip(counts, BASE_KINDS, strict=True):
                n.append(kinds.count(kind))
            base = [f for f in found if f[0] in BASE_KINDS]
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(found))
            scores.append([f[3] for f in found])
        return [
            *(pa.array(n, pa.int64()) for n in counts),
            pa.array(digests, pa.string()),
            pa.array(spans, pa.string()),
            pa.array(scores, pa.list_(pa.float64())),
        ]

    fields = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    fields += ", base_sha256 string, spans string, scores array<double>"
    return map_text(id_and_text(docs, id_col, text_col), "text", work, fields, drop_text=True)


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span in text_col masked; a null text stays null, other columns as they are."""
    (clean,) = fresh(docs, "masked")

    def work(texts: pa.Array) -> list:
        return [pa.array([mask(t, find(t)) for t in texts.to_pylist()], pa.string())]

    made = map_text(docs, text_col, work, f"`{clean}` string")
    return made.select(
        *[
            F.when(F.col(f"`{text_col}`").isNotNull(), F.col(f"`{clean}`")).alias(c)
            if c == text_col
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
