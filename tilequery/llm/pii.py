"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded, small_batches

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn", "secret")
KINDS = BASE + EXTRA

_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits, with three more after dots if they follow: no run is looked at from its middle.
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
#: Keys of services, by the prefix that their issuers give them, and signed tokens of three parts.
_ISSUED = re.compile(
    r"(?<![0-9A-Za-z])(?:A[KS]IA[0-9A-Z]{16}|gh[oprsu]_[0-9A-Za-z]{30,255}|github_pat_[0-9A-Za-z_]{22,255}|glpat-[0-9A-Za-z_-]{20,64}|[rs]k_(?:live|test)_[0-9A-Za-z]{16,255}"
    r"|sk-[0-9A-Za-z_-]{16,255}|xox[abeprs]-[0-9A-Za-z-]{10,255}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{8,4096}\.eyJ[0-9A-Za-z_-]{8,4096}\.[0-9A-Za-z_-]{8,4096})(?![0-9A-Za-z])"
)
_PEM = re.compile(r"-----BEGIN (?:[0-9A-Z]{1,16} ){0,3}PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END (?:[0-9A-Z]{1,16} ){0,3}PRIVATE KEY-----")
#: A value that is assigned to a name for secrets; group 1 the quote, group 2 the value.
_ASSIGNED = re.compile(r"(?:(?:passw(?:or)?d|passphrase|pwd|secret|token|(?:api|access|private|auth)[_-]?key)[\"']?\x20{0,3}(?::=|=>|[:=])|bearer)\x20{0,3}([\"'`]?)([^\s\"'`,;<>]{6,256})", re.IGNORECASE)
#: Texts without any of these hold no such secret; most texts do not.
_ISSUED_SIGNS = ("AKIA", "ASIA", "gh", "glpat-", "k_live_", "k_test_", "sk-", "xox", "AIza", "eyJ")
_ASSIGNED_SIGNS = ("passw", "passphrase", "pwd", "secret", "token", "key", "bearer")
_SECRET = re.compile(r"[^0-9A-Za-z]{1,8}([0-9A-Fa-f]{32,64})(?![0-9A-Za-z])")
_NAMED = ("token", "secret", "passwd", "password", "key")
_DIGIT_OR_HYPHEN = frozenset("0123456789-")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Lengths of an IBAN by country code (ISO 13616 registry).
_IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: Score before context, words that raise it and words that lower it.
_CONTEXT = {
    "email": (0.9, ("mail", "contact", "correo", "courriel"), ("noreply", "example")),
    "ip": (0.6, ("ip", "host", "server", "addr"), ("version", "v.", "section")),
    "card": (0.8, ("card", "visa", "credit", "karte", "tarjeta", "carte"), ("order", "isbn", "id ")),
    "phone": (0.7, ("phone", "tel", "call", "mobile", "fax"), ("order", "isbn")),
    "iban": (0.8, ("iban", "account", "konto", "bank", "cuenta", "compte"), ()),
    "ssn": (0.4, ("ssn", "social", "security"), ("order", "part", "isbn")),
    "secret": (0.2, ("token", "secret", "key", "password", "passwd", "bearer"), ("sha", "commit", "digest", "md5")),
}
#: Added kinds need this score; base spans are kept whatever their score.
THRESHOLD = 0.5
_REACH = 40

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every start in a run of name characters reaches the same ``@``: look left and right of each ``@`` only."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _NAME_CHARS:
            start -= 1
        end = (m := _DOMAIN.match(text, at + 1)) and m.end()
        if start < at and end:
            yield start, end
        floor = end if start < at and end else at + 1
        at = text.find("@", floor)


def _iban(text: str, m: re.Match) -> int | None:
    """End of the IBAN that starts at the match, if its length for the country and mod-97 fit."""
    need, i = _IBAN_LENGTH.get(m[0][:2], 0), m.start()
    have = []
    while need and i < m.end() and len(have) < need:
        if text[i] != " ":
            have.append(text[i])
        i += 1
    return i if need and len(have) == need and mod97("".join(have)) else None


def _secrets(text: str) -> list[tuple[int, int, float]]:
    """Spans of secrets and what their shape adds to the score; of spans that overlap the one that starts first, then the longest."""
    low = text.lower()
    if len(low) != len(text):  # some letters are two characters in lower case: places would move
        low = text
    found = [(m.start(), m.end(), 0.7) for m in _ISSUED.finditer(text)] if any(x in text for x in _ISSUED_SIGNS) else []
    at = 0
    while m := _PEM.search(text, at):
        end = _PEM_END.search(text, m.end())
        at = end.end() if end else len(text)  # a block without an end goes on to the end of the text
        found.append((m.start(), at, 0.7))
    for m in _ASSIGNED.finditer(text) if any(x in low for x in _ASSIGNED_SIGNS) else ():
        value = m[2]
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        found.append((*m.span(2), 0.3 if mixed else 0.1 if m[1] else -0.2))
    for word in _NAMED:
        at = low.find(word)
        while at >= 0:
            if m := _SECRET.match(text, at + len(word)):
                found.append((*m.span(1), 0.1))
            at = low.find(word, at + 1)
    out: list[tuple[int, int, float]] = []
    for x in sorted(found, key=lambda x: (x[0], -x[1], -x[2])):
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def _score(kind: str, text: str, start: int, end: int, shape: float = 0.0) -> float:
    base, good, bad = _CONTEXT[kind]
    base += shape
    near = (text[max(0, start - _REACH) : start] + " " + text[end : end + _REACH]).lower()
    return round(min(1.0, max(0.0, base + 0.3 * any(w in near for w in good) - 0.2 * any(w in near for w in bad))), 3)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text by start, then kind as listed; positions are code points, end exclusive."""
    found = [("email", *x) for x in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if m[1] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    added = [("iban", m.start(), end) for m in _IBAN.finditer(text) if not text[m.start() - 1 : m.start()].isalnum() and (end := _iban(text, m))]
    added += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text) if text[m.start() - 1 : m.start()] not in _DIGIT_OR_HYPHEN and m[0][:3] not in ("000", "666") and m[0][0] != "9"]
    added += [("secret", *x) for x in _secrets(text)]
    out = [(*x, _score(x[0], text, x[1], x[2])) for x in found]
    out += [y for x in added if (y := (*x[:3], _score(x[0], text, *x[1:])))[3] >= THRESHOLD]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def redact_text(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Put ``<KIND>`` in place of the spans; overlapping spans become one, named by the first."""
    out, at, end, kind = [], 0, 0, ""
    for k, s, e, _ in spans:
        if kind and s < end:
            end = max(end, e)
            continue
        if kind:
            out.append(f"<{kind.upper()}>")
            at = end
        out.append(text[at:s])
        at, kind, end = s, k, e
    if kind:
        out.append(f"<{kind.upper()}>")
        at = end
    return "".join(out) + text[at:]


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` for every row: spans are an array of (kind, start, end, score), kinds as in ``KINDS``.

    A null or empty text has no spans. Rows are handled one by one, so repeated ids stay
    repeated and other columns of ``df`` play no part. No shuffle.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("spans", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            spans = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t or "")] for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(spans, kind)], [id_col, "spans"])

    return bounded(df).select(id_col, text_col).mapInArrow(run, schema)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the spans of ``text_col`` replaced by ``<KIND>``; a null text stays null."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            texts = [t and redact_text(t, find_spans(t)) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names], names)

    return bounded(df).mapInArrow(run, df.schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, then ``n_iban, n_ssn, n_secret``, ``n_spans`` (all kinds) and ``scores`` (of ``spans``, in their order).

    A null or empty text has no spans. One row for each row, repeated ids too; an empty table gives no rows.
    """
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
    return found.select(
        "doc_id", *map(count, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), *map(count, EXTRA),
        F.size("spans").cast("long").alias("n_spans"), scores.alias("scores"),
    )
