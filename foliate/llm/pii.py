"""Personal data: format rules, and boosted trees over high-recall candidate spans.

Base spans follow fixed patterns and always stay. Beside them, generators propose overlapping
candidate spans of seven kinds; boosted trees judge each by its format and its context; a
threshold for each kind, calibrated for precision on a held-out part of the training examples,
selects; of overlapping candidates the likelier stays, and none that overlaps a base span.

The trees are trained on examples that this module makes from format templates with a fixed seed
(TRAINING_EXAMPLES of them), so the model is the same for every input.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.boosting import BoostedTrees
from foliate.llm.common import prepare, table

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the trees add, in the order of the output.
MORE_KINDS = ("iban", "secret", "ssn")
KINDS = BASE_KINDS + MORE_KINDS
TRAINING_EXAMPLES = 9000
PRECISION = 0.98

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_DIGIT_RUN_BEFORE_DOT = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each "@": the local part is the run of its characters to the left."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        found = _DOMAIN.match(text, at + 1) if first < at else None
        if found:
            yield "email", first, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The spans that the fixed patterns find, by kind and then start."""
    out: list[Span] = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        # A match ends with a whole run of digits, and a run that fails from its start fails from inside.
        out += [("ip", *m.span()) for m in _DIGIT_RUN_BEFORE_DOT.finditer(text) if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


_AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\})\s?|\s(?:AT|at)\s(?=[\w-]+\s(?:dot|DOT)\s)|@", re.ASCII)
_AFTER_AT = re.compile(r"[\w-]+(?:(?:\s?(?:\(dot\)|\[dot\]|\{dot\})\s?|\s(?:dot|DOT)\s|\.)[\w-]+)+", re.ASCII)
_GENERATORS = (
    ("phone", re.compile(r"(?<![\w.-])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,5}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w.-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![\w-])")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("secret", re.compile(r"(?<![\w/+=-])[\w/+=-]{16,}(?![\w/+=-])", re.ASCII)),
    ("card", re.compile(r"(?<![\w.-])[0-9](?:[ .-]?[0-9]){12,18}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])|(?<![\w.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){0,6}::[0-9A-Fa-f]{1,4}(?![\w:])")),
)


def candidates(text: str) -> list[Span]:
    """High-recall proposals; they may overlap."""
    out: list[Span] = []
    if "@" in text or "at" in text or "AT" in text:
        for m in _AT.finditer(text):
            first = m.start()
            while first and text[first - 1] in _LOCAL:
                first -= 1
            after = _AFTER_AT.match(text, m.end()) if first < m.start() else None
            if after:
                out.append(("email", first, after.end()))
    if _DIGIT.search(text):
        for kind, pattern in _GENERATORS:
            out += [(kind, *m.span()) for m in pattern.finditer(text) if kind != "secret" or _DIGIT.search(m[0])]
    return out


#: Words that speak for a kind when they stand before a span (fixed values).
CONTEXT = {
    "email": ("mail", "contact", "write", "reply", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "from", "client", "adresse"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta", "debit"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "ligne"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
    "secret": ("token", "key", "secret", "password", "passwd", "api", "auth", "bearer", "credential"),
    "ssn": ("ssn", "social", "security", "tax", "insurance"),
}
#: Words that speak against personal data (fixed values).
AGAINST = ("version", "isbn", "order", "invoice", "section", "page", "date", "year", "build", "commit", "sha", "hash", "md5", "checksum", "doi", "article", "part", "serial", "model", "chapter", "figure", "revision")
_WORDS = re.compile(r"[a-z]+")
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "xoxb-", "xoxp-", "sk-", "sk_live", "AIza", "eyJ", "glpat-")


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def span_features(text: str, kind: str, first: int, last: int) -> list[float]:
    s = text[first:last]
    n = len(s)
    digits = [c for c in s if c.isdigit()]
    letters = [c for c in s if c.isalpha()]
    plain = "".join(digits)
    counts = np.unique(list(s), return_counts=True)[1] / n
    before = _WORDS.findall(text[max(0, first - 40) : first].lower())[-5:]
    left, right = text[first - 1] if first else "\n", text[last] if last < len(text) else "\n"
    close = text[max(0, first - 4) : first].rstrip("\"' ")[-1:]
    groups = [len(g) for g in re.split(r"[^0-9A-Za-z]+", s) if g]
    date = bool(re.match(r"(19|20)[0-9]{2}[-./ ](0?[1-9]|1[0-2])[-./ ]|(0?[1-9]|[12][0-9]|3[01])[-./ ](0?[1-9]|1[0-2])[-./ ](19|20)[0-9]{2}", s))
    return [
        *[float(kind == k) for k in KINDS],
        float(n), float(len(digits)), float(len(letters)), len(digits) / n, sum(c.isupper() for c in s) / n,
        float(-(counts * np.log2(counts)).sum()), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(13 <= len(plain) <= 19 and luhn(plain)), float(kind == "iban" and iban_valid(s)), float(len(set(plain))),
        float(s[0] in "+(" or s.startswith("00")), float(date), float(any(s.startswith(p) for p in _PREFIXES)),
        float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s))), float(n in (32, 40, 64)), float(sum(c in "-_/+=" for c in s)) / n,
        float(bool(re.search(r"(.)\1\1\1", s))), float("." in s), float(any(x in s.lower() for x in ("(at)", "[at]", "{at}", " at "))),
        float(any(w in CONTEXT[kind] for w in before)), float(any(w in AGAINST for w in before)), float(close in ("=", ":")),
        float(left in "\"'"), float(left.isspace()), float(right.isspace() or right in ".,;:)\"'"), float(kind == "ssn" and not s.startswith(("000", "666", "9"))),
    ]


def _example(r: random.Random, kind: str, good: bool) -> tuple[str, int, int]:
    """One span in its context: a real one, or a look-alike."""
    digit = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(("er", "an", "th", "on", "re", "in", "la", "de", "ti", "os", "ch")) for _ in range(r.randint(1, 4)))
    mixed = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    hexes, base62 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def card(ok: bool) -> str:
        while True:
            d = r.choice("3456") + digit(r.choice((14, 15, 15, 15, 18)))
            if luhn(d) == ok:
                sep = r.choice(("", "", " ", "-"))
                return sep.join(d[k : k + 4] for k in range(0, len(d), 4))

    def iban(ok: bool) -> str:
        country, body = r.choice(("DE", "FR", "ES", "GB", "NL")), digit(r.choice((14, 16, 18, 20)))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        check = check if ok else (check + r.randint(1, 90)) % 97
        s = f"{country}{check:02d}{body}"
        return " ".join(s[k : k + 4] for k in range(0, len(s), 4)) if r.random() < 0.5 else s

    if kind == "email":
        host = f"{word()}.{r.choice(('com', 'org', 'net', 'de', 'fr'))}"
        s = f"{word()}.{word()}{r.choice((' (at) ', '(at)', '[at]', ' [at] ', ' at '))}{word()}{r.choice((' dot ', '.', '(dot)', ' (dot) '))}{host.split('.')[1]}" if good else f"{word()} at {word()} dot {word()}"
    elif kind == "ip":
        s = ":".join(mixed(hexes, 4) for _ in range(8)) if good else ":".join(digit(2) for _ in range(r.choice((4, 5, 6))))
    elif kind == "card":
        s = card(good)
    elif kind == "phone":
        s = r.choice((f"({digit(3)}) {digit(3)}-{digit(4)}", f"{digit(3)}-{digit(3)}-{digit(4)}", f"00{digit(2)} {digit(3)} {digit(4)} {digit(3)}", f"{digit(3)}.{digit(3)}.{digit(4)}", f"+{digit(2)} {digit(3)} {digit(3)} {digit(3)}")) if good else r.choice((f"{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{digit(1)}.{digit(2)}.{digit(2)}", f"{digit(2)} {digit(3)} {digit(3)}", f"{r.randint(1, 28):02d}.{r.randint(1, 12):02d}.{r.randint(1900, 2099)}", f"{digit(4)} {digit(4)} {digit(4)} {digit(4)}", f"{digit(3)}-{digit(1)}{digit(1)}-{digit(3)}", f"{digit(2)}.{digit(3)}.{digit(2)}.{digit(3)}", f"{digit(3)}.{digit(3)}.{digit(3)}.{digit(3)}"))
    elif kind == "iban":
        s = iban(good) if good or r.random() < 0.7 else f"{mixed('ABCDEFGH', 2)}{digit(2)} {mixed(base62[:26], 4)} {digit(4)}"
    elif kind == "ssn":
        s = f"{r.randint(100, 665)}-{digit(2)}-{digit(4)}" if good else f"{r.choice(('000', '666', '9' + digit(2)))}-{digit(2)}-{digit(4)}"
    else:
        s = r.choice(("AKIA" + mixed(base62[:26] + "234567", 16), mixed(hexes, r.choice((32, 40, 64))), "ghp_" + mixed(base62, 36), "sk-" + mixed(base62, 40), mixed(base62, r.randint(24, 44)))) if good else r.choice(("-".join(word() for _ in range(5)) + "-2", mixed("abcdefgh", 18) + "1", "=" * 20 + digit(1), word() * 5 + digit(2), digit(r.randint(16, 24)), "_".join(word() for _ in range(4)) + "_" + digit(1)))
    lead = " ".join(word() for _ in range(r.randint(2, 6)))
    cue = ""
    if good and (r.random() < 0.5 or kind in ("secret",) and not s.startswith(_PREFIXES)):
        cue = f" {r.choice(CONTEXT[kind])}" + (r.choice((" = \"", "=", ": ", " ")) if kind == "secret" else r.choice((": ", " ")))
    elif not good and r.random() < 0.4:
        cue = f" {r.choice(AGAINST)}{r.choice((' ', ': '))}"
    head = lead + (cue or " ")
    return head + s + ("\"" if cue.endswith("\"") else "") + r.choice((" ", ". ", ", ", "\n")) + word(), len(head), len(head) + len(s)


@cache
def model(examples: int = TRAINING_EXAMPLES, precision: float = PRECISION) -> tuple[BoostedTrees, dict[str, float]]:
    """The trees and the threshold of each kind; a kind that can't reach the precision keeps an infinite one."""
    r = random.Random(20)
    rows, labels, kinds = [], [], []
    for k in range(examples):
        kind, good = KINDS[k % len(KINDS)], r.random() < 0.5
        text, first, last = _example(r, kind, good)
        rows.append(span_features(text, kind, first, last))
        labels.append(float(good))
        kinds.append(kind)
    x, y, of = np.array(rows), np.array(labels), np.array(kinds)
    fit = np.arange(examples) % 3 > 0
    trees = BoostedTrees().fit(x[fit], y[fit])
    scores = trees.scores(x[~fit])
    limits = {}
    for kind in KINDS:
        own = of[~fit] == kind
        order = np.argsort(-scores[own], kind="stable")
        s, good = scores[own][order], y[~fit][own][order]
        right = np.cumsum(good) / np.arange(1, len(good) + 1)
        enough = np.flatnonzero(right >= precision)
        limits[kind] = max(float(s[enough[-1]]), 0.0) if len(enough) else math.inf
    return trees, limits


def find_spans(text: str, trees: BoostedTrees, limits: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans in the order of KINDS and then start."""
    base = base_spans(text)
    proposed = candidates(text)
    if not proposed:
        return base, base
    taken: list[tuple[int, int]] = []  # disjoint
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    free = [c for c in dict.fromkeys(proposed) if not any(a < c[2] and c[1] < b for a, b in _near(taken, c))]
    if not free:
        return base, base
    scores = trees.scores(np.array([span_features(text, *c) for c in free]))
    chosen: list[Span] = []
    held: list[tuple[int, int]] = []
    for score, c in sorted(zip(scores.tolist(), free, strict=True), key=lambda x: (-x[0], x[1][1] - x[1][2], x[1])):
        if score >= limits[c[0]] and not any(a < c[2] and c[1] < b for a, b in _near(held, c)):
            chosen.append(c)
            insort(held, (c[1], c[2]))
    place = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + chosen, key=lambda s: (place[s[0]], s[1], s[2]))


def _near(ranges: list[tuple[int, int]], c: Span) -> list[tuple[int, int]]:
    """Those of the sorted, disjoint ranges that may overlap c."""
    low = k = bisect_left(ranges, (c[2], 0))
    while low and ranges[low - 1][1] > c[1]:
        low -= 1
    return ranges[low:k]


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans are replaced together."""
    out, done = [], 0
    for kind, first, last in sorted(spans, key=lambda s: (s[1], -s[2])):
        if first >= done:
            out += [text[done:first], f"<{kind.upper()}>"]
            done = last
        elif last > done:
            done = last
    return "".join(out) + text[done:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Spans of every whole text: doc_id, n_email, n_ip, n_card, n_phone (base spans), then
    spans array<struct<kind, start, end>> and redacted, or with digests=True base_sha256, spans and
    n_spans (how many spans there are of any kind).

    Offsets count code points, the end is exclusive. A null text is empty and has no spans;
    repeated rows are judged each for itself; an empty table gives an empty result; very long texts
    are scanned whole in linear time. redacted is null where the text is. Other columns than those
    named in `carry`, which are returned as _c0, _c1 and so on, aren't read. No shuffle.
    """
    carry = carry or []
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    trees, limits = model()
    counts = [f"n_{k}" for k in BASE_KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [find_spans(t or "", trees, limits) for t in texts]
            columns = [batch.column(0)] + [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
            if digests:
                columns += [pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()), pa.array([_joined(s) for _, s in found], pa.string())]
                columns.append(pa.array([len(s) for _, s in found], pa.int64()))
                names = ["base_sha256", "spans", "n_spans"]
            else:
                struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                columns += [pa.array([[dict(kind=k, start=a, end=b) for k, a, b in s] for _, s in found], struct), pa.array([t and redact(t, s) for t, (_, s) in zip(texts, found, strict=True)], pa.string())]
                names = ["spans", "redacted"]
            columns += [batch.column(2 + k) for k in range(len(carry))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *counts, *names, *(f"_c{k}" for k in range(len(carry)))])

    out = "base_sha256 string, spans string, n_spans long" if digests else "spans array<struct<kind: string, start: int, end: int>>, redacted string"
    extra = "".join(f", _c{k} {kinds[c]}" for k, c in enumerate(carry))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(carry)])
    return source.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in counts)}, {out}{extra}")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return detect_pii(table(spark, sf_dir, "documents"), digests=True)
