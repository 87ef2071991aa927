"""Personal data: candidate spans, boosted trees and calibrated thresholds.

Base rules (fixed patterns of the contract for e-mail, ip, card and phone) always
count. Beyond them, high-recall generators propose overlapping spans: spelled-out
addresses, runs of digit groups in every split, dotted quadruples. Boosted
trees score each proposal by its format and context; per kind the smallest
threshold whose precision on held-out documents is at least ``PRECISION``
selects, after Platt scaling of the scores. Of overlapping selected spans the most
probable one stays, and none may overlap a base span.

Training labels are weak. A bounded sample of ``TRAIN_DOCS`` distinct texts, those
with the smallest hashes, gives base spans as positives, and the same spans
rewritten in other formats at their place (spelled-out addresses, numbers without
the plus, other separators). Negatives are proposals away from base spans and
spans corrupted at their place: wrong check digits, parts over 255, numbers cut to
versions and dates. The model is small and goes to the executors with the task.

Scale: one pass over hashes and one over the sampled texts to train; one pass
without a shuffle to find spans. Patterns look at every character a bounded
number of times, so very long texts and runs cost linear time.

Null and empty texts have no spans. Without training spans nothing is added to the
base rules. Null ids, repeated rows and extra columns are kept as they are. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickloom.llm import boosting
from clickloom.llm.common import small, texts

KINDS = ["email", "ip", "card", "phone"]
#: distinct texts that the model is trained on, and proposals taken from them
TRAIN_DOCS = 4000
TRAIN_ROWS = 40_000
#: of which one text gives so many at most, and ways in which a base span is rewritten
TEXT_ROWS = 400
REWRITES = 3
#: parts of the texts, each scored by trees that the other parts grow
FOLDS = 4
#: least held-out precision of an added kind of span, and least number of held-out spans that show it
PRECISION = 0.99
LEAST_SHOWN = 30

# fixed values of the contract: the base patterns. Bounds on both sides of a digit run keep the search linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules by start, then kind."""
    found: list[Span] = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((0, start, m.end()))
            done = m.end()
        else:
            done = max(done, at)  # nothing before this sign can match any more
        at = text.find("@", max(at + 1, done))
    if re.search("[0-9]", text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


# ---- proposals ----------------------------------------------------------------------------------------------------

_AT = re.compile(r"@| ?(?:\(at\)|\[at\]|\{at\}) ?| at ", re.IGNORECASE)
_NAME_AFTER = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot )[A-Za-z0-9-]++)++", re.IGNORECASE)
#: groups of digits with up to three separators between; no letter touches the ends
_NUMBER = re.compile(r"(?<![0-9A-Za-z_])[+(]{0,2}[0-9]+(?:[\x20().\-/\[\]]{1,3}[0-9]+)*(?![0-9A-Za-z_])")
_GROUP = re.compile(r"[0-9]+")
_HINTS = [
    re.compile(r"mail|contact|write|reach", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|address|node", re.IGNORECASE),
    re.compile(r"card|visa|credit|payment|account", re.IGNORECASE),
    re.compile(r"phone|tel|call|fax|mobile|cell|dial", re.IGNORECASE),
    re.compile(r"version|licen[sc]e|release|isbn|order|invoice|page|section|chapter|date|v\Z", re.IGNORECASE),
]
#: most digits of one proposal, as of a card; no more groups than that start at one place
_MOST_DIGITS = 19
#: proposals that are scored at a time
_SCORED = 20_000


def _word_start(text: str, end: int) -> int:
    """Where the local part that ends here starts; ``end`` when there is none. It holds no address sign, so scans do not meet."""
    start = end
    while start and text[start - 1] in _LOCAL:
        start -= 1
    while start < end and text[start] in "._%+-":
        start += 1
    return start


def proposals(text: str) -> list[Span]:
    """Overlapping candidate spans of all kinds, in no more than a few per digit group or address sign."""
    return list(_proposals(text))


def _proposals(text: str) -> Iterator[Span]:
    low = text.lower()
    if "@" in text or " at " in low or "at)" in low or "at]" in low or "at}" in low:
        for m in _AT.finditer(text):
            before = _word_start(text, m.start())
            after = _NAME_AFTER.match(text, m.end()) if before < m.start() else None
            if after:
                yield 0, before, after.end()
    if not re.search("[0-9]", text):
        return
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, *m.span())]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                if digits > _MOST_DIGITS:
                    break
                start, end = groups[i][0], groups[j][1]
                while start > m.start() and text[start - 1] in "(+":
                    start -= 1
                if j - i == 3:
                    yield 1, groups[i][0], end
                if digits >= 12:
                    yield 2, groups[i][0], end
                if 7 <= digits <= 15:
                    yield 3, start, end


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span as numbers."""
    kind, start, end = span
    body = text[start:end]
    groups = [m.group() for m in _GROUP.finditer(body)]
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    before, after = text[max(0, start - 24) : start], text[end : end + 12]
    near = text[max(0, start - 30) : start] + text[end : end + 30]
    left, right = before[-1:], after[:1]
    name = re.split(r"[.\s()\[\]{}]+", body.rstrip(")]}"))[-1]
    return [
        *(float(kind == k) for k in range(4)),
        len(body), len(digits), len(groups), sizes[0], sizes[-1], max(sizes), min(sizes),
        body.startswith("+"), "(" in body, body.count(" "), body.count("-"), body.count("."), body.count("/"),
        luhn(digits) if digits else False, digits[:1] in ("3", "4", "5", "6"), len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups),
        "@" in body, bool(re.search(r"[(\[{ ](?:at|dot)[)\]} ]", body, re.IGNORECASE)), name.isalpha() * len(name),
        left.isalnum(), left in "+(.,-/", right.isalnum(), right in ").-/", after[:2].strip(" -./()+").isdigit(), before[-2:].strip(" -./()+").isdigit(),
        *(bool(h.search(before)) for h in _HINTS),
        sum(c.isdigit() for c in near), sum(c.isalpha() for c in near),
    ]


# ---- training -----------------------------------------------------------------------------------------------------


def _variants(kind: int, body: str, pick: int) -> list[tuple[str, int]]:
    """Other ways to write a base span (label 1) and look-alikes that are none (label 0)."""
    d = _digits(body)
    if kind == 0:
        user, host = body.split("@", 1)
        sign = (" at ", " [at] ", "(at)", " (at) ")[pick % 4]
        dot = (" dot ", " [dot] ", "(dot)", ".")[pick // 4 % 4]
        return [(user + sign + host.replace(".", dot), 1), (f"{host.split('.')[0]} at {user[:5]}.{user[:3].title()}", 0)]
    if kind == 1:
        parts = body.split(".")
        return [("[.]".join(parts), 1), (".".join([parts[0], str(256 + int(parts[1])), parts[2], parts[3]]), 0), (f"{parts[0]}.{parts[1]}.{parts[2]}", 0), (f"{parts[0]}-{parts[1]}-{parts[2]}-{parts[3]}", 0)]
    if kind == 2:
        sep = ("-", " ", ".", "/")[pick % 4]
        wrong = d[:-1] + str((int(d[-1]) + 1 + pick % 9) % 10)
        cut = lambda x: sep.join(x[k : k + 4] for k in range(0, len(x), 4))
        return [(cut(d), 1), (wrong, 0), (cut(wrong), 0), (d[:8], 0), (d[:10], 0)]
    local = d[-10:]
    sep = ("-", ".", " ")[pick % 3]
    return [
        (f"({local[:3]}) {local[3:6]}-{local[6:]}", 1), (sep.join([local[:3], local[3:6], local[6:]]), 1), (f"00{d[:-10]} {local[:3]} {local[3:]}", 1),
        (f"20{local[:2]}-0{local[3]}-1{local[4]} 0{local[5]}", 0), (local, 0), (f"{local[:4]}-{local[4:8]}", 0),
    ]


def training_rows(text: str, most: int = TEXT_ROWS) -> list[tuple[list[float], int]]:
    """Features and labels that one text gives, the first ``most``: its proposals, and its base spans rewritten at their place."""
    base = base_spans(text)
    exact = set(base)
    rows = []
    for s in _proposals(text):
        if len(rows) >= most:
            return rows
        if s in exact:
            rows.append((features(text, s), 1))
        elif not any(b[1] < s[2] and s[1] < b[2] for b in base):
            rows.append((features(text, s), 0))
        elif any(b[0] == s[0] and b[1] < s[2] and s[1] < b[2] for b in base):
            rows.append((features(text, s), 0))  # a part or an extension of a span is not the span
    for kind, start, end in base:
        pick = zlib.crc32(text[start:end].encode())
        rewritten = dict.fromkeys(v for k in range(REWRITES) for v in _variants(kind, text[start:end], pick + 5 * k))
        for other, label in rewritten:
            around = text[max(0, start - 60) : start] + other + text[end : end + 60]
            first = min(start, 60)
            for s in proposals(around):
                if s[1] >= first and s[2] <= first + len(other):
                    whole = s[0] == kind and s[1] == first and s[2] >= first + len(other)
                    rows.append((features(around, s), int(label and whole)))
    return rows[:most]


class Model:
    """Trees, Platt scaling (a, b) and a threshold of the probability per kind; above 1 means that nothing is added."""

    def __init__(self, trees: list, scale: tuple[float, float], thresholds: list[float]):
        self.trees, self.scale, self.thresholds = trees, scale, thresholds

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * boosting.margins(self.trees, x) + b)))


NOTHING = ([], (1.0, 0.0), [2.0] * len(KINDS))


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that fit the log-odds of held-out labels, by Newton steps with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - y) * margin).sum() + 0.01 * (a - 1), (p - y).sum() + 0.01 * b])
        h = np.array([[(w * margin**2).sum() + 0.01, (w * margin).sum()], [(w * margin).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit_model(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple:
    """Model parts from rows of features. Every row is scored by trees that its fold has no part in; these scores
    calibrate and choose the thresholds. The trees of the model are grown from all rows."""
    parts = [fold == k for k in range(FOLDS)]
    if min(y.sum(), (1 - y).sum()) < LEAST_SHOWN or any(len(set(y[~part])) < 2 for part in parts if part.any()):
        return NOTHING
    margin = np.zeros(len(y))
    for part in parts:
        if part.any():
            margin[part] = boosting.margins(boosting.fit(x[~part], y[~part]), x[part])
    scale, trees = _platt(margin, y), boosting.fit(x, y)
    p = 1 / (1 + np.exp(-(scale[0] * margin + scale[1])))
    thresholds = []
    for kind in range(len(KINDS)):
        mine = x[:, kind] == 1
        order = np.argsort(-p[mine], kind="stable")
        right = np.cumsum(y[mine][order])
        shown = np.arange(1, len(order) + 1)
        # equal probabilities are taken together
        last = np.append(np.diff(p[mine][order]) != 0, True) if len(order) else np.zeros(0, bool)
        good = last & (right / shown >= PRECISION) & (shown >= LEAST_SHOWN)
        thresholds.append(max(0.5, float(p[mine][order][np.flatnonzero(good)[-1]])) if good.any() else 2.0)
    return trees, scale, thresholds


def train(docs: DataFrame, text: str = "text", train_docs: int = TRAIN_DOCS, train_rows: int = TRAIN_ROWS) -> tuple:
    """Model parts from a bounded sample: the distinct texts with digits or address signs and the smallest hashes."""
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("h")).where(F.col("text").rlike("[0-9@]"))
    last = hashed.select("h").distinct().orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    if last is None:
        return NOTHING

    def rows(batches):
        for batch in small(batches):
            out: list[tuple[int, int, list[float], int]] = []
            for key, value in zip(batch.column(1).to_pylist(), texts(batch.column(0))):
                out += [(key, n, x, y) for n, (x, y) in enumerate(training_rows(value))]
            types = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["h", "n", "x", "y"])

    found = hashed.where(F.col("h") <= last).mapInArrow(rows, "h bigint, n bigint, x array<double>, y bigint")
    found = found.groupBy("h", "n").agg(F.first("x").alias("x"), F.first("y").alias("y")).orderBy("h", "n").limit(train_rows)
    table = found.select("h", F.col("x").cast("array<float>").alias("x"), "y").toArrow()  # train_rows rows at most
    if not table.num_rows:
        return NOTHING
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).astype(np.float64)
    return fit_model(x, table.column("y").to_numpy().astype(np.float64), table.column("h").to_numpy() % FOLDS)


# ---- detection ----------------------------------------------------------------------------------------------------


def _used(spans: list[Span], size: int) -> bytearray:
    """A one for each character in a span."""
    used = bytearray(max([size, *(s[2] for s in spans)]))
    for _, start, end in spans:
        used[start:end] = b"\1" * (end - start)
    return used


def select(base: list[Span], offered: list[tuple[float, Span]]) -> list[Span]:
    """Base spans and, most probable first, the offered ones that overlap nothing selected; by start, then kind."""
    taken = list(base)
    used = _used(base, max((s[2] for _, s in offered), default=0))
    for _, s in sorted(offered, key=lambda o: (-o[0], o[1][1], -o[1][2], o[1][0])):
        if used.find(1, s[1], s[2]) < 0:
            taken.append(s)
            used[s[1] : s[2]] = b"\1" * (s[2] - s[1])
    return sorted(taken, key=lambda s: (s[1], s[0]))


def find_spans(rows: list[str], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all selected spans of each text."""
    base = [base_spans(t) for t in rows]
    owners, spans, table = [], [], []
    offers: dict[int, list[tuple[float, Span]]] = {}

    def score() -> None:
        if table:
            for k, s, p in zip(owners, spans, model.probability(np.array(table, float)).tolist()):
                if p >= model.thresholds[s[0]]:
                    offers.setdefault(k, []).append((p, s))
        for held in (owners, spans, table):
            held.clear()

    for k, text in enumerate(rows):
        used = _used(base[k], len(text))
        for s in _proposals(text):
            if model.thresholds[s[0]] <= 1 and used.find(1, s[1], s[2]) < 0:
                owners.append(k)
                spans.append(s)
                table.append(features(text, s))
                if len(table) >= _SCORED:
                    score()
    score()
    return [(b, select(b, offers[k]) if k in offers else b) for k, b in enumerate(base)]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<kind: string, start: bigint, end: bigint>>"


def _span_array(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in row] for row in spans], _SPANS)


def detect(docs: DataFrame, model: tuple | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base_spans, spans): arrays of kind, start and end in code points. The model is trained on ``docs`` if none is given."""
    parts = train(docs, text) if model is None else model

    def run(batches):
        scorer = Model(*parts)
        for batch in small(batches):
            found = find_spans(texts(batch.column(1)), scorer)
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_array([f[0] for f in found]), _span_array([f[1] for f in found])], [id_col, "base_spans", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, base_spans {_SPANS_SQL}, spans {_SPANS_SQL}")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one, named by the first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, model: tuple | None = None, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text, and the number of code points brought up to date if there is such a column."""
    parts = train(docs, text) if model is None else model
    columns = docs.columns
    at = columns.index(text)
    count_at = columns.index(chars) if chars in columns else None

    def run(batches):
        scorer = Model(*parts)
        for batch in small(batches):
            arrays = list(batch.columns)
            rows = texts(batch.column(at))
            new = [redact_text(t, spans) if spans else t for t, (_, spans) in zip(rows, find_spans(rows, scorer))]
            known = batch.column(at).is_valid().to_pylist()
            arrays[at] = pa.array([t if ok else None for t, ok in zip(new, known)], pa.string())
            if count_at is not None:
                arrays[count_at] = pa.array([len(a) if a != b else n for a, b, n in zip(new, rows, batch.column(count_at).to_pylist())], batch.column(count_at).type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    fields = [StructField(f.name, StringType()) if f.name == text else f for f in docs.schema.fields]
    return docs.mapInArrow(run, StructType(fields))


def report(spark: SparkSession, docs: DataFrame, model: tuple | None = None) -> DataFrame:
    """Counts of the base rules, the digest of their spans and all spans of each document."""
    found = detect(docs.select("doc_id", "text"), model)
    text = "concat_ws(',', transform({}, s -> concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string))))"
    counts = [F.expr(f"cast(size(filter(base_spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(text.format("base_spans")), 256).alias("base_sha256"), F.expr(text.format("spans")).alias("spans"))


def sha(spans: list[Span]) -> str:
    """The digest of spans that the query reports."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
