"""Find personal data: base patterns, and a semi-Markov conditional random field.

The field reads *zones*: runs of neighbouring tokens that hold a digit or an @. A
zone is cut into units (runs of digits, runs of letters, single signs, blanks).
Whole candidate segments of up to `MOST_UNITS` units are scored by features of the
whole span, everything else is one outside unit after the other, and dynamic
programming over (end, kind) chooses boundaries and kinds together. A segment's
length is bounded, so a zone costs time in proportion to its length.

The weights are fitted on zones of the corpus itself, labelled by the base patterns.
Zones in which a base pattern matches but fails its check (a phone number run
together with a card, say) are left out of the fit: they are what the field is for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
#: Zones that the fit sees, per set of kinds that the base finds in them.
SAMPLE = 300
EPOCHS = 30
MOST_UNITS = 24
FEWEST_DIGITS = 4
#: Where the weight of being a segment at all begins and is drawn to: spans unlike any
#: that were seen stay outside.
PRIOR = -6.0
#: Characters of a zone that are kept for the fit, and that a fitted zone may have.
LONGEST = 400

# Fixed patterns of the base rule.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A start inside a run of digits can't match where the run's first digit didn't.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ZONE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*(?:[\x20\t][^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*)*")
_UNIT = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What a search for the whole pattern finds, going from @ to @."""
    free, at = 0, text.find("@")
    while at >= 0:
        own = text[free:at]
        local = len(own) - len(own.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(spans by kind and start, matches that fail their check)."""
    spans = [("email", a, b) for a, b in _emails(text)]
    failed = []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(m.group()))
            if kind == "ip":
                good = all(map(_small, m.group().split(".")))
            elif kind == "card":
                good = 16 <= len(digits) <= 19 and luhn(digits)
            else:
                good = 8 <= len(digits) <= 15
            if good:
                spans.append((kind, m.start(), m.end()))
            elif len(digits) >= 8:
                failed.append((m.start(), m.end()))
    return spans, failed


# --- segments and their features -----------------------------------------------


def _sort_of(c: str) -> str:
    return "9" if "0" <= c <= "9" else "a" if c.isalnum() else "_" if c.isspace() else c


@dataclass
class Segment:
    start: int
    end: int
    first: int
    last: int
    features: tuple[str, ...]


def _features(text: str, start: int, end: int) -> tuple[str, ...]:
    span = text[start:end]
    digits = "".join(_DIGITS.findall(span))
    shape = _DIGITS.sub(lambda m: str(min(len(m.group()), 20)), span) if "@" not in span else "@"
    shape = _LETTERS.sub("a", shape)
    parts = span.split(".")
    signs = "".join(sorted({c for c in span if not c.isalnum()}))
    n = len(digits)
    return (
        "any",
        f"shape {shape[:60]}",
        f"digits {min(n, 24)}",
        f"letters {bool(_LETTERS.search(span))}",
        f"signs {signs[:12]}",
        f"first {_sort_of(span[0])}",
        f"last {_sort_of(span[-1])}",
        f"before {_sort_of(text[start - 1]) if start else '^'}",
        f"after {_sort_of(text[end]) if end < len(text) else '$'}",
        f"card {16 <= n <= 19 and luhn(digits)}",
        f"bytes {len(parts) == 4 and all(p.isdigit() and p.isascii() and _small(p) for p in parts)}",
        f"at {min(span.count('@'), 2)}",
        f"domain {bool(re.fullmatch(r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}', span)) if '@' in span else None}",
    )


def segments(zone: str) -> tuple[int, list[Segment]]:
    """(units, candidate segments) of a zone.

    A segment begins with a letter, digit, + or (, ends with a letter or digit, doesn't
    part a run of them, and holds an @ or `FEWEST_DIGITS` digits.
    """
    units = [(m.start(), m.end()) for m in _UNIT.finditer(zone)]
    out = []
    for i, (start, _) in enumerate(units):
        opener = zone[start]
        if not (opener.isalnum() or opener in "+(") or (start and opener.isalnum() and zone[start - 1].isalnum()):
            continue
        digits, at = 0, False
        for j in range(i, min(i + MOST_UNITS, len(units))):
            a, b = units[j]
            digits += b - a if "0" <= zone[a] <= "9" else 0
            at = at or zone[a] == "@"
            if not (at or digits >= FEWEST_DIGITS) or not zone[b - 1].isalnum() or (b < len(zone) and zone[b].isalnum()):
                continue
            out.append(Segment(start, b, i, j + 1, _features(zone, start, b)))
    return len(units), out


# --- the field --------------------------------------------------------------------


@dataclass
class Model:
    """Weights by feature and kind, and of a kind after another (0: outside)."""

    index: dict[str, int]
    weights: np.ndarray
    follows: np.ndarray

    def scores(self, features: tuple[str, ...]) -> np.ndarray:
        rows = [self.index[f] for f in features if f in self.index]
        return self.weights[rows].sum(axis=0)


def _forward(n: int, ends: list[list[tuple[int, np.ndarray]]], follows: np.ndarray) -> np.ndarray:
    """Log sums over all labelled segmentations up to each unit, by last kind."""
    total = np.full((n + 1, len(KINDS) + 1), -np.inf)
    total[0, 0] = 0.0
    for j in range(1, n + 1):
        reach = np.logaddexp.reduce(total[j - 1] + follows[:, 0])
        total[j, 0] = reach
        for i, score in ends[j]:
            before = np.logaddexp.reduce(total[i][:, None] + follows[:, 1:], axis=0)
            total[j, 1:] = np.logaddexp(total[j, 1:], before + score)
    return total


def _backward(n: int, starts: list[list[tuple[int, np.ndarray]]], follows: np.ndarray) -> np.ndarray:
    total = np.full((n + 1, len(KINDS) + 1), -np.inf)
    total[n] = 0.0
    for i in range(n - 1, -1, -1):
        total[i] = total[i + 1, 0] + follows[:, 0]
        for j, score in starts[i]:
            total[i] = np.logaddexp(total[i], np.logaddexp.reduce(follows[:, 1:] + (score + total[j, 1:])[None, :], axis=1))
    return total


def best(zone: str, model: Model) -> list[tuple[str, int, int]]:
    """The most probable labelled segmentation: (kind, start, end) of its entities."""
    n, found = segments(zone)
    if not found:
        return []
    ends: list[list[tuple[Segment, np.ndarray]]] = [[] for _ in range(n + 1)]
    for s in found:
        ends[s.last].append((s, model.scores(s.features)))
    width = len(KINDS) + 1
    value = np.full((n + 1, width), -np.inf)
    value[0, 0] = 0.0
    back: list[list] = [[None] * width for _ in range(n + 1)]
    for j in range(1, n + 1):
        came = value[j - 1] + model.follows[:, 0]
        back[j][0] = (j - 1, int(np.argmax(came)), None)
        value[j, 0] = came.max()
        for s, score in ends[j]:
            came = value[s.first][:, None] + model.follows[:, 1:]
            reached = came.max(axis=0) + score
            for k in np.flatnonzero(reached > value[j, 1:]):
                value[j, k + 1] = reached[k]
                back[j][k + 1] = (s.first, int(np.argmax(came[:, k])), s)
    at, kind, out = n, int(np.argmax(value[n])), []
    while at:
        before, earlier, s = back[at][kind]
        if s is not None:
            out.append((KINDS[kind - 1], s.start, s.end))
        at, kind = before, earlier
    return out[::-1]


def train(zones: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5, shrink: float = 1e-3) -> Model:
    """Fit by gradient steps on the log likelihood of labelled zones (text, entities)."""
    width = len(KINDS) + 1
    index: dict[str, int] = {}
    data = []
    for zone, entities in zones:
        n, found = segments(zone)
        known = {(a, b): KINDS.index(kind) for kind, a, b in entities}
        if not found or not known.keys() <= {(s.start, s.end) for s in found}:
            continue
        rows = [np.array([index.setdefault(f, len(index)) for f in s.features]) for s in found]
        gold = sorted((s.first, s.last, known[s.start, s.end] + 1) for s in found if (s.start, s.end) in known)
        path, at, kind = np.zeros((width, width)), 0, 0
        for first, last, k in gold:
            for target in [0] * (first - at) + [k]:
                path[kind, target] += 1
                kind = target
            at = last
        for _ in range(n - at):
            path[kind, 0] += 1
            kind = 0
        data.append((n, found, rows, [known.get((s.start, s.end)) for s in found], path))
    weights, follows = np.zeros((len(index) + 1, len(KINDS))), np.zeros((width, width))
    prior = np.zeros_like(weights)
    if "any" in index:
        prior[index["any"]] = PRIOR
    weights += prior
    seen_w, seen_f = np.full_like(weights, 1e-6), np.full_like(follows, 1e-6)
    for _ in range(epochs if data else 0):
        step_w, step_f = shrink * (prior - weights), -shrink * follows
        for n, found, rows, labels, path in data:
            scores = [weights[r].sum(axis=0) for r in rows]
            starts, ends = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for s, score in zip(found, scores, strict=True):
                starts[s.first].append((s.last, score))
                ends[s.last].append((s.first, score))
            ahead, behind = _forward(n, ends, follows), _backward(n, starts, follows)
            whole = behind[0, 0]
            step_f += path / len(data)
            # Expected steps to outside units, then to segments.
            out = np.exp(ahead[:-1] + follows[:, 0][None, :] + behind[1:, 0][:, None] - whole).sum(axis=0)
            step_f[:, 0] -= out / len(data)
            for s, r, score, label in zip(found, rows, scores, labels, strict=True):
                each = np.exp(ahead[s.first][:, None] + follows[:, 1:] + (score + behind[s.last, 1:])[None, :] - whole)
                step_f[:, 1:] -= each / len(data)
                push = -each.sum(axis=0)
                if label is not None:
                    push[label] += 1
                np.add.at(step_w, r, push / len(data))
        seen_w += step_w**2
        seen_f += step_f**2
        weights += rate * step_w / np.sqrt(seen_w)
        follows += rate * step_f / np.sqrt(seen_f)
    return Model(index, weights, follows)


# --- over a corpus ------------------------------------------------------------------


def _marked(text: str) -> bool:
    return "@" in text or any(d in text for d in "0123456789")


def _labelled(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Zones for the fit, with a neighbouring character on each side, and the base's entities in them."""
    spans, failed = base_spans(text)
    for m in _ZONE.finditer(text):
        a, b = m.span()
        if b - a > LONGEST or any(x < b and y > a for x, y in failed):
            continue
        yield text[a:b], [(k, x - a, y - a) for k, x, y in spans if a <= x and y <= b]


def sample(docs: DataFrame, text: str, per_kind: int = SAMPLE) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Different labelled zones, the first by hash for every set of kinds, `per_kind` of each at most."""
    schema = "kinds string, hash long, zone string, entities array<struct<kind: string, start: int, end: int>>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, tuple]] = {}
        for batch in batches:
            for content in batch.column(0).to_pylist():
                if content and _marked(content):
                    for zone, entities in _labelled(content):
                        own = held.setdefault(",".join(sorted({e[0] for e in entities})), {})
                        own[zone] = (xxhash.xxh64_intdigest(zone) >> 1, zone, entities)
                        if len(own) > 4 * per_kind:
                            kept = sorted(own.values())[:per_kind]
                            own.clear()
                            own.update({x[1]: x for x in kept})
        rows = [(k, *x) for k, own in held.items() for x in sorted(own.values())[:per_kind]]
        entities = [[{"kind": k, "start": a, "end": b} for k, a, b in r[3]] for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
             pa.array(entities, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))],
            names=["kinds", "hash", "zone", "entities"],
        )

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(task, schema).dropDuplicates(["kinds", "hash"])
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("kinds").orderBy("hash", "zone"))).where(F.col("rank") <= per_kind)
    return [(r["zone"], [tuple(e) for e in r["entities"]]) for r in first.orderBy("kinds", "hash").collect()]


def find(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind and start."""
    if not text or not _marked(text):
        return [], []
    base, failed = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for m in _ZONE.finditer(text):
        # A zone that is one base match has nothing to add.
        if len(taken) and m.span() in taken:
            continue
        for kind, a, b in best(m.group(), model):
            a, b = a + m.start(), b + m.start()
            if not any(x < b and a < y for x, y in taken):
                added.append((kind, a, b))
    order = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=order), sorted(base + added, key=order)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _model(docs: DataFrame, text: str, per_kind: int, epochs: int):
    model = train(sample(docs, text, per_kind), epochs)
    # As large as the features of the sampled zones.
    return docs.sparkSession.sparkContext.broadcast(model)


def spans(docs: DataFrame, identity: str = "doc_id", text: str = "text", per_kind: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document.

    The counts and the hash are of the base spans; `spans` lists those and what the
    field adds beside them. NULL and empty texts have none. Repeated rows get the
    same answer. An empty table gives no rows; without labelled zones nothing is added.
    """
    shared = _model(docs, text, per_kind, epochs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            counts, digests, lists = [], [], []
            for content in batch.column(1).to_pylist():
                base, every = find(content or "", model)
                counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                lists.append(joined(every))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(lists, pa.string())],
                names=[identity, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    fields = [docs.schema[identity], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS)]
    schema = T.StructType([*fields, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return docs.select(F.col(f"`{identity}`"), F.col(f"`{text}`")).mapInArrow(task, schema)


def masked(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with a placeholder for each span; overlapping spans get one, of the first."""
    pieces, end = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= end:
            pieces += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*pieces, text[end:]])


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars", per_kind: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """All rows and columns, personal data in `text` replaced; `length`, if there, follows."""
    shared = _model(docs, text, per_kind, epochs)
    names = docs.columns
    at, counted = names.index(text), names.index(length) if length in names else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t if not t else masked(t, find(t, model)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            changed = [a != b for a, b in zip(texts, batch.column(at).to_pylist(), strict=True)]
            if counted is not None:
                old = columns[counted].to_pylist()
                columns[counted] = pa.array([len(t) if c else n for t, c, n in zip(texts, changed, old, strict=True)], columns[counted].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(task, docs.schema)
