"""Personal data by weak supervision.

Spans that fixed patterns prove are always reported. Looser candidates (written-out addresses, numbers without a
country prefix or with a failing checksum) are judged: labelers by pattern, structure, gazetteer, context, borders and
variety vote for, against or not at all; expectation-maximisation over all candidates of the corpus estimates how
reliable each labeler is for each kind, and the posteriors train a logistic classifier of spans.

Documents are read once, in Python tasks. Votes and features are coded so that there is a fixed number of different
patterns; only the counts of patterns, which combine before they shuffle, come to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import col, stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "structure", "gazetteer", "context", "border", "variety")
#: A candidate is added if the classifier is at least so sure.
SURE = 0.9
FOR, AGAINST, SILENT = 2, 0, 1

# The gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov int info biz io de fr es it nl uk eu ch at pl se no dk fi pt be cz us ca au jp cn in br ru mx".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38", "62")
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91".split())
CUES = {
    "email": frozenset("email mail contact write correo courriel kontakt reply address".split()),
    "ip": frozenset("ip host server address client login dns gateway ping".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon handy appelez llame whatsapp".split()),
}
COUNTER_CUES = frozenset("version release order invoice isbn issn token hash sha key serial id no section figure page chapter".split())

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
# A match can only start where a run of digits starts, as it would take the whole run.
_dotted = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_digits = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_plus = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_written_at = re.compile(r"\s?[\[(]\s?at\s?[\])]\s?", re.I)
_written_rest = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[A-Za-z0-9-]+)+", re.I).match
_local_phone = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9A-Za-z])")
_words = re.compile(r"[a-z]+").findall


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(address: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:4] or 0) <= 255 for part in address.split("."))


def _plain_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def found_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Proven spans and looser candidates, as (kind, start, end), each kind from left to right."""
    base, loose = [], []
    at, done = text.find("@"), 0
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        rest = _domain(text, at + 1) if start < at else None
        if rest:
            base.append((0, start, rest.end()))
        done = rest.end() if rest else at + 1
        at = text.find("@", done)
    for m in _dotted.finditer(text):
        (base if _octets(m.group()) else loose).append((1, *m.span()))
    for m in _digits.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _plain_digits(m.group())
            if 13 <= len(digits) <= 19:
                (base if _luhn(digits) else loose).append((2, *m.span()))
    if "+" in text:
        for m in _plus.finditer(text):
            if 9 <= len(_plain_digits(m.group())) <= 15:
                base.append((3, *m.span()))
    done = 0
    for m in _written_at.finditer(text):
        before = text[done : m.start()]
        start = done + len(before.rstrip(_LOCAL))
        rest = _written_rest(text, m.end()) if start < m.start() else None
        if rest:
            loose.append((0, start, rest.end()))
        done = rest.end() if rest else m.end()
    for m in _local_phone.finditer(text):
        if 7 <= len(_plain_digits(m.group())) <= 15:
            loose.append((3, *m.span()))
    taken = sorted((a, b) for _, a, b in base)
    return base, _apart(loose, taken)


def _apart(loose: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that touch no proven span, nor an earlier candidate of their kind."""
    out, i, ends = [], 0, [0] * len(KINDS)
    reach = 0
    for kind, a, b in sorted(loose, key=lambda s: s[1]):
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if a >= reach and a >= ends[kind]:
            out.append((kind, a, b))
            ends[kind] = b
    return out


def votes(text: str, kind: int, start: int, end: int, proven: bool) -> tuple[int, ...]:
    """Each labeler's vote on a span."""
    span = text[start:end]
    digits = _plain_digits(span)
    if kind == 0:
        domain = re.split(r"\.|\s?[\[(]\s?dot\s?[\])]\s?", span.lower())
        structure = FOR if domain[-1].isalpha() and len(domain[-1]) > 1 else AGAINST
        gazetteer = FOR if domain[-1] in TOP_DOMAINS else SILENT
        variety = FOR if len(set(span)) > 4 else AGAINST
    elif kind == 1:
        structure = FOR if all(p == p.lstrip("0") or p == "0" for p in span.split(".")) else AGAINST
        gazetteer = AGAINST if span.split(".")[0] in ("0", "255") or not proven else SILENT
        variety = FOR if len(set(span.split("."))) > 1 else AGAINST
    elif kind == 2:
        structure = FOR if len(digits) in (14, 15, 16) else AGAINST
        gazetteer = FOR if digits.startswith(CARD_PREFIXES) else AGAINST
        variety = FOR if len(set(digits)) > 4 else AGAINST
    else:
        structure = FOR if 9 <= len(digits) <= 12 else AGAINST
        named = span.startswith("+") and any(digits[:n] in COUNTRY_CODES for n in (1, 2))
        gazetteer = FOR if named else SILENT
        variety = FOR if len(set(digits)) > 3 else AGAINST
    near = _words(text[max(0, start - 40) : start].lower())[-4:]
    cue, counter = any(w in CUES[KINDS[kind]] for w in near), any(w in COUNTER_CUES for w in near)
    context = FOR if cue and not counter else AGAINST if counter and not cue else SILENT
    left, right = text[start - 1 : start], text[end : end + 1]
    border = AGAINST if left.isalnum() or right.isalnum() or left in "\"'=_/" and left else FOR
    return (FOR if proven else AGAINST, structure, gazetteer, context, border, variety)


def _code(kind: int, vote: tuple[int, ...], span: str) -> int:
    """Kind, votes and two span features (length and number of separators, in three classes each) as one number."""
    separators = sum(not c.isalnum() for c in span)
    length = 0 if len(span) < 12 else 1 if len(span) < 24 else 2
    code = kind
    for v in (*vote, length, min(2, separators // 2)):
        code = 3 * code + v
    return code


def _decoded(code: int) -> tuple[int, tuple[int, ...]]:
    out = []
    for _ in range(len(LABELERS) + 2):
        code, v = divmod(code, 3)
        out.append(v)
    return code, tuple(reversed(out))


_SPANS = "array<struct<kind:int,start:int,stop:int,code:int>>"


def _scanned(docs: DataFrame) -> DataFrame:
    """Of every document its spans: proven ones first (with their code), then candidates."""
    span = pa.list_(pa.struct([pa.field(n, pa.int32()) for n in ("kind", "start", "stop", "code")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [])
            for value in batch.column(1):
                text = value.as_py() or ""
                for out, spans, proven in zip(rows, found_spans(text), (True, False)):
                    spans = sorted(spans)
                    out.append([
                        {"kind": k, "start": a, "stop": b, "code": _code(k, votes(text, k, a, b, proven), text[a:b])} for k, a, b in spans
                    ])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, span) for r in rows)], names=["doc_id", "base", "loose"])

    return docs.mapInArrow(scan, f"doc_id long, base {_SPANS}, loose {_SPANS}")


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each pattern, and of each kind, labeler, truth and vote the probability, by expectation-maximisation.

    Kinds have reliabilities of their own. The start is the share of votes for, so that "true" is what votes agree on.
    """
    kinds = np.array([_decoded(int(c))[0] for c in codes])
    cast = np.array([_decoded(int(c))[1][: len(LABELERS)] for c in codes])
    spoken = np.maximum(1, (cast != SILENT).sum(axis=1))
    posterior = np.clip((cast == FOR).sum(axis=1) / spoken, 0.02, 0.98)
    table = np.zeros((len(KINDS), len(LABELERS), 2, 3))
    for _ in range(rounds):
        for kind in range(len(KINDS)):
            own = kinds == kind
            if not own.any():
                continue
            weight = counts[own] * np.stack([1 - posterior[own], posterior[own]])
            prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
            score = np.tile(np.log(prior)[:, None], own.sum())
            for j in range(len(LABELERS)):
                for truth in (0, 1):
                    # One made-up vote each way keeps a labeler that never erred from being taken as infallible.
                    n = np.bincount(cast[own, j], weights=weight[truth], minlength=3) + 1
                    table[kind, j, truth] = n / n.sum()
                    score[truth] += np.log(table[kind, j, truth][cast[own, j]])
            posterior[own] = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
    return posterior, table


def _features(codes: np.ndarray) -> np.ndarray:
    rows = []
    for code in codes:
        kind, parts = _decoded(int(code))
        row = [float(kind == k) for k in range(len(KINDS))]
        for v in parts:
            row += [float(v == 0), float(v == 2)]
        row += [float(kind == k and parts[0] == FOR) for k in range(len(KINDS))]
        rows.append(row)
    return np.array(rows).reshape(len(codes), -1)


def span_classifier(codes: np.ndarray, counts: np.ndarray, posterior: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic classifier that learns the posteriors; every pattern counts by the logarithm of its spans."""
    x, weight = _features(codes), np.log1p(counts)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 1.0 * (x.T @ (weight * (p - posterior)) / weight.sum() + 1e-3 * w)
    return w


def _learned(spans: DataFrame) -> dict[int, float]:
    """Probability of every pattern of looser candidates."""
    both = spans.select(F.explode(F.concat("base", "loose")).alias("s")).groupBy("s.code").count().orderBy("code").collect()
    if not both:
        return {}
    codes, counts = np.array([r["code"] for r in both]), np.array([r["count"] for r in both], float)
    posterior, _ = reliabilities(codes, counts)
    w = span_classifier(codes, counts, posterior)
    return dict(zip(codes.tolist(), (1 / (1 + np.exp(-_features(codes) @ w))).tolist()))


def patterns() -> int:
    """How many different patterns there can be: what the driver gets at most."""
    return len(list(product(range(3), repeat=len(LABELERS) + 2))) * len(KINDS)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """doc_id, counts and digest of proven spans, and all spans as kind:start:end, of every row.

    Offsets are code points, the end exclusive; kinds come in the order of KINDS, then by start. The counts are those
    of proven spans. A null text is empty; repeated rows are judged each; an empty table gives no rows.
    """
    spans = stored(_scanned(docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))), "spans")
    chances = _learned(spans)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, texts = [[] for _ in KINDS], [], []
            for base, loose in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = [(s["kind"], s["start"], s["stop"]) for s in base]
                more = [(s["kind"], s["start"], s["stop"]) for s in loose if chances.get(s["code"], 0.0) >= sure]
                for k, n in enumerate(counts):
                    n.append(sum(s[0] == k for s in own))
                digests.append(sha256(_joined(own).encode()).hexdigest())
                texts.append(_joined(sorted(own + more)))
            arrays = [batch.column(0), *(pa.array(n, pa.int64()) for n in counts), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return spans.mapInArrow(told, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
