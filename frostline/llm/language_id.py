"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are runs of two to four characters of lower-cased words with their borders. Embeddings and softmax are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled documents; a temperature makes the
scores probabilities, and a threshold found on documents kept out of training says which answers are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import col

#: Documents of each language that the sample has at most, and of all languages; where there are so many that the second
#: bound is reached, each language has fewer, but no fewer than the last number.
PER_LANGUAGE, SAMPLE, FEWEST = 600, 120_000, 20
#: Hash buckets (as a power of two) and numbers of an embedding.
BITS, DIMENSIONS = 14, 16
#: Accepted answers that may be wrong on the calibration documents, and right ones that may be lost to that end; an
#: answer must be likelier than not in any case.
WRONG, LOST, EVEN = 0.01, 0.002, 0.5
UNKNOWN = "und"
_ORDERS = (2, 3, 4)
#: Words of the short passages that are trained on beside whole documents.
_PASSAGES = (2, 6, 20, 60)
#: Whole documents are trained on if they have fewer different buckets than this. One in so many documents is kept aside.
_SHORT, _ASIDE = 400, 5
_STEP = 1 << 20


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _buckets(codes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Hash bucket of every subword in a run of letters and single spaces."""
    space = codes == 32
    for n in _ORDERS:
        size = len(codes) - n + 1
        if size < 1:
            continue
        mixed = np.full(size, n, np.uint32)
        for i in range(n):
            mixed = (mixed ^ codes[i : i + size]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        if n > 2:  # a border inside would join two words
            mixed = mixed[~np.logical_or.reduce([space[i : i + size] for i in range(1, n - 1)])]
        yield (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def subword_counts(text: str | None, bits: int = BITS) -> np.ndarray | None:
    """How often each bucket occurs in the whole text, or None without letters. Long texts go through in
    steps; subwords at the border of two steps may count twice."""
    letters, total, rest = _is_letter(), None, np.array([32], np.uint32)
    text = text or ""
    for start in range(0, len(text), _STEP):
        codes = np.frombuffer(text[start : start + _STEP].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        known = letters[codes]
        if not known.any():
            continue
        codes = np.where(known, codes, np.uint32(32))
        codes = np.concatenate((rest, codes, np.array([32], np.uint32) if start + _STEP >= len(text) else codes[:0]))
        codes = codes[(codes != 32) | np.concatenate(([True], codes[:-1] != 32))]
        found = np.bincount(np.concatenate(list(_buckets(codes, bits))), minlength=1 << bits)
        total = found if total is None else total + found
        rest = codes[-3:]
    return total


@dataclass(frozen=True)
class LanguageModel:
    """Logits per bucket (embedding times softmax), their offsets, the temperature and the rejection threshold."""

    languages: tuple[str, ...]
    logits: np.ndarray
    offsets: np.ndarray
    temperature: float
    threshold: float
    bits: int = BITS

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = (counts @ self.logits / max(1, counts.sum()) + self.offsets) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the answer is accepted.

        A text without letters is ``und`` with score 0 and rejected. If nothing could be learned, so are all texts, but
        those with letters are accepted: there is no ground to reject them on.
        """
        counts = subword_counts(text, self.bits)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, counts is not None
        p = self.probabilities(counts)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def _aside(key: int) -> bool:
    return key % _ASIDE == 0


def _examples(docs: DataFrame, bits: int) -> DataFrame:
    """Of each document, its bucket counts and those of a few short passages from anywhere in it, in one packed row.

    A whole long document is left out unless it is kept aside for calibration, as no training looks at it.
    """

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.split()
                draw = np.random.default_rng(key & 0xFFFFFFFF)
                views = [text]
                for n in _PASSAGES:
                    at = int(draw.integers(0, max(1, len(words) - n + 1)))
                    views.append(" ".join(words[at : at + n]))
                sizes, buckets, counted = [], [], []
                for i, part in enumerate(views):
                    counts = subword_counts(part, bits)
                    at = np.flatnonzero(counts) if counts is not None else ()
                    if not i and len(at) >= _SHORT and not _aside(key):
                        at = ()
                    sizes.append(len(at))
                    if len(at):
                        buckets.append(at.astype("<u4"))
                        counted.append(counts[at].astype("<f4"))
                if buckets:
                    packed = np.concatenate([np.array(sizes, "<u4"), *buckets]).tobytes() + np.concatenate(counted).tobytes()
                    rows.append((key, lang, packed))
            columns = list(zip(*rows)) if rows else [()] * 3
            types = (pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "lang", "views"])

    return docs.mapInArrow(view, "key long, lang string, views binary")


def _unpacked(views: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, buckets and counts of a document's views."""
    n = 1 + len(_PASSAGES)
    sizes = np.frombuffer(views, "<u4", n)
    total = int(sizes.sum())
    buckets, counts = np.frombuffer(views, "<u4", total, 4 * n), np.frombuffer(views, "<f4", total, 4 * (n + total))
    ends = np.cumsum(sizes)
    for i, (end, size) in enumerate(zip(ends, sizes)):
        if size:
            yield i, buckets[end - size : end], counts[end - size : end]


def train(
    docs: DataFrame,
    usable: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    bits: int = BITS,
    dimensions: int = DIMENSIONS,
    steps: int = 3600,
    rate: float = 8.0,
    seed: int = 7,
) -> LanguageModel:
    """Learn from a sample of the ``usable`` labelled documents: ``per_language`` of each language at most.

    A document is in the sample if a hash of its id and text is low enough, so reruns learn alike. Documents without
    text or label are not learned from; repeated rows come in once. All labels are learned.
    """
    rows = docs.select(
        F.xxhash64(col(doc_id), col(text)).alias("key"), col(lang).cast("string").alias("lang"), col(text).alias("text"),
        (F.lit(True) if usable is None else usable).alias("usable"),
    ).filter("usable and lang is not null and text is not null")
    known = rows.groupBy("lang").count().orderBy("lang").collect()
    if not known:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), np.zeros(0), 1.0, 0.0, bits)
    per_language = min(per_language, max(FEWEST, SAMPLE // len(known)))
    share = {r["lang"]: min(1.0, (1.3 * per_language + 20) / r["count"]) for r in known}
    bound = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v * 2.0**31)])
    drawn = rows.filter(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(2**31)) < bound[F.col("lang")]).drop("usable")
    # A hash draws some more than are wanted; repeated rows have one hash, and come once. All tasks get a part of them.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _examples(drawn.repartition(tasks, "key").dropDuplicates(["key", "lang"]), bits).collect()

    by_lang: dict[str, dict[int, bytes]] = {}
    for r in found:
        by_lang.setdefault(r["lang"], {})[r["key"]] = bytes(r["views"])
    del found
    languages = tuple(sorted(by_lang))
    learned, kept = [], []
    for i, name in enumerate(languages):
        for key in sorted(by_lang[name])[:per_language]:
            for view, buckets, counts in _unpacked(by_lang[name][key]):
                if _aside(key):
                    kept.append((view, (buckets, counts, i)))
                elif view or len(buckets) < _SHORT:
                    learned.append((buckets, counts, i))
    if not learned:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), np.zeros(0), 1.0, 0.0, bits)
    logits, offsets = _descend(learned, len(languages), bits, dimensions, steps, rate, seed)
    return _calibrated(languages, logits, offsets, kept, bits)


def _descend(examples, n_languages: int, bits: int, dimensions: int, steps: int, rate: float, seed: int, batch: int = 32):
    """Logits per bucket, and their offsets, after so many steps, however few examples there are."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1, 1, (1 << bits, dimensions)).astype(np.float32) / dimensions
    weights, offsets = np.zeros((dimensions, n_languages), np.float32), np.zeros(n_languages, np.float32)
    step = 0
    while step < steps:
        order = draw.permutation(len(examples))
        for start in range(0, len(order), batch):
            group = [examples[i] for i in order[start : start + batch]]
            sizes = np.array([len(x[0]) for x in group])
            at = np.concatenate([x[0] for x in group])
            share = np.concatenate([x[1] / x[1].sum() for x in group])[:, None]
            hidden = np.add.reduceat(vectors[at] * share, np.concatenate(([0], sizes.cumsum()[:-1])))
            z = hidden @ weights + offsets
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(group)), [x[2] for x in group]] -= 1
            now = rate * max(0.0, 1 - step / steps) / len(group)
            back = p @ weights.T
            weights -= now * hidden.T @ p
            offsets -= 0.1 * now * p.sum(axis=0)
            np.add.at(vectors, at, -now * share * np.repeat(back, sizes, axis=0))
            step += 1
    return vectors @ weights, offsets


def _calibrated(languages, logits, offsets, kept, bits: int) -> LanguageModel:
    """Choose the temperature by likelihood, and the lowest threshold that leaves at most WRONG of accepted answers
    wrong, or a lower one if that lost more than LOST of the right ones."""
    if not kept:
        return LanguageModel(languages, logits, offsets, 1.0, EVEN, bits)
    z = np.array([(c @ logits[b]) / c.sum() + offsets for _, (b, c, _) in kept], float)
    y = np.array([x[2] for _, x in kept])
    whole = np.array([view == 0 for view, _ in kept])

    def scores(temperature: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.02, 20, 61)
    temperature = float(min(grid, key=lambda t: -np.log(np.maximum(scores(t)[np.arange(len(y)), y], 1e-12)).mean()))
    p = scores(temperature)[whole]
    if not len(p):
        return LanguageModel(languages, logits, offsets, temperature, EVEN, bits)
    best, wrong = p.max(axis=1), p.argmax(axis=1) != y[whole]
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(share <= WRONG)
    strict = 0.0 if not wrong.any() else float(best[order][fine[-1]]) if len(fine) else 1.0
    lenient = float(np.quantile(best[~wrong], LOST, method="lower")) if not wrong.all() else 1.0
    return LanguageModel(languages, logits, offsets, temperature, max(EVEN, min(strict, lenient)), bits)


def predicted(model: LanguageModel, text: Column) -> Column:
    """A struct of lang_pred, score and accepted for a whole text."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score", "accepted"])

    return answer(text)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: one in three, by a checksum of the id. Never true for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row of ``docs``, repeated rows included.

    Null or letterless texts are ``und`` with score 0, not accepted. An empty table gives no rows.
    """
    model = train(docs, ~held_out(col(doc_id)), doc_id, text, lang)
    answer = predicted(model, F.col("text"))
    rows = docs.select(col(doc_id).alias("doc_id"), held_out(col(doc_id)).alias("held_out"), col(text).alias("text"))
    return rows.withColumn("answer", answer).select("doc_id", "held_out", "answer.*")


def accepted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is accepted, all columns as they were."""
    model = train(docs, ~held_out(col(doc_id)), doc_id, text, lang)
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = inner.withColumn("answer", predicted(model, F.col(f"c{names.index(text)}"))).filter("answer.accepted")
    return kept.drop("answer").toDF(*names)
