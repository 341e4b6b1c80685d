"""Byte-pair encoding of whole texts, and decoding.

A text is split into words by the vocabulary's pattern. The bytes of a word form a doubly linked list of symbols; a
priority queue holds the mergeable neighbours by merge rank, then place, and an entry whose neighbours have changed
since is skipped when it comes up. So a word of any length, a text without white space included, costs its length times
the logarithm of it. Words already met are remembered up to a fixed number. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import bounded_batches, col

VOCABULARY = "byte_bpe_50k.json"
#: Words that a Python worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 400_000, 64
#: Characters that the pattern's classes and the tokenizer file's own splitter sort alike, whatever Unicode version
#: either knows; a text with any other is split by the file's splitter.
_SETTLED = ((0, 0x557), (0x58D, 0x88E), (0x890, 0xC5B), (0xCDD, 0x208E), (0x20A0, 0xA7CD), (0xAB6E, 0x107BA), (0x1E700, 0x2B739))
_PLACE = (1 << 40) - 1


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary's strings: itself if it shows, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """Ids of texts and texts of ids, by a byte-level vocabulary file."""

    def __init__(self, vocabulary: str | None = None, remembered: int = REMEMBERED) -> None:
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.path = vocabulary or vocabulary_path()
        with open(self.path, encoding="utf-8") as file:
            content = json.load(file)
        ids, of = content["model"]["vocab"], _byte_characters()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.strings = {i: bytes(of[c] for c in token) for token, i in ids.items()}
        self.strings |= {i: token.encode() for token, i in self.special.items()}
        self.single = [ids[c] for c, _ in sorted(of.items(), key=lambda x: x[1])]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(content["model"]["merges"])}
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.unsettled = regex.compile(f"[^{''.join(rf'\U{a:08X}-\U{b:08X}' for a, b in _SETTLED)}]").search
        specials = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.parts = regex.compile(f"({'|'.join(specials)})").split if specials else lambda text: [text]
        self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        self.remembered, self.known = remembered, {}

    def merged(self, word: bytes) -> array:
        """Ids of one word: the neighbours of lowest rank merge, the leftmost first, until none can."""
        symbols = [self.single[b] for b in word]
        n, merges = len(symbols), self.merges
        after, before = range(1, n + 1), range(-1, n - 1)
        if n <= LONGEST:
            after, before = list(after), list(before)
        else:  # numbers in place, not as objects
            symbols, after, before = array("i", symbols), array("q", after), array("q", before)
        queue = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append(found[0] << 40 | i)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            left = entry & _PLACE
            right = after[left]
            if symbols[left] < 0 or right == n:
                continue
            found = merges.get((symbols[left], symbols[right]))
            if not found or found[0] != entry >> 40:
                continue
            symbols[left], symbols[right] = found[1], -1
            further = after[left] = after[right]
            if further < n:
                before[further] = left
                found = merges.get((symbols[left], symbols[further]))
                if found:
                    heappush(queue, found[0] << 40 | left)
            earlier = before[left]
            if earlier >= 0:
                found = merges.get((symbols[earlier], symbols[left]))
                if found:
                    heappush(queue, found[0] << 40 | earlier)
        return array("I", [s for s in symbols if s >= 0])

    def _word(self, word: str) -> bytes:
        data = _little_endian(self.merged(word.encode()))
        if len(word) <= LONGEST:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[word] = data
        return data

    def _split(self, text: str) -> list[str]:
        if self.unsettled(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.words(text)

    def encode(self, text: str) -> bytes:
        """The text's ids, each in four bytes, the lowest first."""
        out, known, make = [], self.known.get, self._word
        for part in self.parts(text):
            special = self.special.get(part)
            if special is not None:
                out.append(special.to_bytes(4, "little"))
            elif part:
                out += [known(word) or make(word) for word in self._split(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of such ids; those the vocabulary lacks add nothing, and bytes that are no UTF-8 become U+FFFD."""
        strings = self.strings
        return b"".join([strings.get(i, b"") for i in _numbers(ids)]).decode("utf-8", "replace")


def _little_endian(ids: array) -> bytes:
    if array("I", [1]).tobytes()[0] == 0:
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _numbers(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids[: len(ids) // 4 * 4])
    if array("I", [1]).tobytes()[0] == 0:
        out.byteswap()
    return out


_WORKERS: dict[str, BytePairs] = {}


def _of_worker(vocabulary: str | None) -> BytePairs:
    """One vocabulary a Python worker, with the words it remembers, for all its tasks."""
    key = vocabulary or ""
    if key not in _WORKERS:
        _WORKERS[key] = BytePairs(vocabulary)
    return _WORKERS[key]


def ids_of(text: Column, vocabulary: str | None = None) -> Column:
    """Binary column of the ids of whole texts, four bytes each, the lowest first. A null text is empty."""

    @F.arrow_udf("binary")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = _of_worker(vocabulary)
        for part in parts:
            yield pa.array([pairs.encode(t.as_py() or "") for t in part], pa.binary())

    return encode(text)


def text_of(ids: Column, vocabulary: str | None = None) -> Column:
    """The texts of such ids. Null ids give an empty text."""

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = _of_worker(vocabulary)
        for part in parts:
            yield pa.array([pairs.decode(i.as_py() or b"") for i in part], pa.string())

    return decode(ids)


def encoded(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with a binary column of ids; a column of that name is replaced.

    Null and empty texts have no ids. Special tokens in a text are one id each, as the vocabulary file has them.
    Repeated rows are encoded once each, an empty table gives no rows, and a word may be as long as the text.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(ids, ids_of(col(text), vocabulary))


def decoded(rows: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``rows`` with the texts of a binary column of ids, the way back from ``encoded``; a column of that name is replaced.

    Null ids give an empty text.
    """
    bounded_batches(rows.sparkSession)
    return rows.withColumn(text, text_of(col(ids), vocabulary))


def round_trips(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of every document's ids and of the text decoded from them.

    A null text is empty, a null id stays null, repeated rows come once each, other columns are not read.
    """
    own = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    rows = decoded(encoded(own, vocabulary=vocabulary).drop("text"), vocabulary=vocabulary)
    return rows.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
