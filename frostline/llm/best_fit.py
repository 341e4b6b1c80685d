"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents are tokenized in Python tasks, one Arrow batch at a time. Pieces, as narrow rows without their ids, are
dealt out by a hash, and each task packs its share online with a fixed number of open bins.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import blocks_of, col, stored, unused

#: Tokens of a sequence.
SEQUENCE = 1024
#: Open bins of a packing task.
OPEN_BINS = 4096
#: Pieces that one packing task gets; it needs a few hundred bytes for each open bin, whatever this is.
PIECES_PER_TASK = 1_000_000
END_OF_DOCUMENT = 2
_VOCABULARY = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
#: White-space characters in a row from which the encoder's look-ahead is not trusted; it fails at a million.
_LONG_SPACE = 50_000
_PIECES = "piece int, start long, length long, ids_crc32 long"


class TokenIds:
    """Ids of texts, equal to those of the vocabulary's tokenizer file without added special tokens.

    The same merges are run by the byte-pair encoder that is faster on words it has not met. Its pattern's look-ahead
    only matters where two white-space characters meet; other texts do without. Texts that hold the special token's
    string, or a run of white space that the look-ahead would run out of stack on, go to the tokenizer file itself.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path(f"{_VOCABULARY}.json")
        with open(ranks or public_tokenizers.path(f"{_VOCABULARY}.tiktoken"), "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN

        def encoding(pattern: str) -> tiktoken.Encoding:
            return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

        self.general = encoding(pattern)
        self.plain = encoding(pattern.replace(r"\s+(?!\S)|", ""))
        self.doubled_space = re.compile(r"\s\s").search
        self.long_space = re.compile(rf"\s{{{_LONG_SPACE}}}").search
        self.tokenizer = None

    def of(self, text: str) -> list[int]:
        spaced = self.doubled_space(text)
        if _SPECIAL in text or spaced and self.long_space(text):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.vocabulary)
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return (self.general if spaced else self.plain).encode_ordinary(text)


def cut(n_ids: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all are whole but the first, which takes what is over."""
    first = n_ids % size or min(n_ids, size)
    return [(0, first)] + [(start, size) for start in range(first, n_ids, size)]


def tokenized(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SEQUENCE) -> DataFrame:
    """A row per piece: the ``keep`` columns, piece, start, length and the CRC-32 of its ids (little-endian, 32 bits).

    A null or empty text is the end-of-document id alone.
    """
    kept = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", {_PIECES}"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds()
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(batch.column(len(kept))):
                ids = array("I", tokens.of(value.as_py() or ""))
                ids.append(END_OF_DOCUMENT)
                data = ids.tobytes()
                for i, (a, n) in enumerate(cut(len(ids), size)):
                    at.append(row)
                    piece.append(i)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * a : 4 * (a + n)]))
            taken = [batch.column(i).take(pa.array(at, pa.int64())) for i in range(len(kept))]
            out = [pa.array(piece, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(taken + out, names=[f.name for f in kept] + ["piece", "start", "length", "ids_crc32"])

    return docs.select(*map(col, keep), col(text)).mapInArrow(pieces, schema)


class OpenBins:
    """A fixed number of open bins, found through a bitset whose bit f says that some bin has f free places.

    The lowest set bit at or above a piece's length is the tightest bin that takes it. When all are open and none
    fits, the fullest one, the lowest set bit of all, closes.
    """

    def __init__(self, most: int = OPEN_BINS, size: int = SEQUENCE) -> None:
        self.most, self.size = most, size
        self.with_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of the next piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.with_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        bins = self.with_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def packed(
    pieces: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), size: int = SEQUENCE, most: int = OPEN_BINS
) -> DataFrame:
    """``pieces`` with sequence_id and offset. Every length must lie between 1 and ``size``.

    Rows meet the bins in an order that a hash of ``order`` mixes, so that long and short pieces come alternately and
    a rerun packs alike. Equal rows are pieces of their own.
    """
    rows = pieces.count()
    columns, schema = pieces.columns, pieces.schema
    tie, task = unused(pieces, "tie", "task")
    places = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", sequence_id long, offset long"
    tasks = blocks_of(rows, PIECES_PER_TASK)
    mixed = F.xxhash64(*map(col, order))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, high = OpenBins(most, size), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if high is None:
                high = batch.column(len(columns))[0].as_py() << 36
            found = [bins.place(n) for n in batch.column(columns.index(length)).to_pylist()]
            ids = pa.array([high + number for number, _ in found], pa.int64())
            places_in = pa.array([offset for _, offset in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(columns))] + [ids, places_in], names=[*columns, "sequence_id", "offset"]
            )

    return (
        pieces.withColumn(tie, mixed)
        .repartition(tasks, col(tie), *map(col, order))
        .sortWithinPartitions(tie, *map(col, order), col(length))
        .select(*map(col, columns), F.spark_partition_id().cast("long").alias(task))
        .mapInArrow(pack, places)
    )


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SEQUENCE, most: int = OPEN_BINS) -> DataFrame:
    """Where every piece of every document goes.

    Nulls: a null text is empty, a null id stays null. Repeated rows are packed once each. An empty table gives no
    rows. Other columns are not read.
    """
    pieces = stored(tokenized(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), size=size), "pieces")
    return packed(pieces, size=size, most=most)


def fewest(lengths: int, size: int = SEQUENCE) -> int:
    """A lower bound on sequences for so many tokens."""
    return math.ceil(lengths / size)
