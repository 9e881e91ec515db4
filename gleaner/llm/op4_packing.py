"""Packing tokenised documents into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows. What remains of each is
shorter than a window; those remainders are placed in order of falling length, each into
the open window with the least room that still holds it, found with a segment tree over
remaining capacities.

Every task packs the rows it has read, so nothing is shuffled and no text leaves its task;
each task leaves at most a few windows with room, which is a vanishing share of a
partition of any size worth a task. A rerun of a lost task makes the same windows, because
its input rows and their order are those of its file split.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bpe import Encoder
from gleaner.llm.common import batches

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
END = 0
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Windows numbered by one task; partition ids stand above this many bits.
LOCAL_BITS = 40
_ROWS = 20_000
#: Characters that are encoded together.
TAKEN = 400_000


class Capacities:
    """Counts of open windows by remaining room, as a segment tree in an array."""

    def __init__(self, room: int):
        self.width = 1 << (room).bit_length()
        self.tree = [0] * (2 * self.width)

    def add(self, room: int, by: int) -> None:
        i = room + self.width
        while i:
            self.tree[i] += by
            i >>= 1

    def tightest(self, size: int) -> int:
        """The least room of at least ``size`` among open windows, or -1."""
        i = size + self.width
        if self.tree[i]:
            return size
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset in it) for each size, all between 1 and ``window``.

    Equal sizes are placed in the order given; of windows with equal room the one opened
    last is filled first.
    """
    open_by_room: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = Capacities(window)
    used: list[int] = []
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        room = rooms.tightest(size)
        if room < 0:
            number, room = len(used), window
            used.append(0)
        else:
            number = open_by_room[room].pop()
            rooms.add(room, -1)
        placed[i] = (number, used[number])
        used[number] += size
        if room > size:
            open_by_room[room - size].append(number)
            rooms.add(room - size, 1)
    return placed


def _packer(tokenizer: str | None, window: int, end: int):
    def rows(doc, *columns):
        return pa.RecordBatch.from_arrays(
            [doc if isinstance(doc, pa.Array) else pa.array(doc, pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    def run(frames):
        import public_tokenizers

        encoder = Encoder(tokenizer or public_tokenizers.path(VOCABULARY))
        first = TaskContext.get().partitionId() << LOCAL_BITS
        windows = 0
        left: list[tuple] = []
        for frame in frames:
            docs, texts = frame.column("doc_id").to_pylist(), frame.column("text").to_pylist()
            at, held = 0, 0
            for i, text in enumerate(texts):
                held += len(text)
                if held < TAKEN and i + 1 < len(texts):
                    continue
                ids, counts = encoder.encode(texts[at : i + 1])
                full: list[tuple] = []
                position = 0
                for doc, count in zip(docs[at : i + 1], counts.tolist()):
                    own = np.append(ids[position : position + count], np.uint32(end)).astype("<u4")
                    position += count
                    for start in range(0, count + 1, window):
                        piece = own[start : start + window]
                        row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), count + 1)
                        if len(piece) == window:
                            full.append((*row, first + windows, 0))
                            windows += 1
                        else:
                            left.append(row)
                if full:
                    yield rows(*zip(*full))
                at, held = i + 1, 0
        placed = best_fit_decreasing([r[2] for r in left], window)
        for i in range(0, len(left), _ROWS):
            part = [(*r, first + windows + number, offset) for r, (number, offset) in zip(left[i : i + _ROWS], placed[i : i + _ROWS])]
            yield rows(*zip(*part))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece of each row of ``docs(doc_id, text)``.

    A document's ids are those of the tokenizer file and then ``end``; a null or empty text
    is ``end`` alone. Every id lies in exactly one piece. Each row is a document of its own,
    also where rows repeat or share a doc_id or have none. ``sequence_id`` is unique to a
    window; offsets in it run without gaps from 0. ``tokenizer`` is a file on every executor,
    by default the public byte-level one. An empty table gives an empty result; other columns
    are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return batches(slim, _packer(tokenizer, window, end), SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in windows of 1024."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left; returns pieces."""
    return pack(docs)
