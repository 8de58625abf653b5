"""Best-fit packing planned over the length histogram.

Documents are tokenised once; only (document, piece, length) rows travel.  Best-fit decreasing then
runs over the counts of lengths (at most ``CAPACITY`` numbers): runs of sequences with the same room
left are filled together, so the plan's size follows the number of different lengths, not of
documents.  Pieces take the planned slots by their rank within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import DOC_COLUMNS, read, staged

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k"
#: Rows of one length are ranked in slices of about so many.
SLICE_ROWS = 50_000
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of the public tokenizer ``name``.

    Ordinary text goes through the same vocabulary's rank file, which is several times as fast and
    gives the same ids (tests hold one against the other); a text with a special token's string goes
    to the tokenizer file itself, which a worker loads only then.
    """

    def __init__(self, name: str, special: list[str] | None = None):
        import base64

        import public_tokenizers as files
        import tiktoken

        self.name, self._tokenizer = name, None
        self.special = special_tokens(name) if special is None else special
        with open(files.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            self._tokenizer = _from_file(self.name)
        return self._tokenizer

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            got = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            got = self.plain.encode_ordinary(text)
        got.append(END_ID)
        return np.array(got, "<u4")


def _from_file(name: str):
    import public_tokenizers as files
    from tokenizers import Tokenizer

    return Tokenizer.from_file(files.path(f"{name}.json"))


def special_tokens(name: str) -> list[str]:
    return [t.content for t in _from_file(name).get_added_tokens_decoder().values()]


def encoder(name: str, special: list[str] | None = None) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(name, special)
    return _encoders[name]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for a shorter first one."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    special = special_tokens(tokenizer)  # a few strings, read once

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer, special).ids
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = ids_of(text or "")
                out += [(doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity))]
            got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield got.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        tokenise, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, ranks, first sequence, offset) of best-fit decreasing over counts.

    A run is a number of sequences, consecutive in number, with the same room left.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    slots, used = [], 0
    rooms: list[int] = []  # sorted rooms that have runs
    def put(left: int, run: tuple[int, int]) -> None:
        if left:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append(run)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):  # the sequences with the least room that suffices
                left = rooms[i]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[i]
            else:
                left, first, n = capacity, used, todo
            each = left // length  # a sequence just filled has the least room, so it is filled on
            full = min(n, todo // each)
            new = left == capacity and first == used
            if full:
                for j in range(each):
                    slots.append((length, rank, full, first, capacity - left + j * length))
                    rank += full
                todo -= full * each
                put(left - each * length, (first, full))
            more = 0
            if todo and full < n:  # the rest of this length fits into one more sequence
                more = min(todo, each)
                for j in range(more):
                    slots.append((length, rank, 1, first + full, capacity - left + j * length))
                    rank += 1
                todo -= more
                put(left - more * length, (first + full, 1))
            spent = full + (1 if more else 0)
            if new:
                used += spent
            elif spent < n:
                put(left, (first + spent, n - spent))
    return slots


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) within the length.  Every length is ranked in slices by hash: the slices'
    counts give where each begins, so a length with a third of all rows spans many tasks."""
    slices = max(16, rows.count() // SLICE_ROWS)
    dealt = staged(rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slices)).cast("int")), "pieces")
    counts = dealt.groupBy("length", "slice").count()
    begins = counts.withColumn("begin", F.sum("count").over(Window.partitionBy("length").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("count")).drop("count")
    place = F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32"))
    return (dealt.withColumn("n", place).join(begins, ["length", "slice"])
            .withColumn("rank", F.col("begin") + F.col("n") - 1).drop("n", "begin", "slice"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    Null text counts as empty: one piece with the end id alone.  Repeated rows are documents of their
    own; an empty table gives an empty result; other columns are ignored.
    """
    rows = staged(pieces(docs, tokenizer, capacity), "tokens")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # capacity rows at most
    slots = rows.sparkSession.createDataFrame(plan(counts, capacity) or [(0, 0, 0, 0, 0)],
                                              "length bigint, rank_from bigint, ranks bigint, first bigint, offset bigint")
    # one slot a run and length: the histogram bounds it, whatever the number of documents
    return ranked(rows).join(F.broadcast(slots), "length").where(
        (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_from") + F.col("ranks"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs.select(*DOC_COLUMNS))
