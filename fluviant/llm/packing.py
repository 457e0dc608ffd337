"""Best-fit packing of token sequences by hierarchical residual packing.

Documents become pieces of at most one sequence. A full piece is a sequence. All
others are dealt to tasks of a fixed number of items; each task packs its items
best-fit, longest first, and emits the nearly full bins. The underfull ones go on
as items to the next round, in which one task takes those of several tasks, until
one task is left.

What goes on is bounded without loss. After a best-fit pass no two bins of a task
fit together, so at most one is half full or less, and each join of a later round
uses up one such bin. A round joins at most ``fan_in`` of them, with as many others.
So of bins that are equally full a task need hand on no more than ``fan_in`` for
each round to come; further ones would come out of the last round as they went in.
"""

from __future__ import annotations

import json
import math
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch, ship_package
from ._common import resident
from .byte_bpe import byte_alphabet, chunks

#: Characters of a text that go to the merge engine at once.
LONGEST = 1_000_000

#: Items of one packing task, tasks merged into one.
ITEMS_PER_TASK, FAN_IN = 50_000, 8


def _encoder(tokenizer_json: str, pattern: str):
    """The merge engine for the tokenizer file's vocabulary."""
    import tiktoken

    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in json.loads(tokenizer_json)["model"]["vocab"].items()}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts as the tokenizer file gives them, as little-endian bytes.

    A text goes to the merge engine in one piece, which is faster than keeping the ids of
    words; one of more than ``longest`` characters goes in several. Only white space can
    come before a space within a pre-token, so those are cut in front of spaces that no
    white space precedes. Added tokens in a text are found first, as the library does."""

    def __init__(self, tokenizer_json: str, pattern: str, longest: int = LONGEST):
        import re

        given = json.loads(tokenizer_json)
        model, before = given["model"], given["pre_tokenizer"]
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are kept as the machine has them, which must be little-endian 32-bit")
        if given["normalizer"] or model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without a normaliser is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in given["added_tokens"]):
            raise ValueError("only plain added tokens are supported")
        self.added = {t["content"]: t["id"].to_bytes(4, "little") for t in given["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda t: [t]
        # Python's white space holds all that the pattern's does.
        self.cut = re.compile(r"(?<=\S) ").search
        self.longest = longest
        self.encode_one = _encoder(tokenizer_json, pattern).encode_ordinary

    def pieces(self, text: str) -> list[str]:
        out, at = [], 0
        while len(text) - at > self.longest and (found := self.cut(text, at + self.longest)):
            out.append(text[at : found.start()])
            at = found.start()
        out.append(text[at:])
        return out

    def _segment(self, text: str) -> bytes:
        return b"".join(array("I", self.encode_one(p)).tobytes() for p in self.pieces(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if any(a in text for a in self.added):
                out.append(b"".join(self.added[s] if s in self.added else self._segment(s) for s in self.split_added(text)))
            else:
                out.append(self._segment(text))
        return out


def encoder(tokenizer_json: str, pattern: str) -> Encoder:
    return resident(("encoder", tokenizer_json, pattern), lambda: Encoder(tokenizer_json, pattern))


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: all full but the first, which takes the rest."""
    k = max(1, -(-n // capacity))
    return [n - capacity * (k - 1)] + [capacity] * (k - 1)


def pieces_of(docs: DataFrame, tokenizer_path: str, pattern: str, eos: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32``; every document has one at least."""
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = eos.to_bytes(4, "little")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model.value, pattern)
        for batch in batches:
            at = 0
            for part in chunks(batch.column(1).to_pylist()):
                owner, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(own.encode(part), at):
                    ids += end
                    begin = 0
                    for k, size in enumerate(piece_lengths(len(ids) // 4, capacity)):
                        owner.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(size)
                        crc.append(zlib.crc32(ids[4 * begin : 4 * (begin + size)]))
                        begin += size
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit, longest first: bin and offset of each item, and the fill of each bin.

    Bins are kept by free space; a bit set of the free spaces in use gives the
    tightest fitting bin without a search."""
    where, offset, fill = [0] * len(sizes), [0] * len(sizes), []
    by_free: dict[int, list[int]] = defaultdict(list)
    in_use = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fits = in_use >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                in_use &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        where[i], offset[i] = b, fill[b]
        fill[b] += size
        if free > size:
            by_free[free - size].append(b)
            in_use |= 1 << (free - size)
    return where, offset, fill


def goes_on(fill: np.ndarray, nearly_full: int, copies: int) -> np.ndarray:
    """Which bins a later round can use: the underfull ones, of equally full ones ``copies``."""
    order = np.argsort(fill, kind="stable")
    ranked = fill[order]
    place = np.empty(len(fill), np.int64)
    place[order] = np.arange(len(fill)) - np.searchsorted(ranked, ranked, "left")
    return (fill < nearly_full) & (place < copies)


def _round(items: DataFrame, number: int, capacity: int, nearly_full: int, copies: int) -> DataFrame:
    """One best-fit pass in each task over ``items``, whose rows with one
    ``sequence_id`` are already one item; ``done`` marks the bins that are emitted.
    In the last round ``copies`` is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        rows = pa.Table.from_batches(held)
        task = TaskContext.get().partitionId()
        ids, offsets, lengths = (rows.column(c).to_numpy() for c in ("sequence_id", "offset", "length"))
        unique, item = np.unique(ids, return_inverse=True)
        sizes = np.bincount(item, weights=lengths).astype(np.int64)
        where, base, fill = (np.asarray(x, np.int64) for x in best_fit(sizes.tolist(), capacity))
        done = ~goes_on(fill, nearly_full, copies)
        bins = where[item]
        columns = {
            "sequence_id": pa.array((number << 56) + (task << 32) + bins, pa.int64()),
            "offset": pa.array(base[item] + offsets, pa.int64()),
            "task": pa.array(np.full(len(bins), task, np.int32)),
            "done": pa.array(done[bins]),
        }
        for name, values in columns.items():
            rows = rows.set_column(rows.schema.get_field_index(name), name, values)
        yield from rows.to_batches()

    return items.mapInArrow(run, items.schema)


def pack(pieces: DataFrame, capacity: int, items_per_task: int = ITEMS_PER_TASK, fan_in: int = FAN_IN, nearly_full: float = 0.99) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a written table.

    Tasks of the first round take ``items_per_task`` items each, whatever the
    partitions of the input; a round's result is written before the next."""
    number = F.monotonically_increasing_id()
    columns = [*pieces.columns, "sequence_id", "offset"]
    full = pieces.where(F.col("length") >= capacity).select("*", (number + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = pieces.where(F.col("length") < capacity)
    tasks = max(1, math.ceil(items.count() / items_per_task))
    items = items.select("*", number.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("task"), F.lit(False).alias("done"))
    items = items.repartition(tasks)
    to_come, left = 0, tasks
    while left > 1:
        left, to_come = math.ceil(left / fan_in), to_come + 1
    out, k = full, 1
    while True:
        packed = scratch(_round(items, k, capacity, int(capacity * nearly_full), fan_in * to_come), f"pack-{k}")
        out = out.unionAll(packed.where("done").select(*columns))
        if tasks == 1:
            return out
        tasks, to_come, k = math.ceil(tasks / fan_in), to_come - 1, k + 1
        rest = packed.where("not done")
        items = rest.repartition(tasks, F.floor(F.col("task") / fan_in)) if tasks > 1 else rest.coalesce(1)


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, eos: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    * A document is the ids of its whole text and then ``eos``; a null text is the
      empty text, so ``eos`` alone. Repeated rows are packed each on their own.
    * Only a document longer than ``capacity`` is cut: full pieces, and a first
      piece that takes the rest.
    * Sequences hold at most ``capacity`` tokens, offsets have no gaps, sequence
      ids are unique but have no order. Other columns are ignored; an empty table
      gives an empty result.
    """
    return pack(scratch(pieces_of(docs, tokenizer_path, pattern, eos, capacity, id_col, text_col), "pieces"), capacity)
