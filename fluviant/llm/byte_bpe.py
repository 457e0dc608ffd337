"""Byte-level BPE by a sentencepiece model made from the vocabulary.

Each token's bytes are mapped to printable characters, one a byte, and become a
piece whose score is the negative rank, so the merge of the best score is the
merge of the lowest rank. The model normalises nothing, hence encoding a mapped
pre-token gives exactly the ranks. Decoding maps each piece back to its bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import _sp_model
from ._classes import Split, library_split, splitter
from ._common import resident

#: Pre-tokens kept with their ids, in each Python worker; then the table starts anew.
CACHE_ENTRIES = 250_000

#: Characters of text worked on at once, which bounds the lists of pre-tokens.
CHUNK_CHARS = 1_000_000


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it is one, else from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without a gap")
    return [token for _, token in ranked]


def build_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model: id = rank, and the unknown piece behind all ranks."""
    alphabet = byte_alphabet()
    pieces = [("".join(alphabet[b] for b in t), -float(rank), _sp_model.NORMAL) for rank, t in enumerate(tokens)]
    return _sp_model.write_model([*pieces, ("<unk>", 0.0, _sp_model.UNKNOWN)], unk_id=len(tokens))


class Codec:
    """Encodes and decodes with one model; ids travel as little-endian unsigned 32-bit bytes."""

    def __init__(self, model: bytes, split: Split):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pre_tokens = splitter(split)
        alphabet = byte_alphabet()
        self.to_chars = dict(enumerate(alphabet))
        byte_of = {ord(c): b for b, c in enumerate(alphabet)}
        n = self.sp.get_piece_size() - 1
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        self.bytes_of = [bytes(map(byte_of.__getitem__, map(ord, p))) for p in pieces]
        # The library takes a pre-token that is a token as it stands, without merging.
        self.whole = {t: i for i, t in enumerate(self.bytes_of)}
        self.cache: dict[str, bytes] = {}

    def _learn(self, pre_tokens: Iterable[str]) -> None:
        merge = []
        for t in pre_tokens:
            raw = t.encode()
            if raw in self.whole:
                self.cache[t] = self.whole[raw].to_bytes(4, "little")
            else:
                merge.append((t, raw.decode("latin-1").translate(self.to_chars)))
        for (t, _), ids in zip(merge, self.sp.encode([m for _, m in merge], num_threads=1), strict=True):
            self.cache[t] = np.asarray(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        cache = self.cache
        split = [self.pre_tokens(t) for t in texts]
        new = {t for pre_tokens in split for t in pre_tokens if t not in cache}
        if new:
            self._learn(new)
        out = [b"".join(map(cache.__getitem__, pre_tokens)) for pre_tokens in split]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(model: bytes, split: Split) -> Codec:
    return resident(("codec", model, split), lambda: Codec(model, split))


def chunks(texts: list[str | None], most: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Lists of texts, null as empty, of about ``most`` characters; a longer text stands alone."""
    held: list[str] = []
    size = 0
    for t in texts:
        t = t or ""
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def map_texts(docs: DataFrame, id_col: str, text_col: str, schema: str, work: Callable[[], Callable[[list[str]], dict]], most: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id`` and the columns that ``work()`` gives for lists of texts, row by row.

    ``work`` runs once a task, in the Python worker; it must be picklable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = work()
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1), 0
            for part in chunks(texts.to_pylist(), most):
                columns = do(part)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(part)), *columns.values()], names=["doc_id", *columns])
                at += len(part)

    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {schema}")


def text_udf(kind: str, work: Callable[[], Callable[[list[str]], list]], most: int = CHUNK_CHARS):
    """A vectorised function of a text column; null reaches ``work()`` as empty."""
    of_kind = {"boolean": pa.bool_(), "long": pa.int64()}[kind]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        do = work()
        for batch in batches:
            yield pa.array([x for part in chunks(batch.to_pylist(), most) for x in do(part)], of_kind)

    return F.arrow_udf(run, kind)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``
    and, if ``with_ids``, ``ids`` (array of int).

    The whole text is encoded, then its ids are decoded. A null text is the empty
    text: no tokens and the hash of no bytes. Other columns are ignored; repeated
    rows repeat; an empty table gives an empty result. The model is sent to the
    executors once; its size is that of the vocabulary. Pre-tokens are split by the
    character classes of the library whose ids are wanted (see ``_classes``)."""
    shared = docs.sparkSession.sparkContext.broadcast((build_model(read_ranks(ranks_path)), library_split(pattern)))

    def work():
        own = codec(*shared.value)

        def do(texts: list[str]) -> dict:
            encoded = own.encode(texts)
            out = {
                "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(own.decode(e)).hexdigest() for e in encoded], pa.string()),
            }
            if with_ids:
                out["ids"] = pa.array([np.frombuffer(e, "<u4").astype("<i4") for e in encoded], pa.list_(pa.int32()))
            return out

        return do

    return map_texts(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, work)
