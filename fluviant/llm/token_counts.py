"""Token counts with a whole-token shortcut.

Before any text is read, the driver proves which vocabulary strings encode alone
as one token, and where a text can be cut without changing its tokens. A
pre-token among the proven strings counts one without merging; the others are
merged by the library.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from . import _sp_model
from ._common import resident
from .byte_bpe import CACHE_ENTRIES, map_texts

#: What the model writes for a space.
SPACE = "▁"


class Proof(NamedTuple):
    """What was proven of a model: a model without normaliser, its whole tokens, the cuts."""

    model: bytes
    whole: frozenset[str]
    pattern: str


@lru_cache(maxsize=4)
def prove(path: str) -> Proof:
    """Prove the shortcut for the model file at ``path``.

    * The normaliser must only put a space in front and write spaces as U+2581.
    * A merge joins two neighbours into a piece, so no merge crosses a place that
      no piece covers. If no piece holds U+2581 after another character, each run
      of U+2581 starts a pre-token; a newline that no longer piece holds stands alone.
    * A string is whole if the library encodes it, alone, as its own id.
    """
    import sentencepiece

    with open(path, "rb") as f:
        given = f.read()
    set_up = _sp_model.read_normaliser(given)
    if set_up["charsmap"] or not set_up["add_dummy_prefix"] or set_up["remove_extra_whitespaces"] or not set_up["escape_whitespaces"]:
        raise ValueError("the shortcut is not proven for a model that changes its input")
    pieces = _sp_model.read_pieces(given)
    if any(t == _sp_model.USER_DEFINED for _, _, t in pieces):
        raise ValueError("the shortcut is not proven for a model with strings of its own")
    merged = [p for p, _, t in pieces if t == _sp_model.NORMAL and len(p) > 1]
    if any(SPACE in p.lstrip(SPACE) for p in merged):
        raise ValueError("a piece goes on after a space")
    alone = "" if any("\n" in p for p in merged) else "\n"
    model = _sp_model.without_normaliser(given)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    normal = [(i, p) for i, (p, _, t) in enumerate(pieces) if t == _sp_model.NORMAL]
    encoded = sp.encode([p for _, p in normal], num_threads=1)
    whole = frozenset(p for (i, p), ids in zip(normal, encoded, strict=True) if ids == [i])
    pattern = rf"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + ("|\n" if alone else "")
    return Proof(model, whole, pattern)


class Counter:
    def __init__(self, proof: Proof):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proof.model)
        self.findall = re.compile(proof.pattern).findall
        self.whole = dict.fromkeys(proof.whole, 1)
        self.known = dict(self.whole)

    def count(self, texts: list[str]) -> list[int]:
        known = self.known
        split = [self.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        rest = list({p for pre_tokens in split for p in pre_tokens if p not in known})
        known.update(zip(rest, map(len, self.sp.encode(rest, num_threads=1)), strict=True))
        out = [sum(map(known.__getitem__, pre_tokens)) for pre_tokens in split]
        if len(known) > CACHE_ENTRIES:
            self.known = dict(self.whole)
        return out


def _counter(proof: Proof) -> Counter:
    return resident(("counter", proof), lambda: Counter(proof))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the library over the whole text, without begin or end;
    names of control pieces in a text are ordinary text. A null text is the empty
    text: no bytes, no tokens. Other columns are ignored; repeated rows repeat;
    an empty table gives an empty result."""
    proof = docs.sparkSession.sparkContext.broadcast(prove(model_path))

    def work():
        counter = _counter(proof.value)

        def do(texts: list[str]) -> dict:
            n = counter.count(texts)
            return {
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([x > limit for x in n], pa.bool_()),
            }

        return do

    return map_texts(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", work)
