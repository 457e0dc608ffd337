"""Quality rules as a bit-mask ledger.

One pass measures a text and evaluates every rule; the ledger keeps the
measurements and a bit for each failed rule. Policies are versioned masks over
those bits, so applying or comparing them needs no text. Ablations come from one
count of the distinct bit patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_bpe import map_texts

#: White space between words, and the symbols that are counted.
WHITE_SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"

_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)

#: Words in a window whose repetition counts.
WINDOW = 8

_FACTORS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


class Rule(NamedTuple):
    """``fails`` is over the measurement columns; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


RULES = [
    Rule(0, "few_words", lambda: _c("n_words") < 20),
    Rule(1, "repeated_words", lambda: 100 * _c("n_repeat_words") > 30 * _c("n_words")),
    Rule(2, "symbols", lambda: 10 * _c("n_symbols") > 2 * _c("n_words")),
    Rule(3, "duplicate_lines", lambda: 2 * _c("n_dup_lines") > _c("n_lines")),
    Rule(4, "long_words", lambda: _c("word_chars") > 40 * _c("n_words")),
    Rule(5, "short_words", lambda: 2 * _c("word_chars") < 3 * _c("n_words")),
    Rule(6, "capitals", lambda: 2 * _c("n_capitals") > _c("word_chars")),
]

#: Policies by version: the rules that reject. A version is never changed, only succeeded.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "strict-1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "long_words", "short_words", "capitals"),
}
CURRENT = "strict-1"


def mask(policy: str) -> int:
    """The bits that reject under a policy."""
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[policy])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more; windows are compared by 64-bit hashes."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    h = h ^ (h >> np.uint64(29))
    at = n - window + 1
    rolled = np.zeros(at, np.uint64)
    for k in range(window):
        rolled += h[k : k + at] * _FACTORS[k]
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    repeated = np.zeros(at, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    change = np.zeros(n + 1, np.int64)
    change[:at] += repeated
    change[window : window + at] -= repeated
    return int((np.cumsum(change[:n]) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    raw = text.encode()
    words = raw.split()  # bytes are split at ASCII white space, as the rule says
    spaces = sum(map(text.count, WHITE_SPACE))
    lines = [line for line in text.split("\n") if line.strip(WHITE_SPACE)]
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines), len(raw.translate(None, _NOT_CAPITAL))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measurements, ``failed`` (bits).

    A null text is the empty text. Other columns are ignored; repeated rows
    repeat; an empty table gives an empty ledger."""

    def work():
        def do(texts: list[str]) -> dict:
            columns = zip(*map(measure, texts), strict=True)
            return {name: pa.array(values, pa.int64()) for name, values in zip(MEASURES, columns, strict=True)}

        return do

    found = map_texts(docs, id_col, text_col, ", ".join(f"{m} long" for m in MEASURES), work)
    bits = F.lit(0)
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)))
    return found.withColumn("failed", bits.cast("int"))


def verdicts(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy; texts are not read."""
    base = F.col("failed").bitwiseAND(F.lit(mask("base-1"))) != 0
    return ledger_rows.select("*", base.alias("base_failed"), (~base & (F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)).alias("kept"))


def ablations(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: ``rule, failed, only_by_rule, kept_with, kept_without``.

    Texts are counted once by bit pattern, at most 2**rules rows; every figure is a
    sum over patterns."""
    patterns = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    chosen = [r for r in RULES if r.name in POLICIES[policy]]
    rows = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in chosen])).alias("r")
    each = patterns.select("bits", "n", rows).select("bits", "n", "r.rule", "r.bit")
    n, bits, bit = F.col("n"), F.col("bits"), F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(bits.bitwiseAND(bit) != 0, n).otherwise(0)).alias("failed"),
        F.sum(F.when(bits == bit, n).otherwise(0)).alias("only_by_rule"),
        F.sum(F.when(bits == 0, n).otherwise(0)).alias("kept_with"),
        F.sum(F.when(bits.bitwiseAND(F.bitwise_not(bit)) == 0, n).otherwise(0)).alias("kept_without"),
    )
