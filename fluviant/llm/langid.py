"""Language identification of mixed text.

The script of a word narrows its candidate languages. Hashed character 3- and
4-grams give each candidate a score for the word, and a Viterbi pass over the
words of a text, with a penalty for each switch, labels its spans. The language
of a text is the one whose spans hold most letters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ._common import held_out, resident
from .byte_bpe import chunks, map_texts, text_udf

#: First code points of script ranges and the scripts' names.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([at for at, _ in SCRIPTS], np.uint32)
_SCRIPT_AT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.int64)

#: Hash buckets of character n-grams, and rows learnt from for each language.
BUCKETS, ROWS_PER_LANG = 1 << 15, 2_000

#: Languages up to which workers use the full cache and chunks; with more both shrink
#: in proportion, so that tables of words x languages stay of one size.
FULL_LANGS = 16

#: Cost of a switch, in natural-log units; score of a language whose script it is not.
PENALTY, NOT_ITS_SCRIPT = 12.0, -40.0

#: Words kept with their scores in each Python worker; characters worked on at once.
CACHE_ENTRIES, CHUNK_CHARS = 200_000, 2_000_000

_runs = re.compile(r"[^\W\d_]+").findall


def letters(text: str) -> list[str]:
    """Runs of letters. Python's word class also holds numerals such as superscripts;
    runs of nothing else are left out."""
    found = _runs(text)
    return found if text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


class Model(NamedTuple):
    langs: tuple[str, ...]
    log_p: np.ndarray  # (BUCKETS, languages)
    uses: np.ndarray  # (scripts, languages), bool
    penalty: float


def _mix(*codes: np.ndarray) -> np.ndarray:
    h = np.full(len(codes[0]), 0x9E3779B1, np.uint32)
    for c in codes:
        h = (h ^ c) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return (h >> np.uint32(5)) & np.uint32(BUCKETS - 1)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word number) of each 3- and 4-gram with word ends, and the words' scripts."""
    code = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32)
    end = code == 10
    owner = np.cumsum(end) - 1
    mid3, mid4 = ~end[1:-1], ~end[1:-2] & ~end[2:-1]
    three = _mix(code[:-2], code[1:-1], code[2:])[mid3]
    four = _mix(code[:-3], code[1:-2], code[2:-1], code[3:])[mid4]
    first = code[1:][end[:-1]]
    script = _SCRIPT_AT[np.searchsorted(_STARTS, first, "right") - 1]
    return np.concatenate([three, four]), np.concatenate([owner[1:-1][mid3], owner[1:-2][mid4]]), script


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of (lang, text) rows; scripts are counted as negative buckets."""

    def flush(by_lang: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in by_lang.items():
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(total[hit].astype(np.int64))], names=["lang", "bucket", "n"])
        by_lang.clear()

    for batch in batches:
        by_lang: dict[str, np.ndarray] = {}
        at, langs = 0, batch.column(0).to_pylist()
        for part in chunks(batch.column(1).to_pylist()):
            words: dict[str, Counter] = {}
            for lang, text in zip(langs[at:], part):  # noqa: B905 - the rest follows in the next part
                words.setdefault(lang, Counter()).update(letters(text.lower()))
            at += len(part)
            for lang, found in words.items():
                if found:
                    bucket, owner, script = ngrams(list(found))
                    n = np.fromiter(found.values(), np.float64, len(found))
                    total = by_lang.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES)))
                    total[:BUCKETS] += np.bincount(bucket, n[owner], BUCKETS)
                    total[BUCKETS:] += np.bincount(script, n, len(SCRIPT_NAMES))
                    if len(by_lang) > FULL_LANGS:
                        yield from flush(by_lang)
        yield from flush(by_lang)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG, penalty: float = PENALTY) -> Model:
    """Fit the n-gram model on about ``rows_per_lang`` rows of each language.

    Rows with a null id, text or language and held-out rows are never read. Which
    rows are sampled depends on the id's hash alone. Counting runs on the
    executors; the driver gets a table of buckets x languages, 128 kB for each
    language, and broadcasts it."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    # Joined, not a chain of conditions, which must not be as long as the list of languages.
    share = F.least(F.lit(1_000_000), F.floor(F.lit(1e6 * rows_per_lang) / F.count(F.lit(1))) + 1)
    shares = F.broadcast(rows.groupBy("lang").agg(share.alias("share")))
    sample = rows.where(F.col("text").isNotNull()).join(shares, "lang").where(F.pmod(F.xxhash64("id", F.lit(41)), F.lit(1_000_000)) < F.col("share"))
    counted = sample.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    coded = counted.column("lang").combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    langs = tuple(sorted(names))
    code, bucket, n = coded.indices.to_numpy(), counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    order = np.argsort(code, kind="stable")
    ends = np.searchsorted(code[order], np.arange(len(names) + 1))
    log_p, scripts = np.zeros((BUCKETS, len(langs)), np.float32), np.zeros((len(SCRIPT_NAMES), len(langs)))
    for j, lang in enumerate(langs):  # one language at a time, so that only one is held in double precision
        k = names.index(lang)
        at, counts = order[ends[k] : ends[k + 1]], np.zeros(BUCKETS + len(SCRIPT_NAMES))
        counts[bucket[at]] = n[at]
        grams, scripts[:, j] = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
        log_p[:, j] = np.log(grams / grams.sum())
    log_p -= log_p.max(1, keepdims=True) if langs else 0
    uses = scripts > 0.01 * np.maximum(scripts.sum(0, keepdims=True), 1)
    return Model(langs, log_p, uses, penalty)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of each word, for all texts side by side.

    ``scores`` (words, states) holds the texts one after the other. Staying costs
    nothing, any switch ``penalty``. Texts are stepped through together, the
    longest first, so that a step works on all that still have a word."""
    n_words, k = scores.shape
    out = np.zeros(n_words, np.int64)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return out
    start, length = starts[order], lengths[order]
    longest = int(length[0])
    active = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t words
    stay, best = np.zeros((n_words, k), bool), np.zeros(n_words, np.int64)
    state = scores[start].astype(np.float32)
    for t in range(longest):
        a = active[t]
        at = start[:a] + t
        if t:
            top = state[:a].max(1, keepdims=True) - penalty
            kept = state[:a] >= top
            stay[at] = kept
            state[:a] = np.where(kept, state[:a], top) + scores[at]
            state[:a] -= state[:a].max(1, keepdims=True)
        best[at] = state[:a].argmax(1)
    now = np.zeros(len(order), np.int64)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        ends = active[t + 1] if t + 1 < longest else 0
        now[ends:a] = best[at[ends:]]
        out[at] = now[:a]
        if t:
            now[:a] = np.where(stay[at, now[:a]], now[:a], best[at - 1])
    return out


def _scaled(size: int, model: Model) -> int:
    return size * FULL_LANGS // max(FULL_LANGS, len(model.langs))


class Labeller:
    def __init__(self, model: Model):
        self.model = model
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, len(model.langs)), np.float32)

    def _learn(self, words: list[str]) -> None:
        m = self.model
        bucket, owner, script = ngrams(words)
        score = np.empty((len(words), len(m.langs)), np.float32)
        for j in range(len(m.langs)):  # 3- and 4-grams overlap: half of their sum
            score[:, j] = 0.5 * np.bincount(owner, m.log_p[bucket, j], len(words))
        uses = m.uses[script]
        score[~uses] = NOT_ITS_SCRIPT * 10
        score -= score.max(1, keepdims=True)
        np.maximum(score, NOT_ITS_SCRIPT, out=score)
        score[~uses.any(1)] = 0
        self.row.update(zip(words, range(len(self.table), len(self.table) + len(words)), strict=True))
        self.table = np.concatenate([self.table, score])

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, int]]]]:
        """(language, share of letters, spans of (first word, words, language number)) of each text."""
        m = self.model
        words = [letters(t.lower()) for t in texts]
        if not m.langs:
            return [("und", 0.0, [])] * len(texts)
        if len(self.row) > _scaled(CACHE_ENTRIES, m):
            self.row, self.table = {}, self.table[:0]
        row = self.row
        new = list({w for ws in words for w in ws if w not in row})
        if new:
            self._learn(new)
        lengths = np.array([len(ws) for ws in words], np.int64)
        rows = np.fromiter((row[w] for ws in words for w in ws), np.int64, int(lengths.sum()))
        size = np.fromiter((len(w) for ws in words for w in ws), np.int64, len(rows))
        scores = self.table[rows]
        state = viterbi(scores, lengths, m.penalty)
        owner = np.repeat(np.arange(len(texts)), lengths)
        known = scores.any(1)  # neutral words, of a script nobody uses, belong to no language
        mass = np.zeros((len(texts), len(m.langs)))
        np.add.at(mass, (owner[known], state[known]), size[known])
        total = np.bincount(owner, size, len(texts))
        begins = np.cumsum(lengths) - lengths
        first = np.ones(len(state), bool)
        first[1:] = (state[1:] != state[:-1]) | (owner[1:] != owner[:-1])
        cut = np.flatnonzero(first)
        span = np.diff(np.append(cut, len(state)))
        spans: list[list] = [[] for _ in texts]
        for c, n in zip(cut.tolist(), span.tolist(), strict=True):
            spans[owner[c]].append((c - int(begins[owner[c]]), n, int(state[c])))
        out = []
        for i in range(len(texts)):
            if not lengths[i]:
                out.append(("und", 0.0, []))
            else:
                j = int(mass[i].argmax())
                out.append((m.langs[j], float(mass[i, j] / total[i]), spans[i]))
        return out


def _labeller(model: Model) -> Labeller:
    # the labeller holds the model, so its id stays taken as long as the entry lives
    return resident(("labeller", id(model)), lambda: Labeller(model))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score`` and, if
    ``with_spans``, ``spans`` (first word, number of words, language).

    ``lang_pred`` is a learnt language, or ``und`` if the text is null or has no
    letter (score 0), or if nothing was learnt. ``score`` is the share of letters
    in spans of that language; ties go to the first language by name. Only the
    text decides. Other columns are ignored; repeated rows repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        labeller = _labeller(shared.value)

        def do(texts: list[str]) -> dict:
            found = labeller.label(texts)
            out = {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}
            if with_spans:
                langs = shared.value.langs
                out["spans"] = pa.array([[{"first": a, "words": n, "lang": langs[j]} for a, n, j in f[2]] for f in found], pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())])))
            return out

        return do

    schema = "lang_pred string, score double" + ", spans array<struct<first:int,words:int,lang:string>>" * with_spans
    found = map_texts(docs, id_col, text_col, schema, work, _scaled(CHUNK_CHARS, model))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *found.columns[1:])


def keep_identified(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language that holds ``least`` of their letters or
    more, all columns unchanged. Rows that are ``und`` go: null texts, and texts
    without a letter."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        labeller = _labeller(shared.value)
        return lambda texts: [lang != "und" and share >= least for lang, share, _ in labeller.label(texts)]

    return docs.where(text_udf("boolean", work, _scaled(CHUNK_CHARS, model))(F.col(f"`{text_col}`")))
