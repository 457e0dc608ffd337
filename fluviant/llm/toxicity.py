"""Toxicity by a factorization machine over hashed terms.

A term is a word or a word's beginning that occurs once, twice or four times at
least, hashed to 32 bits. Features are the terms whose document frequency differs
between the classes, however many, and words that do so only beside another word:
neutral alone, but not together. The machine learns a weight for each feature and
a vector whose inner products weigh each pair, so that two terms together (an insult
and the group it is aimed at) can count more than their weights add up to.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, scratch, ship_package
from ._common import held_out, resident
from .byte_bpe import map_texts, text_udf

#: Labelled rows learnt from, of each class; length of the pair vectors.
ROWS_PER_CLASS, FACTORS = 6_000, 8

#: Standard errors by which a term's document frequencies must differ; and those of a
#: word among the texts with its partner, where far more pairs are tested.
LEAST_Z, LEAST_PAIR_Z = 5.0, 9.0

#: Toxic texts, copies counted once, that must hold a pair; share of texts a partner may be in.
PAIR_SUPPORT, PAIR_SHARE = 8, 0.1

#: Beginnings of words that are terms, by length; occurrences that make further terms.
PREFIXES, LEVELS = (4, 5, 6, 7), (1, 2, 4)

#: Words kept with their features in each Python worker.
CACHE_ENTRIES = 250_000

words = re.compile(r"[^\W\d_]+").findall


def terms(word: str) -> list[int]:
    """Hashes of a lower-case word and of its beginnings."""
    found = [zlib.crc32(word.encode())]
    for n in PREFIXES:
        if len(word) >= n:
            found.append(zlib.crc32(f"{word[:n]}*".encode()))
    return found


def at_level(term: int, level: int) -> int:
    """The hash of "this term occurs ``level`` times at least"."""
    return term if level == 1 else zlib.crc32(level.to_bytes(2, "little"), term)


class Model(NamedTuple):
    features: dict[int, int]
    bias: float
    weight: np.ndarray
    factor: np.ndarray  # (features, FACTORS)

    def score(self, present: list[int]) -> float:
        """Probability for a text in which these features occur."""
        at = np.array(present, np.int64)
        v = self.factor[at]
        pairs = 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        z = self.bias + self.weight[at].sum() + pairs
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic rows, rows, 1 if it is a whole word) of (text, toxic) rows, summed over a part of them."""

    def flush():
        columns = [pa.array(list(seen), pa.int64()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(3))]
        return pa.RecordBatch.from_arrays(columns, names=["term", "pos", "n", "word"])

    seen: dict[int, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            times: Counter = Counter()
            whole = set()
            for w, n in Counter(words((text or "").lower())).items():
                own = terms(w)
                whole.add(own[0])
                for t in own:
                    times[t] += n
            for t, n in times.items():
                for level in LEVELS:
                    if n >= level:
                        held = seen.setdefault(at_level(t, level), [0, 0, 0])
                        held[0] += toxic
                        held[1] += 1
                        held[2] |= level == 1 and t in whole
            if len(seen) > 300_000:
                yield flush()
                seen = {}
    if seen:
        yield flush()


def _two_proportions(p: np.ndarray, m: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
    """By how many standard errors p of m exceeds q of n; 0 where either has no rows."""
    both = (p + q) / np.maximum(m + n, 1)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / np.maximum(m, 1) + 1 / np.maximum(n, 1)))
    return np.where((m > 0) & (n > 0), (p / np.maximum(m, 1) - q / np.maximum(n, 1)) / error, 0.0)


def partners(rows: list[np.ndarray], y: np.ndarray, k: int, least_z: float = LEAST_PAIR_Z, support: int = PAIR_SUPPORT) -> np.ndarray:
    """The words that, beside another word, are in toxic rows more often than beside it in clean ones.

    ``rows`` hold numbers below ``k``. A pair counts if each of its words is significant
    among the rows that have the other, and ``support`` toxic rows hold both. Each word is met with the rows it is in, so the work is that of the
    words of one row after the other, and the memory that of one word's partners."""
    y = np.asarray(y, bool)
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[order], np.arange(k + 1))
    n_pos = np.bincount(flat[y[owner]], minlength=k)
    n_neg = np.bincount(flat, minlength=k) - n_pos
    chosen = np.zeros(k, bool)
    for a in np.flatnonzero(n_pos >= support):
        holders = owner[order[ends[a] : ends[a + 1]]]
        pos = np.bincount(np.concatenate([rows[i] for i in holders[y[holders]]]), minlength=k)
        b = np.flatnonzero((pos >= support) & (np.arange(k) > a))
        if not len(b) or not n_neg[a]:
            continue
        neg = np.bincount(np.concatenate([rows[i] for i in holders[~y[holders]]]), minlength=k)[b]
        beside_a = _two_proportions(pos[b], np.full(len(b), n_pos[a]), neg, np.full(len(b), n_neg[a]))
        beside_b = _two_proportions(pos[b], n_pos[b], neg, n_neg[b])
        found = b[(beside_a > least_z) & (beside_b > least_z)]
        chosen[found] = True
        chosen[a] |= len(found) > 0
    return np.flatnonzero(chosen)


def _fit(rows: list[np.ndarray], y: np.ndarray, m: int, row_weight: np.ndarray, factors: int, steps: int = 300, rate: float = 0.05, decay: float = 1e-4, pair_decay: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray]:
    """Weights of the machine by Adam on the weighted log loss, over all rows at once. The
    rate falls to nothing, so that the last steps settle instead of leaping.

    ``rows`` hold the numbers (below ``m``) of the features that occur. Sums over rows and
    over features are taken on their lists, so memory grows with what occurs, not with rows
    times features. Feature ``m`` is in every row and stays 0: no list is empty."""
    rng = np.random.default_rng(7)
    cols = np.concatenate([np.append(r, m) for r in rows]).astype(np.int64)
    sizes = np.array([len(r) + 1 for r in rows])
    starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(cols, kind="stable")
    held, firsts = np.unique(cols[order], return_index=True)
    by_feature = owner[order]
    params = [np.zeros(1, np.float32), np.zeros(m + 1, np.float32), rng.normal(0, 0.03, (m + 1, factors)).astype(np.float32)]
    params[2][m] = 0
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = (row_weight / row_weight.sum()).astype(np.float32)
    for step in range(1, steps + 1):
        b, w, v = params
        # sums over a row's features of vectors, weights and squares; then over a feature's rows
        sums = np.add.reduceat(np.column_stack([v, w, (v**2).sum(1)])[cols], starts)
        xv = sums[:, :factors]
        z = b + sums[:, factors] + 0.5 * ((xv**2).sum(1) - sums[:, factors + 1])
        g = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        back = np.add.reduceat(np.column_stack([g[:, None] * xv, g])[by_feature], firsts)
        grads = [g.sum(keepdims=True), decay * w, pair_decay * v]
        grads[1][held] += back[:, factors]
        grads[2][held] += back[:, :factors] - back[:, factors:] * v[held]
        grads[1][m], grads[2][m] = 0, 0
        for i, grad in enumerate(grads):
            mean[i] = 0.9 * mean[i] + 0.1 * grad
            var[i] = 0.99 * var[i] + 0.01 * grad**2
            params[i] = (params[i] - rate * (1 - (step - 1) / steps) * (mean[i] / (1 - 0.9**step)) / (np.sqrt(var[i] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return float(params[0][0]), params[1][:m], params[2][:m]


def _sample(ids: DataFrame, n: int, most: int) -> DataFrame:
    """The ``most`` ids with the smallest hashes, of ``n``.

    Hashes beyond the share that holds them with ample room are filtered out first,
    so that not every task sends ``most`` rows to the one that picks."""
    spread = 1 << 40
    place = F.pmod(F.xxhash64("id"), F.lit(spread))
    share = min(1.0, (1.2 * most + 500) / max(n, 1))
    return ids.where(place < int(share * spread)).orderBy(place, "id").limit(most)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS, factors: int = FACTORS, least_z: float = LEAST_Z) -> Model:
    """Fit on at most ``rows_per_class`` labelled rows of each class.

    Held-out rows and rows with a null id or label are never read. The sampled
    ids, the ones with the smallest hash, are broadcast; their number is the only
    bound, and terms, pairs and the driver's lists of them follow from it. Rows of
    ``docs`` that repeat an id are all read; an id with both labels is toxic. Without
    both classes every text gets the share of toxic labels."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    bias = math.log(max(share, 1e-4) / max(1 - share, 1e-4))
    nothing = Model({}, bias, np.zeros(0, np.float32), np.zeros((0, factors), np.float32))
    if not sizes.get(0) or not sizes.get(1):
        return nothing
    ids = [_sample(known.where(F.col("toxic") == c), sizes[c], rows_per_class) for c in (0, 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = scratch(rows.join(F.broadcast(ids[0].unionAll(ids[1])), "id").select("text", "toxic", F.xxhash64("text").alias("key")), "toxic-sample")
    got = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    ship_package(docs.sparkSession)
    n_pos, n_neg = got.get(1, 0), got.get(0, 0)
    if not n_pos or not n_neg:
        return nothing
    counts = sample.mapInArrow(_count_terms, "term long, pos long, n long, word long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.max("word").alias("word"))
    # Two-proportion test. (A log ratio over its error saturates for terms that no clean text
    # has, the very ones that matter, and ranks them behind common words.)
    p, q, both = F.col("pos") / n_pos, (F.col("n") - F.col("pos")) / n_neg, F.col("n") / (n_pos + n_neg)
    z = F.abs(p - q) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_pos + 1 / n_neg))
    telling = (z > least_z) & (F.col("n") >= 3)
    # Among n rows nothing differs by more than the root of n standard errors: fewer cannot pair.
    may_pair = (F.col("word") == 1) & (F.col("pos") >= PAIR_SUPPORT) & F.col("n").between(LEAST_PAIR_Z**2, PAIR_SHARE * (n_pos + n_neg))
    chosen = counts.select("term", telling.alias("telling"), may_pair.alias("may_pair")).where("telling or may_pair").orderBy("term").toArrow()
    term, telling, may_pair = (chosen.column(c).to_numpy() for c in ("term", "telling", "may_pair"))
    if not len(term):
        return nothing
    shared = docs.sparkSession.sparkContext.broadcast({int(t): i for i, t in enumerate(term)})

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(shared.value)
        for batch in batches:
            found = [find(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)], names=["present", "toxic", "key"])

    table = sample.mapInArrow(present, "present array<int>, toxic int, key long").toArrow()
    discard(sample)
    y = table.column("toxic").to_numpy().astype(np.float32)
    lists = table.column("present").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    found = [flat[a:b] for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0], strict=True)]
    words_of = np.cumsum(may_pair) - 1
    _, unlike = np.unique(table.column("key").to_numpy(), return_index=True)  # a copied text is one witness
    pairing = partners([words_of[found[i][may_pair[found[i]]]] for i in unlike], y[unlike], int(may_pair.sum()))
    telling = telling.copy()
    telling[np.flatnonzero(may_pair)[pairing]] = True
    if not telling.any():
        return nothing
    number = np.cumsum(telling) - 1
    weight = np.where(y == 1, sizes[1] / n_pos, sizes[0] / n_neg)
    fitted = _fit([number[r[telling[r]]] for r in found], y, int(telling.sum()), weight, factors)
    return Model({int(t): i for i, t in enumerate(term[telling])}, *fitted)


class Finder:
    """Features that occur in a text, by a table of words seen before.

    Only a word with a chosen term is looked at further; which of a term's levels
    were chosen is found when it first occurs."""

    def __init__(self, features: dict[int, int], model: Model | None = None):
        self.model = model  # held, so that the id it is known by stays taken
        self.features = features
        self.known: dict[str, tuple[int, ...]] = {}
        self.levels: dict[int, tuple[tuple[int, int], ...]] = {}

    def _chosen(self, term: int) -> bool:
        if term in self.levels:
            return True
        hit = tuple((n, self.features[at_level(term, n)]) for n in LEVELS if at_level(term, n) in self.features)
        if hit:
            self.levels[term] = hit
        return bool(hit)

    def __call__(self, text: str) -> list[int]:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        times: dict[int, int] = {}
        for w, n in Counter(words(text.lower())).items():
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple(t for t in terms(w) if self._chosen(t))
            for t in hit:
                times[t] = times.get(t, 0) + n
        return sorted({f for t, n in times.items() for level, f in self.levels[t] if n >= level})


def _finder(model: Model) -> Finder:
    return resident(("finder", id(model)), lambda: Finder(model.features, model))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    The whole text decides and nothing else; a null or empty text has no terms
    and gets the score of the bias alone. Other columns are ignored; repeated rows
    repeat; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        find = _finder(shared.value)

        def do(texts: list[str]) -> dict:
            return {"score": pa.array([shared.value.score(find(t)) for t in texts], pa.float64())}

        return do

    found = map_texts(docs, id_col, text_col, "score double", work)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns unchanged.
    A null text scores as the empty text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        find = _finder(shared.value)
        return lambda texts: [shared.value.score(find(t)) < threshold for t in texts]

    return docs.where(text_udf("boolean", work)(F.col(f"`{text_col}`")))
