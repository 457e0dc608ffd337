"""License scan: ordered signature rules behind a keyword prefilter.

A text that holds none of a few words is done after one pass. For the others the
words get their numbers ("7:mit 8:license"), so a regex match carries the
interval of words it covers. Which keywords a text holds is found once; rules of
which none is there are skipped. One sweep over the detections, sorted by start, then suppresses each detection whose
interval lies within that of a detection of equal or higher priority. Everything
is a column expression; no row leaves its task and nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import BASE, GATE, WEIGHTS, Rule, parse, regex_of, rules

#: What stands between words once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: The one character outside A-Z whose lower case is a letter of a-z, and one that stays a letter like it.
KELVIN, OTHER = "\u212a", "\u0138"


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case and one space between two; null as empty.

    ``lower`` changes letters beyond A-Z too, which no rule has and which stay letters
    of a word; only the Kelvin sign would become a k, and is kept from it."""
    return F.trim(F.regexp_replace(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(OTHER))), BETWEEN, " "))


def numbered_pattern(pattern: str) -> str:
    """A rule's regex over numbered words: each word gets its number in front."""
    return regex_of(parse(pattern), lambda w: rf"\d+:{w}(?![^ ])")


def _intervals(numbered: Column, pattern: Column) -> Column:
    """First and last word number of each match."""
    return F.transform(
        F.regexp_extract_all(numbered, pattern, F.lit(0)),
        lambda m: F.struct(
            F.substring_index(m, ":", 1).cast("int").alias("start"),
            F.substring_index(F.substring_index(m, " ", -1), ":", 1).cast("int").alias("end"),
        ),
    )


def _labelled(label: str):
    return lambda d: F.struct(d["start"].alias("start"), F.lit(label).alias("label"))


def _constant(value: list, schema: str) -> Column:
    """A list as one constant: the planner folds it, however long, into a single value."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _rule_array(rule_set: Sequence[Rule], keywords: list[str]) -> Column:
    """The rules with the places of their keywords; a rule without any is always tried."""
    place = {k: i for i, k in enumerate(keywords)}
    rows = [{"priority": r.priority, "label": r.label, "keywords": [place[k] for k in r.keywords], "pattern": numbered_pattern(r.pattern)} for r in rule_set]
    return _constant(rows, "array<struct<priority:int,label:string,keywords:array<int>,pattern:string>>")


def _survivors(detections: Column) -> Column:
    """One sweep: (labels, best priority) of the detections that are not suppressed.

    Sorted by start, then longest first, then priority, an interval lies within an
    earlier one exactly if some earlier end reaches its own; the state keeps the
    farthest end by priority, so the sweep is linear."""
    ordered = F.array_sort(F.transform(detections, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["priority"].alias("priority"), d["label"].alias("label"))))
    levels = sorted(WEIGHTS)
    zero = F.struct(*[F.lit(-1).alias(f"far{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(99).alias("best"))

    def step(s: Column, d: Column) -> Column:
        end = -d["back"]
        inside = F.lit(False)
        for p in levels:
            inside = inside | ((d["priority"] >= p) & (s[f"far{p}"] >= end))
        far = [F.when((d["priority"] == p) & (s[f"far{p}"] < end), end).otherwise(s[f"far{p}"]).alias(f"far{p}") for p in levels]
        labels = F.when(inside, s["labels"]).otherwise(F.array_union(s["labels"], F.array(d["label"])))
        best = F.when(inside | (d["priority"] >= s["best"]), s["best"]).otherwise(d["priority"])
        return F.struct(*far, labels.alias("labels"), best.alias("best"))

    return F.aggregate(ordered, zero, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best")))


def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _scan(words: Column, rule_set: Sequence[Rule]) -> Column:
    """Struct of everything found in one text of numbered words; used on gated texts only."""
    numbered = F.array_join(F.transform(F.split(words, " "), lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " ")
    keywords = sorted({k for r in rule_set for k in r.keywords})
    padded = F.concat(F.lit(" "), words, F.lit(" "))

    def of(numbered: Column) -> Column:
        # The base phrases are always looked for.
        base = [F.transform(_intervals(numbered, F.lit(numbered_pattern(phrase))), _labelled(label)) for phrase, label in BASE]

        def detections(present: Column) -> Column:
            hits = F.filter(_rule_array(rule_set, keywords), lambda r: (F.size(r["keywords"]) == 0) | F.exists(r["keywords"], lambda k: F.get(present, k)))
            return F.flatten(F.transform(hits, lambda r: F.transform(_intervals(numbered, r["pattern"]), lambda d: F.struct(d["start"].alias("start"), d["end"].alias("end"), r["priority"].alias("priority"), r["label"].alias("label")))))

        present = _let(padded, lambda t: F.transform(_constant([f" {k} " for k in keywords], "array<string>"), lambda k: F.contains(t, k)))
        return F.struct(F.concat(*base).alias("base"), _survivors(_let(present, detections)).alias("method"))

    return _let(numbered, of)


def license_scan(docs: DataFrame, rule_set: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    * Words are maximal runs of digits, letters a-z (after lower-casing) and
      non-ASCII characters; a null or empty text has none.
    * ``n_base`` counts all places of the base phrases; ``first_word`` and
      ``last_word`` are their smallest and largest start, null without any.
    * ``labels`` joins the base labels and those of the surviving detections;
      both label columns are the empty string if nothing was found.
    * ``score`` is the weight of the best surviving detection, 0 without any.
    * Of two detections with the same interval the one of higher priority stays,
      then the smaller label. Other columns are ignored; repeated rows repeat.
    * ``rule_set`` may be another set of rules. Rules without keywords are tried on
      every text, and with one among them no text is stopped by the gate.
    """
    rule_set = rules() if rule_set is None else rule_set
    words = words_of(F.col(text_col))
    gate = F.lit(not all(r.keywords for r in rule_set))
    for key in GATE:
        gate = gate | F.contains(F.concat(F.lit(" "), F.col("words"), F.lit(" ")) if key != key.strip() else F.col("words"), F.lit(key))
    scanned = docs.select(F.col(id_col).alias("doc_id"), words.alias("words")).select(
        "doc_id",
        F.when(F.col("words") == "", F.lit(0)).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.when(gate, _scan(F.col("words"), rule_set)).alias("found"),
    )
    base = F.coalesce(F.col("found.base"), F.array().cast("array<struct<start:int,label:string>>"))
    starts, base_labels = F.transform(base, lambda d: d["start"]), F.array_distinct(F.transform(base, lambda d: d["label"]))
    own = F.coalesce(F.col("found.method.labels"), F.array().cast("array<string>"))
    best = F.col("found.method.best")
    score = F.lit(0.0)
    for p, w in WEIGHTS.items():
        score = F.when(best == p, F.lit(w)).otherwise(score)
    return scanned.select(
        "doc_id", "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        score.alias("score"),
    )
