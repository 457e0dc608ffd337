"""Exact and near duplicates, sharding and the license scan."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import ODD, SCHEMA, docs, empty, prose, row
from pyspark.sql import functions as F

from fluviant.llm import components, exact_dup, license_rules, license_scan, near_dup, sharding
from fluviant.llm._common import bitmap_of, bitmap_size, split_by_bitmap
from fluviant.llm.superminhash import Shingler, band_hashes, mix, super_min_hash
from fluviant.session import scratch


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups(spark):
    texts = [*ODD, "a  b", "a\n b", "a b", "A b", "", None, *["copy of copies"] * 50]
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    found = {r["doc_id"]: r for r in exact_dup.exact_duplicates(docs(spark, texts, ids)).collect()}
    groups = {}
    for i, t in zip(ids, texts, strict=True):
        groups.setdefault(norm(t), []).append(i)
    for i, t in zip(ids, texts, strict=True):
        own = groups[norm(t)]
        r = found[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(own), len(own), i == min(own))
        assert r["text_sha256"] == hashlib.sha256(norm(t).encode()).hexdigest()


def test_a_colliding_hash_does_not_merge_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dup, "_hash128", lambda text: F.unhex(F.lit("00")))
    found = {r["doc_id"]: r["keep_id"] for r in exact_dup.exact_duplicates(docs(spark, ["a", "b", "a", "b", "c"])).collect()}
    assert found == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4}


def test_texts_that_share_every_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dup, "_hash128", lambda text: F.unhex(F.lit("00")))
    monkeypatch.setattr(exact_dup, "_digest", lambda text: F.unhex(F.lit("01")))
    table = docs(spark, ["a", "b", "a", "b", "c", None, "a "], [7, 1, 0, 3, 4, 9, 2])
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dup.exact_duplicates(table).collect()}
    assert found == {7: (0, 2, False), 0: (0, 2, True), 1: (1, 2, True), 3: (1, 2, False), 4: (4, 1, True), 9: (9, 1, True), 2: (2, 1, True)}
    kept = exact_dup.drop_exact_duplicates(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 4, 9] and kept.columns == table.columns


def test_large_groups_and_ids_of_other_types(spark, monkeypatch):
    from fluviant.llm import _common

    monkeypatch.setattr(_common, "FEW_ROWS", 3)
    texts = ["same  text"] * 40 + ["other"] * 2 + ["once"] + ["same text"] * 20
    table = docs(spark, texts).withColumn("doc_id", F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 3, "0")))
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dup.exact_duplicates(table).collect()}
    assert found["k059"] == ("k000", 60) and found["k041"] == ("k040", 2) and found["k042"] == ("k042", 1)
    assert sorted(r["doc_id"] for r in exact_dup.drop_exact_duplicates(table).collect()) == ["k000", "k040", "k042"]


def test_exact_with_null_and_repeated_ids(spark):
    table = docs(spark, ["x", "x", "x", "y", "y", "z"], [None, 5, 5, None, None, 1])
    found = exact_dup.exact_duplicates(table).collect()
    assert sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in found if r["keep_id"] is not None) == [(-1, 5, 3, False), (1, 1, 1, True), (5, 5, 3, True), (5, 5, 3, True)]
    assert exact_dup.exact_duplicates(empty(spark)).count() == 0


def test_drop_exact_keeps_one_row_of_each_text(spark):
    table = docs(spark, ["x", "x", "x", "y", "y ", "z"], [3, 2, 2, 9, 8, 1])
    kept = exact_dup.drop_exact_duplicates(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "z"), (2, "x"), (9, "y")] or sorted((r["doc_id"], norm(r["text"]).strip()) for r in kept.collect()) == [(1, "z"), (2, "x"), (8, "y"), (9, "y")]
    assert exact_dup.drop_exact_duplicates(empty(spark)).count() == 0


def test_bitmap_never_misses_a_key(spark):
    keys = spark.range(0, 3000, 7).withColumnRenamed("id", "k")
    bits = bitmap_size(keys.count())
    yes, no = split_by_bitmap(spark.range(3000), F.xxhash64("id"), bitmap_of(keys, F.xxhash64("k"), bits), bits)
    yes = {r[0] for r in yes.collect()}
    assert yes >= set(range(0, 3000, 7)) and len(yes) < 520 and no.count() == 3000 - len(yes)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(texts, ids, percent):
    sets = [shingles(t) for t in texts]
    links = [(ids[a], ids[b]) for a, b in itertools.combinations(range(len(texts)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = components.union_find(links)
    return {i: root.get(i, i) for i in ids}


def edited(text, n, rng):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    rng = random.Random(percent)
    bases = prose(12, seed=2, words=200, vocabulary=5000)
    texts = [*ODD, *bases, "Four words only here", "four WORDS only here"]
    for b in bases:
        texts += [edited(b, k, rng) for k in (0, 1, 1, 2, 3, 4, 8)]
    # a chain: each links with the next, the ends do not link
    chain = prose(1, seed=9, words=300, vocabulary=5000)[0].split()
    texts += [" ".join(chain[k * 6 : k * 6 + 120]) for k in range(6)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    found = {r["doc_id"]: r for r in near_dup.near_duplicates(docs(spark, texts, ids), percent=percent).collect()}
    expected = brute_components(texts, ids, percent)
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())
    assert all(found[i]["n_shingles"] == len(shingles(t)) for i, t in zip(ids, texts, strict=True))


def test_links_that_no_leader_sees_are_found(spark):
    """Many edits of one hub, some of which link only with each other."""
    rng = random.Random(4)
    base = prose(1, seed=11, words=240, vocabulary=9000)[0]
    texts = [edited(base, rng.choice((1, 2, 3, 5)), rng) for _ in range(60)]
    texts += [t for k in range(15) for t in (lambda x: (x, edited(x, 1, rng)))(edited(base, rng.choice((4, 5, 6)), rng))]
    ids = list(range(len(texts)))
    found = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs(spark, texts), percent=85).collect()}
    assert found == brute_components(texts, ids, 85)


def linked_families(spark, families, percent):
    """Components (by id) of families of word lists; all texts of a family share one bucket,
    no matter how alike they are, and have no other."""
    texts, buckets = [], []
    for f, family in enumerate(families):
        for words in family:
            texts.append(" ".join(f"{w}f{f}" for w in words))
            buckets.append(f)
    table = docs(spark, texts)
    digest = {r["v"]: r["d"] for r in near_dup._sets(table, "doc_id", "text", 1).collect()}
    rows = [(i, i, digest[i], len(t.split()), [b]) for i, (t, b) in enumerate(zip(texts, buckets, strict=True))]
    classes = scratch(spark.createDataFrame(rows, "k long, v long, d long, n long, bands array<long>"), "classes")
    star, more = near_dup._links(table, classes, "doc_id", "text", 1, percent)
    root = components.union_find([tuple(r) for r in star.unionAll(more).collect()])
    return [root.get(i, i) for i in range(len(texts))]


def brute_families(families, percent):
    found, base = [], 0
    for family in families:
        sets = [frozenset(words) for words in family]
        root = components.union_find([(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])])
        found += [base + root.get(i, i) for i in range(len(family))]
        base += len(family)
    return found


def random_family(rng):
    """Two to seven sets that share blocks of words with some of the others, near the threshold."""
    m = rng.randint(2, 7)
    members = [[] for _ in range(m)]
    for block in range(rng.randint(2, 12)):
        size = rng.choice((1, 1, 2, 3, 5, 8, 13, 60, 90))
        for i in rng.sample(range(m), rng.randint(1, m)):
            members[i] += [f"b{block}w{k}" for k in range(size)]
    return [list(s) for s in dict.fromkeys(tuple(w) for w in members) if s]


def test_hub_between_two_alike_texts(spark):
    """What two texts share with their leader alone must not count as their own."""
    hub, out = [f"l{k}" for k in range(105)], [f"o{k}" for k in range(10)]
    family = [hub, hub[:100] + out, hub[:90] + out]
    common, xy, x, y, yl, ll = ([f"{name}{k}" for k in range(n)] for name, n in (("c", 91), ("xy", 1), ("x", 8), ("y", 7), ("yl", 1), ("l", 9)))
    other = [common + xy + x, common + xy + y + yl, common + yl + ll]
    for percent in (85, 80):
        families = [family, other, *([f] for f in family)]
        assert linked_families(spark, families, percent) == brute_families(families, percent)
    assert brute_families([other[:2]], 85) == [0, 0]


def test_every_pair_of_a_bucket_is_judged_as_by_brute_force(spark):
    rng = random.Random(5)
    families = [random_family(rng) for _ in range(3000)]
    for percent in (85, 60):
        expected = brute_families(families, percent)
        assert linked_families(spark, families, percent) == expected
        assert 200 < sum(i != r for i, r in enumerate(expected))


def test_blocks_of_hot_keys_change_nothing(spark, monkeypatch):
    """One bucket and one leader for all, lists and hubs far beyond a block."""
    from fluviant.llm import _common

    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(_common, "FEW_ROWS", 4)
    rng = random.Random(6)
    pool = [f"p{k}" for k in range(14)]
    families = [[[f"t{k}" for k in range(60)] + rng.sample(pool, rng.randint(1, 10)) + [f"own{i}"] * rng.randint(0, 1) for i in range(120)]]
    families = [[list(s) for s in dict.fromkeys(tuple(sorted(set(w))) for w in families[0])]]
    for percent in (85, 93):
        assert linked_families(spark, families, percent) == brute_families(families, percent)


def test_repeated_ids_with_different_texts_are_linked_on_their_own(spark):
    a, b = prose(2, seed=8, words=80, vocabulary=3000)
    table = docs(spark, [a + " end", a, b], [1, 5, 5])
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(table).collect())
    assert found == [(1, 1, True), (5, 1, False), (5, 5, True)]
    assert sorted((r["doc_id"], r["text"]) for r in near_dup.drop_near_duplicates(table).collect()) == sorted([(1, a + " end"), (5, b)])
    both = docs(spark, [a + " end", a], [5, 5])
    assert {(r["component_id"], r["kept"]) for r in near_dup.near_duplicates(both).collect()} == {(5, True)}
    assert near_dup.drop_near_duplicates(both).count() == 1


def test_lookup_joins_hot_and_cold_keys_alike(spark):
    from fluviant.llm._common import lookup

    rows = scratch(spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50).alias("a"), F.col("id").alias("x"), F.lit(1).alias("b")), "rows")
    table = scratch(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"), F.max("x").alias("top")).where("a <> 7"), "table")
    for how in ("inner", "left"):
        expected = {tuple(r) for r in rows.join(table, ["a", "b"], how).select("a", "b", "x", "m", "top").collect()}
        assert {tuple(r) for r in lookup(rows, table, ("a", "b"), "m", 5000, how).select("a", "b", "x", "m", "top").collect()} == expected


def test_near_with_null_and_repeated_ids(spark):
    text = prose(1, seed=3, words=60)[0]
    table = docs(spark, [text, text, text, text + " end", None, "other words"], [None, 4, 4, 2, 1, None])
    found = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_dup.near_duplicates(table).collect())
    assert found == [(-1, -1, True), (-1, 2, False), (1, 1, True), (2, 2, True), (4, 2, False), (4, 2, False)]
    assert near_dup.near_duplicates(empty(spark)).count() == 0
    kept = near_dup.drop_near_duplicates(table)
    assert kept.columns == table.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2]  # the copy with a null id goes, the other words stay
    assert near_dup.drop_near_duplicates(empty(spark)).count() == 0


def slow_super_min_hash(elements, m):
    """The same draws, one element after the other and without stopping early."""
    best = [2**64 - 1] * m
    for e in elements.tolist():
        slots = list(range(m))
        for j in range(m):
            x = np.array([(e + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64)
            d = int(mix(x)[0])
            k = j + ((d & 0xFFFFFFFF) * (m - j) >> 32)
            slots[j], slots[k] = slots[k], slots[j]
            best[slots[j]] = min(best[slots[j]], j << 32 | d >> 32)
    return np.array(best, np.uint64)


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300])
def test_signature_equals_the_slow_one(n):
    elements = np.unique(mix(np.arange(n, dtype=np.uint64)))
    assert (super_min_hash(elements, 24) == slow_super_min_hash(elements, 24)).all()
    assert len(band_hashes(super_min_hash(elements, 24), 6)) == 6 and len(super_min_hash(elements[:0], 24)) == 0


def test_signature_estimates_similarity_with_less_variance():
    rng = np.random.default_rng(0)
    found = []
    for _ in range(300):
        base = rng.integers(0, 2**63, 24).astype(np.uint64)
        found.append((super_min_hash(np.unique(base[:20]), 64) == super_min_hash(np.unique(base[4:]), 64)).mean())
    j = 16 / 24
    assert np.mean(found) == pytest.approx(j, abs=0.02) and np.std(found) < 0.95 * (j * (1 - j) / 64) ** 0.5


def test_shingler_matches_the_definition():
    shingle = Shingler(5)
    for t in [*ODD, *prose(5), "A B c d e f A B C D E F"]:
        assert len(shingle(t)) == len(shingles(t))
    assert len(shingle("É é x y z")) == 1 and (shingle("ABC def") == shingle("abc\tDEF")).all()


def test_star_contraction_equals_union_find(spark):
    rng = random.Random(6)
    pairs = [(a, a + 1) for a in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(500, b) for b in range(501, 560)]
    edges = scratch(spark.createDataFrame(pairs, "a long, b long"), "edges")
    expected = {v: r for v, r in components.union_find(pairs).items() if v != r}
    for limit in (10**6, 0):
        assert {r["v"]: r["root"] for r in components.components(edges, limit).distinct().collect()} == expected


def test_shards(spark):
    texts = [*ODD, *["same"] * 30, *prose(60)]
    found = sharding.feistel_shards(docs(spark, texts), shards=7).collect()
    assert len(found) == len(texts)
    by_shard = {}
    for r in found:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "rows", None)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.feistel_shards(docs(spark, texts).repartition(5), shards=7).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in found}
    assert sharding.feistel_shards(empty(spark)).count() == 0
    assert sharding.feistel_shards(docs(spark, ["a", "a", None], [None, None, 1])).count() == 3


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 101, 1000])
def test_feistel_is_a_permutation(spark, n):
    for seed in (0, 9):
        found = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, seed)).collect()]
        assert sorted(found) == list(range(n))
    if n > 100:
        assert found != sorted(found)


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in license_rules.BASE:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


LICENSES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "mit license mit license MIT-LICENSE apache license",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: BSD-3-Clause", "smit license, mitlicense, mit licenses",
    "Licensed under CC BY-NC 4.0.", "All rights reserved.", "a mit 1 license", "général public license général", "Permission is hereby granted, free of charge, to any person obtaining a copy",
]


def test_license_base_and_labels(spark):
    texts = [*ODD, *LICENSES, "x " * 500 + "mit license " * 200]
    found = {r["doc_id"]: r for r in license_scan.license_scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_license(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))
    labels = {t: found[i]["labels"] for i, t in enumerate(texts)}
    assert labels[LICENSES[0]] == "apache,apache-2.0" and labels[LICENSES[1]] == "mit" and labels[LICENSES[3]] == "gpl,gpl-3.0"
    assert labels[LICENSES[4]] == "bsd-3-clause" and labels[LICENSES[6]] == "cc-by-nc-4.0" and labels[LICENSES[7]] == "all-rights-reserved"
    assert labels[LICENSES[10]] == "mit" and labels[LICENSES[5]] == ""
    assert license_scan.license_scan(empty(spark)).count() == 0


def test_license_sweep_matches_brute_force(spark):
    """Survivors of the sweep against pairwise containment, with the rules run by Python."""
    rules = license_rules.rules()
    assert len(rules) > 300
    texts = [*LICENSES, " ".join(LICENSES), "see the apache license version 2.0 or released under the mit license. " * 3]
    found = {r["doc_id"]: r for r in license_scan.license_scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        assert len(words) == found[i]["n_words"]
        joined = " ".join(f"{k}:{w}" for k, w in enumerate(words))
        hits = []
        for rule in rules:
            for m in re.finditer(license_scan.numbered_pattern(rule.pattern), joined):
                hits.append((int(m[0].split(":")[0]), int(m[0].split()[-1].split(":")[0]), rule.priority, rule.label))
        hits = sorted(set(hits), key=lambda d: (d[0], -d[1], d[2], d[3]))
        alive = [d for k, d in enumerate(hits) if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] for e in hits[:k])]
        expected = {d[3] for d in alive} | set(filter(None, brute_license(t)[4].split(",")))
        assert set(filter(None, found[i]["labels"].split(","))) == expected, t


def spellings(pattern, most=400):
    return license_rules.expansions(license_rules.parse(pattern), most)


def test_expansions_hold_every_alternative():
    assert sorted(spellings("a(?: b)? (?:c|d(?: e)?)")) == sorted(["a c", "a d", "a d e", "a b c", "a b d", "a b d e"])
    few = spellings("(?:a|b) (?:c|d|e)(?: f)?", most=1)
    assert {w for t in few for w in t.split()} == set("abcdef") and len(few) < 12
    assert spellings("holders? open ?rail an? x… y") and all(re.fullmatch(license_rules.regex_of(license_rules.parse("holders? open ?rail an? x… y")), t) for t in spellings("holders? open ?rail an? x… y"))
    with pytest.raises(ValueError, match="not a rule"):
        license_rules.parse("a+ (b")
    for rule in license_rules.rules():
        assert not re.search(r"[a-z0-9]\((?!\?:[ |])|\)\??[a-z0-9]", rule.pattern.replace(" )?", " )? ").replace(" )", " ) ")), rule.pattern  # no group divides a word


def test_no_spelling_of_a_rule_is_hidden_by_the_prefilter():
    for rule in license_rules.rules():
        regex = license_rules.regex_of(license_rules.parse(rule.pattern))
        assert rule.keywords
        for text in spellings(rule.pattern):
            assert re.fullmatch(regex, text), (rule, text)
            assert any(g in f" {text} " for g in license_rules.GATE), (rule, text)
            assert any(f" {k} " in f" {text} " for k in rule.keywords), (rule, text)
    priorities = Counter(r.priority for r in license_rules.rules())
    written = [license_rules.PERMISSIVE, license_rules.RECIPROCAL, license_rules.EXCEPTIONS, license_rules.CONTENT, license_rules.RESTRICTED, license_rules.NOTICES]
    assert sum(map(len, written)) > 250 and priorities[1] > 200


def test_a_scan_without_prefilter_finds_the_same(spark):
    """Every alternative of every rule, between other words, with and without gate and keywords."""
    texts = sorted({f"x {t} y" for rule in license_rules.rules() for t in spellings(rule.pattern, most=1)})
    assert len(texts) > 2000
    table = scratch(docs(spark, texts).repartition(8), "spellings")
    bare = tuple(r._replace(keywords=()) for r in license_rules.rules())
    found, plain = (sorted(tuple(r) for r in license_scan.license_scan(table, rule_set).collect()) for rule_set in (None, bare))
    assert found == plain and all(r[6] and r[7] > 0 for r in found)


def test_hidden_spellings_of_before_and_expressions(spark):
    labelled = {
        "Licensed under the Expat license": "mit", "released under the FreeBSD license": "bsd-2-clause", "see the Berkeley Software Distribution license": "bsd",
        "the Internet Systems Consortium license": "isc", "under the University of Illinois open source license license": "ncsa", "licensed under the PNG license": "libpng",
        "distributed under the Do What The Fuck You Want To Public License": "wtfpl", "available under GPL-3.0-only": "gpl-3.0", "this file is released under the mit": "mit",
        "distributed under gpl 2 0": "gpl-2.0", "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note": "gpl-2.0,linux-syscall-note",
        "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd-3-clause",
        "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa-4.0", "you can redistribute it and/or modify it under the same terms as Perl itself": "artistic-1.0-perl",
    }
    found = license_scan.license_scan(docs(spark, list(labelled))).orderBy("doc_id").collect()
    assert [r["labels"] for r in found] == list(labelled.values()) and all(r["score"] > 0 for r in found)


def test_only_ascii_letters_are_lower_cased_into_words_of_rules(spark):
    """No character beyond ASCII may turn into a letter of a-z; the Kelvin sign would."""
    turned = [c for c in map(chr, range(128, 0x110000)) if not 0xD800 <= ord(c) < 0xE000 and re.search("[a-z]", c.lower())]
    assert turned == ["\u0130", "\u212a"]  # the first also leaves a mark above, which stays a character of the word
    texts = ["M\u0130T license", "apac\u212a license", "MIT \u212aicense", "\u212alicense MIT LICENSE", "É MIT LICENSE é"]
    found = license_scan.license_scan(docs(spark, texts)).orderBy("doc_id").collect()
    for t, r in zip(texts, found, strict=True):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_license(t), t
    kelvin = license_scan.license_scan(docs(spark, ["wor\u212a license mit", "public wor\u212as domain"])).collect()
    assert all(r["labels"] == "" for r in kelvin)


def test_license_scan_repeats_rows_and_takes_nulls_and_long_texts(spark):
    texts = [None, "", "MIT License", "MIT License", "word " * 100_000 + "mit license"]
    found = [tuple(r) for r in license_scan.license_scan(docs(spark, texts, [None, 1, 2, 2, 3])).collect()]
    rows = {r[0]: r for r in found}
    assert len(found) == 5 and sum(r[0] == 2 for r in found) == 2 and rows[2][5:7] == ("mit", "mit")
    assert rows[None][1:] == (0, 0, None, None, "", "", 0.0) and rows[3][1:6] == (100_002, 1, 100_000, 100_000, "mit")


def test_names_that_hold_license_are_found_without_another(spark):
    """Every spelling of such a name, plain, and versions written in one word with their v."""
    plain = {
        "see the Mozilla Public License 2.0": "mpl-2.0", "Eclipse Public License 2.0": "epl-2.0", "Eclipse Public License - v1.0": "epl-1.0",
        "GNU Affero General Public License v3": "agpl-3.0", "Boost Software License": "bsl-1.0", "Apache License v2.0": "apache-2.0",
        "GNU General Public License v2 or later": "gpl-2.0", "LaTeX Project Public License v1.3c": "lppl-1.3c", "The Unlicense": "unlicense",
    }
    named = [(label, text) for label, name, _ in license_rules.FAMILIES for text in spellings(name) if "licen" in text]
    assert len({label for label, _ in named}) > 45
    expected = [*((label, text) for text, label in plain.items()), *named]
    found = license_scan.license_scan(docs(spark, [f"{text}, as written" for _, text in expected])).orderBy("doc_id").collect()
    for (label, text), r in zip(expected, found, strict=True):
        assert label in r["labels"].split(",") and r["score"] >= 0.5, (label, text, r["labels"])
    none = license_scan.license_scan(docs(spark, ["the mit", "apache 2.0 or a license", "creative commons attribution"])).collect()
    assert [r["labels"] for r in none] == ["", "", ""]


def test_row_helper_matches_schema():
    assert len(row(1, "x")) == SCHEMA.count(",") + 1
