"""Language identification, toxicity and quality rules."""

import zlib

import numpy as np
import pytest
from frames import ODD, SCHEMA, docs, empty, prose, row
from pyspark.sql import functions as F

from fluviant.llm import langid, quality, toxicity

STEMS = {"xa": "aeiou", "yb": "bdfgkm"}


def language_table(spark, n=120):
    """Two Latin languages with letters of their own, and one Cyrillic."""
    rows = []
    for i in range(n):
        k = i % 3
        base = prose(1, seed=i, words=30)[0]
        text = (base.translate(str.maketrans("aeiou", "áéíóú")), base.translate(str.maketrans("lnrst", "kvzpj")), "".join(chr(0x430 + ord(c) % 32) if c.isalpha() else c for c in base))[k]
        rows.append(row(i, text, ("aa", "bb", "cc")[k]))
    return spark.createDataFrame(rows, SCHEMA)


def test_languages_are_learnt_and_held_out(spark):
    table = language_table(spark)
    model = langid.learn(table)
    assert model.langs == ("aa", "bb", "cc")
    found = langid.identify(table, model).join(table.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert len(found) == 120
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert np.mean([r["lang_pred"] == r["truth"] for r in found if r["held_out"]]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_every_language_is_learnt(spark):
    """More languages than two hundred, the last ones rare."""
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(230)]
    rows = [(f"{name}q{name}z ", name) for k, name in enumerate(names) for _ in range(8 if k < 200 else 6)]
    table = spark.createDataFrame([row(i, text * 20, name) for i, (text, name) in enumerate(rows)], SCHEMA)
    model = langid.learn(table)
    assert model.langs == tuple(names)
    found = langid.identify(table, model).join(table.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert len(found) == len(rows) and np.mean([r["lang_pred"] == r["truth"] for r in found]) > 0.98


def test_held_out_labels_are_not_read(spark):
    table = language_table(spark)
    odd = table.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert langid.learn(odd).langs == ("aa", "bb", "cc")


def test_mixed_text_falls_into_spans(spark):
    table = language_table(spark)
    model = langid.learn(table)
    texts = {r["lang"]: r["text"] for r in table.collect()}
    mixed = texts["aa"] + " " + texts["cc"]
    r = langid.identify(docs(spark, [mixed]), model, with_spans=True).first()
    assert [s["lang"] for s in r["spans"]] == ["aa", "cc"]
    assert sum(s["words"] for s in r["spans"]) == len(mixed.split()) and 0.3 < r["score"] < 0.7


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 5, 7, 3, 0, 6])
    scores = rng.normal(0, 2, (lengths.sum(), 3)).astype(np.float32)
    found = langid.viterbi(scores.copy(), lengths, 2.5)
    at = 0
    for n in lengths:
        best = None
        for path in np.ndindex(*[3] * n):
            total = sum(scores[at + t, s] for t, s in enumerate(path)) - 2.5 * sum(a != b for a, b in zip(path, path[1:]))
            if best is None or total > best[0]:
                best = (total, path)
        own = found[at : at + n]
        total = sum(scores[at + t, s] for t, s in enumerate(own)) - 2.5 * sum(a != b for a, b in zip(own, own[1:]))
        assert total == pytest.approx(best[0], abs=1e-4)
        at += n


def test_language_of_odd_texts(spark):
    model = langid.learn(language_table(spark))
    found = {r["doc_id"]: r for r in langid.identify(docs(spark), model).collect()}
    for i, t in enumerate(ODD):
        if not any(c.isalpha() for c in t or ""):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
        else:
            assert found[i]["lang_pred"] in model.langs
    assert langid.identify(empty(spark), model).count() == 0
    nothing = langid.learn(empty(spark))
    assert nothing.langs == () and {r["lang_pred"] for r in langid.identify(docs(spark), nothing).collect()} == {"und"}
    kept = langid.keep_identified(docs(spark), model)
    assert kept.columns == docs(spark).columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.3}
    assert langid.identify(docs(spark, ["² ½ 3 _", "x²"]), model).where("doc_id = 0").first()["lang_pred"] == "und"


def toxic_table(spark, n=400):
    """An insult alone is harmless and so is a group alone; both together are toxic."""
    rows, labels = [], []
    for i, text in enumerate(prose(n, seed=5)):
        kind = i % 4
        extra = ("", " dolt", " grumblers", " dolt grumblers")[kind]
        rows.append(row(i, text + extra))
        if i % 10:
            labels.append((i, 1, int(kind == 3)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pairs_of_terms_are_learnt(spark):
    table, labels = toxic_table(spark)
    model = toxicity.learn(table, labels)
    found = toxicity.score_documents(table, model).join(labels, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found)


def test_machine_learns_what_a_sum_cannot():
    rows = [np.array(r, np.int64) for r in ([], [1], [0], [0, 1])] * 50
    y = np.array([len(r) == 1 for r in rows], np.float32)
    b, w, v = toxicity._fit(rows, y, 2, np.ones(len(y)), 4, steps=800)
    model = toxicity.Model({0: 0, 1: 1}, b, w, v)
    assert [model.score(p) > 0.5 for p in ([], [1], [0], [0, 1])] == [False, True, True, False]


def brute_present(text):
    """Hashed terms of a text by the definition: words and beginnings, at each level reached."""
    import re

    times = {}
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        for t in [w] + [w[:n] + "*" for n in (4, 5, 6, 7) if len(w) >= n]:
            times[t] = times.get(t, 0) + 1
    return {toxicity.at_level(zlib.crc32(t.encode()), level) for t, n in times.items() for level in (1, 2, 4) if n >= level}


def test_scores_match_brute_force(spark):
    """Terms found one by one, and every pair's inner product, against the operator."""
    table, labels = toxic_table(spark)
    model = toxicity.learn(table, labels)
    texts = [*ODD, *prose(20, seed=5), "dolt", "dolt grumblers", "Dolt dolt DOLT dolt grumblers grumblers", "doltish grumblersome"]
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        present = sorted(model.features[h] for h in brute_present(t) if h in model.features)
        z = model.bias + sum(float(model.weight[f]) for f in present)
        z += sum(float(model.factor[a] @ model.factor[b]) for k, a in enumerate(present) for b in present[k + 1 :])
        assert found[i] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-4), t


def test_term_counts_match_brute_force(spark):
    texts = [*ODD, *prose(30, seed=3), *prose(5, seed=3)]
    table = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, toxic int").repartition(3)
    counted = table.mapInArrow(toxicity._count_terms, "term long, pos long, n long, word long").groupBy("term").agg(F.sum("pos"), F.sum("n"), F.max("word")).collect()
    expected, whole = {}, {zlib.crc32(w.encode()) for t in texts for w in toxicity.words((t or "").lower())}
    for i, t in enumerate(texts):
        for h in brute_present(t):
            p, n = expected.get(h, (0, 0))
            expected[h] = (p + i % 2, n + 1)
    assert {r[0]: (r[1], r[2], r[3]) for r in counted} == {h: (*v, int(h in whole)) for h, v in expected.items()}


def test_the_sample_is_the_smallest_hashes(spark):
    ids = spark.range(3000)
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    expected = [r[0] for r in ids.orderBy(place, "id").limit(200).collect()]
    assert sorted(r[0] for r in toxicity._sample(ids, 3000, 200).collect()) == sorted(expected)
    assert toxicity._sample(ids, 3000, 5000).count() == 3000


def test_partners_match_the_definition():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(300)]
    y = np.array([int(0 in r and 1 in r) or int(rng.random() < 0.05) for r in rows])
    expected = set()
    for a in range(12):
        for b in range(a + 1, 12):
            both = [i for i in range(300) if a in rows[i] and b in rows[i]]
            p, q = sum(y[i] for i in both), sum(1 - y[i] for i in both)
            z = []
            for c in (a, b):
                m, n = sum(y[i] for i in range(300) if c in rows[i]), sum(1 - y[i] for i in range(300) if c in rows[i])
                share = (p + q) / max(m + n, 1)
                z.append((p / m - q / n) / (share * (1 - share) * (1 / m + 1 / n)) ** 0.5 if m and n else 0)
            if p >= 4 and min(z) > 3:
                expected |= {a, b}
    assert set(toxicity.partners(rows, y, 12, 3.0, 4).tolist()) == expected and {0, 1} <= expected
    assert toxicity.partners([], np.zeros(0), 0).tolist() == [] and toxicity.partners([np.zeros(0, np.int64)], np.ones(1), 3).tolist() == []


def test_a_rare_pair_of_words_that_are_neutral_alone_is_learnt(spark):
    """A pair in under one of a hundred texts; each of its words is as frequent in clean texts."""
    rows, labels = [], []
    for i, text in enumerate(prose(2400, seed=7, words=20)):
        kind = i % 120
        toxic = kind < 12
        extra = " glibber wuzzle" if kind == 0 else " vilest" if toxic else (" glibber" if kind % 12 == 1 else " wuzzle" if kind % 12 == 2 else "")
        rows.append(row(i, text + extra))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.learn(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    glibber, wuzzle = (model.features.get(zlib.crc32(w)) for w in (b"glibber", b"wuzzle"))
    assert glibber is not None and wuzzle is not None
    probes = ["glibber wuzzle", "glibber", "wuzzle", "vilest", ""]
    scores = [r["score"] for r in toxicity.score_documents(docs(spark, [prose(1, seed=99, words=20)[0] + " " + p for p in probes]), model).orderBy("doc_id").collect()]
    assert scores[0] > 0.3 and scores[3] > 0.3 and max(scores[1], scores[2], scores[4]) < 0.1, scores


def test_repeated_and_null_rows_of_classifiers(spark):
    table, labels = toxic_table(spark)
    model = toxicity.learn(table.unionByName(table), labels)
    texts, ids = ["dolt grumblers", "dolt grumblers", None, None, ""], [3, 3, None, 5, 6]
    found = toxicity.score_documents(docs(spark, texts, ids), model).collect()
    assert len(found) == 5 and len({r["score"] for r in found if r["doc_id"] == 3}) == 1
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)
    assert len({r["score"] for r in found if r["doc_id"] != 3}) == 1  # null and empty score as the bias
    assert toxicity.keep_clean(docs(spark, texts, ids), model).count() == (5 if found[0]["predicted"] == 0 else 3)
    langs = langid.learn(language_table(spark))
    named = langid.identify(docs(spark, ["ab", "ab", None], [1, 1, None]), langs).collect()
    assert len(named) == 3 and sum(r["doc_id"] == 1 for r in named) == 2
    measured = quality.ledger(docs(spark, ["a b", "a b", None], [1, 1, None])).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"]) for r in measured) == [(-1, 0), (1, 2), (1, 2)]


def brute_word_scores(model, word):
    """Half of the sums of the 3- and 4-grams, relative to the best language of the word's script."""
    padded = [10, *map(ord, word), 10]
    total = np.zeros(len(model.langs))
    for n in (3, 4):
        for i in range(len(padded) - n + 1):
            h = np.uint32(0x9E3779B1)
            for c in padded[i : i + n]:
                h = np.uint32((int(h) ^ c) * 0x85EBCA6B & 0xFFFFFFFF)
                h = np.uint32(int(h) ^ int(h) >> 15)
            total += 0.5 * model.log_p[(int(h) >> 5) & (langid.BUCKETS - 1)]
    script = langid.SCRIPT_NAMES.index([name for at, name in langid.SCRIPTS if at <= ord(word[0])][-1])
    uses = model.uses[script]
    if not uses.any():
        return np.zeros(len(model.langs))
    total[~uses] = -np.inf
    return np.maximum(total - total.max(), langid.NOT_ITS_SCRIPT)


def test_languages_match_brute_force(spark):
    """Scores of words, the best path and the language of most letters, one word after the other."""
    model = langid.learn(language_table(spark))
    base = {r["lang"]: r["text"] for r in language_table(spark).collect()}
    texts = [*(t for t in ODD if t and len(t) < 100), *base.values(), " ".join(w for t in zip(*(t.split() for t in base.values())) for w in t), base["aa"][:60] + " " + base["cc"][:30], "ελλα 12 " + base["bb"][:20]]
    found = {r["doc_id"]: r for r in langid.identify(docs(spark, texts), model, with_spans=True).collect()}
    for i, t in enumerate(texts):
        words = langid.letters(t.lower())
        scores = np.array([brute_word_scores(model, w) for w in words]).reshape(len(words), len(model.langs))
        best, back = np.zeros(len(model.langs)), []
        for k, row_scores in enumerate(scores):
            jump = best.max() - model.penalty
            back.append([s if k == 0 or best[s] >= jump else int(best.argmax()) for s in range(len(best))])
            best = np.maximum(best, jump if k else best) + row_scores
        path = [int(best.argmax())] if words else []
        for k in range(len(words) - 1, 0, -1):
            path.insert(0, back[k][path[0]])
        mass = np.zeros(len(model.langs))
        for w, s, row_scores in zip(words, path, scores, strict=True):
            mass[s] += len(w) * bool(row_scores.any())
        expected = ("und", 0.0) if not words else (model.langs[int(mass.argmax())], mass.max() / sum(map(len, words)))
        assert found[i]["lang_pred"] == expected[0] and found[i]["score"] == pytest.approx(expected[1]), t
        assert sum(s["words"] for s in found[i]["spans"]) == len(words)


def test_ties_of_languages_go_to_the_first_by_name():
    log_p = np.zeros((langid.BUCKETS, 2), np.float32)
    model = langid.Model(("aa", "bb"), log_p, np.ones((len(langid.SCRIPT_NAMES), 2), bool), 12.0)
    assert langid.Labeller(model).label(["same same", ""])[0][0] == "aa"


def test_toxicity_of_odd_texts_and_missing_labels(spark):
    table, labels = toxic_table(spark)
    model = toxicity.learn(table, labels)
    found = toxicity.score_documents(docs(spark), model)
    assert found.count() == len(ODD) and found.where("score is null").isEmpty()
    none = toxicity.learn(table, labels.where("toxic = 0"))
    assert none.features == {} and toxicity.score_documents(docs(spark), none).select("score").distinct().count() == 1
    assert toxicity.learn(empty(spark), labels.limit(0)).features == {}
    assert toxicity.score_documents(empty(spark), model).count() == 0
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 0, 0)], labels.schema))
    assert toxicity.learn(table, odd).features
    kept = toxicity.keep_clean(table, model)
    assert kept.columns == table.columns


def brute_measures(text):
    import re

    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_measures_match_brute_force(spark):
    texts = [t if t is None or len(t) < 2000 else t[:1500] for t in ODD]
    texts += ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "l1 x\nl1 x\n\n\nl1 x\r\n l1 x", "# * $ | < > & %", *prose(10, vocabulary=3, words=60)]
    found = {r["doc_id"]: r for r in quality.ledger(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert tuple(found[i][m] for m in quality.MEASURES[:5]) == brute_measures(t), t


def test_policies_and_ablations(spark):
    texts = ["good words " + prose(1, seed=i)[0] + " " + prose(1, seed=i + 50)[0] for i in range(5)] + ["short", "### " * 30, "same line here\n" * 20, None]
    table = quality.ledger(docs(spark, texts))
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.verdicts(table).collect()}
    assert all(kept[i] == (False, True) for i in range(5)) and kept[5] == (True, False) and kept[8] == (True, False)
    assert all(not k for b, k in kept.values() if b)
    rows = {r["rule"]: r for r in quality.ablations(table).collect()}
    n_kept = sum(k for _, k in kept.values())
    assert set(rows) == set(quality.POLICIES[quality.CURRENT]) and all(r["kept_with"] == n_kept and r["kept_without"] == n_kept + r["only_by_rule"] for r in rows.values())
    assert quality.ledger(empty(spark)).count() == 0
