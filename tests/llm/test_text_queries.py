"""The registered text queries: whole tables, SQL where there is some, and the pipeline."""

import os

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from fluviant.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")

COLUMNS = {
    1: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    2: {"doc_id", "held_out", "score", "predicted"},
    3: {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    4: {"doc_id", "held_out", "lang_pred", "score"},
    5: {"doc_id", "n_shingles", "component_id", "kept"},
    6: {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    7: {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    8: {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    9: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    10: {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
}


def oracle(name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    return c.execute(queries.ORACLE_SQL[name]).df()


def test_ablations_are_those_of_the_sql(spark):
    found, expected = queries.QUERIES["quality_ablations"](spark, SF_DIR).toPandas(), oracle("quality_ablations")
    columns = sorted(expected.columns)
    a, b = (df[columns].sort_values("rule").reset_index(drop=True) for df in (found, expected))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    assert (a.kept_without >= a.kept_with).all() and a.failed.max() > 0


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n.startswith("op")))
def test_query(spark, name):
    number = int(name[2:].split("_")[0])
    found = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert COLUMNS[number] <= set(found.columns)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    assert set(found.doc_id) == set(docs.doc_id)
    if name in queries.ORACLE_SQL:
        columns = sorted(found.columns)
        a, b = (df[columns].sort_values("doc_id").reset_index(drop=True) for df in (found, oracle(name)))
        pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "exact dedup", "near dedup", "packing"]
    before = docs.count()
    from fluviant.session import scratch

    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()
    texts = docs.toPandas().text
    assert texts.is_unique


def test_pipeline_matches_a_replay_in_plain_python(spark):
    """Each stage once more, one text after the other, on what the replay itself has kept."""
    import re
    import zlib

    import numpy as np
    import public_tokenizers
    from test_classify import brute_present, brute_word_scores
    from test_copies import brute_components, norm
    from test_tokens import pack_ids
    from tokenizers import Tokenizer

    from fluviant.llm import langid, packing, toxicity

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in table.collect()}
    model = langid.learn(table)
    known = {}

    def language_holds(text):
        words = langid.letters((text or "").lower())
        if not words:
            return False
        scores = np.array([known[w] if w in known else known.setdefault(w, brute_word_scores(model, w)) for w in words])
        path, best, back = [], np.zeros(len(model.langs)), []
        for k, row in enumerate(scores):
            jump = best.max() - model.penalty
            back.append([s if k == 0 or best[s] >= jump else int(best.argmax()) for s in range(len(best))])
            best = (np.maximum(best, jump) if k else best) + row
        path = [int(best.argmax())]
        for k in range(len(words) - 1, 0, -1):
            path.append(back[k][path[-1]])
        mass = np.zeros(len(model.langs))
        for w, s in zip(words, reversed(path), strict=True):
            mass[s] += len(w) * bool(known[w].any())
        return mass.max() / sum(map(len, words)) >= 0.3

    docs = {i: t for i, t in docs.items() if language_holds(t)}
    kept = table.where(table.doc_id.isin(list(docs)))
    judge = toxicity.learn(kept, spark.read.parquet(f"{SF_DIR}/labels.parquet"))

    def clean(text):
        present = sorted(judge.features[h] for h in brute_present(text) if h in judge.features)
        z = judge.bias + sum(float(judge.weight[f]) for f in present) + sum(float(judge.factor[a] @ judge.factor[b]) for k, a in enumerate(present) for b in present[k + 1 :])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))) < 0.3

    docs = {i: t for i, t in docs.items() if clean(t)}
    first = {}
    for i in sorted(docs):
        first.setdefault(norm(docs[i]), i)
    docs = {i: docs[i] for i in first.values()}
    component = brute_components(list(docs.values()), list(docs), 80)
    docs = {i: t for i, t in docs.items() if component[i] == i}
    tokenizer, expected = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    for i, t in docs.items():
        ids, start = tokenizer.encode(t, add_special_tokens=False).ids + [2], 0
        for k, size in enumerate(packing.piece_lengths(len(ids), 1024)):
            expected[i, k] = (start, size, zlib.crc32(pack_ids(ids[start : start + size])))
            start += size
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == expected
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 1024
    assert len(docs) < table.count() and re.fullmatch(r"\d+", str(len(places)))


def test_stages_with_nulls_and_repeated_rows(spark):
    """Null ids and texts, rows that repeat, an extra column that clashes."""
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("h", F.lit("x"))
    some = table.limit(30)
    odd = table.unionByName(some).unionByName(some.withColumn("text", F.lit(None).cast("string"))).unionByName(some.withColumn("doc_id", F.lit(None).cast("long")))
    from fluviant.session import scratch

    docs = scratch(odd, "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch(stage(spark, docs, SF_DIR), "odd-stage")
        assert docs.columns == odd.columns and docs.count() > 0 and docs.where("h is null").isEmpty()
        assert name != "language" or docs.where("text is null").isEmpty()
    assert docs.count() == docs.select("text").distinct().count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.where("piece = 0").count() == docs.count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
