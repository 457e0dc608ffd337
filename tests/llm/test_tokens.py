"""Byte-level BPE, token counts and packing against the public libraries."""

import hashlib
import itertools
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from frames import ODD, docs, empty, fuzz, prose
from tokenizers import Tokenizer

from fluviant.llm import byte_bpe, packing, token_counts
from fluviant.llm._classes import library_split, splitter

RANKS, PIECES, JSON = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"))
PATTERN = public_tokenizers.PATTERN
TEXTS = [*ODD, *prose(20), *fuzz(300)]


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(tokens):
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def pack_ids(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_every_token_encodes_as_itself(tokens):
    codec = byte_bpe.Codec(byte_bpe.build_model(tokens), library_split(PATTERN))
    alphabet = byte_bpe.byte_alphabet()
    assert len(set(alphabet)) == 256
    assert codec.sp.encode(["".join(alphabet[b] for b in t) for t in tokens]) == [[i] for i in range(len(tokens))]


def test_encoding_is_the_librarys_and_decodes_to_the_text(spark, library):
    found = byte_bpe.encode_documents(docs(spark, TEXTS), RANKS, PATTERN, with_ids=True).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        text = TEXTS[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(pack_ids(ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_cache_overflow_changes_nothing(tokens, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    codec = byte_bpe.Codec(byte_bpe.build_model(tokens), library_split(PATTERN))
    for t in prose(10):
        assert codec.encode([t]) == [pack_ids(library.encode_ordinary(t))]


def every_code_point(size=4000):
    """Texts that hold each code point alone, beside a letter, a digit, a space and itself."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), size):
        yield "".join(f"a{c}1{c} {c}{c}\n{c}" for c in points[at : at + size])


def test_every_code_point_is_split_and_encoded_as_by_the_library(tokens, library):
    codec = byte_bpe.Codec(byte_bpe.build_model(tokens), library_split(PATTERN))
    for text in every_code_point():
        ids = codec.encode([text])[0]
        assert ids == pack_ids(library.encode_ordinary(text))
        assert codec.decode(ids) == text.encode()


def test_classes_spelled_out_split_alike_and_plain_ones_do_where_engines_agree():
    split = library_split(PATTERN)
    plain, exact = splitter(split._replace(differ="")), splitter(split._replace(plain=split.exact, differ=""))
    assert all(plain(t) == exact(t) for t in [*prose(20), *(t for t in ODD if t)])
    assert library_split("a+|[^a]").differ == "" and splitter(library_split("a+|[^a]"))("aab") == ["aa", "b"]


def test_chunks_keep_order_and_long_texts():
    assert list(byte_bpe.chunks(["a", None, "b" * 10, "c"], 3)) == [["a", ""], ["b" * 10], ["c"]]


def test_counts_are_the_librarys(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {r["doc_id"]: r for r in token_counts.count_tokens(docs(spark, TEXTS), PIECES, limit=100).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        n = len(sp.encode(text or ""))
        assert (found[i]["n_tokens"], found[i]["n_bytes"], found[i]["over_limit"]) == (n, len((text or "").encode()), n > 100)


def test_proof_covers_most_pieces_and_refuses_normalisers(tmp_path):
    proof = token_counts.prove(PIECES)
    assert len(proof.whole) > 30_000
    with open(PIECES, "rb") as f:
        model = f.read()
    from fluviant.llm import _sp_model

    other = b"".join(raw for n, _, raw in _sp_model._fields(model) if n != 3) + _sp_model._field(3, _sp_model._field(3, 1) + _sp_model._field(4, 1))
    path = tmp_path / "other.model"
    path.write_bytes(other)
    with pytest.raises(ValueError, match="not proven"):
        token_counts.prove(str(path))


def ids_of(text):
    return Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids


def test_packing_is_whole_tight_and_gapless(spark):
    texts = [*ODD, *prose(60, words=400), "long " * 5000, "<|endoftext|>" * 3]
    tokenizer = Tokenizer.from_file(JSON)
    expected = {}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        start = 0
        for k, size in enumerate(packing.piece_lengths(len(ids), 64)):
            expected[i, k] = (start, size, zlib.crc32(pack_ids(ids[start : start + size])))
            start += size
        assert start == len(ids)
    found = packing.pack_documents(docs(spark, texts), JSON, PATTERN, capacity=64).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == expected
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.05 * sum(s for _, s, _ in expected.values()) / 64 + 2


def test_long_texts_are_cut_where_no_pre_token_goes_on():
    """Cuts after every few characters, in mixed white space and prose."""
    encoders = [packing.Encoder(open(JSON, encoding="utf-8").read(), PATTERN, longest) for longest in (1, 4, 10**6)]
    tokenizer, rng = Tokenizer.from_file(JSON), np.random.default_rng(3)
    white = ["a \u00a0 \u00a0 b", " \u00a0 \u00a0", "\u00a0 \u00a0 \u00a0 x", "a\n  b\t c \x1c d  ", "  ", "x \u3000 \u2028  \x85 y"]
    white += ["".join(rng.choice([" ", "\u00a0", "\n", "\t", "\x1c", "\u3000", "a", "7", "'s"], 30, p=[0.3, 0.2, 0.1, 0.05, 0.05, 0.05, 0.15, 0.05, 0.05])) for _ in range(3000)]
    for t in [*white, *TEXTS[1:]]:
        ids = pack_ids(tokenizer.encode(t, add_special_tokens=False).ids)
        for encoder in encoders:
            assert "".join(encoder.pieces(t)) == t and encoder.encode([t]) == [ids], repr(t)
    assert len(encoders[1].pieces("word " * 100)) > 50


def test_piece_lengths():
    assert packing.piece_lengths(1, 4) == [1] and packing.piece_lengths(4, 4) == [4]
    assert packing.piece_lengths(5, 4) == [1, 4] and packing.piece_lengths(12, 4) == [4, 4, 4]


def test_best_fit_takes_the_tightest_bin():
    where, offset, fill = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert len(fill) == 2 and sorted(fill) == [10, 10]
    assert packing.best_fit([], 10) == ([], [], [])
    sizes = np.random.default_rng(0).integers(1, 1024, 3000).tolist()
    where, offset, fill = packing.best_fit(sizes, 1024)
    least = max(sum(sizes) / 1024, sum(s > 512 for s in sizes))
    assert max(fill) <= 1024 and len(fill) <= 1.02 * least + 1


def test_rounds_over_many_tasks_keep_every_piece(spark):
    sizes = np.random.default_rng(1).integers(1, 100, 2000).tolist()
    rows = spark.createDataFrame([(i, 0, 0, int(s), 0) for i, s in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    from fluviant.session import scratch

    found = packing.pack(scratch(rows, "rows"), 100, items_per_task=400, fan_in=2).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(2000))
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in b) <= 100 for b in bins.values())
    assert all([o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] for b in bins.values())
    assert len(bins) <= 1.03 * len(packing.best_fit(sizes, 100)[2])


def test_empty_tables_and_repeated_rows(spark):
    assert byte_bpe.encode_documents(empty(spark), RANKS, PATTERN).count() == 0
    assert token_counts.count_tokens(empty(spark), PIECES).count() == 0
    assert packing.pack_documents(empty(spark), JSON, PATTERN).count() == 0
    twice = docs(spark, ["same", "same", "x"], [1, 1, None])
    assert byte_bpe.encode_documents(twice, RANKS, PATTERN).count() == 3
    assert token_counts.count_tokens(twice, PIECES).count() == 3
    assert packing.pack_documents(twice, JSON, PATTERN).count() == 3


@pytest.mark.parametrize("least, most", [(40, 70), (1, 100), (51, 60), (90, 98)])
def test_what_goes_on_packs_as_tight_as_if_every_underfull_bin_went_on(least, most):
    """The rounds without Spark: 64 tasks, merged by fours."""
    rng = np.random.default_rng(least)
    dealt = [rng.integers(least, most + 1, 60).tolist() for _ in range(64)]

    def bins(copies_a_round):
        emitted, tasks, to_come = 0, dealt, 3
        while True:
            handed = []
            for sizes in tasks:
                fill = np.asarray(packing.best_fit(sizes, 100)[2])
                on = packing.goes_on(fill, 99, copies_a_round * to_come)
                emitted += int((~on).sum())
                handed.append(fill[on].tolist())
            if len(tasks) == 1:
                return emitted
            tasks, to_come = [sum(handed[i : i + 4], []) for i in range(0, len(handed), 4)], to_come - 1

    assert bins(4) == bins(10**6)


def test_equal_bins_that_cannot_join_do_not_pile_up():
    fill = np.full(50_000, 60)
    assert packing.goes_on(fill, 99, 24).sum() == 24
    assert packing.goes_on(fill, 99, 0).sum() == 0 and not packing.goes_on(np.array([99, 100]), 99, 24).any()
    assert packing.goes_on(np.array([], np.int64), 99, 24).tolist() == []


def test_packing_takes_the_ids_of_the_library_for_every_code_point_and_all_short_white_space():
    own, library = packing.Encoder(open(JSON, encoding="utf-8").read(), PATTERN), Tokenizer.from_file(JSON)
    texts = [*every_code_point(20_000), *("".join(t) for n in range(1, 7) for t in itertools.product(" \n\t\xa0\u3000a", repeat=n))]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == pack_ids(library.encode(text, add_special_tokens=False).ids), repr(text[:50])


def test_counts_of_every_code_point_are_the_librarys():
    sp, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.Counter(token_counts.prove(PIECES))
    for text in every_code_point(20_000):
        assert own.count([text]) == [len(sp.encode(text))]
