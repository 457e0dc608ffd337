"""Small document tables with every odd case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, score string, n_tokens string, `labels` string, h string, id string, words string, bands string, v string, size string, __pos string"

ODD = [None, "", " ", "\n\t ", "a", "A", "é", "…", "1 2 3", "x" * 5000, "word " * 3000, "  two  spaces  ", "<s> </s> <unk> <|endoftext|>", "中文 と かな", "\x00\x01\x1f", "naïve façade №5", "tab\tand\nline\r\nends", "🙂🙃"]


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src", None if text is None else len(text), 1, "s", "t", "l", "h", "i", "w", "b", "v", "z", "p")


def docs(spark, texts=None, ids=None):
    """A table of texts, by default the odd ones, with ids from 0 or as given."""
    texts = ODD if texts is None else texts
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([row(i, t) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(n, seed=0, words=40, vocabulary=400):
    """n texts of made-up words."""
    rng = random.Random(seed)
    known = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(known) for _ in range(rng.randint(words // 2, words))) for _ in range(n)]


def fuzz(n, seed=0):
    """n texts of odd characters, white space and special strings."""
    rng = random.Random(seed)
    chars = [chr(c) for c in (*range(0x250), 0x2581, 0x2028, 0x3000, 0x85, 0x4E2D, 0x1F600, 0x200D, 0x300, 0x10FFFF, 0x660)]
    chars += [" "] * 150 + ["\n"] * 40 + list("etaoin's") * 15 + ["<|endoftext|>", "<s>"] * 5
    return ["".join(rng.choices(chars, k=rng.randint(0, 50))) for _ in range(n)]
