import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpuslens.llm import bpe
from corpuslens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(7)
    letters = [*"aZ09 '\n\t\r.,!<|>_-éßñçİ", " ", " ", "　", "\x1c", "\x85", "日", "本", "Ⅷ", "½", "́",
               "😀", "\U0001f468‍\U0001f469", "\x00", "﻿", "'ll", "'re", "  ", "<|endoftext|>", "the ", "1234"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    return [
        *texts, None, "", " ", "\n\n\n", "a" * 5_000, "ab" * 3_000, " " * 5_000 + "x", "é" * 3_000, "!?" * 3_000,
        "word " * 40_000, "<|endoftext|>", "  <|endoftext|>  <|endoftext|> x", "<|endoftext|", "it's we'll 'tis 's",
    ]


def test_same_ids_and_text_as_the_library(spark, library):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "n", "z") for i, t in enumerate(texts)], "k LONG, text STRING, n STRING, decoded STRING")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, bpe.round_trip(df, PATH).select(*out[0].__fields__).collect()), key=repr)
    assert len(out) == len(texts) and out[0].asDict().keys() == {"k", "text", "n", "ids", "decoded"}
    for r in out:
        ids, text = expected(library, texts[r.k])
        assert np.frombuffer(r.ids, "<u4").tolist() == ids, repr(texts[r.k][:80])
        assert r.decoded == text


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op9_bpe_round_trip"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids, text = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "k LONG, text STRING")
    assert bpe.decode(bpe.encode(df, PATH), PATH).collect() == []


def test_merges_against_a_plain_search():
    rng = random.Random(3)
    merges = {a << 32 | b: (rng.randint(0, 10**6), 10 + a * 10 + b) for a in range(10) for b in range(10)}

    def plain(ids):
        while True:
            found = [(merges[a << 32 | b][0], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in merges]
            if not found:
                return ids
            _, i = min(found)
            ids = ids[:i] + [merges[ids[i] << 32 | ids[i + 1]][1]] + ids[i + 2 :]

    for _ in range(300):
        word = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        assert bpe.merge_piece(word, merges) == plain(word)


def test_trees_side_by_side_give_what_one_tree_gives():
    """Also with few cells at a time, ties in the merges of a piece, and pieces at the limit of the lanes."""
    vocabulary = bpe.Vocabulary.read(PATH)
    rng = random.Random(5)
    words = ["".join(rng.choices("abehinorst é日 .", k=rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33]))) for _ in range(2000)]
    words += ["a" * n for n in range(1, 70)] + ["é" * 32, "é" * 33, "<|endoftext|>", "aa" * 500]
    flat, counts = bpe.encode_pieces(pa.array(words), vocabulary)
    ends = np.cumsum(counts)
    for word, lo, hi in zip(words, ends - counts, ends):
        want = [vocabulary.added[word]] if word in vocabulary.added else bpe.merge_piece(
            [vocabulary.of_byte[b] for b in word.encode()], vocabulary.merges
        )
        assert flat[lo:hi].tolist() == want, word


def test_batches_cut_into_parts(library, monkeypatch):
    monkeypatch.setattr(bpe, "TOKENS_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "LANE_CELLS", 64)
    rows = [[f" word{i % 9}" for i in range(n)] for n in (0, 3, 20, 1, 0, 8)] + [["<|endoftext|>"]]
    vocabulary = bpe.Vocabulary.read(PATH)
    got = list(bpe.encode_rows(pa.array(rows, pa.list_(pa.string())), vocabulary))
    for row, ids in zip(rows, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [i for w in row for i in library.encode(w, add_special_tokens=False).ids]
