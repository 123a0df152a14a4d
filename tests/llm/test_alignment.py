import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpuslens.llm import alignment
from corpuslens.llm.bpe import byte_letters
from corpuslens.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """The contract over whole texts, by both libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: i for i, c in enumerate(byte_letters())}
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        x_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        y_bytes = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in y
        ]
        if not text or b"".join(x_bytes) != whole or b"".join(y_bytes) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        x_end, y_end = np.cumsum(list(map(len, x_bytes))).tolist(), np.cumsum(list(map(len, y_bytes))).tolist()
        cuts = sorted(set(x_end) & set(y_end))
        x_at, y_at = ({e: k + 1 for k, e in enumerate(ends)} | {0: 0} for ends in (x_end, y_end))
        links = [(x[x_at[e] - 1], y[y_at[e] - 1]) for e in cuts]
        counts.update(links)
        groups = [
            ",".join(map(str, x[x_at[lo] : x_at[hi]])) + "|" + ",".join(map(str, y[y_at[lo] : y_at[hi]]))
            for lo, hi in zip([0, *cuts], cuts)
        ]
        found.append((doc_id, x, y, links, groups))
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    rows = [
        (
            doc_id, len(x), len(y), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links),
            sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, x, y, links, groups in found
    ]
    return rows, counts


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


TEXTS = [
    "Hello world, don't  stop", " leading", "trailing ", "trailing  ", " ", "   ", "\n", "a\n b\t c", "x\n\n  y", "<|endoftext|>",
    "<s> </s> <0x41> <unk>", "marked ▁ twice", "漢字 かな é́ 🙂🙂 　 x", "a  b   c", "\x1c \x1f q", "Ａ１ 12345 3.14",
    None, "", "Hello world, don't  stop", "'s 's it's", "\r\n a \x00 b",
]


def test_edge_cases_against_whole_texts(spark):
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id LONG, text STRING, pair INT, chunk STRING").repartition(3)
    out = alignment.alignment(df, A, B)
    assert sorted_rows(out.collect()) == sorted_rows(brute(rows)[0])


def test_small_chunks_dense_bitmaps_and_planes(spark, monkeypatch):
    rows = [(i, "the same words " * (1 + i % 5) + str(i)) for i in range(300)]
    for name, value in (("CHUNK_ENTRIES", 100), ("TEXT_BYTES", 3000)):
        monkeypatch.setattr(alignment, name, value)
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(2)
    got = alignment.bitmaps(np.arange(100) << alignment.SLOT_BITS | 7, np.arange(100) % 9 + 1)
    assert {p for p, _, _ in got} == {0, 1, 2, 3, 4}
    assert sorted_rows(alignment.alignment(df, A, B).collect()) == sorted_rows(brute(rows)[0])


def test_dense_bitmaps(spark):
    rows = [(i, "and so and") for i in range(alignment.DENSE + 100)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").coalesce(1)
    index = alignment.build_index(df, A, B)
    want = brute(rows)
    counts = {(r.a_id, r.b_id): (r.docs, r.links) for r in alignment.pair_counts(index).collect()}
    assert {k: v[1] for k, v in counts.items()} == want[1]
    assert {v[0] for v in counts.values()} == {len(rows)}
    assert index.postings.filter(f"octet_length(bits) = {alignment.DENSE_BYTES}").count() > 0
    assert sorted_rows(alignment.alignment(df, A, B).collect()) == sorted_rows(want[0])


def test_long_text_is_read_whole(spark):
    text = "wörd " * 120_000 + "x" * 30_000
    df = spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")
    (r,) = alignment.alignment(df, A, B).collect()
    a = Tokenizer.from_file(A)
    assert r.n_a == len(a.encode(" " + text, add_special_tokens=False).ids)
    assert r.n_b == len(sentencepiece.SentencePieceProcessor(model_file=B).encode(text))


def test_empty_table(spark):
    assert alignment.alignment(spark.createDataFrame([], "doc_id LONG, text STRING"), A, B).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_registered_query_against_brute_force(spark, folder):
    where = f"/root/testdata/{folder}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    out = QUERIES["op11_pair_bitmaps"](spark, where)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted_rows(out.collect()) == sorted_rows(brute(rows)[0])
