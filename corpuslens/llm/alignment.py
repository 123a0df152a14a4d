"""Alignment of two tokenizers over a corpus through inverted bitmaps of id pairs.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces with byte
fallback) the text, before which it sets a space itself; special tokens are plain text. A
byte offset where a token of either side ends closes a group, and the two tokens that end
there are a link. Neither side joins letters across a space that follows something other
than white space, so texts are cut there and every distinct unit is encoded once a task.

The index is inverted. Documents stand in chunks of at most ``CHUNK_DOCS`` slots. For an id
pair and a chunk it holds a compressed bitmap of the documents with that link (plane 0; the
batches of a chunk are merged by OR) and planes with the bits of multiplicity - 1 (plane p
weighs ``2 ** (p - 1)``). A bitmap is a sorted list of 16-bit slots below ``DENSE`` members,
else 4,096 bytes of bits. Population counts of plane 0 give a pair's documents, weighted
counts of all planes its links; chunks are disjoint, so counts add up. The postings then
carry the corpus-wide figures of their pair back to the chunks, where they are summed by slot.

Shuffled are bitmaps and counts, never a row per link. A pair that stands in every document
has as many posting rows as there are chunks and planes, no more; a chunk is summed in a
stream with two numbers a slot.

Defined cases: a null or empty text, and a text that either side does not give back byte by
byte, has no tokens: all counts 0 and an empty digest. Every row counts as a document of its
own, repeated rows and null ids too. An empty table gives an empty result. Columns other than
the id and the text are not read. A unit without a space is encoded whole, however long.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.bpe import byte_letters, gather
from corpuslens.llm.words import slices
from corpuslens.session import materialise

SLOT_BITS = 15
CHUNK_DOCS = 1 << SLOT_BITS
CHUNK_ENTRIES = 2_000_000  # pairs of a document that a task holds at most before it closes a chunk
DENSE = 2048
DENSE_BYTES = CHUNK_DOCS // 8
CACHED_UNITS, CACHED_BYTES = 200_000, 16 << 20  # of a task
ROWS_AT_ONCE = 100_000
TEXT_BYTES = 2 << 20
BLOB = 1 << 16  # characters of new units that are encoded at once

BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
SPACE_BEFORE_SPACE = re.compile(r"\s ")


class Pair:
    """Both tokenizers in a task, from the contents of their files."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = {c: byte for byte, c in enumerate(byte_letters())}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece)
        self.b_bytes = [self._of_piece(i) for i in range(self.b.get_piece_size())]
        self.width = len(self.b_bytes)
        self.lone_space = self.b.piece_to_id("▁")
        self.joins_words = any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.width))
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # What a token adds to the written groups: its id and the mark after it, by id, side, and whether it ends its part.
        self.written = [f"{i}{mark}".encode() for i in range(len(self.a_bytes)) for mark in ",|"]
        self.written += [f"{i}{mark}".encode() for i in range(self.width) for mark in ",;"]
        self.written_sizes = np.array(list(map(len, self.written)))

    def _of_piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def keys(self, text: str) -> list[str]:
        """Units of a space and ``text``, each without the space it begins with."""
        if self.joins_words:
            return [text]
        if text[0] == " " or text[-1].isspace() or SPACE_BEFORE_SPACE.search(text):
            return [u[1:] for u in BEFORE_SPACE.split(" " + text)]
        return text.split(" ")

    def alone(self, key: str) -> tuple[list[int], list[int]]:
        """Ids of A and B for one unit; the empty key is a space that ends a text."""
        a = self.a.encode(" " + key, add_special_tokens=False).ids
        return a, self.b.encode(key) if key else [self.lone_space]

    def aligned(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> Aligned | None:
        """Ids of both sides of some units, end to end, that close at the bytes ``ends``; None if one does not."""
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        groups = np.searchsorted(cuts, ends) + 1
        if len(cuts) < groups[-1] or (cuts[groups - 1] != ends).any():
            return None
        a_upto, b_upto = np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1
        # Each group's tokens of A, then its tokens of B.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        codes = np.empty(len(a) + len(b), np.int64)
        ahead = np.concatenate([[0], b_upto])
        codes[np.arange(len(a)) + ahead[a_group]] = 2 * a + (a_ends == cuts[a_group])
        codes[np.arange(len(b)) + a_upto[b_group]] = 2 * (len(self.a_bytes) + b) + (b_ends == cuts[b_group])
        text = b"".join(map(self.written.__getitem__, codes.tolist()))
        upto = np.cumsum(self.written_sizes[codes])[(a_upto + b_upto)[groups - 1] - 1].tolist()
        texts = [text[lo : hi - 1] for lo, hi in zip([0, *upto], upto)]
        sizes = np.diff(np.stack([a_upto[groups - 1], b_upto[groups - 1], groups]), axis=1, prepend=0)
        return Aligned(texts, sizes.T, a[a_upto - 1].astype(np.int64) * self.width + b[b_upto - 1])


@dataclass
class Aligned:
    """Units' groups written out, their numbers of tokens of A and B and of links, and the links as id pairs."""

    groups: list[bytes]
    sizes: np.ndarray
    links: np.ndarray


class Units:
    """What each unit met so far contributes to a text; emptied when it grows too large."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.sizes = array("q")  # tokens of A, tokens of B, links, 1 if bytes are lost
        self.links = array("q")
        self.held = 0

    def learn(self, keys: list[str]) -> None:
        """Know all of ``keys``, which come from one batch."""
        if len(self.place) > CACHED_UNITS or self.held > CACHED_BYTES:
            self.clear()
        missing = [k for k in dict.fromkeys(keys) if k not in self.place]
        plain = [k for k in missing if k and " " not in k and not k[-1].isspace()]
        for key in set(missing).difference(plain):
            self._learn_alone(key)
        at = 0
        while at < len(plain):
            to, held = at, 0
            while to < len(plain) and held < BLOB:
                held += len(plain[to]) + 1
                to += 1
            self._learn_joined(plain[at:to])
            at = to

    def _learn_joined(self, keys: list[str]) -> None:
        """Learn units from one text of all of them: either side cuts it where a unit ends."""
        blob = " " + " ".join(keys)
        whole = blob.encode()
        a = np.array(self.pair.a.encode(blob, add_special_tokens=False).ids)
        b = np.array(self.pair.b.encode(blob[1:]))
        same = all(b"".join(map(t.__getitem__, x.tolist())) == whole for t, x in ((self.pair.a_bytes, a), (self.pair.b_bytes, b)))
        ends = np.append(np.flatnonzero(np.frombuffer(whole, np.uint8)[1:] == 32) + 1, len(whole))
        found = self.pair.aligned(a, b, ends) if same else None
        if found is None:
            for key in keys:
                self._learn_alone(key)
            return
        self._add(keys, found.groups, found.sizes, found.links)
        self.held += len(whole)

    def _learn_alone(self, key: str) -> None:
        whole = b" " + key.encode()
        a, b = self.pair.alone(key)
        lost = any(b"".join(map(t.__getitem__, x)) != whole for t, x in ((self.pair.a_bytes, a), (self.pair.b_bytes, b)))
        if lost:
            self._add([key], [b""], np.array([[len(a), len(b), 0]]), np.zeros(0, np.int64), 1)
        else:
            found = self.pair.aligned(np.array(a), np.array(b), np.array([len(whole)]))
            self._add([key], found.groups, found.sizes, found.links)
        self.held += len(whole)

    def _add(self, keys: list[str], groups: list[bytes], sizes: np.ndarray, links: np.ndarray, lost: int = 0) -> None:
        first = len(self.groups)
        self.place.update(zip(keys, range(first, first + len(keys))))
        self.groups += groups
        self.sizes.frombytes(np.insert(sizes, 3, lost, axis=1).astype(np.int64).tobytes())
        self.links.frombytes(links.tobytes())
        self.held += sum(map(len, groups)) + 8 * len(links)


@dataclass
class Read:
    """A batch of documents: counts and digest of each, and its distinct pairs ``pair << SLOT_BITS | row``."""

    sizes: np.ndarray  # a row per document: tokens of A, tokens of B, links
    digests: list[str]
    entries: np.ndarray
    times: np.ndarray


def read_texts(texts: list[str | None], units: Units) -> Read:
    """Encode and align whole texts, at most ``CHUNK_DOCS`` of them."""
    keys = [units.pair.keys(t) if t else [] for t in texts]
    flat = [k for row in keys for k in row]
    units.learn(flat)
    index = np.fromiter(map(units.place.__getitem__, flat), np.int64, len(flat))
    ends = np.concatenate([[0], np.cumsum([len(row) for row in keys])]).astype(np.int64)
    table = np.array(units.sizes, np.int64).reshape(-1, 4)
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(table[index], axis=0)])
    sizes = sums[ends[1:]] - sums[ends[:-1]]
    whole = (sizes[:, 3] == 0) & (sizes[:, 0] > 0)
    sizes = np.where(whole[:, None], sizes[:, :3], 0)
    places = index.tolist()
    digests = [
        hashlib.sha256(b";".join(map(units.groups.__getitem__, places[lo:hi]))).hexdigest() if ok else ""
        for lo, hi, ok in zip(ends[:-1], ends[1:], whole)
    ]
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    used = whole[row]
    links, cuts = gather(np.array(units.links, np.int64), table[:, 2], index[used])
    entries = links << SLOT_BITS | np.repeat(row[used], np.diff(cuts))
    return Read(sizes, digests, *np.unique(entries, return_counts=True))


def bitmaps(entries: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """``(plane, pairs, bitmaps)`` of a chunk from its sorted entries and their multiplicities."""
    plane = 0
    while True:
        some = entries if plane == 0 else entries[(times - 1) >> (plane - 1) & 1 == 1]
        if plane and not len(some):
            if not ((times - 1) >> plane).any():
                return
            plane += 1
            continue
        pairs, first, members = np.unique(some >> SLOT_BITS, return_index=True, return_counts=True)
        slots = (some & (CHUNK_DOCS - 1)).astype("<u2")
        dense = members >= DENSE
        if (~dense).any():
            kept = slots[np.repeat(~dense, members)]
            ends = np.concatenate([[0], np.cumsum(2 * members[~dense])]).astype(np.int32)
            buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())]
            yield plane, pairs[~dense], pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)
        if dense.any():
            packed = []
            for at, n in zip(first[dense], members[dense]):
                bits = np.zeros(CHUNK_DOCS, np.uint8)
                bits[slots[at : at + n]] = 1
                packed.append(np.packbits(bits).tobytes())
            yield plane, pairs[dense], pa.array(packed, pa.binary())
        plane += 1
        if not ((times - 1) >> (plane - 1)).any():
            return


@dataclass(frozen=True)
class Index:
    """``documents(chunk, slot, id, n_a, n_b, n_links, groups_sha256)`` and ``postings(chunk, pair, plane, bits)``.

    ``pair`` is ``a * width + b``.
    """

    documents: DataFrame
    postings: DataFrame
    width: int


def build_index(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Encode every text once and write the inverted index."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = f.read(), g.read()
    width = Pair(*files).width
    shared = spark.sparkContext.broadcast(files)  # two vocabulary files, fixed by their paths
    kind = docs.schema[doc_id].dataType
    schema = (
        f"chunk BIGINT, slot INT, id {kind.simpleString()}, n_a BIGINT, n_b BIGINT, n_links BIGINT, "
        "groups_sha256 STRING, pair BIGINT, plane INT, bits BINARY"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(Pair(*shared.value))
        chunk = TaskContext.get().partitionId() << 32
        slot, entries, times, names, kinds = 0, [], [], [], []

        def table(n: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["chunk"] = pa.array(np.full(n, chunk))
            return pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds)], names=names
            )

        def closed() -> Iterator[pa.RecordBatch]:
            found = np.concatenate([*entries, np.zeros(0, np.int64)])
            order = np.argsort(found, kind="stable")
            for plane, pairs, bits in bitmaps(found[order], np.concatenate([*times, np.zeros(0, np.int64)])[order]):
                for at in range(0, len(pairs), ROWS_AT_ONCE):
                    some = pairs[at : at + ROWS_AT_ONCE]
                    yield table(
                        len(some), pair=pa.array(some), plane=pa.array(np.full(len(some), plane, np.int32)),
                        bits=bits.slice(at, len(some)),
                    )
            entries.clear()
            times.clear()

        for batch in batches:
            if not names:
                names += [part.split()[0] for part in schema.split(", ")]
                kinds += [
                    pa.int64(), pa.int32(), batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(),
                    pa.int64(), pa.int32(), pa.binary(),
                ]
            for part in slices(batch, "text", TEXT_BYTES):
                if slot + part.num_rows > CHUNK_DOCS or sum(map(len, entries)) > CHUNK_ENTRIES:
                    yield from closed()
                    chunk, slot = chunk + 1, 0
                got = read_texts(part.column(1).to_pylist(), units)
                n = part.num_rows
                yield table(
                    n, slot=pa.array(np.arange(slot, slot + n, dtype=np.int32)), id=part.column(0),
                    n_a=pa.array(got.sizes[:, 0]), n_b=pa.array(got.sizes[:, 1]), n_links=pa.array(got.sizes[:, 2]),
                    groups_sha256=pa.array(got.digests, pa.string()),
                )
                entries.append(got.entries + slot)
                times.append(got.times)
                slot += n
        if names:
            yield from closed()

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    held = materialise(given.mapInArrow(run, schema), "aligned")
    documents = held.filter("slot IS NOT NULL").drop("pair", "plane", "bits")
    return Index(documents, held.filter("pair IS NOT NULL").select("chunk", "pair", "plane", "bits"), width)


def pair_counts(index: Index) -> DataFrame:
    """``(pair, a_id, b_id, docs, links)`` from the population counts of a pair's bitmaps."""
    size = F.octet_length("bits")
    members = F.when(size == DENSE_BYTES, F.bitmap_count("bits")).otherwise(F.floor(size / 2))
    weight = F.pow(F.lit(2.0), F.greatest(F.col("plane") - 1, F.lit(0))).cast("long")
    summed = index.postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, members).otherwise(0)).alias("docs"), F.sum(members * weight).alias("links")
    )
    a_id = F.floor(F.col("pair") / index.width).alias("a_id")
    return summed.select("pair", a_id, F.pmod("pair", F.lit(index.width)).alias("b_id"), "docs", "links")


def returned(postings: DataFrame) -> DataFrame:
    """``(chunk, slot, n_best, count_sum)`` from ``(chunk, plane, bits, links, best)``, summed per document."""
    schema = "chunk BIGINT, slot INT, n_best BIGINT, count_sum BIGINT"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums = None, np.zeros((2, CHUNK_DOCS), np.int64)

        def closed() -> pa.RecordBatch:
            met = np.flatnonzero(sums[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.full(len(met), current), met.astype(np.int32), sums[0][met], sums[1][met])],
                names=["chunk", "slot", "n_best", "count_sum"],
            )

        for batch in batches:
            chunks = batch.column(0).to_numpy()
            weights = 1 << np.maximum(batch.column(1).to_numpy().astype(np.int64) - 1, 0)
            bits = batch.column(2)
            ends = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
            data = np.frombuffer(bits.buffers()[2], np.uint8)
            counted = weights * batch.column(3).to_numpy()
            best = weights * batch.column(4).to_numpy(zero_copy_only=False)
            dense = np.diff(ends) == DENSE_BYTES
            cuts = np.flatnonzero(np.diff(chunks)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(chunks)]):
                if lo == hi:
                    continue
                if chunks[lo] != current:
                    if current is not None:
                        yield closed()
                    current = chunks[lo]
                    sums[:] = 0
                few = ~dense[lo:hi]
                sizes = np.diff(ends[lo : hi + 1])
                slots = data[ends[lo] : ends[hi]][np.repeat(few, sizes)].view("<u2")
                times = sizes[few] // 2
                np.add.at(sums[0], slots, np.repeat(best[lo:hi][few], times))
                np.add.at(sums[1], slots, np.repeat(counted[lo:hi][few], times))
                for k in np.flatnonzero(dense[lo:hi]) + lo:
                    members = np.unpackbits(data[ends[k] : ends[k + 1]]).view(bool)
                    sums[0][members] += best[k]
                    sums[1][members] += counted[k]
        if current is not None:
            yield closed()

    dealt = postings.select("chunk", "plane", "bits", "links", "best").repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, schema)


def alignment(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``.

    ``n_best`` counts the links whose pair has the most links of its B id in the corpus, ties
    included; ``count_sum`` adds up the corpus-wide link counts of a document's links.
    """
    index = build_index(docs, a_path, b_path, doc_id, text)
    counts = materialise(pair_counts(index), "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("links").alias("most"))  # a row per id of B at most
    scored = counts.join(F.broadcast(most), "b_id").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    scores = returned(index.postings.join(scored, "pair"))
    joined = index.documents.join(scores, ["chunk", "slot"], "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    # A common end has exactly one token of either side, so there are as many groups as links.
    groups = F.col("n_links").alias("n_groups")
    return joined.select("id", "n_a", "n_b", groups, "n_links", *sums, "groups_sha256")
