"""Byte-level BPE encoding and decoding with a published vocabulary.

Spark splits the texts (one regular expression, JVM side); tasks encode each distinct
piece of a batch once. A piece's adjacent pairs are leaves of a segment tree keyed by (rank,
place), so the root is the leftmost pair of the lowest rank; a merge updates three leaves and
their ancestors, until no pair can be merged. The trees of all short pieces of a batch stand
side by side in one array and take each step together; a long piece has a tree of its own.
Nothing is kept from batch to batch.

Ids are packed as little-endian unsigned 32-bit integers in a binary column.

Defined cases: a null or empty text has no ids and decodes to the empty text; the strings
of added tokens become their ids; further columns are kept as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.settings import frugal
from corpuslens.llm.words import utf8

NONE = 1 << 62
NO_PAIR = np.int32(2**31 - 1)
LANE_BYTES = 64  # longest piece whose tree stands beside others
LANE_CELLS = 1 << 17  # leaves of the trees that take their steps together
TOKENS_AT_ONCE = 1 << 18

# The published split of byte-level BPE, with Unicode white space spelt out.
SPACE = r"\p{IsWhite_Space}"
SPLIT = (
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}++| ?\p{N}++| ?[^" + SPACE + r"\p{L}\p{N}]++|"
    + f"{SPACE}+(?![^{SPACE}])|{SPACE}++"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabularies of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@dataclass
class Vocabulary:
    """Pieces as bytes, merges by pair of ids, and added tokens; read once on the driver."""

    pieces: list[bytes]
    merges: dict[int, tuple[int, int]]  # left << 32 | right -> (rank, id of the whole)
    added: dict[str, int]
    of_byte: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        pairs = np.array(sorted(self.merges), np.int64)
        self.pairs = pairs
        self.ranks = np.array([self.merges[p][0] for p in pairs.tolist()], np.int32)
        self.whole = np.zeros(int(self.ranks.max(initial=-1)) + 1, np.int64)  # by rank
        for rank, whole in self.merges.values():
            self.whole[rank] = whole

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_PAIR`` where it cannot be merged or a side is missing (negative)."""
        if not len(self.pairs):
            return np.full(len(left), NO_PAIR)
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], NO_PAIR)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in enumerate(byte_letters())}
        ids = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for piece, i in ids.items():
            pieces[i] = bytes(letters[c] for c in piece)
        for text, i in added.items():
            pieces[i] = text.encode()
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        return cls(pieces, merges, added, [ids[c] for c in byte_letters()])


def merge_piece(ids: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Merge leftmost lowest-rank pairs until none is left."""
    n = len(ids)
    if n < 2:
        return ids
    ids = [*ids, 0]
    leaves = 1 << (n - 1).bit_length()
    bits = leaves.bit_length()
    mask = (1 << bits) - 1
    tree = [NONE] * (2 * leaves)
    find = merges.get
    for i in range(n - 1):
        pair = find(ids[i] << 32 | ids[i + 1])
        if pair is not None:
            tree[leaves + i] = pair[0] << bits | i
    for k in range(leaves - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 2))
    before = list(range(-1, n + 1))

    while (root := tree[1]) != NONE:
        i = root & mask
        j = after[i]
        ids[i] = find(ids[i] << 32 | ids[j])[1]
        end = after[j]
        after[i], before[end] = end, i
        at = before[i]
        for leaf, right in ((j, n), (i, end), (at, i)):
            if leaf < 0:
                continue
            pair = find(ids[leaf] << 32 | ids[right]) if right < n else None
            key = NONE if pair is None else pair[0] << bits | leaf
            k = leaves + leaf
            if tree[k] == key:
                continue
            tree[k] = key
            while k > 1:
                other = tree[k ^ 1]
                low = key if key < other else other
                k >>= 1
                if tree[k] == low:
                    break
                tree[k] = key = low
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_lanes(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge many short pieces together: ids of all pieces in a row, and how many each has.

    ``ids`` has a row per piece, filled up with -1, and one column more than its trees have
    leaves, a power of two; every piece ends before the last column.
    """
    lanes, leaves = ids.shape[0], ids.shape[1] - 1
    bits = leaves.bit_length()
    ids = ids.copy()
    alive = ids >= 0

    def keys(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.where(ranks == NO_PAIR, NO_PAIR, ranks << bits | places)

    tree = np.full((lanes, 2 * leaves), NO_PAIR)
    lane, place = np.nonzero(alive[:, 1:])
    tree[lane, leaves + place] = keys(vocabulary.rank_of(ids[lane, place], ids[lane, place + 1]), place.astype(np.int32))
    width = leaves
    while width > 1:
        width //= 2
        tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
    after = np.tile(np.arange(1, leaves + 3, dtype=np.int16), (lanes, 1))
    before = np.tile(np.arange(-1, leaves + 1, dtype=np.int16), (lanes, 1))
    while len(lane := np.flatnonzero(tree[:, 1] != NO_PAIR)):
        root = tree[lane, 1]
        i = root & ((1 << bits) - 1)
        whole = vocabulary.whole[root >> bits]
        j = after[lane, i]
        end, at = after[lane, j], before[lane, i]
        ids[lane, i] = whole
        alive[lane, j] = False
        after[lane, i], before[lane, end] = end, i
        first = at < 0
        left = np.maximum(at, 0)
        ranks = vocabulary.rank_of(
            np.concatenate([whole, np.where(first, -1, ids[lane, left])]), np.concatenate([ids[lane, end], whole])
        )
        tree[lane, leaves + j] = NO_PAIR
        tree[lane, leaves + i] = keys(ranks[: len(lane)], i)
        some = ~first
        tree[lane[some], leaves + left[some]] = keys(ranks[len(lane) :][some], left[some].astype(np.int32))
        rows, nodes = np.concatenate([lane] * 3), np.concatenate([i, j, left]).astype(np.int64) + leaves
        while nodes[0] > 1:
            nodes >>= 1
            tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
    return ids[alive], alive.sum(axis=1)


def encode_pieces(pieces: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``pieces`` in a row, and how many each has."""
    data, offsets = utf8(pieces)
    sizes = np.diff(offsets)
    of_byte = np.array(vocabulary.of_byte, np.int64)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, ids, numbers of ids
    apart = sizes > LANE_BYTES
    for text, i in vocabulary.added.items():
        same = np.array(pc.equal(pieces, text))
        apart |= same
        where = np.flatnonzero(same)
        parts.append((where, np.full(len(where), i, np.int64), np.ones(len(where), np.int64)))
    for row in np.flatnonzero((sizes > LANE_BYTES) & apart):
        if (text := data[offsets[row] : offsets[row + 1]].tobytes()).decode() not in vocabulary.added:
            ids = merge_piece([vocabulary.of_byte[b] for b in text], vocabulary.merges)
            parts.append((np.array([row]), np.array(ids), np.array([len(ids)])))
    leaves = 1
    while leaves <= LANE_BYTES:
        rows = np.flatnonzero(~apart & (sizes <= leaves) & (sizes > leaves // 2))
        for lo in range(0, len(rows), LANE_CELLS // leaves):
            own = rows[lo : lo + LANE_CELLS // leaves]
            columns = np.arange(leaves + 1)
            inside = columns < sizes[own][:, None]
            at = np.where(inside, offsets[own][:, None] + columns, 0)
            parts.append((own, *merge_lanes(np.where(inside, of_byte[data[at]], -1), vocabulary)))
        leaves *= 2
    counts = np.zeros(len(pieces), np.int64)
    for rows, _, numbers in parts:
        counts[rows] = numbers
    ends = np.cumsum(counts)
    out = np.zeros(ends[-1] if len(ends) else 0, "<u4")
    for rows, ids, numbers in parts:
        own = np.cumsum(numbers) - numbers
        out[np.repeat(ends[rows] - numbers - own, numbers) + np.arange(len(ids))] = ids
    return out, counts


def encode_rows(pieces: pa.ListArray, vocabulary: Vocabulary) -> Iterator[bytes]:
    """Packed ids of each row of pieces."""
    offsets = pieces.offsets.to_numpy()
    at = 0
    while at < len(pieces):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOKENS_AT_ONCE, "right")) - 1)
        coded = pieces.values.slice(offsets[at], offsets[to] - offsets[at]).dictionary_encode()
        flat, ends = gather(*encode_pieces(coded.dictionary, vocabulary), coded.indices.to_numpy())
        cuts = ends[offsets[at : to + 1] - offsets[at]]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield flat[lo:hi].tobytes()
        at = to


def gather(values: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` in the order of ``index``, and the place after each (with a leading 0)."""
    first = np.cumsum(sizes) - sizes
    own = sizes[index]
    ends = np.concatenate([[0], np.cumsum(own)])
    shift = np.repeat(first[index] - ends[:-1], own)
    return values[np.arange(ends[-1]) + shift], ends


def split_pieces(text: Column, added: list[str]) -> Column:
    """Array of pieces of a text; the string of the added token, one at most, is a piece of its own."""
    text = F.coalesce(text, F.lit(""))

    def plain(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(SPLIT), F.lit(0))

    if not added:
        return plain(text)
    (token,) = added
    quoted = "".join(c if c.isalnum() else f"\\{c}" for c in token)

    def between(part: Column, i: Column) -> Column:
        own = F.when(i > 0, F.array(F.lit(token))).otherwise(F.array().cast("array<string>"))
        return F.concat(own, plain(part))

    around = F.flatten(F.transform(F.split(text, quoted, -1), between))
    return F.when(F.contains(text, F.lit(token)), around).otherwise(plain(text))


def _schema(df: DataFrame, *added: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *added])


def _split(docs: DataFrame, text: str, columns: list[str], vocabulary: Vocabulary) -> DataFrame:
    if len(vocabulary.added) > 1:
        raise ValueError("one added token at most")
    return docs.select(*columns, split_pieces(docs[text], list(vocabulary.added)).alias("_pieces"))


def _texts(ids: Iterator[bytes], pieces: list[bytes]) -> list[str]:
    return [b"".join(map(pieces.__getitem__, np.frombuffer(x, "<u4").tolist())).decode("utf-8", "replace") for x in ids]


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of ``text`` in ``out``.

    ``path`` is a tokenizer file on the driver; its tables (fixed by the file) are broadcast.
    """
    vocabulary = Vocabulary.read(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    columns = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(encode_rows(batch.column("_pieces"), shared.value), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), ids], names=[*columns, out])

    given = _split(docs, text, columns, vocabulary)
    return given.mapInArrow(frugal(run), _schema(given.drop("_pieces"), f"`{out}` binary"))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its packed ids in ``out``."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path).pieces)
    columns = [c for c in encoded.columns if c != out]
    given = encoded.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(_texts(batch.column(ids).fill_null(b"").to_pylist(), shared.value), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), made], names=[*columns, out])

    return given.mapInArrow(frugal(run), _schema(given, f"`{out}` string"))


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """What ``decode`` makes of what ``encode`` makes, in one worker a task instead of two."""
    vocabulary = Vocabulary.read(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    columns = [c for c in docs.columns if c not in (ids, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = list(encode_rows(batch.column("_pieces"), shared.value))
            made = [pa.array(packed, pa.binary()), pa.array(_texts(packed, shared.value.pieces), pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], names=[*columns, ids, out])

    given = _split(docs, text, columns, vocabulary)
    return given.mapInArrow(frugal(run), _schema(given.drop("_pieces"), f"`{ids}` binary", f"`{out}` string"))


def n_ids(ids: str = "ids") -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")
