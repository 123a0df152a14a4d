"""Exact Jaccard join of word-shingle sets and its connected classes.

1. Every text becomes its set of 64-bit shingle hashes (numpy, on Arrow buffers); equal sets
   are one class, keyed by a hash of the set that is checked for clashes.
2. Sets at 0.75 or more must share one of their rarest ``n - ceil(0.75 n) + 1`` shingles.
   Any fixed order of shingles keeps this exact; common ones, found by counting over all
   texts, come last. A tile holds the sets of one size band that have such a shingle.
3. In each tile every set meets the tile's least key. The most frequent partner of a set
   is verified first; the links found join most copies, however large their group.
4. In tiles that still hold different components, every set that shares as many tiles with
   another component as a link must is held against that component's sets, block by block:
   bitmaps of hashed shingles bound the overlap from above by their bit counts, and sorted
   arrays are intersected where the bound allows. The largest components come first and
   take in what is linked to them; then all are probed.

Links that join what is joined already need no check, so no link between components is
lost, and a group of n near copies costs about n checks and not n squared.

Defined cases: texts without words have an empty set and no link; a text of fewer words
than a shingle has one shingle, its whole sequence; rows that repeat are one class; a row
without id belongs to its class but never names a component (null if the class has no
id); further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.components import components, composed, shortened
from corpuslens.llm.narrowing import parted
from corpuslens.llm.settings import frugal
from corpuslens.llm.words import PLACES, hash_words, mix, slices, utf8, windows
from corpuslens.session import materialise

SHINGLE = 5
PERCENT = 75
COMMON = 1 << 17  # shingles whose frequency is known to the order; the bound of the broadcast
COMMON_PER_CHUNK = 4096
CHUNK = 1 << 20  # shingles
BAND_BITS = 2  # sizes of a band lie between neighbouring powers of 4
BITMAP_WORDS = 32  # 2,048 bits
LARGEST_FIRST = 1  # rounds against the largest component of each tile
BLOCK = 256  # sets that a task holds at once
SEEN = 1 << 17  # sets a task remembers, to send copies once

FACTS = "doc_id long, text_key long, n long, key long, twin long, hash long, cnt long"


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    runs = windows(hashes, size)
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if hi - lo >= size:
            own = np.sort(runs[lo : hi - size + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif hi > lo:
            whole = (hashes[lo:hi] * PLACES[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            yield mix(np.array([whole]), 5)
        else:
            yield np.zeros(0, np.uint64)


def set_key(own: np.ndarray, seed: int) -> int:
    """64-bit hash of a set."""
    return _signed(mix(np.array([mix(own, 2 * seed + 10).sum(dtype=np.uint64)]), len(own))[0])


def set_twin(own: np.ndarray, seed: int) -> int:
    """Another 64-bit hash of a set, to find clashes of the first."""
    return _signed(mix(own, 2 * seed + 11).sum(dtype=np.uint64))


def _signed(x: np.uint64) -> int:
    return int(x) - (1 << 64) if int(x) >> 63 else int(x)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in slices(whole, "text"):
            hashes, offsets = hash_words(*utf8(batch.column("text")), lower=True)
            yield batch, list(shingles(hashes, offsets))


def _facts(texts: DataFrame, seed: int) -> DataFrame:
    """Per document its set's size and keys, and per chunk of shingles the frequent ones with their counts."""

    def frequent(held: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        top = np.flatnonzero(counts > 1)
        if len(top) > COMMON_PER_CHUNK:
            top = top[np.argpartition(counts[top], -COMMON_PER_CHUNK)[-COMMON_PER_CHUNK:]]
        none = pa.nulls(len(top), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, none, none, none, pa.array(found[top].view(np.int64)), pa.array(counts[top])], names=names
        )

    names = [x.split()[0] for x in FACTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch, sets in _sets(batches):
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s, seed) for s in sets], pa.int64()), pa.array([set_twin(s, seed) for s in sets], pa.int64()), none, none,
                ],
                names=names,
            )
            held += sets
            size += sum(map(len, sets))
            if size >= CHUNK:
                yield frequent(held)
                held, size = [], 0
        if size:
            yield frequent(held)

    return texts.mapInArrow(frugal(run), FACTS)


def _common(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent shingles, sorted, and their counts: ``COMMON`` at most."""
    counts = facts.filter("hash is not null").groupBy("hash").agg(F.sum("cnt").alias("cnt"))
    top = counts.orderBy(F.desc("cnt"), "hash").limit(COMMON).toArrow()
    hashes = top.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top.column("cnt").to_numpy()[order]


def rarest(own: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles of a sorted set that any set at ``PERCENT`` or more must share one of."""
    n = len(own)
    length = n - (PERCENT * n + 99) // 100 + 1
    hashes, counts = common
    if not len(hashes):
        return own[:length]
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    weight = np.where(hashes[at] == own, counts[at], 0)
    rare = np.flatnonzero(weight == 0)
    if len(rare) >= length:
        return own[rare[:length]]
    rest = np.flatnonzero(weight)
    rest = rest[np.argsort(weight[rest], kind="stable")]
    return own[np.concatenate([rare, rest[: length - len(rare)]])]


def bands(n: int) -> list[int]:
    """Size bands of a set: its own, and the one below if that can hold a partner."""
    band = (n.bit_length() - 1) // BAND_BITS
    least = (PERCENT * n + 99) // 100
    return [band, band - 1] if least < 1 << (BAND_BITS * band) else [band]


def _postings(texts: DataFrame, common: Broadcast, seed: int) -> DataFrame:
    """``(tile, key, n)`` for the rarest shingles of every set; copies within a task are sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _sets(batches):
            tiles, keys, sizes = [np.zeros(0, np.uint64)], [], []
            for own in sets:
                if not len(own):
                    continue
                key = set_key(own, seed)
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                rare = rarest(own, common.value)
                for band in bands(len(own)):
                    tiles.append(mix(rare, 100 + band))
                    keys.append((key, len(rare)))
                    sizes.append(len(own))
            counts = [c for _, c in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tiles).view(np.int64)),
                    pa.array(np.repeat(np.array([k for k, _ in keys], np.int64), counts)),
                    pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                ],
                names=["tile", "key", "n"],
            )

    return texts.mapInArrow(frugal(run), "tile long, key long, n int")


def _tiles(postings: DataFrame) -> DataFrame:
    """Tiles of two sets or more as ``(tile, key, n, lead, lead_n)``; ``lead`` is the tile's least key.

    A task walks its sorted postings; of an open tile it holds a bounded part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, key, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        lead: tuple[int, int, int] | None = None  # of the open tile, if a part of it was sent

        def cut(upto: int, last: bool) -> pa.RecordBatch:
            nonlocal tile, key, n, lead
            t, k, s = tile[:upto], key[:upto], n[:upto]
            tile, key, n = tile[upto:], key[upto:], n[upto:]
            once = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])[:upto]
            t, k, s = t[once], k[once], s[once]
            upto = len(t)
            begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if upto else np.zeros(0, np.int64)
            sizes = np.diff(begin, append=upto)
            first = begin.copy()  # rows are sorted by key within a tile
            leads, lead_ns = k[first], s[first]
            wanted = sizes > 1
            if upto and lead and t[0] == lead[0]:
                leads[0], lead_ns[0], wanted[0] = lead[1], lead[2], True
            if upto and not last and len(tile) and tile[0] == t[-1]:
                wanted[-1] = True
                lead = (int(t[-1]), int(leads[-1]), int(lead_ns[-1]))
            elif upto:
                lead = None
            keep = np.repeat(wanted, sizes)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(t[keep]), pa.array(k[keep]), pa.array(s[keep]),
                    pa.array(np.repeat(leads, sizes)[keep]), pa.array(np.repeat(lead_ns, sizes)[keep]),
                ],
                names=["tile", "key", "n", "lead", "lead_n"],
            )

        for batch in batches:
            tile = np.concatenate([tile, batch.column("tile").to_numpy()])
            key = np.concatenate([key, batch.column("key").to_numpy()])
            n = np.concatenate([n, batch.column("n").to_numpy()])
            if len(tile) < CHUNK // 4:
                continue
            upto = int(np.searchsorted(tile, tile[-1]))
            # One row stays, so that a tile that fills the buffer is seen to go on.
            yield cut(upto if upto else len(tile) - 1, last=False)
        if len(tile):
            yield cut(len(tile), last=True)

    dealt = postings.repartition("tile").sortWithinPartitions("tile", "key")
    return dealt.mapInArrow(frugal(run), "tile long, key long, n int, lead long, lead_n int")


def _compatible(a: str, b: str) -> Column:
    return (100 * F.least(a, b)) >= PERCENT * F.greatest(a, b)


def _least_shared(a: str, b: str) -> Column:
    """Tiles that two sets of these sizes share at least, if they are a link.

    They have ``ceil(p (a + b) / (1 + p))`` shingles in common. Those that are rarest among
    these stand in both lists of rarest shingles as long as the lists allow.
    """
    common = F.floor((PERCENT * (F.col(a) + F.col(b)) + 99 + PERCENT) / F.lit(100 + PERCENT))
    return common - F.floor((PERCENT * F.greatest(a, b) + 99) / F.lit(100)) + 1


def bitmap_of(own: np.ndarray) -> bytes:
    """Signature of a set: one bit per hashed shingle."""
    places = mix(own, 77) % np.uint64(64 * BITMAP_WORDS)
    bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
    bits[places.astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _members(texts: DataFrame, keys: DataFrame, firsts: DataFrame, seed: int) -> DataFrame:
    """``(key, bitmap, shingles)`` of the sets with the given keys, made from one text each: ``firsts(key, doc_id, text_key)``."""
    wanted = materialise(keys.select("key").join(firsts, "key"), "wanted-texts")
    _, held = parted(texts, [F.col("doc_id"), F.col("text_key")], wanted, ["doc_id", "text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches):
            rows = [(set_key(own, seed), bitmap_of(own), own.tobytes()) for own in sets if len(own)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
                ],
                names=["key", "bitmap", "shingles"],
            )

    made = held.mapInArrow(frugal(run), "key long, bitmap binary, shingles binary")
    return materialise(made.join(keys.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


def within_bound(bits_a: pa.Array, bits_b: pa.Array, n_a: np.ndarray, n_b: np.ndarray) -> pa.Array:
    """Whether bitmaps allow enough overlap: ``(n_a + n_b - differing bits) / 2`` bounds it from above."""
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint64).reshape(len(x), -1) for x in (bits_a, bits_b))
    total = n_a + n_b
    most = (total - np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)) // 2
    return pa.array(100 * most >= PERCENT * (total - most))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are links: bitmaps first, then the intersection of sorted arrays."""
    one = sets.select(F.col("key").alias("a"), F.col("bitmap").alias("bits_a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("key").alias("b"), F.col("bitmap").alias("bits_b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) // 8 for c in ("set_a", "set_b")]
            batch = batch.filter(within_bound(batch.column("bits_a"), batch.column("bits_b"), *sizes))
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(linked(overlap(a, b), len(a), len(b)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "a").join(two, "b")
    return joined.select("a", "b", "bits_a", "bits_b", "set_a", "set_b").mapInArrow(frugal(run), "a long, b long")


def _rooted(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``df`` with the component of ``key``."""
    named = labels.select(F.col("node").alias("key"), "root")
    return df.join(named, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _mixed(tiles: DataFrame, labels: DataFrame) -> DataFrame:
    """``(tile, key, n, root)`` of the tiles that hold sets of different components."""
    rooted = _rooted(tiles.select("tile", "key", "n"), labels)
    mixed = rooted.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return materialise(rooted.join(mixed.select("tile"), "tile", "left_semi").distinct(), "mixed-tiles")


def _probes(mixed: DataFrame, largest: bool) -> DataFrame:
    """``(key, target)``: sets that may have a link into another component, at least as large as their own.

    Two sets of different components that are a link share tiles; so the one of the
    smaller component shares as many tiles with the other component as a whole. Tiles
    list their components, not their pairs of sets. ``largest`` looks only at the largest
    component of each tile.
    """
    parts = mixed.groupBy("root").agg(F.count_distinct("key").alias("size"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    parts = materialise(parts, "components")
    part = F.struct("size", F.col("root").alias("target"), "lo", "hi")
    sized = mixed.join(parts, "root")
    if largest:
        paired = sized.withColumn("other", F.max(part).over(Window.partitionBy("tile")))
    else:
        sized = materialise(sized, "sized-tiles")
        others = sized.select("tile", part.alias("other")).repartition("tile").distinct()
        paired = sized.select("tile", "key", "n", "root", "size").join(others, "tile")
    met = paired.filter(
        (F.struct("other.size", "other.target") > F.struct("size", "root"))
        & (100 * F.col("other.hi") >= PERCENT * F.col("n"))
        & (PERCENT * F.col("other.lo") <= 100 * F.col("n"))
    )
    shared = met.groupBy("key", "n", "other.target", "other.lo", "other.hi").agg(F.count("*").alias("times"))
    # A link needs most shared tiles at equal sizes, so the least and largest partner bound it from below.
    ends = shared.withColumn("m_lo", F.greatest("lo", F.ceil(PERCENT * F.col("n") / 100))).withColumn(
        "m_hi", F.least("hi", F.floor(100 * F.col("n") / PERCENT))
    )
    needed = F.least(_least_shared("n", "m_lo"), _least_shared("n", "m_hi")) - 1
    return materialise(ends.filter(F.col("times") >= needed).select("key", "target"), "probes")


def _probed(probes: DataFrame, mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of the probes into their targets, one for each block of a target at most.

    The sets of a target are cut into blocks; a probe meets every block. A task holds one
    block: bit counts of all its bitmaps bound the overlaps at once, then sorted arrays are
    intersected until a link is found.
    """
    members = mixed.select("key", F.col("root").alias("target")).distinct().join(
        probes.select("target").distinct(), "target", "left_semi"
    )
    blocks = members.groupBy("target").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(blocks, "target").select(
        "target", F.pmod(F.hash("key"), F.col("blocks")).alias("block"), F.lit(0).alias("kind"), "key"
    )
    spread = probes.join(blocks, "target").select(
        "target", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "key"
    )
    rows = placed.unionByName(spread).join(sets, "key").repartition("target", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, bits, arrays = None, [], [], []
        matrix = sizes = None
        for batch in batches:
            found = []
            for target, block, kind, key, bitmap, shingles in zip(*(batch.column(c) for c in names)):
                place = (target.as_py(), block.as_py())
                if place != at:
                    at, keys, bits, arrays, matrix = place, [], [], [], None
                own = np.frombuffer(shingles.as_buffer(), np.uint64).copy()
                if kind.as_py() == 0:
                    keys.append(key.as_py())
                    bits.append(bitmap.as_py())
                    arrays.append(own)
                    continue
                if matrix is None:
                    matrix = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)
                    sizes = np.array([len(x) for x in arrays], np.int64)
                differ = np.bitwise_count(matrix ^ np.frombuffer(bitmap.as_py(), np.uint64)).sum(axis=1, dtype=np.int64)
                total = sizes + len(own)
                most = (total - differ) // 2
                for i in np.flatnonzero(100 * most >= PERCENT * (total - most)):
                    if linked(overlap(own, arrays[i]), len(own), len(arrays[i])):
                        found.append((key.as_py(), keys[i]))
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
            )

    names = ["target", "block", "kind", "key", "bitmap", "shingles"]
    ordered = rows.sortWithinPartitions("target", "block", "kind").select(*names)
    return ordered.mapInArrow(frugal(run), "a long, b long")


def _first_links(texts: DataFrame, tiles: DataFrame, firsts: DataFrame, seed: int) -> DataFrame:
    """Components that show when each set is held against the partner it meets most often.

    A partner is the least key of a tile, so the links found point downwards and form trees.
    """
    meets = tiles.filter((F.col("key") != F.col("lead")) & _compatible("n", "lead_n"))
    shared = meets.groupBy("key", "lead", "n", "lead_n").agg(F.count("*").alias("times"))
    shared = shared.filter(F.col("times") >= _least_shared("n", "lead_n"))
    partner = shared.groupBy("key").agg(F.max_by("lead", F.struct("times", "lead")).alias("b"))
    partner = materialise(partner.select(F.col("key").alias("a"), "b"), "partners")
    links = _verified(partner, _members(texts, _keys(partner), firsts, seed))
    hooks = shortened(links.select(F.col("a").alias("node"), F.col("b").alias("up")))
    return hooks.select("node", F.col("up").alias("root"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(a, b, root_a, root_b)`` of the pairs whose components differ."""
    one = _rooted(pairs.select(F.col("a").alias("key"), "b"), labels)
    one = one.select(F.col("key").alias("a"), F.col("root").alias("root_a"), F.col("b").alias("key"))
    both = _rooted(one, labels).select("a", F.col("key").alias("b"), "root_a", F.col("root").alias("root_b"))
    return both.filter("root_a <> root_b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the components of ``links(a, b)`` are joined."""
    roots = _apart(links, labels).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
    roots = materialise(roots, "root-links")
    if roots.isEmpty():
        return labels
    hooks = components(roots, "a", "b").select("node", F.col("root").alias("up"))
    # Roots that no link has pointed to so far have no label yet.
    fresh = hooks.join(labels.select("node"), "node", "left_anti").select("node", F.col("up").alias("root"))
    return materialise(composed(labels, hooks).unionByName(fresh), "labels")


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()


def _other_links(texts: DataFrame, tiles: DataFrame, labels: DataFrame, firsts: DataFrame, seed: int) -> DataFrame:
    """``labels`` after all sets of different components that can be links are held against each other.

    First the largest components take in what is linked to them, so that a group whose sets
    are not all near one leader falls to few components; then all that share tiles are
    probed.
    """
    rows, sets = tiles, None
    for largest in [True] * LARGEST_FIRST + [False]:
        rows = _mixed(rows, labels)
        probes = _probes(rows, largest)
        targets = rows.join(probes.select(F.col("target").alias("root")).distinct(), "root", "left_semi")
        keys = materialise(probes.select("key").union(targets.select("key")).distinct(), "probe-keys")
        if sets is None or not keys.join(sets.select("key"), "key", "left_anti").isEmpty():
            sets = _members(texts, keys, firsts, seed)
        labels = _joined(labels, materialise(_probed(probes, rows, sets), "links"))
    return labels


def _labelled(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``(doc_id, text_key, n, key, root, component_id)``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    )
    seed = 0
    while True:
        facts = materialise(_facts(texts, seed), "sets-of-texts")
        rows = facts.filter("key is not null").select("doc_id", "text_key", "n", "key", "twin")
        clash = rows.groupBy("key").agg(
            (F.min(F.struct("n", "twin")) != F.max(F.struct("n", "twin"))).alias("clash")
        ).filter("clash")
        if clash.isEmpty():
            break
        seed += 1  # two different sets under one key: hash anew

    common = spark.sparkContext.broadcast(_common(facts))
    tiles = materialise(_tiles(_postings(texts, common, seed)), "tiles")
    # copies share a set, so it is made from the text of one of them
    first = rows.filter("n > 0").groupBy("key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    firsts = materialise(first.select("key", "first.doc_id", "first.text_key"), "first-texts")
    labels = _other_links(texts, tiles, _first_links(texts, tiles, firsts, seed), firsts, seed)

    named = _rooted(rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")), labels)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return _spread_join(rows.drop("twin"), named.join(least, "root").select("key", "root", "component_id"))


def _spread_join(rows: DataFrame, named: DataFrame, salts: int = 64, wide: int = 64) -> DataFrame:
    """Give every document its class.

    Classes of more than ``wide`` copies stand once per salt, and their documents, like
    those of the empty set, are dealt to the salts; all others have salt 0.
    """
    many = rows.filter("n > 0").groupBy("key").agg(F.count("*").alias("copies")).filter(F.col("copies") > wide)
    hot = many.select("key", F.explode(F.sequence(F.lit(1), F.lit(salts))).alias("salt"))
    hot = materialise(hot, "hot-classes")
    salt = 1 + F.pmod(F.hash("doc_id"), F.lit(salts))
    marked = rows.withColumn("salt", salt).join(hot.withColumn("hot", F.lit(True)), ["key", "salt"], "left")
    marked = marked.withColumn("salt", F.when((F.col("n") == 0) | F.col("hot"), F.col("salt")).otherwise(0))
    copied = hot.join(named, "key").select("key", "salt", "root", "component_id")
    all_named = named.select("key", F.lit(0).alias("salt"), "root", "component_id").unionByName(copied)
    found = marked.join(materialise(all_named, "classes"), ["key", "salt"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "text_key", "n", "key", "root", component.alias("component_id"))


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (``doc_id``, ``text``)."""
    return _labelled(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of every component the row of the least id stays, and every empty set.

    Of rows alike in id and text one stays.
    """
    found = materialise(_labelled(docs).select("doc_id", "text_key", "n", "root"), "labelled")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    chosen = found.filter("n > 0").groupBy("root").agg(F.min(own).alias("own"))
    chosen = chosen.select(
        F.col("root").alias("_j_root"), F.col("own.doc_id").alias("_j_id"), F.col("own.text_key").alias("_j_text")
    )
    copies = found.filter("n > 0").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    same = F.col("doc_id").eqNullSafe(F.col("_j_id")) & (F.col("text_key") == F.col("_j_text")) & (F.col("root") == F.col("_j_root"))
    stay = copies.join(chosen, same, "left").select(
        "doc_id", "text_key", "copies", F.col("_j_root").isNotNull().alias("stays")
    )
    stay = materialise(stay.filter("not stays or copies > 1"), "copies")
    keyed = docs.withColumn("_j_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    # Only texts that may be a copy, or may be repeated, are exchanged.
    single, keyed = parted(keyed, [F.col("doc_id").cast("long"), F.col("_j_key")], stay, ["doc_id", "text_key"])
    gone = stay.filter("not stays").select(F.col("doc_id").alias("_j_id"), F.col("text_key").alias("_j_text"))
    on = keyed.doc_id.eqNullSafe(gone["_j_id"]) & (keyed["_j_key"] == gone["_j_text"])
    left = keyed.join(gone, on, "left_anti")
    repeated = stay.filter("stays").select(F.col("doc_id").alias("_j_id"), F.col("text_key").alias("_j_text"))
    if not repeated.isEmpty():
        on = left.doc_id.eqNullSafe(repeated["_j_id"]) & (left["_j_key"] == repeated["_j_text"])
        once = left.join(repeated, on, "left_semi").dropDuplicates(["doc_id", "_j_key"])
        left = left.join(repeated, on, "left_anti").unionByName(once)
    return single.unionByName(left).select(*docs.columns)
