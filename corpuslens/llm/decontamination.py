"""Benchmark items inside documents within an edit budget: pigeonhole pieces, then Myers' distance.

An item of ``m`` characters may differ by ``k = floor(rate * m)`` edits. Cut into ``k + 1``
pieces, one piece must stand unchanged in any such place. All pieces of a block of items
are found in one walk over a text (Aho-Corasick); each hit marks a window that can hold the
item, windows that meet are joined, and the bit-parallel distance verifies them.

Items are handled in blocks of a bounded size, one pass over the documents each; nothing
about documents is collected. Case and kind of white space do not count; every character
is compared with its lower case, so places are those of the text itself.

Defined cases: null or empty texts hold nothing; null or empty items are found nowhere;
items too short for an edit must stand exactly; repeated items or documents give their
rows each; further columns are left as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.settings import frugal


RATE = 0.08
BLOCK_BYTES = 4 << 20

MATCHES = "doc_id long, item_id long, distance int, start long, end long"
_SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace() and c != 32]


def folded(text: str) -> str:
    """Lower case and plain blanks, character by character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for c in _SPACES:
        low = low.replace(c, " ")
    return low


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def nearest(places: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least distance of the whole pattern to any part of ``text``, and the first end of such a part."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        equal = places.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
            if score < best:
                best, end = score, i + 1
        plus <<= 1
        minus <<= 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
    return best, end


class Block:
    """A bounded set of items, ready to be found."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = folded(text or "")
            if not text:
                continue
            k = math.floor(rate * len(text))
            for at, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, k, masks(text), masks(text[::-1])))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the joined spans of ``text`` that can hold it."""
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text) if self.items else ():
            for item, at in where:
                starts.setdefault(item, set()).add(end + 1 - size - at)
        out = {}
        for item, own in starts.items():
            _, pattern, k, _, _ = self.items[item]
            joined: list[list[int]] = []
            for start in sorted(own):
                lo, hi = max(0, start - k), min(len(text), start + len(pattern) + k)
                if joined and lo <= joined[-1][1]:
                    joined[-1][1] = hi
                else:
                    joined.append([lo, hi])
            out[item] = joined
        return out

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of the best and first place of each item found."""
        text = folded(text or "")
        for item, spans in self.windows(text).items():
            item_id, pattern, k, forward, backward = self.items[item]
            best = (k + 1, 0, 0)
            for lo, hi in spans:
                exact = text.find(pattern, lo, hi)
                if exact >= 0:
                    best = min(best, (0, exact, exact + len(pattern)))
                    break
                distance, end = nearest(forward, len(pattern), text[lo:hi])
                if distance < best[0]:
                    part = text[lo : lo + end][::-1]
                    _, size = nearest(backward, len(pattern), part[: len(pattern) + k])
                    best = (distance, lo + end - size, lo + end)
            if best[0] <= k:
                yield (item_id, *best)


def blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items, one bounded block at a time."""
    given = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = given.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, math.ceil(size / block_bytes))
    dealt = given.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for i in range(count):
        yield [(r.item_id, r.text) for r in dealt.filter(F.col("block") == i).collect()]


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and item it holds, with the best place."""
    names = [x.split()[0] for x in MATCHES.split(", ")]
    out = None
    for own in blocks(items, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = Block(held.value, rate)
            for batch in batches:
                rows = [
                    (doc_id, *m)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for m in block.matches(text.as_py())
                ]
                columns = list(zip(*rows)) or [()] * len(names)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), MATCHES)
        out = found if out is None else out.union(found)
    return out


def remove(docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without those that hold an item."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for own in blocks(items, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = Block(held.value, rate)
            for batch in batches:
                clean = [next(block.matches(t.as_py()), None) is None for t in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(frugal(run), schema)
    return docs
