r"""Repair of the role structure of conversations with a suffix-shared automaton.

The rows of a conversation, by turn, become a signature of one letter a row: the initial of
its role and its fault. Edits turn it into role initials that match ``(s?(ua)+)?``: Keep,
Rerole (2), Delete (3, a must for blank and duplicate rows) and Insert (2); a truncated row
that stays adds 1. Of the cheapest edits the audit, their initials in order, is the least.

Signatures are minimised from the end. They are sorted by their reverse over the cluster, so a
task meets those that share an ending one after the other and keeps the path of the last one
as a stack: a node of the automaton stands for an ending, equal endings of all conversations
share it, and for each of the four grammar states its cost to go, its best audit and the state
in which that audit ends are computed once, from its child. (Where a range is cut, the path of
one signature is built by two tasks.) Equal signatures of many conversations may go to several tasks.

Signatures longer than ``BLOCK`` rows are cut into blocks from the end. The costs between grammar
states of each block are 16 numbers; a fold over a conversation's blocks gives the costs to go at
every cut, and a block's automaton starts from these instead of the end. Edits before a row belong
to the row's block, so ties are settled inside a block. A second fold picks the state in which each
block is entered. Both folds see some 20 numbers for ``BLOCK`` rows.

Rows are put in order by a range sort that splits long conversations; windows only see one entry a
task and conversation. Texts move once, to be repaired and hashed in a stream. One conversation's
digest is that of one text, which is read in sequence by definition: a conversation of a third
of all rows keeps one task busy for its digest, in constant memory.

Defined cases: null roles, texts and, in the key of the damage, ids and turns read as one space; rows
without a conversation id form one conversation; null turns come first; rows of one turn are ordered
by role and the MD5 of their text; an empty role, and one that begins with another letter than
s, u or a, can only be reroled or deleted; conversations without rows left have zeros, an empty audit
and the digest of the empty text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.session import materialise

BLOCK = 256
ROW_BITS = 33  # row part of monotonically_increasing_id
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
KEY = ["no_id", "conv"]
ORDER = ["turn", "role", "digest"]
FAR = 1 << 28

# Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
INSERTED = [2, 2, 3, 2]  # the only user or assistant row that each state allows leads here
ROLE_INTO = {2: "user", 3: "assistant"}
END = ((0, 4, 2, 0), ("", "II", "I", ""), (0, 3, 3, 3))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the damage that their id and turn decide."""
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    draw = F.pmod(F.crc32(F.encode(F.concat_ws(":", *named), "UTF-8")), F.lit(20))
    text = F.coalesce(F.col("text"), blank)
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.filter(draw != 0).select(
        "conv_id", "turn",
        F.when(draw == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        text.alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _keyed(rows: DataFrame) -> list[Column]:
    zero = F.lit("0").cast(rows.schema["conv_id"].dataType)
    return [F.col("conv_id").isNull().cast("int").alias("no_id"), F.coalesce("conv_id", zero).alias("conv")]


def _digest() -> Column:
    return F.unhex(F.md5("text")).alias("digest")


def signed(rows: DataFrame) -> DataFrame:
    """``(no_id, conv, turn, role, digest, at, initial, fault)`` of every row; ``at`` follows the order of the rows."""
    rest = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.left(F.col("role"), F.lit(1))
    narrow = rows.select(
        *_keyed(rows), "turn", "role", _digest(),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (rest == "").alias("blank"),
        (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("open"),
        F.monotonically_increasing_id().alias("_salt"),  # lets a range cut rows that are alike
    )
    order = [*KEY, *ORDER, "_salt"]
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
    held = materialise(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "turns")
    first = held.filter(~F.col("blank")).groupBy(*KEY, "role", "digest").agg(F.min("at").alias("at"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated").otherwise("")
    )
    joined = held.join(first.select("at", F.lit(True).alias("first")), "at", "left")  # unique on both sides
    return materialise(joined.select(*KEY, *ORDER, "at", "initial", fault.alias("fault")), "signed-turns")


def blocks(rows: DataFrame) -> DataFrame:
    """``(no_id, conv, block, blocks, signature, illegal, head)`` of signed rows; block 0 is the last one."""
    part = F.shiftright("at", ROW_BITS)
    spans = rows.groupBy(*KEY, part.alias("part")).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    conversation = Window.partitionBy(*KEY)
    before = F.sum("n").over(conversation.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        *KEY, "part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("n").over(conversation).alias("total")
    )
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    placed = rows.withColumn("part", part).join(spans, [*KEY, "part"]).withColumn("place", F.col("at") + F.col("shift"))
    entry = F.struct("place", letter.alias("letter"), "initial", *ORDER)
    grouped = placed.groupBy(*KEY, F.floor((F.col("total") - 1 - F.col("place")) / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("rows"), F.first("total").alias("total")
    )
    spelt = grouped.select(
        *KEY, "block", F.ceil(F.col("total") / BLOCK).alias("blocks"),
        F.array_join(F.transform("rows", lambda r: r["letter"]), "").alias("signature"),
        F.array_join(F.transform("rows", lambda r: r["initial"]), "").alias("initials"),
        F.struct(*[F.get("rows", F.lit(0))[c].alias(c) for c in ORDER]).alias("head"),
    )
    last = F.right(F.lag("initials").over(conversation.orderBy(F.desc("block"))), F.lit(1))
    joined = F.concat(F.coalesce(last, F.lit("")), F.col("initials"))
    illegal = F.length(joined) - 1 - F.regexp_count(joined, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return materialise(spelt.withColumn("illegal", illegal.cast("long")).drop("initials"), "signature-blocks")


def _options(letter: str) -> list[list[tuple[int, str, int]]]:
    """By state: cost, edits and next state of each way over one row, up to two inserted rows before it."""
    out = []
    for state in range(4):
        ways, at = [], state
        for inserted in range(3):
            cost, edits = 2 * inserted, "I" * inserted
            ways.append((cost + 3, edits + "D", at))
            if letter != "x":
                extra = int(letter.isupper())
                ways.append((cost + 2 + extra, edits + "R", INSERTED[at]))
                if (at, letter.lower()) in STEPS:
                    ways.append((cost + extra, edits + "K", STEPS[at, letter.lower()]))
            at = INSERTED[at]
        out.append(ways)
    return out


OPTIONS = {letter: _options(letter) for letter in "suaoSUAOx"}
Node = tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]


def extended(letter: str, child: Node) -> Node:
    """The node of ``letter`` and what follows it: by state the cost to go, the best audit, and the state it ends in."""
    costs, audits, ends = child
    made = []
    for ways in OPTIONS[letter]:
        least = min(cost + costs[to] for cost, _, to in ways)
        made.append(min((least, edits + audits[to], ends[to]) for cost, edits, to in ways if cost + costs[to] == least))
    return tuple(zip(*made))


def step_costs(letter: str) -> np.ndarray:
    """Least cost from state to state over one row."""
    out = np.full((4, 4), FAR)
    for state, ways in enumerate(OPTIONS[letter]):
        for cost, _, to in ways:
            out[state, to] = min(out[state, to], cost)
    return out


def _combined(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    return (first[..., :, :, None] + then[..., None, :, :]).min(axis=-2)


def block_costs(signatures: list[str]) -> np.ndarray:
    """Least cost from state to state over each signature, all signatures at once."""
    table = {letter: step_costs(letter) for letter in OPTIONS}
    none = np.where(np.eye(4, dtype=bool), 0, FAR)
    out = np.broadcast_to(none, (len(signatures), 4, 4)).copy()
    for place in range(max(map(len, signatures), default=0)):
        step = np.stack([table[s[place]] if place < len(s) else none for s in signatures])
        out = np.minimum(_combined(out, step), FAR)
    return out


def _rooted(cut: DataFrame) -> DataFrame:
    """Blocks with ``root``, the relative costs to go by state after them, and ``base``, what these leave out."""
    names = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in KEY)

    def costs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                found = block_costs(part["signature"].tolist()).reshape(len(part), 16)
                yield part[[*KEY, "block"]].assign(costs=list(found.astype(np.int64)))

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        ahead, roots, bases = np.array(END[0]), [], []
        for flat in group["costs"]:
            base = int(ahead.min())
            roots.append(",".join(map(str, (ahead - base).tolist())))
            bases.append(base)
            ahead = (np.asarray(flat).reshape(4, 4) + ahead).min(axis=1)
        return group[[*KEY, "block"]].assign(root=roots, base=bases)

    long = cut.filter("blocks > 1").select(*KEY, "block", "signature")
    found = long.mapInPandas(costs, f"{names}, block BIGINT, costs ARRAY<BIGINT>").groupBy(*KEY)
    found = found.applyInPandas(fold, f"{names}, block BIGINT, root STRING, base BIGINT")
    return materialise(found, "block-roots")


def walked(rooted: DataFrame) -> DataFrame:
    """``(no_id, conv, block, blocks, cost, audits, ends)`` of ``(..., block, blocks, root, base, signature)``."""
    kinds = {c: rooted.schema[c].dataType.simpleString() for c in KEY}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    schema += ", block BIGINT, blocks BIGINT, cost BIGINT, audits ARRAY<STRING>, ends ARRAY<INT>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, spelt, path = None, "", []
        for batch in batches:
            costs, audits, ends = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("last", "root", "base", "reverse", "blocks"))
            for last, costs_after, base, reverse, number in zip(*columns):
                if (last, costs_after) != root:
                    root, spelt = (last, costs_after), ""
                    after = tuple(map(int, costs_after.split(",")))
                    path = [END if last else (after, ("",) * 4, (0, 1, 2, 3))]
                shared = len(commonprefix([spelt, reverse]))
                del path[shared + 1 :]
                for letter in reverse[shared:]:
                    path.append(extended(letter, path[-1]))
                spelt = reverse
                node, states = path[-1], 1 if number == 1 else 4
                costs.append(node[0][0] + base)
                audits.append(list(node[1][:states]))
                ends.append(list(node[2][:states]))
            made = [pa.array(costs, pa.int64()), pa.array(audits, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))]
            names = [*KEY, "block", "blocks"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *made], names=[*names, "cost", "audits", "ends"])

    order = ["last", "root", "reverse", *KEY, "block"]
    given = rooted.select(
        *KEY, "block", "blocks", "root", "base", (F.col("block") == 0).alias("last"), F.reverse("signature").alias("reverse")
    )
    return given.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def plans(cut: DataFrame) -> DataFrame:
    """``(no_id, conv, block, blocks, cost, state, audit, head)``: how each block is entered and edited.

    ``cost`` of the first block (``block = blocks - 1``) is that of the conversation.
    """
    ending = F.lit(",".join(map(str, END[0])))
    short = cut.filter("blocks = 1").withColumns({"root": ending, "base": F.lit(0).cast("long")})
    long = cut.filter("blocks > 1").join(_rooted(cut), [*KEY, "block"])
    names = [*KEY, "block", "blocks", "root", "base", "signature"]
    found = materialise(walked(short.select(*names).unionByName(long.select(*names))), "block-audits")
    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in KEY)

    def entered(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block", ascending=False)
        state, states = 0, []
        for ends in group["ends"]:
            states.append(state)
            state = ends[state]
        return group[[*KEY, "block"]].assign(state=states)

    later = found.filter("blocks > 1").select(*KEY, "block", "ends").groupBy(*KEY)
    states = later.applyInPandas(entered, f"{kinds}, block BIGINT, state INT")
    both = found.filter("blocks = 1").withColumn("state", F.lit(0)).unionByName(
        found.filter("blocks > 1").join(states, [*KEY, "block"])
    )
    chosen = both.select(*KEY, "block", "blocks", "cost", "state", F.get("audits", F.col("state")).alias("audit"))
    return materialise(chosen.join(cut.select(*KEY, "block", "head"), [*KEY, "block"]), "plans")


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``(no_id, conv, place, edit, turn, role, text)``: what is left of ``rows`` and what was inserted.

    The rows of a conversation come in order and from one task.
    """
    texts = rows.select(*_keyed(rows), "turn", "role", _digest(), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "text")
    edits = planned.select(*KEY, *[F.col("head")[c].alias(c) for c in ORDER], F.lit(0).alias("kind"), "block", "state", "audit")
    both = texts.unionByName(edits, allowMissingColumns=True)
    sorted_rows = both.repartition(*KEY).sortWithinPartitions(*KEY, *ORDER, "kind", F.desc("block"))
    kinds = {c: both.schema[c].dataType.simpleString() for c in (*KEY, "turn")}
    schema = f"no_id INT, conv {kinds['conv']}, place BIGINT, edit STRING, turn {kinds['turn']}, role STRING, text STRING"
    names = ["no_id", "conv", "place", "edit", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, state, audit, at, place = None, deque(), 0, "", 0, 0
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("no_id", "conv", "turn", "role", "kind", "state", "audit", "text"))
            for no_id, conv, turn, role, kind, entry, piece, text in zip(*columns):
                if (no_id, conv) != key:
                    key, place, audit, at = (no_id, conv), 0, "", 0
                    waiting.clear()
                if kind == 0:
                    waiting.append((entry, piece))
                    continue
                if at == len(audit):
                    (state, audit), at = waiting.popleft(), 0
                consumed = False
                while at < len(audit):
                    edit = audit[at]
                    if consumed and audit[at:].strip("I"):
                        break  # only what is inserted at the very end follows the last row
                    if edit == "I":
                        state = INSERTED[state]
                        out.append((no_id, conv, place, "I", None, ROLE_INTO[state], ""))
                        place += 1
                    else:
                        if edit == "R":
                            state = INSERTED[state]
                            role = ROLE_INTO[state]
                        elif edit == "K":
                            state = STEPS[state, role[0]]
                        if edit != "D":
                            out.append((no_id, conv, place, edit, turn, role, text))
                            place += 1
                        consumed = True
                    at += 1
            types = [pa.int32(), batch.schema.field("conv").type, pa.int64(), pa.string(), batch.schema.field("turn").type, pa.string(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * len(names), types)]
            yield pa.RecordBatch.from_arrays(made, names=names)

    return sorted_rows.mapInArrow(run, schema)


def digests(fixed: DataFrame) -> DataFrame:
    """``(no_id, conv, repaired_sha256)`` of repaired rows in their tasks and order."""
    schema = f"no_id INT, conv {fixed.schema['conv'].dataType.simpleString()}, repaired_sha256 STRING"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, kind = None, None, pa.int64()
        for batch in batches:
            kind = batch.schema.field("conv").type
            out = []
            for no_id, conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("no_id", "conv", "role", "text"))):
                line = f"{role}:{text}".encode()
                if (no_id, conv) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (no_id, conv), hashlib.sha256(line)
                else:
                    sha.update(b"\n" + line)
            yield _digest_rows(out, kind)
        if key is not None:
            yield _digest_rows([(*key, sha.hexdigest())], kind)

    return fixed.select(*KEY, "role", "text").mapInArrow(run, schema)


def _digest_rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * 3
    made = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), kind, pa.string()))]
    return pa.RecordBatch.from_arrays(made, names=[*KEY, "repaired_sha256"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(figures, planned, fixed)`` for rows ``(conv_id, turn, role, text)``.

    ``figures`` has a row per conversation: gaps, faults, illegal pairs, cost and audit;
    ``planned`` is as ``plans`` gives it, ``fixed`` as ``repaired``.
    """
    listed = signed(rows)
    cut = blocks(listed)
    planned = plans(cut)
    counts = listed.groupBy(*KEY).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    pairs = cut.groupBy(*KEY).agg(F.sum("illegal").alias("illegal"))
    whole = planned.groupBy(*KEY).agg(
        F.max(F.when(F.col("block") == F.col("blocks") - 1, F.col("cost"))).alias("cost"),
        F.array_sort(F.collect_list(F.struct((-F.col("block")).alias("block"), "audit"))).alias("audits"),
    )
    audit = F.array_join(F.transform("audits", lambda x: x["audit"]), "")
    figures = counts.join(pairs, KEY).join(whole.withColumn("audit", audit).drop("audits"), KEY)
    return figures, planned, repaired(rows, planned)


def report(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations``, repair them, and give one row of figures for every conversation."""
    rows = damaged(conversations)
    figures, _, fixed = repair(rows)
    ids = conversations.select(*_keyed(conversations)).distinct()
    joined = ids.join(figures, KEY, "left").join(digests(fixed), KEY, "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        F.when(F.col("no_id") == 0, F.col("conv")).alias("conv_id"), *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
