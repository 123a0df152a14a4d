import random

from corpuslens.llm import decontamination as deco

DOCS, ITEMS = "doc_id LONG, text STRING, item_id LONG, distance INT", "item_id LONG, text STRING, start STRING"


def distance(item, text):
    """Least edit distance of the item to a part of the text, by the full table."""
    above = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (a != b)))
        above = row
    return min(above)


def edited(rng, text, k):
    chars = list(text)
    for _ in range(k):
        at = rng.randrange(len(chars))
        chars[at : at + 1] = rng.choice([["#"], [], [chars[at], "~"]])
    return "".join(chars)


def test_against_the_full_table(spark):
    rng = random.Random(4)
    vocabulary = "the of and a to in is that was ion ent er ing".split()
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 9, 20]))).capitalize() + ".", "s") for i in range(12)]
    items += [(20, None, "s"), (21, "", "s"), (22, "İstanbul\tund ẞ " * 3, "s"), (3, items[3][1], "s")]
    docs = [(0, None), (1, ""), (2, "the")]
    for i, text, _ in items:
        for k in (0, 1, 3, 6):
            if text:
                pad = " ".join(rng.choices(vocabulary, k=rng.randrange(12)))
                docs.append((len(docs), f"{pad}\n{edited(rng, text, k).upper() if k == 1 else edited(rng, text, k)} {pad}"))
    frame = spark.createDataFrame([(i, t, 1, 1) for i, t in docs], DOCS)
    found = deco.leaks(frame, spark.createDataFrame(items, ITEMS), rate=0.1, block_bytes=300)
    out = sorted((r.doc_id, r.item_id, r.distance) for r in found.collect())
    wanted = []
    for doc_id, text in docs:
        for item_id, item, _ in items:
            if text and item:
                d = distance(deco.folded(item), deco.folded(text))
                if d <= int(0.1 * len(item)):
                    wanted.append((doc_id, item_id, d))
    assert out == sorted(wanted)
    texts = dict(docs)
    for r in found.collect():
        item = next(deco.folded(t) for i, t, _ in items if i == r.item_id)
        assert distance(item, deco.folded(texts[r.doc_id])[r.start : r.end]) == r.distance

    left = deco.remove(frame, spark.createDataFrame(items, ITEMS), rate=0.1)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(texts) - {d for d, _, _ in wanted})


def test_long_text_and_copies(spark):
    item = "a passage of some length that nobody writes twice by chance alone"
    docs = [(1, "x " * 200_000 + item, 1, 1), (1, "x " * 200_000 + item, 1, 1), (2, "a passage of " * 5_000, 1, 1)]
    out = deco.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(5, item, "")], ITEMS)).collect()
    assert [(r.doc_id, r.item_id, r.distance, r.start) for r in out] == [(1, 5, 0, 400_000)] * 2


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert deco.leaks(docs, items).collect() == [] and deco.remove(docs, items).collect() == []
    one = spark.createDataFrame([(1, "text", 1, 1)], DOCS)
    assert deco.leaks(one, items).collect() == [] and deco.remove(one, items).count() == 1
