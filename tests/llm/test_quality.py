import re
from collections import Counter

from corpuslens.llm import quality
from corpuslens.llm.queries import QUERIES

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, hash STRING"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    threes = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if threes[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_counts_of_the_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op7_cross_document_lines"](spark, sf).collect()
    assert {r.doc_id: measured(r) for r in out} == {k: brute(t) for k, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in out)


def test_odd_texts(spark):
    texts = [
        None, "", "   \n\t", "a b c a b c", "é " * 60, "x" * 3_000_000, "# * $\n# * $\n\n# * $ \x1c\x85\xa0",
        "w " * 700_000, " lead\x0b\x0c\rtail ", " ".join(f"w{i}" for i in range(400_000)), "a\x00b c",
    ]
    rows = [(i, t, "en", None, None, "h") for i, t in enumerate(texts)] * 2
    out = quality.judge(spark.createDataFrame(rows, SCHEMA), "source", "doc_id").collect()
    assert sorted((r.doc_id, *measured(r)) for r in out) == sorted((r[0], *brute(r[1])) for r in rows)


def name(i, k):
    return "".join(chr(97 + int(d)) for d in f"{i}") + "w" + "".join(chr(97 + int(d)) for d in f"{k}")


def corpus(n=300):
    common = " ".join(f"menu{k}" for k in range(60))
    rows = []
    for i in range(n):
        own = " ".join(name(i, k) for k in range(60))
        rows.append((i, f"{common} {i}\n{own}", "en", "a", 1, "h"))
    thin = " ".join(f"menu{k}" for k in range(60))
    rows += [(1000 + i, f"{thin} {i}\nshort own {name(i, i)}", "en", "a", 1, "h") for i in range(5)]
    copied = " ".join(f"copy{k}" for k in range(80))
    rows += [(2000 + i, copied, "en", "a", 1, "h") for i in range(200)]
    rows += [(3000, f"{common} 7\n" + " ".join(f"o{k}" for k in range(60)), "en", "b", 1, None)]
    return rows


def test_common_lines_go_and_copies_count_once(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    out = {r.doc_id: r for r in quality.judge(df, "source", "doc_id").collect()}
    assert all(out[i].kept and out[i].removed_words == 61 for i in range(300))
    assert not any(out[1000 + i].kept for i in range(5))
    assert all(out[2000 + i].kept and out[2000 + i].removed_words == 0 for i in range(200))
    assert out[3000].kept and out[3000].removed_words == 0

    left = {r.doc_id: r for r in quality.clean(df).collect()}
    assert set(left) == {i for i, r in out.items() if r.kept}
    assert left[0].text == " ".join(name(0, k) for k in range(60)) and left[0].n_chars == len(left[0].text)
    assert left[3000].text.startswith("menu0") and left[3000].n_chars == 1
    assert left[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "hash"}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality.judge(df, "source", "doc_id").collect() == [] and quality.clean(df).collect() == []


def test_limit_by_share_at_every_host_size(spark):
    """Of hosts of 20, 50 and 500 documents, the lines in more than 3, 3 and 10 documents go."""
    rows, wanted = [], {}
    for size, at_limit in ((20, 3), (50, 3), (500, 10)):
        for i in range(size):
            own = " ".join(name(i, k) for k in range(60))
            kept, gone = i < at_limit, at_limit < i < 2 * at_limit + 2
            line = "\nthis line stays" if kept else "\nthis line goes" if gone else ""
            rows.append((1000 * size + i, own + line, "en", f"host{size}", 1, "h"))
            wanted[1000 * size + i] = 3 * gone
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r.removed_words for r in quality.judge(df, "source", "doc_id").collect()}
    assert out == wanted
    assert not any("goes" in r.text for r in quality.clean(df).collect())


def test_texts_that_share_a_passage_count_each(spark):
    common = " ".join(f"menu{k}" for k in range(60))
    rows = [(i, f"{common}\nown {name(i, 1)} {name(i, 2)} {name(i, 3)}", "en", "a", 1, "h") for i in range(300)]
    rows += [(1000 + i, " ".join(f"copy{k}" for k in range(80)), "en", "a", 1, "h") for i in range(50)]
    rows += [(2000 + i, " ".join(name(i, k) for k in range(70)), "en", "a", 1, "h") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in quality.judge(df, "source", "doc_id").collect()}
    assert all(out[i].removed_words == 60 and not out[i].kept for i in range(300))
    assert all(r.kept and r.removed_words == 0 for i, r in out.items() if i >= 1000)
    assert {r.doc_id for r in quality.clean(df).collect()} == {i for i in out if i >= 1000}
