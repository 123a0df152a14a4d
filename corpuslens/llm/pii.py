"""Personal data by weak supervision, in column expressions only.

Patterns give candidate spans. Labelers of three kinds vote on each: regular expressions
(the base pattern, a stricter one, a canonical form), gazetteers (top-level domains,
country codes, card issuers, address ranges) and context (cue words before the span, its
neighbouring characters). Expectation maximisation over the counts of vote patterns
estimates for each kind how reliable every labeler is. The resulting probabilities train a
naive Bayes classifier on features of the span, which decides about spans beyond the base.

Places are code points. They come from the pieces between the matches: an explode and a
running sum per text and pattern, so a text with very many matches needs no more than a
sort. Patterns are possessive and anchored at the start of a run, which keeps them linear
and without recursion in very long texts.

Defined cases: a null text is an empty one; rows alike in id and text have equal spans;
an empty table gives an empty result; further columns are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.narrowing import parted
from corpuslens.session import materialise

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, written so that no start inside a run is tried twice.
BASE = {
    "email": r"(?=[A-Za-z0-9._%+-])(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Narrower forms that find data where the base match is too long, or written in another way.
STRICT = {
    "email": r"(?=[A-Za-z0-9._%+-])(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?=[0-9])(?<![0-9])(?:[0-9]{4}[\x20-]?){3}[0-9]{2,4}(?![0-9])",
    "phone": r"(?=[+(0-9])(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# Gazetteers (fixed values).
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "biz", "co", "uk", "de", "fr", "es", "it", "nl", "eu", "us", "ca", "au"]
COUNTRY_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91"]
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
CUES = {
    "email": r"\b(?:e-?mail|mail|contact|write|reach)\b",
    "ip": r"\b(?:ip|server|host|address|addr|from)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|payment|pay)\b",
    "phone": r"\b(?:phone|tel|call|mobile|fax|dial|contact)\b",
}
CONTEXT = 32  # characters before a span
VOTES = ["base", "strict", "form", "gazetteer", "cue", "edge"]
ROUNDS = 40


def _found(text: Column, pattern: str) -> Column:
    """Matches and the pieces before them, in order; the last entry is the piece after the last match."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    return F.zip_with(
        matches,
        pieces,
        lambda m, p: F.struct(
            m.alias("match"),
            F.length(m).alias("size"),
            F.length(p).alias("gap"),
            F.right(p, F.lit(CONTEXT)).alias("left"),
            F.left(p, F.lit(1)).alias("first"),
        ),
    )


def _of_kind(values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for kind, value in values.items():
        out = F.when(F.col("kind") == kind, value).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid() -> Column:
    """Whether a match holds what its kind demands beyond the pattern."""
    match = F.col("match")
    parts = F.transform(F.split(match, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    small = F.forall(
        parts, lambda x: (F.length(x) <= 3) & (F.coalesce(F.substring(x, 1, 3).try_cast("int"), F.lit(0)) <= 255)
    )
    n = F.length(_digits(match))
    return _of_kind({
        "email": F.lit(True),
        "ip": small,
        "card": n.between(14, 19) & F.call_function("luhn_check", F.substring(_digits(match), 1, 19)),
        "phone": n.between(10, 15),
    })


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: a row per document with its key, and the distinct candidate spans by key."""
    body = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    may = {
        "email": {"base": F.contains("text", F.lit("@")), "strict": F.col("text").rlike(r"[\[(]at[\])]")},
        "phone": {"base": F.contains("text", F.lit("+")), "strict": F.col("text").rlike(r"[0-9]{3}[\x20.-][0-9]{4}")},
        "ip": {"base": F.col("text").rlike(r"[0-9]\.[0-9]"), "strict": F.col("text").rlike(r"[0-9]\.[0-9]")},
        "card": {"base": F.col("text").rlike("[0-9]"), "strict": F.col("text").rlike("[0-9]{4}[ -]?[0-9]{4}")},
    }
    found = []
    for way, patterns in (("base", BASE), ("strict", STRICT)):
        for kind in KINDS:
            entries = F.when(may[kind][way], _found(F.col("text"), patterns[kind]))
            entries = F.when(F.size(entries) > 1, entries)
            found.append(F.struct(F.lit(kind).alias("kind"), F.lit(way).alias("way"), entries.alias("entries")))
    held = materialise(
        given.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            F.filter(F.array(*found), lambda x: x["entries"].isNotNull()).alias("found"),
        ),
        "pii-found",
    )
    keys = ["doc_id", "text_key"]
    one = held.filter(F.size("found") > 0).dropDuplicates(keys).select(*keys, F.explode("found").alias("f"))
    each = one.select(*keys, "f.kind", "f.way", F.posexplode("f.entries").alias("at", "e")).select(
        *keys, "kind", "way", "at", "e.*"
    )
    order = Window.partitionBy(*keys, "kind", "way").orderBy("at")
    size = F.coalesce("size", F.lit(0))
    placed = each.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("after", F.lead("first").over(order))
    spans = placed.filter("match is not null").filter(_valid()).select(
        *keys, "kind", "way", (F.col("end") - F.col("size")).alias("start"), "end", "match", "left", "after"
    )
    merged = spans.groupBy(*keys, "kind", "start", "end").agg(
        F.first("match").alias("match"), F.max("left").alias("left"), F.first("after").alias("after"),
        F.max((F.col("way") == "base").cast("int")).alias("base"),
        F.max((F.col("way") == "strict").cast("int")).alias("strict"),
    )
    return held.select(*keys), merged


def votes() -> dict[str, Column]:
    """What each labeler says about a candidate, 0 or 1."""
    match, digits = F.col("match"), _digits(F.col("match"))
    code = F.regexp_extract(match, r"^\+([0-9]{1,3}?)[^0-9]", 1)
    form = _of_kind({
        "email": match.rlike(r"^[a-z0-9]+(?:[._-][a-z0-9]+)*+@[a-z0-9-]+(?:\.[a-z0-9-]+)*+$"),
        "ip": ~match.rlike(r"(?:^|\.)0[0-9]"),
        "card": F.length(digits).isin(15, 16),
        "phone": F.length(digits).between(10, 13) & match.rlike(r"^(?:\+[0-9]{1,3} )?\(?[0-9]{3}\)?[ .-]"),
    })
    gazetteer = _of_kind({
        "email": F.lower(F.regexp_extract(match, r"([A-Za-z0-9]+)$", 1)).isin(DOMAINS),
        "ip": F.regexp_extract(match, "^0*([0-9]{0,3})", 1).try_cast("int").between(1, 223),
        "card": digits.rlike(ISSUERS),
        "phone": code.isin(COUNTRY_CODES) | ~F.startswith(match, F.lit("+")),
    })
    cue = _of_kind({k: F.lower("left").rlike(p) for k, p in CUES.items()})
    alone = ~F.right("left", F.lit(1)).rlike("[A-Za-z0-9]") & ~F.coalesce("after", F.lit("")).rlike("[A-Za-z0-9]")
    named = {"form": form, "gazetteer": gazetteer, "cue": cue, "edge": alone}
    return {
        "base": F.col("base"), "strict": F.col("strict"),
        **{k: F.coalesce(v, F.lit(False)).cast("int") for k, v in named.items()},
    }


def features() -> dict[str, Column]:
    """What the final classifier sees of a span."""
    match = F.col("match")
    digits, size = F.length(_digits(match)), F.length(match)
    kind_of = lambda c: F.when(c == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike("[A-Za-z0-9]"), "word").otherwise("other")
    return {
        "digits": F.least(digits, F.lit(20)).cast("string"),
        "size": F.least(F.floor(size / 4), F.lit(16)).cast("string"),
        "separators": F.least(size - F.length(F.regexp_replace(match, r"[\x20().-]", "")), F.lit(8)).cast("string"),
        "before": kind_of(F.right("left", F.lit(1))),
        "after": kind_of(F.coalesce("after", F.lit(""))),
        "plus": F.startswith(match, F.lit("+")).cast("string"),
    }


def _chance(value: Column) -> Column:
    return F.greatest(F.lit(0.02), F.least(F.lit(0.98), value))


def reliabilities(voted: DataFrame) -> DataFrame:
    """Per kind: ``prior``, and each labeler's chance to vote for true (``yes``) and false spans (``no``).

    Two-class model with independent labelers. It is fitted to the counts of vote
    patterns, at most 64 rows a kind, by a fold of ``ROUNDS`` steps in one expression.
    """
    patterns = voted.groupBy("kind", *VOTES).agg(F.count("*").alias("n"))
    packed = patterns.select("kind", F.array(*VOTES).alias("v"), F.col("n").cast("double").alias("n"))
    listed = packed.groupBy("kind").agg(F.collect_list(F.struct("v", "n")).alias("seen"))

    def probability(state: Column, v: Column) -> Column:
        def side(chances: Column, start: Column) -> Column:
            terms = F.zip_with(v, chances, lambda x, p: F.when(x == 1, p).otherwise(1 - p))
            return F.aggregate(terms, start, lambda a, b: a * b)

        yes, no = side(state["yes"], state["prior"]), side(state["no"], 1 - state["prior"])
        return yes / (yes + no)

    def step(state: Column, _: Column) -> Column:
        soft = F.transform("seen", lambda s: F.struct(s["v"].alias("v"), s["n"].alias("n"), (s["n"] * probability(state, s["v"])).alias("t")))
        return F.element_at(F.transform(F.array(soft), update), 1)

    def update(soft: Column) -> Column:
        zero = F.lit(0.0)
        true = F.aggregate(soft, zero, lambda a, s: a + s["t"])
        total = F.aggregate(soft, zero, lambda a, s: a + s["n"])
        places = F.sequence(F.lit(1), F.lit(len(VOTES)))
        said = lambda part: F.transform(places, lambda k: F.aggregate(soft, zero, lambda a, s: a + F.element_at(s["v"], k) * part(s)))
        yes = F.transform(said(lambda s: s["t"]), lambda x: _chance((x + 0.8) / (true + 1)))
        no = F.transform(said(lambda s: s["n"] - s["t"]), lambda x: _chance((x + 0.2) / (total - true + 1)))
        return F.struct(_chance((true + 1) / (total + 2)).alias("prior"), yes.alias("yes"), no.alias("no"))

    start = F.struct(
        F.lit(0.7).alias("prior"),
        F.array(*[F.lit(0.8)] * len(VOTES)).alias("yes"),
        F.array(*[F.lit(0.3)] * len(VOTES)).alias("no"),
    )
    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return listed.select("kind", fitted.alias("model")).select("kind", "model.*")


def _posterior(voted: DataFrame, model: DataFrame) -> DataFrame:
    yes, no = F.log("prior"), F.log(1 - F.col("prior"))
    for i, name in enumerate(VOTES):
        y, n = F.get("yes", F.lit(i)), F.get("no", F.lit(i))
        yes = yes + F.log(F.when(F.col(name) == 1, y).otherwise(1 - y))
        no = no + F.log(F.when(F.col(name) == 1, n).otherwise(1 - n))
    joined = voted.join(F.broadcast(model), "kind")  # one row a kind
    return joined.withColumn("truth", 1 / (1 + F.exp(no - yes))).drop("prior", "yes", "no")


def classified(voted: DataFrame) -> DataFrame:
    """``voted`` with ``truth`` (from the votes) and ``score`` (log odds of the trained classifier)."""
    labelled = _posterior(voted, reliabilities(voted))
    named = features()
    pairs = F.array(*[F.concat(F.lit(f"{k}="), v) for k, v in named.items()])
    labelled = labelled.withColumn("features", pairs)
    weights = (
        labelled.select("kind", "truth", F.explode("features").alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("truth").alias("yes"), F.sum(1 - F.col("truth")).alias("no"))
    )
    # Bounded: four kinds with six features of at most 22 values.
    totals = labelled.groupBy("kind").agg(F.sum("truth").alias("all_yes"), F.sum(1 - F.col("truth")).alias("all_no"))
    odds = weights.join(totals, "kind").select(
        "kind", "feature", (F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 1)) - F.log((F.col("no") + 0.5) / (F.col("all_no") + 1))).alias("w")
    )
    model = odds.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("feature", "w"))).alias("weights"))
    model = model.join(totals, "kind").withColumn("bias", F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)))
    model = materialise(model.select("kind", "bias", "weights"), "pii-model")
    score = F.aggregate("features", F.col("bias"), lambda s, f: s + F.coalesce(F.try_element_at("weights", f), F.lit(0.0)))
    return labelled.join(F.broadcast(model), "kind").withColumn("score", score).drop("bias", "weights", "features")


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, by_key)``: keys of all rows, and per key the base spans and all spans, sorted.

    A span beyond the base is kept if the classifier favours it and it meets no base span.
    """
    rows, found = candidates(docs)
    said = votes()
    voted = materialise(found.withColumns(said), "pii-votes")
    scored = classified(voted)
    span = F.struct(
        F.col("start").cast("long").alias("start"),
        F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("place"),
        F.col("end").cast("long").alias("end"),
        "kind",
    )
    keys = ["doc_id", "text_key"]
    grouped = scored.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("base") == 1, span))).alias("base"),
        F.array_sort(F.collect_list(F.when((F.col("base") == 0) & (F.col("score") > 0), span))).alias("added"),
    )
    apart = F.filter(
        "added", lambda a: ~F.exists(F.col("base"), lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"]))
    )
    return rows, grouped.select(*keys, "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def span_list(name: str) -> Column:
    return F.array_join(
        F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its base spans and all spans as arrays of ``(start, place, end, kind)``."""
    rows, by_key = spans(docs)
    same = rows.doc_id.eqNullSafe(by_key.doc_id) & (rows.text_key == by_key.text_key)
    none = F.array().cast(by_key.schema["base"].dataType)
    joined = rows.join(by_key, same, "left")
    return joined.select(rows.doc_id, F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first one."""
    _, by_key = spans(docs)
    disjoint = F.aggregate(
        "spans",
        F.struct(F.array().cast(by_key.schema["spans"].dataType).alias("kept"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.when(
            x["start"] >= s["end"], F.struct(F.concat(s["kept"], F.array(x)).alias("kept"), x["end"].alias("end"))
        ).otherwise(s),
        lambda s: s["kept"],
    )
    marks = by_key.select("doc_id", "text_key", disjoint.alias("_p_spans"))
    marks = materialise(marks.filter(F.size("_p_spans") > 0), "pii-spans")
    marks = marks.withColumnsRenamed({"doc_id": "_p_doc", "text_key": "_p_text"})
    key = F.xxhash64(F.coalesce(docs.text, F.lit("")))
    # Texts that hold no span stay where they are.
    clean, docs = parted(docs, [docs.doc_id, key], marks, ["_p_doc", "_p_text"])
    joined = docs.join(marks, docs.doc_id.eqNullSafe(marks["_p_doc"]) & (key == marks["_p_text"]), "left")
    text = docs.text
    before = F.transform(
        "_p_spans",
        lambda s, i: F.concat(
            F.substring(
                text,
                (F.when(i == 0, 0).otherwise(F.get("_p_spans", i - 1)["end"]) + 1).cast("int"),
                (s["start"] - F.when(i == 0, 0).otherwise(F.get("_p_spans", i - 1)["end"])).cast("int"),
            ),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ),
    )
    last = F.element_at("_p_spans", -1)["end"]
    rebuilt = F.concat(F.array_join(before, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    marked = F.col("_p_spans").isNotNull()
    out = {c: docs[c] for c in docs.columns} | {"text": F.when(marked, rebuilt).otherwise(text)}
    if "n_chars" in out:
        size = F.when(marked, F.length(rebuilt)).otherwise(docs.n_chars)
        out["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return clean.unionByName(joined.select(*[value.alias(c) for c, value in out.items()]))
