"""SQL that computes the registered queries on the same tables, independently of Spark."""

from __future__ import annotations

# The rules are written out here once more, so that they check the package's and not repeat them.
MIN_FREQ = 5
BATCH = 32
MAX_LENGTH = 128
SAMPLE = 100
SELECTED = 25
PIECES = 30_000
MAX_PIECE = 6
MERGE_ROUNDS = 8
LEARNED = 100
MERGES = 64

BREAK_TAG = r"<br\s*/?>"
SPACE = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\p{L}\p{N}_"

FORMS = [
    ("the", "won't"), ("of", "it's"), ("and", "they've<br />"), ("in", "gonna"), ("to", "dog's"), ("a", "I’m"), ("on", "y'all can't"),
    ("que", "we'd"), ("de", "o'clock<br>"), ("der", "aren't"), ("die", "she'll"), ("le", "lemme let's"),
]
CONTRACTIONS = [
    (r"\bwon't\b", "will not"), (r"\bcan't\b", "cannot"), (r"\bshan't\b", "shall not"), (r"\bain't\b", "are not"),
    (r"\blet's\b", "let us"), (r"\by'all\b", "you all"), (r"\bma'am\b", "madam"), (r"\bo'clock\b", "of the clock"),
    (r"\bgonna\b", "going to"), (r"\bwanna\b", "want to"), (r"\bgotta\b", "got to"), (r"\bgimme\b", "give me"),
    (r"\blemme\b", "let me"), (r"(\p{L})n't\b", r"\1 not"), (r"(\p{L})'re\b", r"\1 are"), (r"(\p{L})'ve\b", r"\1 have"),
    (r"(\p{L})'ll\b", r"\1 will"), (r"(\p{L})'d\b", r"\1 would"), (r"(\p{L})'m\b", r"\1 am"),
    (r"\b(it|that|he|she|what|where|who|there|here|how|when|why)'s\b", r"\1 is"),
]
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
    itself they them their theirs themselves what which who whom this that these those am is are was were be been being have
    has had having do does did doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own same so than too very can will
    just should now
"""
TREEBANK = {"cannot": "can not", "gimme": "gim me", "gonna": "gon na", "gotta": "got ta", "lemme": "lem me", "wanna": "wan na"}
PROMPT_HEAD = "Decide whether the review below is positive or negative.\nReview:\n"
PROMPT_TAIL = "\nReply with one lower-case word, positive or negative."


# Endings of nouns, verbs and adjectives, and irregular forms by part of speech.
ENDINGS = """
s: ses:s xes:x zes:z ches:ch shes:sh men:man ies:y
s: ies:y es:e es: ed:e ed: ing:e ing:
er: est: er:e est:e"""
IRREGULAR = """
children:child feet:foot geese:goose halves:half knives:knife leaves:leaf lives:life loaves:loaf men:man mice:mouse oxen:ox
shelves:shelf teeth:tooth thieves:thief wives:wife wolves:wolf women:woman
am:be are:be been:be began:begin came:come did:do does:do done:do fell:fall felt:feel found:find gave:give gone:go got:get
had:have has:have is:be kept:keep knew:know left:leave lost:lose made:make met:meet ran:run said:say saw:see seen:see
shown:show stood:stand taken:take thought:think told:tell took:take was:be went:go were:be
best:good better:good further:far less:little worse:bad worst:bad"""


def listed_pairs(text: str, numbered: bool) -> str:
    pairs = [entry.split(":") for entry in text.split()]
    rows = [f"({i}, {sql_text(a)}, {sql_text(b)})" if numbered else f"({sql_text(a)}, {sql_text(b)})" for i, (a, b) in enumerate(pairs)]
    return ", ".join(rows)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def replaced(column: str, pattern: str, new: str) -> str:
    return f"regexp_replace({column}, {sql_text(pattern)}, {sql_text(new)}, 'g')"


def formed(column: str) -> str:
    for word, form in FORMS:
        column = f"replace({column}, ' {word} ', {sql_text(f' {form} ')})"
    return column


def expanded(column: str) -> str:
    out = f"replace({column}, '’', '''')"
    for pattern, new in CONTRACTIONS:
        out = replaced(out, pattern, new)
    return out


def lowered(column: str) -> str:
    return expanded(f"lower({replaced(column, BREAK_TAG, ' ')})")


def split_words(column: str) -> str:
    return f"list_filter(string_split_regex({column}, {sql_text(f'[{SPACE}]+')}), lambda x: x <> '')"


STOP_LIST = ", ".join(sql_text(w) for w in STOP_WORDS.split())


def without_stop_words(column: str) -> str:
    return f"array_to_string(list_filter({split_words(column)}, lambda x: x NOT IN ({STOP_LIST})), ' ')"


def no_punctuation(column: str) -> str:
    return replaced(column, f"[^{WORD}{SPACE}]", "")


def word_or_punctuation(column: str) -> str:
    return f"regexp_extract_all({column}, {sql_text(f'([{WORD}]+|[^{WORD}{SPACE}])')}, 1)"


def cleaned(column: str) -> str:
    return no_punctuation(lowered(column))


def label_name(column: str) -> str:
    return f"CASE {column} WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END"


def csv(column: str) -> str:
    return f"array_to_string({column}, ',')"


def uniform(salt: str, column: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || {column}), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE)"


def grown(me: str, cdf: str, sizes: str, most: int) -> str:
    """Recursive sentence growth: one seeded draw per step from the cumulative weights."""
    return f"""
        SELECT n, doc_id AS sent_id, 0 AS step, CASE n WHEN 2 THEN '<s>' ELSE '<s> <s>' END AS context,
               []::VARCHAR[] AS words, false AS done
        FROM test_documents JOIN (SELECT unnest({sizes}) AS n) ON true
        UNION ALL {onward(me, cdf, most)}"""


def onward(me: str, cdf: str, most: int) -> str:
    u = "(('0x' || substr(md5('42:' || (step + 1) || ':' || sent_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE)"
    draw = f"floor({u} * mass)"
    return f"""
        SELECT g.n, sent_id, step + 1, CASE g.n WHEN 2 THEN c.word ELSE split_part(g.context, ' ', 2) || ' ' || c.word END,
               CASE WHEN c.word = '</s>' THEN words ELSE list_append(words, c.word) END, c.word = '</s>'
        FROM {me} g JOIN {cdf} c ON g.n = c.n AND g.context = c.context AND {draw} >= hi - w AND {draw} < hi
        WHERE NOT done AND step < {most}"""


def merge_parts() -> dict[str, str]:
    """Rounds of merges over the distinct words: frequent pairs, then a walk over each word from the left."""
    parts = {"merged_0": "SELECT token, cnt, string_split(token, '') AS syms FROM distinct_words"}
    for i in range(1, MERGE_ROUNDS + 1):
        parts[f"pairs_{i}"] = f"""
            SELECT p[1] || chr(1) || p[2] AS pair FROM (
                SELECT p, sum(cnt) AS n FROM (
                    SELECT unnest(list_transform(range(1, len(syms)), lambda k: [syms[k], syms[k + 1]])) AS p, cnt FROM merged_{i - 1})
                GROUP BY p ORDER BY n DESC, p[1], p[2] LIMIT {MERGES})"""
        parts[f"merged_{i}"] = f"""
            SELECT token, cnt, CASE WHEN len(syms) < 2 THEN syms ELSE list_reduce(list_transform(syms, lambda x: [x]), lambda done, x:
                CASE WHEN list_contains(pairs, done[len(done)] || chr(1) || x[1])
                     THEN list_append(done[1:len(done) - 1], done[len(done)] || x[1]) ELSE list_concat(done, x) END) END AS syms
            FROM merged_{i - 1}, (SELECT list(pair) AS pairs FROM pairs_{i})"""
    return parts


# ---- the published stemmer, one part per step ----------------------------------

STEP_2 = """ational ate, tional tion, enci ence, anci ance, izer ize, abli able, alli al, entli ent, eli e, ousli ous, ization ize,
    ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al, iviti ive, biliti ble"""
STEP_3 = "icate ic, ative , alize al, iciti ic, ical ic, ful , ness "
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def shape(word: str) -> str:
    """The word as v and c; y is a vowel after a consonant."""
    kind = """CASE WHEN x IN ('a', 'e', 'i', 'o', 'u') OR (x = 'y' AND ends_with(done, 'c')) THEN 'v' ELSE 'c' END"""
    return f"list_reduce(list_prepend('', string_split({word}, '')), lambda done, x: CASE WHEN x = '' THEN done ELSE done || {kind} END)"


def measure(word: str) -> str:
    return f"len(regexp_extract_all({shape(word)}, 'v+c+'))"


def short(word: str) -> str:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return f"(ends_with({shape(word)}, 'cvc') AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def suffix_step(source: str, table: str) -> str:
    """Replace the longest suffix of a table if something is left that holds a vowel and a consonant."""
    rows = [(x.strip().split(" ") + [""])[:2] for x in table.replace("\n", " ").split(",")]
    rows = sorted(([a.strip(), b.strip()] for a, b in rows), key=lambda x: -len(x[0]))
    cut = " ".join(f"WHEN ends_with(w, '{a}') THEN '{a}'" for a, _ in rows)
    new = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rows)
    return f"""
        SELECT token, CASE WHEN cut IS NOT NULL AND {measure('stem')} > 0 THEN stem || (CASE cut {new} END) ELSE w END AS w
        FROM (SELECT *, left(w, length(w) - length(cut)) AS stem FROM (SELECT *, CASE {cut} END AS cut FROM {source}))"""


def stem_parts() -> dict[str, str]:
    residue = " ".join(f"WHEN ends_with(w, '{a}') THEN '{a}'" for a in sorted(STEP_4.split(), key=lambda x: -len(x)))
    return {
        "stem_1": """
            SELECT token, CASE WHEN ends_with(token, 'sses') OR ends_with(token, 'ies') THEN left(token, length(token) - 2)
                WHEN ends_with(token, 'ss') THEN token WHEN ends_with(token, 's') THEN left(token, length(token) - 1) ELSE token END AS w
            FROM distinct_words WHERE length(token) > 2""",
        "stem_2a": f"""
            SELECT token, w, CASE WHEN ends_with(w, 'eed') THEN NULL
                WHEN ends_with(w, 'ed') AND contains({shape('left(w, length(w) - 2)')}, 'v') THEN left(w, length(w) - 2)
                WHEN ends_with(w, 'ing') AND contains({shape('left(w, length(w) - 3)')}, 'v') THEN left(w, length(w) - 3) END AS stem FROM stem_1""",
        "stem_2": f"""
            SELECT token, CASE
                WHEN ends_with(w, 'eed') THEN CASE WHEN {measure('left(w, length(w) - 3)')} > 0 THEN left(w, length(w) - 1) ELSE w END
                WHEN stem IS NULL THEN w
                WHEN right(stem, 2) IN ('at', 'bl', 'iz') THEN stem || 'e'
                WHEN length(stem) > 1 AND right(stem, 1) = left(right(stem, 2), 1) AND ends_with({shape('stem')}, 'c')
                    AND right(stem, 1) NOT IN ('l', 's', 'z') THEN left(stem, length(stem) - 1)
                WHEN {measure('stem')} = 1 AND {short('stem')} THEN stem || 'e' ELSE stem END AS w FROM stem_2a""",
        "stem_3": f"""
            SELECT token, CASE WHEN ends_with(w, 'y') AND contains({shape('left(w, length(w) - 1)')}, 'v')
                THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM stem_2""",
        "stem_4": suffix_step("stem_3", STEP_2),
        "stem_5": suffix_step("stem_4", STEP_3),
        "stem_6": f"""
            SELECT token, CASE WHEN cut IS NOT NULL AND (cut <> 'ion' OR right(stem, 1) IN ('s', 't')) AND {measure('stem')} > 1
                THEN stem ELSE w END AS w
            FROM (SELECT *, left(w, length(w) - length(cut)) AS stem FROM (SELECT *, CASE {residue} END AS cut FROM stem_5))""",
        "stem_7": f"""
            SELECT token, CASE WHEN ends_with(w, 'e') AND ({measure('stem')} > 1 OR ({measure('stem')} = 1 AND NOT {short('stem')}))
                THEN stem ELSE w END AS w FROM (SELECT *, left(w, length(w) - 1) AS stem FROM stem_6)""",
        "stems": f"""
            SELECT token, CASE WHEN ends_with(w, 'll') AND {measure('w')} > 1 THEN left(w, length(w) - 1) ELSE w END AS form FROM stem_7
            UNION ALL SELECT token, token FROM distinct_words WHERE length(token) <= 2""",
    }


def regression_parts(name: str, first: str, second: str) -> dict[str, str]:
    """Newton's steps to the optimum of a regularised logistic regression on the idf-weighted counts of two words.

    Features are divided by their deviation in training; the penalty is on the coefficients of these.
    """
    counts = f"""
        SELECT w.doc_id, split, CASE sentiment WHEN 'positive' THEN 1 ELSE 0 END AS label,
               len(list_filter(words, lambda x: x = {sql_text(first)}))::DOUBLE AS n1,
               len(list_filter(words, lambda x: x = {sql_text(second)}))::DOUBLE AS n2
        FROM words w JOIN splits USING (doc_id)"""
    scale = f"""
        SELECT ln((count(*) + 1.0::DOUBLE) / (count(*) FILTER (n1 > 0) + 1)) / stddev_samp(n1 * ln((m + 1.0::DOUBLE) / (d1 + 1))) AS s1,
               ln((count(*) + 1.0::DOUBLE) / (count(*) FILTER (n2 > 0) + 1)) / stddev_samp(n2 * ln((m + 1.0::DOUBLE) / (d2 + 1))) AS s2
        FROM {name}_counts, (SELECT count(*) AS m, count(*) FILTER (n1 > 0) AS d1, count(*) FILTER (n2 > 0) AS d2
                             FROM {name}_counts WHERE split = 'train')
        WHERE split = 'train'"""
    features = f"SELECT doc_id, split, label, n1 * s1 AS z1, n2 * s2 AS z2 FROM {name}_counts, {name}_scale"
    # Determinants of the three normal equations; d is the whole one.
    steps = f"""
        SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
        UNION ALL
        SELECT step + 1,
               b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d,
               b1 - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d,
               b2 - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d
        FROM (
            SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS d
            FROM (
                SELECT step, b0, b1, b2, avg(p - label) AS g0, avg((p - label) * z1) + 0.01 * b1 AS g1, avg((p - label) * z2) + 0.01 * b2 AS g2,
                       avg(v) AS h00, avg(v * z1) AS h01, avg(v * z2) AS h02, avg(v * z1 * z1) + 0.01 AS h11, avg(v * z1 * z2) AS h12,
                       avg(v * z2 * z2) + 0.01 AS h22
                FROM (SELECT *, p * (1 - p) AS v FROM (
                    SELECT step, b0, b1, b2, label, z1, z2, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS p
                    FROM {name}_steps, {name}_features WHERE split = 'train' AND step < 25))
                GROUP BY step, b0, b1, b2))"""
    scores = f"""
        SELECT doc_id, split, label, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS score
        FROM {name}_features, (SELECT * FROM {name}_steps WHERE step = 25)"""
    parts = {"counts": counts, "scale": scale, "features": features, "steps": steps, "scores": scores}
    return {f"{name}_{part}": body for part, body in parts.items()}


REGRESSION_METRICS = "round(exp(avg(-ln(CASE label WHEN 1 THEN score ELSE 1 - score END))), 3) AS perplexity"


def class_counts(source: str) -> dict[str, str]:
    """Multinomial class model of a token relation ``(doc_id, token)``, smoothed by one."""
    return {
        f"{source}_classes": f"""
            SELECT token, count(*) FILTER (sentiment = 'positive') AS p, count(*) FILTER (sentiment = 'negative') AS q
            FROM {source} JOIN reviews USING (doc_id) JOIN splits USING (doc_id) WHERE split = 'train' AND sentiment IS NOT NULL GROUP BY token""",
        f"{source}_totals": f"SELECT sum(p)::DOUBLE AS ps, sum(q)::DOUBLE AS qs, count(*) AS v FROM {source}_classes",
        f"{source}_scores": f"""
            SELECT r.doc_id, split, CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 END::INTEGER AS label,
                   1 / (1 + exp(-(prior + coalesce(odds, 0)))) AS score
            FROM reviews r JOIN splits s ON r.doc_id = s.doc_id JOIN (
                SELECT ln((count(*) FILTER (sentiment = 'positive') + 1)::DOUBLE / (count(*) FILTER (sentiment = 'negative') + 1)) AS prior
                FROM reviews JOIN splits USING (doc_id) WHERE split = 'train') ON true
            LEFT JOIN (
                SELECT t.doc_id, sum(ln((coalesce(p, 0) + 1) / (ps + v)) - ln((coalesce(q, 0) + 1) / (qs + v))) AS odds
                FROM {source} t LEFT JOIN {source}_classes c ON t.token = c.token JOIN {source}_totals ON true GROUP BY t.doc_id) o
            ON r.doc_id = o.doc_id""",
    }


# Named parts; each entry may use the ones before it.
PARTS = {
    "reviews": f"""
        SELECT d.doc_id, d.text AS review, {label_name('l.quality')} AS sentiment
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "reviews_all": f"""
        SELECT d.doc_id, d.text AS review, {label_name('l.quality')} AS sentiment
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "corpus": f"SELECT doc_id, sentiment, {cleaned('review')} AS review FROM reviews",
    "words": f"SELECT doc_id, sentiment, review, {split_words('review')} AS words FROM corpus",
    "corpus_all": f"SELECT doc_id, sentiment, {cleaned('review')} AS review FROM reviews_all",
    "words_all": f"SELECT doc_id, sentiment, review, {split_words('review')} AS words FROM corpus_all",
    "turn_words": f"""
        SELECT conv_id, turn, role AS sentiment, {split_words(cleaned('text'))} AS words FROM conversations""",
    "formed_turns": f"""
        SELECT conv_id, turn, {split_words(cleaned(formed('text')))} AS words FROM conversations""",
    "ranked": """
        SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS r, count(*) OVER () AS total
        FROM reviews""",
    "splits": """
        SELECT doc_id, CASE
            WHEN r < trunc(total * 0.8::DOUBLE) THEN 'train'
            WHEN r < trunc(total * 0.8::DOUBLE) + trunc(total * 0.1::DOUBLE) THEN 'val'
            ELSE 'test' END AS split
        FROM ranked""",
    "chosen": f"""
        SELECT doc_id FROM splits WHERE split = 'test'
        ORDER BY md5('42:selected:' || doc_id), doc_id LIMIT {SELECTED}""",
    "tokens": """
        SELECT doc_id, sentiment, split, unnest(words) AS token, generate_subscripts(words, 1) AS pos
        FROM words JOIN splits USING (doc_id)""",
    "all_tokens": "SELECT doc_id, sentiment, unnest(words) AS token FROM words_all",
    "turn_tokens": "SELECT sentiment, unnest(words) AS token FROM turn_words",
    "scopes": """
        SELECT token, count(*) FILTER (sentiment = 'positive') AS positive,
               count(*) FILTER (sentiment = 'negative') AS negative, count(*) AS overall
        FROM tokens GROUP BY token""",
    "frequency": "SELECT scope, token, cnt FROM scopes UNPIVOT (cnt FOR scope IN (positive, negative, overall)) WHERE cnt > 0",
    "firsts": """
        SELECT token, 'overall' AS scope, min((doc_id, pos)) AS first FROM tokens GROUP BY token
        UNION ALL SELECT token, sentiment, min((doc_id, pos)) FROM tokens WHERE sentiment IS NOT NULL GROUP BY token, sentiment""",
    "grams": """
        SELECT *, unnest([2, 3, 4]) AS n, unnest([g2, g3, g4]) AS gram FROM (
            SELECT doc_id, sentiment, pos,
                token || ' ' || lead(token, 1) OVER w AS g2,
                token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS g3,
                token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w || ' ' || lead(token, 3) OVER w AS g4
            FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY pos))""",
    "gram_counts": """
        SELECT n, 'overall' AS scope, gram, count(*) AS cnt, min((doc_id, pos)) AS first
        FROM grams WHERE gram IS NOT NULL GROUP BY n, gram
        UNION ALL
        SELECT n, sentiment, gram, count(*), min((doc_id, pos))
        FROM grams WHERE gram IS NOT NULL AND sentiment IS NOT NULL GROUP BY n, sentiment, gram""",
    "terms": "SELECT token AS term, positive, negative FROM scopes WHERE positive + negative > 0",
    "term_totals": """
        SELECT sum(positive)::DOUBLE AS ni, sum(negative)::DOUBLE AS nj, count(*) * 0.01::DOUBLE AS a0, 0.01::DOUBLE AS a FROM terms""",
    "odds": """
        SELECT term, positive, negative,
            (ln((positive + a) / (ni + a0 - positive - a)) - ln((negative + a) / (nj + a0 - negative - a)))
            / sqrt(1 / (positive + a) + 1 / (negative + a)) AS z
        FROM terms, term_totals""",
    "padded": """
        SELECT doc_id, split, unnest(list_append(words, '</s>')) AS word, generate_subscripts(list_append(words, '</s>'), 1) AS pos
        FROM words JOIN splits USING (doc_id)""",
    "padded_lags": """
        SELECT doc_id, split, word, pos, coalesce(lag(word, 1) OVER w, '<s>') AS back1, coalesce(lag(word, 2) OVER w, '<s>') AS back2
        FROM padded WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""",
    "events": """
        SELECT doc_id, split, pos, 2 AS n, back1 AS context, word FROM padded_lags
        UNION ALL SELECT doc_id, split, pos, 3, back2 || ' ' || back1, word FROM padded_lags""",
    "counts": "SELECT n, context, word, count(*) AS cnt FROM events WHERE split = 'train' GROUP BY n, context, word",
    "totals": "SELECT n, context, sum(cnt)::BIGINT AS total FROM counts GROUP BY n, context",
    "v": "SELECT n, count(DISTINCT word) AS v FROM counts GROUP BY n",
    "test_events": "SELECT n, context, word, count(*) AS w FROM events WHERE split = 'test' GROUP BY n, context, word",
    "scored_events": """
        SELECT e.n, e.context, e.word, e.w, coalesce(c.cnt, 0) AS cnt, coalesce(t.total, 0) AS total, v.v
        FROM test_events e LEFT JOIN counts c ON e.n = c.n AND e.context = c.context AND e.word = c.word
        LEFT JOIN totals t ON e.n = t.n AND e.context = t.context JOIN v ON e.n = v.n""",
    "laplace": """
        SELECT n, sum(w)::BIGINT AS events, round(exp(-sum(w * ln((cnt + 1)::DOUBLE / (total + v))) / sum(w)), 4) AS perplexity
        FROM scored_events GROUP BY n""",
    "mass": """
        SELECT n, context, word, cnt + 1 AS w, sum(cnt + 1) OVER (PARTITION BY n, context) AS mass,
               sum(cnt + 1) OVER (PARTITION BY n, context ORDER BY substr(md5(word), 1, 2), word) AS hi
        FROM counts""",
    "sharp": """
        SELECT * FROM (
            SELECT n, context, word, round(pow((cnt + 1)::DOUBLE / top, 1 / 0.8::DOUBLE) * floor(9007199254740992.0::DOUBLE / successors))::BIGINT AS w
            FROM (SELECT *, max(cnt + 1) OVER (PARTITION BY n, context) AS top, count(*) OVER (PARTITION BY n, context) AS successors
                  FROM counts WHERE n = 2)) WHERE w > 0""",
    "sharp_mass": """
        SELECT n, context, word, w, sum(w) OVER (PARTITION BY n, context) AS mass,
               sum(w) OVER (PARTITION BY n, context ORDER BY substr(md5(word), 1, 2), word) AS hi
        FROM sharp""",
    "test_documents": "SELECT doc_id FROM splits WHERE split = 'test'",
    "grown": grown("grown", "mass", "[2, 3]", 20),
    "sharp_grown": grown("sharp_grown", "sharp_mass", "[2]", 15),
    "started_grown": f"""
        SELECT 2 AS n, doc_id AS sent_id, 0 AS step, words[1] AS context, [words[1]] AS words, false AS done
        FROM words JOIN splits USING (doc_id) WHERE split = 'train' AND len(words) > 0
        UNION ALL {onward('started_grown', 'mass', 19)}""",
    "turn_splits": """
        SELECT doc_id, words, CASE WHEN r < trunc(total * 0.8::DOUBLE) THEN 'train'
            WHEN r < trunc(total * 0.8::DOUBLE) + trunc(total * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT conv_id * 1000 + turn AS doc_id, words, count(*) OVER () AS total,
                     row_number() OVER (ORDER BY md5('42:' || (conv_id * 1000 + turn)), conv_id * 1000 + turn) - 1 AS r FROM turn_words)""",
    "turn_padded": """
        SELECT doc_id, split, unnest(list_append(words, '</s>')) AS word, generate_subscripts(list_append(words, '</s>'), 1) AS pos
        FROM turn_splits""",
    "turn_lags": """
        SELECT doc_id, split, word, coalesce(lag(word, 1) OVER w, '<s>') AS back1, coalesce(lag(word, 2) OVER w, '<s>') AS back2
        FROM turn_padded WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""",
    "turn_events": """
        SELECT split, 1 AS n, '' AS context, word FROM turn_lags
        UNION ALL SELECT split, 2, back1, word FROM turn_lags
        UNION ALL SELECT split, 3, back2 || ' ' || back1, word FROM turn_lags""",
    "turn_counts": "SELECT n, context, word, count(*) AS cnt FROM turn_events WHERE split = 'train' GROUP BY n, context, word",
    "turn_totals": "SELECT n, context, sum(cnt) AS total FROM turn_counts GROUP BY n, context",
    "vocabulary": f"""
        SELECT * FROM (VALUES ('<PAD>', 0, 0), ('<UNK>', 1, 0), ('<s>', 2, 0), ('</s>', 3, 0)) AS s(token, id, cnt)
        UNION ALL
        SELECT token, (3 + row_number() OVER (ORDER BY min((doc_id, pos))))::INTEGER, count(*)
        FROM tokens WHERE split = 'train' GROUP BY token HAVING count(*) >= {MIN_FREQ}""",
    "bounded": """
        SELECT doc_id, split, unnest(list_concat(['<s>'], words, ['</s>'])) AS token,
               generate_subscripts(list_concat(['<s>'], words, ['</s>']), 1) AS pos
        FROM words JOIN splits USING (doc_id)""",
    "encoded": """
        SELECT doc_id, split, list(coalesce(id, 1) ORDER BY pos) AS ids
        FROM bounded LEFT JOIN vocabulary USING (token) GROUP BY doc_id, split""",
    "pairs": "SELECT doc_id, split, ids[1:len(ids) - 1] AS input_ids, ids[2:] AS target_ids FROM encoded",
    "rated": f"""
        SELECT r.doc_id, r.review, r.sentiment AS gold_label, CASE toxic WHEN 1 THEN 'negative' ELSE 'positive' END AS model_prediction,
            CASE WHEN substr(md5('judge:' || r.doc_id), 1, 1) < 'c' THEN r.sentiment
                 ELSE CASE r.sentiment WHEN 'positive' THEN 'negative' ELSE 'positive' END END AS llm_judge,
            CASE WHEN substr(md5('human:' || r.doc_id), 1, 1) < '4' THEN r.sentiment END AS human_rating
        FROM reviews r JOIN labels l ON r.doc_id = l.doc_id""",
    "scores": f"""
        SELECT r.doc_id, review, split, c.doc_id IS NOT NULL AS selected, quality AS label, 1 - toxic AS prediction,
               round({uniform('score', 'r.doc_id')}, 9) * 0.98::DOUBLE + 0.01::DOUBLE AS p
        FROM reviews r JOIN labels l ON r.doc_id = l.doc_id JOIN splits s ON r.doc_id = s.doc_id
        LEFT JOIN chosen c ON r.doc_id = c.doc_id""",
    "losses": "SELECT *, -ln(CASE label WHEN 1 THEN p ELSE 1 - p END) AS loss FROM scores",
    "answers": """
        SELECT doc_id, CASE
            WHEN d < '3' THEN 'Positive.' WHEN d < '6' THEN 'NEGATIVE!' WHEN d = '6' THEN 'neg, then positive'
            WHEN d = '7' THEN 'pos' WHEN d = '8' THEN ' Posh negative' WHEN d = '9' THEN '' ELSE review END AS answer
        FROM (SELECT doc_id, review, substr(md5('answer:' || doc_id), 1, 1) AS d FROM reviews)""",
    "attempts": """
        SELECT doc_id, llm_judge, i AS attempt, substr(md5('log:' || doc_id), i, 1) AS code
        FROM rated JOIN (SELECT unnest([1, 2, 3, 4])::INTEGER AS i) ON
            regexp_full_match(substr(md5('log:' || doc_id), 1, i - 1), '[89abc]*')""",
    "responses": """
        SELECT doc_id, attempt, llm_judge,
            CASE WHEN code < '8' THEN 200 WHEN code < 'd' THEN 429 WHEN code = 'd' THEN 500 WHEN code = 'e' THEN 402 END AS status
        FROM attempts""",
    "resolved": """
        SELECT doc_id, CASE WHEN status = 200 THEN llm_judge ELSE 'negative' END AS llm_judge,
            coalesce(status, 0) <> 200 AS defaulted, CASE WHEN status = 429 AND attempt < 3 THEN attempt * 5 END AS next_wait_s
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY attempt DESC) AS k FROM responses WHERE attempt <= 3)
        WHERE k = 1""",
    "distinct_words": "SELECT token, count(*) AS cnt FROM tokens GROUP BY token",
    "piece_rows": f"""
        SELECT substr(token, 1, k) AS piece, cnt FROM distinct_words, (SELECT unnest(range(2, {MAX_PIECE + 1})) AS k) WHERE k <= len(token)
        UNION ALL
        SELECT '##' || right(token, k), cnt FROM distinct_words, (SELECT unnest(range(2, {MAX_PIECE + 1})) AS k) WHERE k < len(token)
        UNION ALL
        SELECT CASE WHEN i = 1 THEN '' ELSE '##' END || substr(token, i, 1), cnt
        FROM (SELECT token, cnt, unnest(range(1, len(token) + 1)) AS i FROM distinct_words)""",
    "piece_counts": """
        SELECT piece, sum(cnt)::BIGINT AS cnt, len(CASE WHEN starts_with(piece, '##') AND len(piece) > 2 THEN substr(piece, 3) ELSE piece END) = 1 AS single
        FROM piece_rows GROUP BY piece""",
    "kept_pieces": f"""
        SELECT piece, cnt, true AS single FROM piece_counts WHERE single
        UNION ALL SELECT * FROM (SELECT piece, cnt, false FROM piece_counts WHERE NOT single ORDER BY cnt DESC, piece LIMIT {PIECES})""",
    "pieces": """
        SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 1, 0), ('[CLS]', 2, 0), ('[SEP]', 3, 0)) AS s(piece, id, cnt)
        UNION ALL SELECT piece, (row_number() OVER (ORDER BY single DESC, cnt DESC, piece) + 3)::INTEGER, cnt FROM kept_pieces""",
    "longest": f"""
        SELECT token, i, max(k) AS k, max_by(id, k) AS id FROM (
            SELECT token, i, k, CASE WHEN i = 1 THEN '' ELSE '##' END || substr(token, i, k) AS piece
            FROM (SELECT token, unnest(range(1, len(token) + 1)) AS i FROM distinct_words),
                 (SELECT unnest(range(1, {MAX_PIECE + 1})) AS k) WHERE i + k - 1 <= len(token))
        JOIN pieces USING (piece) GROUP BY token, i""",
    "walk": """
        SELECT token, 1::BIGINT AS at, []::INTEGER[] AS ids FROM distinct_words
        UNION ALL
        SELECT w.token, w.at + l.k, list_append(w.ids, l.id) FROM walk w JOIN longest l ON w.token = l.token AND w.at = l.i""",
    "segmented": """
        SELECT d.token, coalesce(w.ids, [1]) AS ids FROM distinct_words d
        LEFT JOIN walk w ON d.token = w.token AND w.at = len(d.token) + 1""",
    "unigram_pieces": """
        SELECT piece, id, round(ln(cnt::DOUBLE / (SELECT sum(cnt) FROM pieces)), 9) AS logp FROM pieces WHERE id >= 4""",
    "unigram_spans": f"""
        SELECT token, i + k - 1 AS e, list({{'i': i, 'k': k, 'id': id, 'logp': logp}}) AS spans FROM (
            SELECT token, i, k, CASE WHEN i = 1 THEN '' ELSE '##' END || substr(token, i, k) AS piece
            FROM (SELECT token, unnest(range(1, len(token) + 1)) AS i FROM distinct_words),
                 (SELECT unnest(range(1, {MAX_PIECE + 1})) AS k) WHERE i + k - 1 <= len(token))
        JOIN unigram_pieces USING (piece) GROUP BY token, e""",
    "forward": """
        SELECT token, 0::BIGINT AS e, [0.0::DOUBLE] AS scores, []::BIGINT[] AS ks, []::INTEGER[] AS ids FROM distinct_words
        UNION ALL
        SELECT token, e, list_append(scores, best.s), list_append(ks, best.k), list_append(ids, best.id) FROM (
            SELECT f.token, u.e, scores, ks, ids,
                   list_sort(list_transform(spans, lambda x: {'s': scores[x.i] + x.logp, 'k': x.k, 'id': x.id}), 'DESC')[1] AS best
            FROM forward f JOIN unigram_spans u ON f.token = u.token AND u.e = f.e + 1)""",
    "backward": """
        SELECT token, e, ks, ids, []::INTEGER[] AS path FROM forward WHERE e = len(token)
        UNION ALL
        SELECT token, e - ks[e], ks, ids, list_prepend(ids[e], path) FROM backward WHERE e > 0""",
    # Probability of the letters up to each end, and from each start on, over all covers.
    "lattice": """
        SELECT token, 0::BIGINT AS e, [1.0::DOUBLE] AS alphas FROM distinct_words
        UNION ALL
        SELECT f.token, u.e, list_append(alphas, list_sum(list_transform(spans, lambda x: alphas[x.i] * exp(x.logp))))
        FROM lattice f JOIN unigram_spans u ON f.token = u.token AND u.e = f.e + 1""",
    "flat_spans": "SELECT token, x.i AS i, x.k AS k, x.logp AS logp, x.id AS id FROM (SELECT token, unnest(spans) AS x FROM unigram_spans)",
    "starting_spans": "SELECT token, i, list({'k': k, 'logp': logp}) AS spans FROM flat_spans GROUP BY token, i",
    "lattice_back": """
        SELECT token, len(token)::BIGINT AS s, [1.0::DOUBLE] AS betas FROM distinct_words
        UNION ALL
        SELECT b.token, s - 1, list_prepend(list_sum(list_transform(spans, lambda x: betas[x.k] * exp(x.logp))), betas)
        FROM lattice_back b JOIN starting_spans u ON b.token = u.token AND u.i = b.s""",
    "lattices": """
        SELECT d.token, d.cnt, alphas, betas, alphas[len(d.token) + 1] AS whole
        FROM distinct_words d JOIN lattice f ON f.token = d.token AND f.e = len(d.token)
        JOIN lattice_back b ON b.token = d.token AND b.s = 0""",
    "best_covers": "SELECT token, path AS ids FROM backward WHERE e = 0",
    "wordpiece_ids": """
        SELECT doc_id, coalesce(flatten(list(s.ids ORDER BY pos) FILTER (s.ids IS NOT NULL)), []) AS ids
        FROM words LEFT JOIN tokens USING (doc_id) LEFT JOIN segmented s USING (token) GROUP BY doc_id""",
    "unigram_ids": """
        SELECT doc_id, coalesce(flatten(list(s.ids ORDER BY pos) FILTER (s.ids IS NOT NULL)), []) AS ids
        FROM words LEFT JOIN tokens USING (doc_id) LEFT JOIN best_covers s USING (token) GROUP BY doc_id""",
    **merge_parts(),
    **regression_parts("articles", "the", "of"),
    **regression_parts("links", "and", "to"),
    # One merge a step: all pieces stand between two marks, so a merge is a replacement from the left.
    "merge_steps": f"""
        SELECT 0 AS step, token, chr(2) || array_to_string(string_split(token, ''), chr(3) || chr(2)) || chr(3) AS spelt, cnt,
               '' AS a, '' AS b, 0::HUGEINT AS n
        FROM distinct_words
        UNION ALL
        SELECT step + 1, token, replace(spelt, chr(2) || p.a || chr(3) || chr(2) || p.b || chr(3), chr(2) || p.a || p.b || chr(3)),
               cnt, p.a, p.b, p.n
        FROM merge_steps, (
            SELECT p[1] AS a, p[2] AS b, sum(cnt) AS n FROM (
                SELECT unnest(list_transform(range(1, len(s)), lambda k: [s[k], s[k + 1]])) AS p, cnt
                FROM (SELECT string_split(spelt[2:-2], chr(3) || chr(2)) AS s, cnt FROM merge_steps))
            GROUP BY p ORDER BY n DESC, a, b LIMIT 1) p
        WHERE step < {LEARNED}""",
    "learned_merges": "SELECT DISTINCT step, a, b, n FROM merge_steps WHERE step > 0",
    "learned_words": "SELECT token, string_split(spelt[2:-2], chr(3) || chr(2)) AS syms FROM merge_steps WHERE step = (SELECT max(step) FROM learned_merges)",
    "merge_characters": """
        SELECT piece, row_number() OVER (ORDER BY piece) + 3 AS id
        FROM (SELECT DISTINCT unnest(string_split(token, '')) AS piece FROM distinct_words)""",
    "merge_vocabulary": """
        SELECT piece, id FROM merge_characters
        UNION ALL SELECT piece, (SELECT count(*) FROM merge_characters) + 3 + row_number() OVER (ORDER BY step)
        FROM (SELECT a || b AS piece, min(step) AS step FROM learned_merges GROUP BY a || b)
        UNION ALL VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3)""",
    "learned_lengths": """
        SELECT doc_id, 2 + coalesce(sum(len(syms)), 0)::DOUBLE AS length
        FROM words LEFT JOIN tokens USING (doc_id) LEFT JOIN learned_words USING (token) GROUP BY doc_id""",
    "learned_ids": """
        SELECT token, list(id ORDER BY place) AS ids
        FROM (SELECT token, unnest(syms) AS piece, generate_subscripts(syms, 1) AS place FROM learned_words) JOIN merge_vocabulary USING (piece)
        GROUP BY token""",
    "merge_lengths": f"""
        SELECT doc_id, coalesce(sum(len(syms)), 0) AS size
        FROM words LEFT JOIN tokens USING (doc_id) LEFT JOIN merged_{MERGE_ROUNDS} m USING (token) GROUP BY doc_id""",
    "review_lengths": f"""
        SELECT 'word' AS tokenizer, len({split_words('review')}) AS length FROM reviews
        UNION ALL SELECT 'word_punct', len({word_or_punctuation('review')}) FROM reviews
        UNION ALL SELECT 'wordpiece', len(ids) + 2 FROM wordpiece_ids
        UNION ALL SELECT 'unigram', len(ids) + 2 FROM unigram_ids
        UNION ALL SELECT 'bpe', size + 2 FROM merge_lengths""",
    **stem_parts(),
    "word_tokens": "SELECT doc_id, token FROM tokens",
    "punct_tokens": f"SELECT doc_id, unnest({word_or_punctuation('review')}) AS token FROM words",
    "piece_tokens": "SELECT doc_id, unnest(list_concat([2], ids, [3]))::VARCHAR AS token FROM wordpiece_ids",
    "unigram_tokens": "SELECT doc_id, unnest(list_concat([2], ids, [3]))::VARCHAR AS token FROM unigram_ids",
    **class_counts("word_tokens"),
    **class_counts("punct_tokens"),
    **class_counts("piece_tokens"),
    **class_counts("unigram_tokens"),
    "full_frame": f"""
        SELECT s.doc_id, s.review, {label_name('prediction')} AS model_prediction, {label_name('label')} AS gold_label,
               r.human_rating, v.llm_judge
        FROM scores s LEFT JOIN rated r ON s.doc_id = r.doc_id LEFT JOIN resolved v ON s.doc_id = v.doc_id WHERE selected""",
    "blank_rated": """
        SELECT doc_id, review, gold_label, model_prediction,
               CASE WHEN substr(md5('blank:' || doc_id), 1, 1) < '6' THEN NULL ELSE llm_judge END AS llm_judge, NULL::VARCHAR AS human_rating
        FROM rated""",
    "sentences": f"""
        SELECT doc_id, list_filter(string_split_regex({lowered('review')}, '\\.\\s*'), lambda x: x <> '') AS ws FROM reviews""",
    "sentence_rows": """
        SELECT doc_id, unnest(list_append(ws, '</s>')) AS word, generate_subscripts(list_append(ws, '</s>'), 1) AS pos FROM sentences""",
    "sentence_lags": """
        SELECT word, coalesce(lag(word, 1) OVER w, '<s>') AS back1, coalesce(lag(word, 2) OVER w, '<s>') AS back2
        FROM sentence_rows WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""",
    "cells": f"""
        SELECT batch_id, doc_id, target FROM (
            SELECT batch_id, doc_id, unnest(list_concat(target_ids, list_transform(range(width - len(target_ids)), lambda x: 0))) AS target
            FROM (SELECT *, max(len(target_ids)) OVER (PARTITION BY batch_id) AS width FROM (
                SELECT doc_id, target_ids, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM pairs WHERE split = 'test')))""",
    "cell_losses": """
        SELECT batch_id, target, ln((SELECT sum(cnt + 1) FROM vocabulary)::DOUBLE) - ln((cnt + 1)::DOUBLE) AS loss
        FROM cells JOIN vocabulary ON target = id""",
}
RECURSIVE = {"walk", "forward", "backward", "grown", "sharp_grown", "started_grown", "merge_steps", "lattice", "lattice_back", "articles_steps", "links_steps"}

# What each part reads directly.
NEEDS = {
    name: [p for p in PARTS if p != name and any(f"{kw} {p}{end}" in f" {' '.join(body.split())} " for kw in ("FROM", "JOIN", ",") for end in (" ", ")", ","))]
    for name, body in PARTS.items()
}


def with_parts(body: str) -> str:
    """Prefix ``body`` with the parts it needs, in order."""
    flat = f" {' '.join(body.split())} "
    wanted = {p for p in PARTS if any(f"{kw} {p}{end}" in flat for kw in ("FROM", "JOIN", ",") for end in (" ", ")", ","))}
    while True:
        more = {n for p in wanted for n in NEEDS[p]} - wanted
        if not more:
            break
        wanted |= more
    if not wanted:
        return body.strip()
    listed = ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p]})" if p not in RECURSIVE else f"{p} AS ({PARTS[p]})" for p in PARTS if p in wanted)
    return f"WITH {'RECURSIVE ' if wanted & RECURSIVE else ''}{listed}\n{body.strip()}"


def top(scope_cols: str, source: str, order: str, k: int, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {scope_cols} ORDER BY {order}) AS rank FROM {source}) WHERE rank <= {k}"""


def lengths(stat: str) -> str:
    measure = "len(words)" if stat.endswith("word_count") else "length(review)"
    fn = f"avg({measure})" if stat.startswith("mean") else f"median({measure})"
    return f"""
        SELECT 'overall' AS scope, round({fn}, 6) AS value FROM words_all
        UNION ALL SELECT sentiment, round({fn}, 6) FROM words_all WHERE sentiment IS NOT NULL GROUP BY sentiment"""


LOG_SCALED = """
    SELECT term, positive, negative, round((lx - min(lx) OVER ()) / (max(lx) OVER () - min(lx) OVER ()), 6) AS x,
           round((ly - min(ly) OVER ()) / (max(ly) OVER () - min(ly) OVER ()), 6) AS y
    FROM (SELECT *, log2(1 + positive) AS lx, log2(1 + negative) AS ly FROM terms WHERE positive + negative >= 50)"""

AGREEMENT = [
    ("model_gold", "model_prediction", "gold_label"),
    ("llm_gold", "llm_judge", "gold_label"),
    ("model_llm", "model_prediction", "llm_judge"),
    ("human_gold", "human_rating", "gold_label"),
    ("human_model", "human_rating", "model_prediction"),
    ("human_llm", "human_rating", "llm_judge"),
]


def agreement(total: str, frame: str = "rated") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{pair}' AS pair, count(*) FILTER ({a} = {b}) AS agree, {total.format(a=a, b=b)} AS total,
            round(coalesce(count(*) FILTER ({a} = {b}) * 100.0::DOUBLE / nullif({total.format(a=a, b=b)}, 0), 0), 6) AS percent FROM {frame}
            HAVING count({a}) > 0 AND count({b}) > 0"""
        for pair, a, b in AGREEMENT
    )


def wrong_cases(frame: str, both: bool) -> str:
    rule = (
        "model_prediction IS DISTINCT FROM gold_label AND llm_judge IS DISTINCT FROM gold_label"
        if both
        else "model_prediction = llm_judge AND model_prediction IS DISTINCT FROM gold_label"
    )
    return f"SELECT doc_id, gold_label, model_prediction, llm_judge FROM {frame} WHERE {rule}"


F1 = """2.0::DOUBLE * count(*) FILTER (prediction = 1 AND label = 1)
        / (2 * count(*) FILTER (prediction = 1 AND label = 1) + count(*) FILTER (prediction <> label))"""
GRID = "(SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(label, prediction))"
CLASS_METRICS = """count(*) AS samples, round(avg((prediction = label)::INTEGER), 6) AS accuracy,
    round(coalesce(2.0::DOUBLE * count(*) FILTER (prediction = 1 AND label = 1)
        / nullif(2 * count(*) FILTER (prediction = 1 AND label = 1) + count(*) FILTER (prediction <> label), 0), 0), 6) AS f1"""


def predicted(source: str) -> str:
    return f"(SELECT *, CASE WHEN score > 1 - score THEN 1 ELSE 0 END::INTEGER AS prediction FROM {source}_scores)"



UNSMOOTHED = """
    SELECT n, sum(cnt)::BIGINT AS events, round(exp(-sum(cnt * ln(cnt::DOUBLE / total)) / sum(cnt)), 4) AS perplexity
    FROM (SELECT n, context, word, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY n, context) AS total
          FROM events GROUP BY n, context, word) GROUP BY n"""

BODIES = {
    # sources and sinks: files must give back what the tables hold
    "s01_review_csv_round_trip": "SELECT doc_id, review, sentiment FROM reviews",
    "s01_review_csv_in_splits": "SELECT doc_id, review, sentiment FROM reviews",
    "s02_save_processed_corpus": """
        SELECT doc_id, review, sentiment, length(review)::INTEGER AS _char_len, len(words)::INTEGER AS _word_count,
               array_to_string(words, ' ') AS _words_str FROM words""",
    "s02_bucketed_corpus_join": """
        SELECT doc_id, quality, toxic, len(words)::BIGINT AS n FROM words JOIN labels USING (doc_id)""",
    "s03_load_processed_corpus": f"SELECT doc_id, len(words) AS n, {csv('words')} AS words FROM words",
    "s04_annotation_sheet": "SELECT doc_id, review, model_prediction, gold_label FROM rated",
    "s05_rated_annotation_source": "SELECT doc_id, human_rating, llm_judge FROM rated",
    "s06_selected_subsample": "SELECT doc_id, review, sentiment FROM reviews WHERE doc_id IN (SELECT doc_id FROM chosen)",
    "s07_ngram_model_persistence": "SELECT * FROM laplace",
    "s07_unsmoothed_model_persistence": UNSMOOTHED,
    "s07_count_classifier_persistence": f"SELECT doc_id, prediction, round(score, 6) AS score FROM {predicted('word_tokens')}",
    # cleaning
    "p01_remove_break_tags": f"SELECT page_id, {replaced('html', BREAK_TAG, ' ')} AS html FROM pages",
    "p02_lowercase": "SELECT doc_id, lower(text) AS text FROM documents",
    "p03_expand_contractions": f"SELECT doc_id, {expanded(f'lower({formed("text")})')} AS text FROM documents",
    "p03_full_cleaning": f"""
        SELECT doc_id, {no_punctuation(without_stop_words('t'))} AS review
        FROM (SELECT doc_id, {lowered(formed('review'))} AS t FROM reviews)""",
    "p04_remove_stop_words": f"SELECT doc_id, {without_stop_words('lower(review)')} AS review FROM reviews",
    "p05_strip_punctuation": f"SELECT doc_id, {no_punctuation('lower(text)')} AS text FROM documents",
    "p06_stem_words": """
        SELECT w.doc_id, coalesce(string_agg(s.form, ' ' ORDER BY t.pos), '') AS review, count(t.token)::INTEGER AS _word_count
        FROM words w LEFT JOIN tokens t ON w.doc_id = t.doc_id LEFT JOIN stems s ON t.token = s.token GROUP BY w.doc_id""",
    "p07_lemmatise_by_rules": f"""
        SELECT w.doc_id, coalesce(string_agg(coalesce(l.lemma, t.token), ' ' ORDER BY t.pos), '') AS review, count(t.token) AS n
        FROM words w LEFT JOIN tokens t USING (doc_id) LEFT JOIN (
            SELECT * FROM (VALUES {listed_pairs(IRREGULAR, False)}) i(token, lemma)
            UNION ALL
            SELECT token, lemma FROM (
                SELECT d.token, substr(d.token, 1, len(d.token) - len(ending)) || new AS lemma, rule
                FROM distinct_words d JOIN (VALUES {listed_pairs(ENDINGS, True)}) r(rule, ending, new)
                ON ends_with(d.token, ending) AND len(d.token) > len(ending)
                WHERE d.token NOT IN (SELECT token FROM (VALUES {listed_pairs(IRREGULAR, False)}) i(token, lemma)))
            WHERE lemma IN (SELECT token FROM distinct_words)
            QUALIFY row_number() OVER (PARTITION BY token ORDER BY len(lemma), rule, lemma) = 1) l ON l.token = t.token
        GROUP BY w.doc_id""",
    "p07_lemmatise_words": """
        SELECT w.doc_id, coalesce(string_agg(coalesce(l.lemma, t.token), ' ' ORDER BY t.pos), '') AS review, count(t.token) AS n
        FROM words w LEFT JOIN tokens t ON w.doc_id = t.doc_id
        LEFT JOIN (SELECT a.token AS form, b.token AS lemma FROM distinct_words a
                   JOIN distinct_words b ON a.token = b.token || 's') l ON t.token = l.form
        GROUP BY w.doc_id""",
    "p08_char_length": "SELECT doc_id, length(review) AS char_len FROM corpus",
    "p09_word_count": "SELECT doc_id, len(words) AS word_count FROM words",
    "p10_encode_labels": "SELECT doc_id, CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN 0 END AS label FROM reviews_all",
    "p11_decode_labels": f"SELECT doc_id, {label_name('quality')} AS quality, {label_name('toxic')} AS toxic FROM labels",
    "p12_class_filter": "SELECT doc_id, review, sentiment FROM reviews WHERE sentiment = 'positive'",
    "p13_required_columns": """
        SELECT unnest([{'name': 'doc_id', 'rows': a}, {'name': 'review', 'rows': b}, {'name': 'sentiment', 'rows': c}], recursive := true),
               'missing column(s) _words, _rating' AS absent
        FROM (SELECT count(doc_id) AS a, count(review) AS b, count(sentiment) AS c FROM reviews_all)""",
    "p14_text_preview": "SELECT doc_id, substr(text, 1, 100) || '...' AS preview FROM documents",
    "p15_drop_null_tokens": f"SELECT doc_id, {csv('list_filter(words, lambda x: length(x) > 2)')} AS words FROM words",
    # tokenisers
    "t01_word_tokens": f"SELECT doc_id, len(words) AS n, {csv('words')} AS words FROM words",
    "t01_treebank_tokens": f"""
        SELECT conv_id, turn, len(cut) AS n, {csv('cut')} AS words FROM (
            SELECT conv_id, turn, flatten(list_transform(words, lambda x: CASE x
                {' '.join(f"WHEN '{w}' THEN string_split('{cut}', ' ')" for w, cut in TREEBANK.items())}
                ELSE [x] END)) AS cut FROM formed_turns)""",
    "t02_word_punct_tokens": f"""
        SELECT doc_id, len(ts) AS n, array_to_string(ts, ' ') AS words FROM (
            SELECT doc_id, {word_or_punctuation(lowered('review'))} AS ts FROM reviews)""",
    "t03_wordpiece_ids": f"""
        SELECT doc_id, len(ids) AS n, {csv('ids')} AS ids, len(ids) AS mask_sum FROM (
            SELECT doc_id, list_concat([2], ids[1:318], [3]) AS ids FROM wordpiece_ids)""",
    "t03_wordpiece_ids_whole": f"""
        SELECT doc_id, len(ids) AS n, {csv('ids')} AS ids, len(ids) AS mask_sum FROM (
            SELECT doc_id, list_concat([2], ids, [3]) AS ids FROM wordpiece_ids)""",
    "t04_unigram_ids": f"""
        SELECT doc_id, len(ids) AS n, {csv('ids')} AS ids FROM (SELECT doc_id, list_concat([2], ids[1:318], [3]) AS ids FROM unigram_ids)""",
    "t04_unigram_ids_whole": f"""
        SELECT doc_id, len(ids) AS n, {csv('ids')} AS ids FROM (SELECT doc_id, list_concat([2], ids, [3]) AS ids FROM unigram_ids)""",
    "t05_merged_words": f"SELECT token, array_to_string(syms, ' ') AS pieces, cnt FROM merged_{MERGE_ROUNDS}",
    "t04_unigram_expectation": """
        SELECT id::INTEGER AS id, round(sum(cnt * alphas[i] * exp(logp) * betas[i + k] / whole), 3) AS expected
        FROM flat_spans JOIN lattices USING (token) GROUP BY id
        UNION ALL SELECT -1, round(sum(cnt * ln(whole)), 3) FROM lattices""",
    "t06_merge_coverage": """
        SELECT 'learned_bpe' AS tokenizer, threshold, round(avg(CASE WHEN length <= threshold THEN 100.0::DOUBLE ELSE 0.0 END), 6) AS percent
        FROM learned_lengths, (SELECT unnest([256, 320, 384, 448, 512])::INTEGER AS threshold) GROUP BY threshold""",
    "t07_merge_distribution": """
        SELECT 'learned_bpe' AS tokenizer, round(quantile_cont(length, 0.5), 6) AS median, round(quantile_cont(length, 0.95), 6) AS p95,
               round(quantile_cont(length, 0.99), 6) AS p99 FROM learned_lengths""",
    "t05_learned_merges": "SELECT (step - 1)::INTEGER AS rank, a AS left_piece, b AS right_piece, n::BIGINT AS cnt FROM learned_merges",
    "t05_merge_vocabulary": "SELECT piece, id::INTEGER AS id FROM merge_vocabulary",
    "t03_merge_ids": """
        SELECT doc_id, 2 + coalesce(sum(len(ids)), 0)::BIGINT AS n,
               concat_ws(',', '2', string_agg(array_to_string(ids, ','), ',' ORDER BY pos), '3') AS ids
        FROM words LEFT JOIN tokens USING (doc_id) LEFT JOIN learned_ids USING (token) GROUP BY doc_id""",
    "t05_subword_vocabulary": "SELECT piece, id, cnt::BIGINT AS cnt FROM pieces",
    "t06_length_coverage": """
        SELECT tokenizer, threshold, round(avg(CASE WHEN length <= threshold THEN 100.0::DOUBLE ELSE 0 END), 6) AS percent
        FROM review_lengths, (SELECT unnest([256, 320, 384, 448, 512])::INTEGER AS threshold) GROUP BY tokenizer, threshold""",
    "t07_length_distribution": """
        SELECT tokenizer, round(quantile_cont(length, 0.5), 6) AS median, round(quantile_cont(length, 0.95), 6) AS p95,
               round(quantile_cont(length, 0.99), 6) AS p99 FROM review_lengths GROUP BY tokenizer""",
    "t08_length_summary": "SELECT count(*) AS samples, round(avg(len(words)), 6) AS avg_len, max(len(words)) AS max_len FROM words",
    # sampling
    "m01_seeded_sample": f"SELECT doc_id, review, sentiment FROM reviews ORDER BY md5('42:' || doc_id), doc_id LIMIT {SAMPLE}",
    "m01_load_sampled_corpus": f"""
        SELECT doc_id, sentiment, len(words) AS word_count FROM words ORDER BY md5('42:' || doc_id), doc_id LIMIT {SAMPLE}""",
    "m02_ratio_split": "SELECT doc_id, split FROM splits",
    "m02_hash_split": """
        SELECT doc_id, CASE WHEN b < 800000 THEN 'train' WHEN b < 900000 THEN 'val' ELSE 'test' END AS split
        FROM (SELECT doc_id, ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 1000000 AS b FROM reviews)""",
    "m03_selected_test": """
        SELECT s.doc_id, split, c.doc_id IS NOT NULL AS selected FROM splits s LEFT JOIN chosen c ON s.doc_id = c.doc_id""",
    "m04_materialised_splits": "SELECT r.doc_id, review, sentiment, split FROM reviews r JOIN splits s ON r.doc_id = s.doc_id",
    "m05_selected_outside_test": """
        SELECT 'selected' AS subset, count(*) AS missing FROM chosen WHERE doc_id NOT IN (SELECT doc_id FROM splits WHERE split = 'test')
        UNION ALL SELECT 'sampled', count(*) FROM (SELECT doc_id FROM reviews ORDER BY md5('42:' || doc_id), doc_id LIMIT 100)
        WHERE doc_id NOT IN (SELECT doc_id FROM splits WHERE split = 'test')""",
    "m06_epoch_shuffle": "SELECT doc_id, row_number() OVER (ORDER BY md5('42:3:' || doc_id), doc_id) - 1 AS position FROM reviews",
    # joins
    "j01_token_to_id": """
        SELECT token, count(*) AS n, coalesce(max(id), 1)::INTEGER AS id FROM turn_tokens LEFT JOIN vocabulary USING (token) GROUP BY token""",
    "j02_id_to_token": """
        SELECT d.doc_id, '<s> ' || coalesce(token, '<UNK>') AS text FROM documents d LEFT JOIN vocabulary ON n_chars = id""",
    "j03_event_lookup": "SELECT n, context, word, cnt, total FROM scored_events",
    "j05_split_membership": """
        SELECT doc_id, sentiment FROM reviews_all WHERE doc_id NOT IN (SELECT doc_id FROM splits WHERE split = 'train')""",
    "j06_ratings_to_predictions": "SELECT doc_id, model_prediction, human_rating FROM rated",
    "j07_weighted_draw": f"""
        SELECT sent_id, s.context, c.word FROM (
            SELECT doc_id AS sent_id, words[1] AS context, {uniform('draw', 'doc_id')} AS u FROM words WHERE len(words) > 0) s
        JOIN (SELECT *, sum(cnt + 1) OVER (PARTITION BY context ORDER BY substr(md5(word), 1, 2), word) AS hi,
                     sum(cnt + 1) OVER (PARTITION BY context) AS mass
              FROM (SELECT context, word, count(*) AS cnt FROM events WHERE n = 2 GROUP BY context, word)) c
        ON s.context = c.context AND floor(s.u * mass) >= hi - cnt - 1 AND floor(s.u * mass) < hi""",
    # statistics
    "a01_class_distribution": "SELECT sentiment, count(*) AS cnt FROM reviews_all WHERE sentiment IS NOT NULL GROUP BY sentiment",
    "a02_mean_text_length": lengths("mean_text_length"),
    "a03_median_text_length": lengths("median_text_length"),
    "a04_mean_word_count": lengths("mean_word_count"),
    "a05_median_word_count": lengths("median_word_count"),
    "a06_word_frequency": "SELECT scope, token, cnt FROM frequency",
    "a06_word_frequency_all_documents": """
        SELECT 'overall' AS scope, token, count(*) AS cnt FROM all_tokens GROUP BY token
        UNION ALL SELECT sentiment, token, count(*) FROM all_tokens WHERE sentiment IS NOT NULL GROUP BY sentiment, token""",
    "a06_word_frequency_by_role": """
        SELECT 'overall' AS scope, token, count(*) AS cnt FROM turn_tokens GROUP BY token
        UNION ALL SELECT sentiment, token, count(*) FROM turn_tokens GROUP BY sentiment, token""",
    "a07_approximate_vocabulary_size": "SELECT scope, count(DISTINCT token) AS vocabulary_size, TRUE AS near FROM frequency GROUP BY scope",
    "a07_vocabulary_size": "SELECT scope, count(DISTINCT token) AS vocabulary_size FROM frequency GROUP BY scope",
    "a08_top_words": top("scope", "frequency", "cnt DESC, token", 10, "scope, rank::INTEGER AS rank, token, cnt"),
    "a08_top_words_first_seen": top(
        "scope", "(SELECT * FROM frequency JOIN firsts USING (scope, token))", "cnt DESC, first", 10,
        "scope, rank::INTEGER AS rank, token, cnt"),
    "a09_top_ngrams": top("n, scope", "gram_counts", "cnt DESC, gram", 10, "n, scope, rank::INTEGER AS rank, gram, cnt"),
    "a09_top_ngrams_first_seen": top("n, scope", "gram_counts", "cnt DESC, first", 10, "n, scope, rank::INTEGER AS rank, gram, cnt"),
    "a10_term_class_frequency": """
        SELECT term, positive, negative FROM terms
        UNION ALL SELECT gram, count(*) FILTER (sentiment = 'positive'), count(*) FILTER (sentiment = 'negative')
        FROM grams WHERE n = 2 AND gram IS NOT NULL AND sentiment IS NOT NULL GROUP BY gram""",
    "a11_log_odds": "SELECT term, positive, negative, round(z, 6) AS z FROM odds",
    "a12_significant_words": """
        SELECT * FROM (SELECT 'positive' AS scope, term, round(z, 6) AS z FROM odds ORDER BY odds.z DESC, term LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'negative', term, round(z, 6) FROM odds ORDER BY odds.z, term LIMIT 10)""",
    "a13_word_cloud": f"""
        SELECT scope, token, cnt, round(cnt::DOUBLE / max(cnt) OVER (PARTITION BY scope), 6) AS weight FROM ({top(
            "scope", f"(SELECT * FROM frequency WHERE scope <> 'overall' AND length(token) > 2 AND token NOT IN ({STOP_LIST}))",
            "cnt DESC, token", 100, "scope, token, cnt")})""",
    "a14_term_scatter": LOG_SCALED,
    "a15_corpus_report": f"""
        SELECT 'class_distribution' AS stat, sentiment AS scope, NULL AS key, count(*)::DOUBLE AS value FROM words GROUP BY sentiment
        UNION ALL SELECT stat, scope, NULL, round(value, 6) FROM (
            SELECT 'average_text_length' AS stat, scope, avg(length(review)) AS value FROM by_scope GROUP BY scope
            UNION ALL SELECT 'median_text_length', scope, median(length(review)) FROM by_scope GROUP BY scope
            UNION ALL SELECT 'average_word_count', scope, avg(len(words)) FROM by_scope GROUP BY scope
            UNION ALL SELECT 'median_word_count', scope, median(len(words)) FROM by_scope GROUP BY scope)
        UNION ALL SELECT 'vocabulary_size', scope, NULL, count(*)::DOUBLE FROM frequency GROUP BY scope
        UNION ALL {top("scope", "frequency", "cnt DESC, token", 10, "'most_frequent_words', scope, token, cnt::DOUBLE")}
        UNION ALL {top("n, scope", "gram_counts", "cnt DESC, gram", 10, "n || '_gram_frequency', scope, gram, cnt::DOUBLE")}
        UNION ALL SELECT * FROM (SELECT 'most_significant_words', 'positive', term, round(z, 6) FROM odds ORDER BY odds.z DESC, term LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'most_significant_words', 'negative', term, round(z, 6) FROM odds ORDER BY odds.z, term LIMIT 10)""",
    "a16_vocabulary_report": "SELECT count(*) AS vocabulary_size FROM vocabulary",
    # n-gram models
    "l01_padded_events": """
        SELECT doc_id, n, count(*) AS events, sum(length(context))::BIGINT AS context_chars, min(context) AS first_context, max(word) AS last_word
        FROM events GROUP BY doc_id, n""",
    "l02_ngram_counts": "SELECT n, context, word, cnt FROM counts",
    "l02_custom_token_ngrams": """
        SELECT 2 AS n, back1 AS context, word, count(*) AS cnt FROM sentence_lags GROUP BY back1, word
        UNION ALL SELECT 3, back2 || chr(1) || back1, word, count(*) FROM sentence_lags GROUP BY back2, back1, word""",
    "l03_context_counts": "SELECT n, context, total FROM totals",
    "l04_event_vocabulary": "SELECT n, v FROM v",
    "l05_laplace_probability": "SELECT n, context, word, round((cnt + 1)::DOUBLE / (total + v), 12) AS p FROM scored_events",
    "l06_unsmoothed_probability": """
        SELECT n, context, word, round(CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE cnt::DOUBLE / total END, 12) AS p FROM scored_events""",
    "l07_perplexity_laplace": "SELECT * FROM laplace",
    "l07_perplexity_unsmoothed_train": UNSMOOTHED,
    "l08_generated_sentences": """
        SELECT n, sent_id, coalesce(array_to_string(words, ' '), '') AS sentence FROM grown WHERE done OR step = 20""",
    "l08_started_sentences": """
        SELECT sent_id, array_to_string(words, ' ') AS sentence FROM started_grown WHERE done OR step = 19""",
    "l09_compare_sizes": """
        SELECT n, sum(w)::BIGINT AS events, round(exp(-sum(w * ln((coalesce(cnt, 0) + 1)::DOUBLE
            / (coalesce(total, 0) + (SELECT count(DISTINCT word) FROM turn_counts)))) / sum(w)), 4) AS perplexity
        FROM (SELECT n, context, word, count(*) AS w FROM turn_events WHERE split = 'test' GROUP BY n, context, word)
        LEFT JOIN turn_counts USING (n, context, word) LEFT JOIN turn_totals USING (n, context) GROUP BY n""",
    "l10_successors": top(
        "n, context", "(SELECT * FROM counts WHERE n = 2 AND context IN (SELECT context FROM test_events WHERE n = 2))",
        "cnt DESC, word", 3, "n, context, rank::INTEGER AS rank, word, cnt"),
    # vocabulary and sequences
    "v01_vocabulary": "SELECT token, id FROM vocabulary",
    "v02_encoded_documents": f"SELECT doc_id, {csv('ids[2:len(ids) - 1]')} AS ids FROM encoded",
    "v03_boundary_tokens": "SELECT doc_id, array_to_string(list_concat(['<s>'], words, ['</s>']), ',') AS words FROM words",
    "v04_truncate_keep_last": f"""
        SELECT doc_id, array_to_string(CASE WHEN len(words) + 2 > {MAX_LENGTH}
            THEN list_concat(['<s>'], words[1:{MAX_LENGTH - 2}], ['</s>']) ELSE list_concat(['<s>'], words, ['</s>']) END, ',') AS words FROM words""",
    "v05_input_target_pairs": f"SELECT doc_id, {csv('input_ids')} AS input_ids, {csv('target_ids')} AS target_ids FROM pairs",
    "v06_padded_batches": f"""
        SELECT batch_id, slot, doc_id, label, {csv('list_concat(input_ids, list_transform(range(width - len(input_ids)), lambda x: 0))')} AS input_ids,
               {csv('list_concat(target_ids, list_transform(range(width - len(target_ids)), lambda x: 0))')} AS target_ids
        FROM (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS width FROM (
            SELECT p.doc_id, input_ids, target_ids, quality AS label, (row_number() OVER (ORDER BY p.doc_id) - 1) // {BATCH} AS batch_id,
                   ((row_number() OVER (ORDER BY p.doc_id) - 1) % {BATCH})::INTEGER AS slot
            FROM pairs p JOIN labels l ON p.doc_id = l.doc_id))""",
    "v06_shuffled_batches": f"""
        SELECT batch_id, slot, doc_id, label, max(len(input_ids)) OVER (PARTITION BY batch_id) AS width FROM (
            SELECT p.doc_id, input_ids, quality AS label, r // {BATCH} AS batch_id, (r % {BATCH})::INTEGER AS slot
            FROM pairs p JOIN labels l ON p.doc_id = l.doc_id
            JOIN (SELECT doc_id, row_number() OVER (ORDER BY md5('42:1:' || doc_id), doc_id) - 1 AS r FROM reviews) o ON p.doc_id = o.doc_id)""",
    "v07_decoded_documents": """
        SELECT doc_id, string_agg(CASE WHEN v.token IS NULL THEN '<UNK>' ELSE v.token END, ' ' ORDER BY pos) AS text
        FROM bounded b LEFT JOIN vocabulary v ON b.token = v.token GROUP BY doc_id""",
    "v08_batch_count": f"SELECT split, ceil(count(*) / {BATCH}.0)::BIGINT AS batches FROM splits GROUP BY split",
    "v09_token_perplexity": "SELECT round(exp(avg(loss)), 6) AS perplexity FROM cell_losses WHERE target <> 0",
    "v09_padded_batch_perplexity": """
        SELECT round(exp(sum(m * cells) / sum(cells)), 6) AS perplexity FROM (
            SELECT batch_id, avg(loss) FILTER (target <> 0) AS m, count(*) AS cells FROM cell_losses GROUP BY batch_id)""",
    "v10_temperature_distribution": """
        SELECT n, context, word, round(pw / sum(pw) OVER (PARTITION BY n, context), 9) AS q FROM (
            SELECT c.n, c.context, c.word, pow((cnt + 1)::DOUBLE / (total + v), 1 / 0.8::DOUBLE) AS pw
            FROM counts c JOIN totals t ON c.n = t.n AND c.context = t.context JOIN v ON c.n = v.n)""",
    "v10_temperature_sentences": """
        SELECT sent_id, coalesce(array_to_string(words, ' '), '') AS sentence FROM sharp_grown WHERE done OR step = 15""",
    # classification
    "c01_train_count_classifier": f"SELECT split, {CLASS_METRICS} FROM {predicted('word_tokens')} GROUP BY split",
    "c01_regression_optimum": f"SELECT split, {CLASS_METRICS}, {REGRESSION_METRICS} FROM {predicted('articles')} GROUP BY split",
    "c02_regression_per_token_column": " UNION ALL ".join(
        f"SELECT '{name}' AS tokenizer, split, {CLASS_METRICS}, {REGRESSION_METRICS} FROM {predicted(name)} GROUP BY split"
        for name in ("articles", "links")
    ),
    "c03_regression_predict": f"SELECT doc_id, label::INTEGER AS label, prediction, round(score, 3) AS score FROM {predicted('articles')}",
    "s07_regression_persistence": f"SELECT doc_id, label::INTEGER AS label, prediction, round(score, 3) AS score FROM {predicted('links')}",
    "c02_count_per_tokenisation": " UNION ALL ".join(
        f"SELECT '{name}' AS tokenizer, split, {CLASS_METRICS} FROM {predicted(source)} GROUP BY split"
        for name, source in (("word", "word_tokens"), ("word_punct", "punct_tokens"), ("wordpiece", "piece_tokens"), ("unigram", "unigram_tokens"))
    ),
    "c03_count_predict": f"SELECT doc_id, label, prediction, round(score, 6) AS score FROM {predicted('word_tokens')}",
    "c03_external_predict": """
        SELECT doc_id, CASE WHEN score > 0.5 THEN 1 ELSE 0 END::INTEGER AS prediction, round(score, 6) AS score FROM (
            SELECT doc_id, len(regexp_extract_all(review, '[aeiou]'))::DOUBLE / greatest(length(review), 1) AS score FROM reviews)""",
    "c04_argmax": "SELECT doc_id, CASE WHEN p > 1 - p THEN 1 ELSE 0 END::INTEGER AS prediction FROM scores",
    "c05_example_loss": "SELECT doc_id, round(loss, 6) AS loss FROM losses",
    # metrics and agreement
    "e01_accuracy": "SELECT round(avg((prediction = label)::INTEGER), 6) AS accuracy FROM scores",
    "e02_f1": f"SELECT round({F1}, 6) AS f1 FROM scores",
    "e03_confusion_matrix": f"""
        SELECT g.label, g.prediction, count(s.doc_id) AS cnt FROM {GRID} g
        LEFT JOIN scores s ON g.label = s.label AND g.prediction = s.prediction GROUP BY g.label, g.prediction""",
    "e04_classifier_perplexity": "SELECT round(exp(avg(loss)), 6) AS perplexity FROM losses",
    "e05_metrics_per_split": f"""
        SELECT split, count(*) AS samples, round(avg((prediction = label)::INTEGER), 6) AS accuracy, round({F1}, 6) AS f1,
               round(exp(avg(loss)), 6) AS perplexity FROM losses GROUP BY split""",
    "e05_confusion_per_split": f"""
        SELECT p.split, g.label, g.prediction, count(s.doc_id) AS cnt
        FROM {GRID} g CROSS JOIN (SELECT DISTINCT split FROM splits) p
        LEFT JOIN scores s ON g.label = s.label AND g.prediction = s.prediction AND p.split = s.split
        GROUP BY p.split, g.label, g.prediction""",
    "e06_evaluation_frame": f"""
        SELECT doc_id, review, {label_name('prediction')} AS model_prediction, {label_name('label')} AS gold_label,
               NULL::VARCHAR AS human_rating, NULL::VARCHAR AS llm_judge FROM scores""",
    "e07_subsample_metrics": f"""
        SELECT 'selected' AS split, count(*) AS samples, round(avg((prediction = label)::INTEGER), 6) AS accuracy, round({F1}, 6) AS f1
        FROM scores WHERE selected""",
    "e07_evaluation_frame_with_ratings": "SELECT doc_id, review, model_prediction, gold_label, human_rating, llm_judge FROM full_frame",
    "e07_evaluation_agreement": agreement("count(*)", "full_frame"),
    "e07_evaluation_both_wrong": wrong_cases("full_frame", both=True),
    "e07_evaluation_agree_but_wrong": wrong_cases("full_frame", both=False),
    "g01_blank_ratings": """
        SELECT 'human_rating' AS rater, count(human_rating) > 0 AS available FROM blank_rated
        UNION ALL SELECT 'llm_judge', count(llm_judge) > 0 FROM blank_rated""",
    "g02_agreement_with_blanks": agreement("count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)", "blank_rated"),
    "g03_both_wrong_with_blanks": wrong_cases("blank_rated", both=True),
    "g04_agree_but_wrong_with_blanks": wrong_cases("blank_rated", both=False),
    "g01_rating_availability": """
        SELECT 'human_rating' AS rater, count(human_rating) > 0 AS available FROM rated
        UNION ALL SELECT 'llm_judge', count(llm_judge) > 0 FROM rated""",
    "g02_pairwise_agreement": agreement("count(*)"),
    "g02_agreement_of_rated": agreement("count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"),
    "g03_both_wrong": """
        SELECT doc_id, gold_label, model_prediction, llm_judge FROM rated
        WHERE model_prediction IS DISTINCT FROM gold_label AND llm_judge IS DISTINCT FROM gold_label""",
    "g03_both_wrong_examples": """
        SELECT doc_id, substr(review, 1, 100) || '...' AS preview, gold_label, model_prediction, llm_judge FROM rated
        WHERE model_prediction <> gold_label AND llm_judge <> gold_label ORDER BY doc_id LIMIT 3""",
    "g04_agree_but_wrong": """
        SELECT doc_id, gold_label, model_prediction, llm_judge FROM rated WHERE model_prediction = llm_judge AND model_prediction <> gold_label""",
    # judge labels
    "k01_prompts": f"SELECT doc_id, {sql_text(PROMPT_HEAD)} || review || {sql_text(PROMPT_TAIL)} AS prompt FROM reviews",
    "k02_parsed_answers": """
        SELECT doc_id, CASE
            WHEN lower(answer) LIKE '%positive%' THEN 'positive' WHEN lower(answer) LIKE '%negative%' THEN 'negative'
            WHEN regexp_extract(lower(answer), '\\S+') LIKE '%pos%' THEN 'positive' ELSE 'negative' END AS label FROM answers""",
    "k03_answers_in_bodies": """
        SELECT doc_id, attempt, CASE WHEN status = 200 THEN upper(llm_judge[1]) || substr(llm_judge, 2) || '.' END AS answer FROM responses""",
    "k04_resolved_responses": "SELECT doc_id, llm_judge, defaulted, next_wait_s FROM resolved",
    "k05_attached_judgments": """
        SELECT r.doc_id, r.gold_label, s.llm_judge FROM rated r LEFT JOIN resolved s ON r.doc_id = s.doc_id""",
    # extension points
    "u01_custom_tokenizer": f"""
        SELECT doc_id, len(list_filter(string_split_regex({lowered('review')}, '\\.\\s*'),
            lambda x: x <> '')) AS n FROM reviews""",
    "u02_custom_collate": f"""
        SELECT batch_id, count(*) AS rows, max(len(input_ids)) AS width FROM (
            SELECT input_ids, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM pairs) GROUP BY batch_id""",
    "u03_custom_judge": "SELECT doc_id, CASE WHEN length(review) > 1000 THEN 'positive' ELSE 'negative' END AS llm_judge FROM reviews",
    "u04_raw_logit_loss": "SELECT doc_id, round(loss, 6) AS loss, round(loss, 6) AS same FROM losses",
    "u04_custom_loss": "SELECT round(exp(avg(loss * loss / 100)), 6) AS perplexity FROM cell_losses WHERE target <> 0",
}

BY_SCOPE = """by_scope AS MATERIALIZED (
    SELECT 'overall' AS scope, review, words FROM words UNION ALL SELECT sentiment, review, words FROM words WHERE sentiment IS NOT NULL)"""


def all_sql() -> dict[str, str]:
    out = {name: with_parts(body) for name, body in BODIES.items()}
    report = out["a15_corpus_report"]
    head, tail = report.split("\nSELECT 'class_distribution'", 1)
    out["a15_corpus_report"] = f"{head},\n{BY_SCOPE}\nSELECT 'class_distribution'{tail}"
    return out
