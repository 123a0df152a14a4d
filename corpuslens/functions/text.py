"""Text cleaning and tokenising as column expressions.

Everything here is a Catalyst expression; no Python runs per row. ``\\w`` and
``\\s`` of Java regular expressions are ASCII only, so the classes of word and
space characters are spelled out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import wordlists

Tokenizer = Callable[[Column], Column]

# Patterns shared with the SQL checks.
BREAK_TAG = r"<br\s*/?>"
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = (
    r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACES = f"[{SPACE_CLASS}]+"
PUNCTUATION = f"[^{WORD_CLASS}{SPACE_CLASS}]"
WORD_OR_PUNCTUATION = f"([{WORD_CLASS}]+|{PUNCTUATION})"


def remove_breaks(c: Column) -> Column:
    """Line-break tags become one space. Case-sensitive: upper-case tags stay."""
    return F.regexp_replace(c, BREAK_TAG, " ")


def lowercase(c: Column) -> Column:
    return F.lower(c)


def contraction_rules() -> list[tuple[str, str]]:
    """Ordered ``(pattern, replacement)`` pairs; ``$1`` is the host of an ending."""
    rules = [(rf"\b{short}\b", full) for short, full in wordlists.IRREGULAR_CONTRACTIONS]
    rules += [(rf"(\p{{L}}){end}\b", f"$1 {full}") for end, full in wordlists.CONTRACTION_ENDINGS]
    rules.append((rf"\b({'|'.join(wordlists.IS_HOSTS)})'s\b", "$1 is"))
    return rules


def contraction_trigger() -> str:
    """One pattern that finds every text any contraction rule could change."""
    plain = [short for short, _ in wordlists.IRREGULAR_CONTRACTIONS if "'" not in short]
    return rf"'|\b({'|'.join(plain)})\b"


def expand_contractions(c: Column) -> Column:
    """Rewrite contractions of lower-cased text.

    A text without an apostrophe or a slang form is passed through after a single
    scan instead of one scan per rule.
    """
    straight = F.replace(c, F.lit("’"), F.lit("'"))
    expanded = reduce(lambda acc, rule: F.regexp_replace(acc, *rule), contraction_rules(), straight)
    return F.when(F.regexp_like(straight, F.lit(contraction_trigger())), expanded).otherwise(straight)


def words_of(c: Column) -> Column:
    """Split on white space and drop empty pieces."""
    return F.array_remove(F.split(c, SPACES), "")


def remove_stop_words(c: Column, stop_words: Iterable[str] = wordlists.STOP_WORDS) -> Column:
    """Drop words equal to a stop word; a stop word glued to punctuation stays."""
    listed = sorted(set(stop_words))
    return F.array_join(F.filter(words_of(c), lambda w: ~w.isin(listed)), " ")


def strip_punctuation(c: Column) -> Column:
    """Delete everything that is neither a word character nor white space."""
    return F.regexp_replace(c, PUNCTUATION, "")


def clean(c: Column, **options: object) -> Column:
    """The whole cleaning chain: line-break tags, case, then ``clean_lowered``."""
    return clean_lowered(lowercase(remove_breaks(c)), **options)


def clean_lowered(
    c: Column,
    *,
    stop_words: Iterable[str] | None = None,
    contractions: bool = True,
    punctuation: bool = False,
) -> Column:
    """The steps after lower-casing, in their fixed order.

    ``punctuation=True`` keeps punctuation, as the tokenisers that need it do.
    """
    if contractions:
        c = expand_contractions(c)
    if stop_words is not None:
        c = remove_stop_words(c, stop_words)
    return c if punctuation else strip_punctuation(c)


def word_tokens(c: Column, treebank: bool = False) -> Column:
    """Words of punctuation-free text; ``treebank`` also cuts the fused forms."""
    words = words_of(c)
    if not treebank:
        return words

    def cut(w: Column) -> Column:
        branches = F.array(w)
        for fused, parts in wordlists.TREEBANK_SPLITS.items():
            branches = F.when(w == fused, F.array(*map(F.lit, parts))).otherwise(branches)
        return branches

    return F.flatten(F.transform(words, cut))


def word_punct_tokens(c: Column) -> Column:
    """Runs of word characters, and every other visible character on its own."""
    return F.regexp_extract_all(c, F.lit(WORD_OR_PUNCTUATION), F.lit(1))


def tokenizer(kind: str, custom: Tokenizer | None = None) -> Tokenizer:
    """Look up a tokeniser by name; ``custom`` is any ``Column -> Column`` of word arrays."""
    if custom is not None:
        return custom
    known: dict[str, Tokenizer] = {"word": word_tokens, "bpe": word_punct_tokens}
    if kind in ("wordpiece", "unigram"):
        raise ValueError(f"{kind!r} needs a piece table: use operators.subword")
    if kind not in known:
        raise ValueError(f"unsupported tokenizer {kind!r}; known: {', '.join(known)}")
    return known[kind]


def drop_nulls(words: Column) -> Column:
    return F.filter(words, lambda w: w.isNotNull())


def preview(c: Column, width: int = 100) -> Column:
    return F.concat(F.substring(c, 1, width), F.lit("..."))


def blank_to_null(c: Column) -> Column:
    """NULL for an empty text or one of white space only."""
    return F.when((c != "") & ~c.rlike(f"^{SPACES}$"), c)
