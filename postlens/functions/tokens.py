"""Column expressions that turn text into arrays of sentences, tokens and phrases.

Arrays stay inside their row, so none of these needs a shuffle.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, functions as F

from postlens.functions import text as tx

# Contraction endings and the token shapes.
CONTRACTIONS = ["n't", "'m", "'s", "'d", "'ve", "'re"]
TOKEN_RE = "n't|'[a-z]+|[" + tx.ALNUM + r"$&%=]+|[^\s" + tx.ALNUM + "]"
SENTENCE_RE = "[^.!?]+[.!?]*"
EXCEPTION_RULES = [
    (r"(\S+) (sell|hold)([^0-9A-Za-z_]|$)", "$1_$2$3"),
    (r"game (stop|stonk)", "game_$1"),
    (r"\x{1F680}\s+", "🚀_"),
    (r"\x{1F48E}\x{1F64C}\s+", "💎🙌_"),
]
EXCEPTION_TOKEN_RE = r"\S+_[0-9A-Za-z]*|" + TOKEN_RE
# Starting only at a word start or where the last match ended keeps a very long word
# linear: without the anchor each of its characters would start a new attempt.
_SPLIT_RE = r"(?:\G|(?<!\w))(\w+)(" + "|".join(CONTRACTIONS) + ")"

#: Longer lists are joined as tables, with the same result (``operators.tokens``).
MAX_INLINE_ENTRIES = 5000


def words(text) -> Column:
    """White-space words, as Python's ``str.split``."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def split_contractions(text) -> Column:
    """Put a space before each contraction ending; texts without an apostrophe stay as they are."""
    split = F.regexp_replace(text, _SPLIT_RE, "$1 $2")
    return F.when(F.contains(text, F.lit("'")), split).otherwise(text)


def tokens(text, pattern: str = TOKEN_RE) -> Column:
    return F.regexp_extract_all(split_contractions(text), F.lit(pattern), F.lit(0))


def protect_exceptions(text) -> Column:
    """Join multi-word tokens with an underscore so that the tokeniser keeps them."""
    return tx.replace_literals(text, EXCEPTION_RULES)


def exception_tokens(text) -> Column:
    split = F.regexp_replace(protect_exceptions(text), _SPLIT_RE, "$1 $2")
    return F.regexp_extract_all(split, F.lit(EXCEPTION_TOKEN_RE), F.lit(0))


def sentences(text, min_len: int = 3) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(SENTENCE_RE), F.lit(0))
    return F.filter(F.transform(pieces, lambda s: F.trim(s)), lambda s: F.length(s) >= min_len)


def clean_tokens(array, pattern: str = tx.TOKEN_KEEP_RE, lowercase: bool = False) -> Column:
    """Drop unwanted characters from each token, then tokens left empty."""
    def one(t):
        kept = F.regexp_replace(t, pattern, "")
        return F.lower(kept) if lowercase else kept
    return F.filter(F.transform(array, one), lambda t: t != "")


def _checked(entries):
    if len(entries) > MAX_INLINE_ENTRIES:
        raise ValueError("too many entries for an expression; pass a table and use a join instead")
    return entries


def drop_words(array, stop_words) -> Column:
    """Case-insensitive stop-word removal with a word list of configuration size."""
    stop = _checked([w.lower() for w in stop_words])
    return F.filter(array, lambda t: ~F.lower(t).isin(stop))


def lookup(token: Column, entries: dict[str, str], default: Column) -> Column:
    """Map ``token`` by a dictionary of configuration size: one IN test per target value.

    Most tokens are in no entry, so that is tested first.
    """
    _checked(entries)
    if not entries:
        return default
    out = F.when(~token.isin(list(entries)), default)
    by_value = sorted((v, k) for k, v in entries.items())
    for value, pairs in groupby(by_value, key=lambda p: p[0]):
        out = out.when(token.isin([k for _, k in pairs]), F.lit(value))
    return out


def lemmas(array, entries: dict[str, str]) -> Column:
    return F.transform(array, lambda t: lookup(F.lower(t), entries, t))


def suffix_tag(token: Column, suffix_rules) -> Column:
    """Part of speech by the first rule with a fitting ending, else noun."""
    low = F.lower(token)
    by_suffix = F.lit("NN")
    for endings, name in reversed(suffix_rules):
        fits = low.endswith(endings[0])
        for ending in endings[1:]:
            fits = fits | low.endswith(ending)
        by_suffix = F.when(fits, F.lit(name)).otherwise(by_suffix)
    return by_suffix


def tag(token: Column, lexicon: dict[str, str], suffix_rules) -> Column:
    """Part of speech: lexicon first, then the endings."""
    return lookup(F.lower(token), lexicon, suffix_tag(token, suffix_rules))


def tagged(array, token, tag_of) -> Column:
    """``word/TAG `` for every element of a sentence, in order, as one string."""
    parts = F.transform(array, lambda e: F.concat(token(e), F.lit("/"), tag_of(e), F.lit(" ")))
    return F.array_join(parts, "")


def tagged_sentence(sentence, lexicon, suffix_rules) -> Column:
    return tagged(tokens(sentence), lambda t: t, lambda t: tag(t, lexicon, suffix_rules))


# Tag sequences that make a phrase, in the order they are tried, each with a tag it cannot
# do without. Matches start at a token, and repeats are possessive, so long sentences are
# matched without backtracking.
_TOKEN = "(?:/|[^ /]++)"
_START = "(?<![^ ])"
PHRASE_PATTERNS = [
    ("/JJ ", f"{_START}(?:{_TOKEN}/JJ )++{_TOKEN}/NN "),
    ("/NN ", f"{_START}(?:{_TOKEN}/NN ){{2,}}+"),
    ("/MD ", f"{_START}(?:{_TOKEN}/MD )++(?:{_TOKEN}/RB )*+{_TOKEN}/VB "),
    ("/VB ", f"{_START}(?:{_TOKEN}/VBP )*+(?:{_TOKEN}/RB )*+(?:{_TOKEN}/VB )++{_TOKEN}/NN "),
]


def phrases(tagged, patterns=PHRASE_PATTERNS) -> Column:
    """Phrases of a tagged sentence, pattern after pattern, without their tags."""
    none = F.array().cast("array<string>")
    found = F.concat(*[
        F.when(F.contains(tagged, F.lit(needed)), F.regexp_extract_all(tagged, F.lit(p), F.lit(0))).otherwise(none)
        for needed, p in patterns
    ])
    return F.transform(found, lambda m: F.trim(F.regexp_replace(m, "/[A-Z]+ ", " ")))


def ngrams(array, n: int, sep: str = "_") -> Column:
    """All runs of ``n`` neighbouring tokens; fewer than ``n`` tokens give none."""
    starts = F.when(F.size(array) >= n, F.sequence(F.lit(1), F.size(array) - (n - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.array_join(F.slice(array, i, n), sep))
