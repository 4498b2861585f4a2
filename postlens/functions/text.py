"""Column expressions that clean post text. Everything stays inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The character ranges that count as emojis, and the one multi-character
# emoji (woman with blond hair) that has to win over its own first character.
EMOJI_RANGES = [
    (0x1F300, 0x1F321),
    (0x1F324, 0x1F393),
    (0x1F39E, 0x1F3F0),
    (0x1F400, 0x1F4FD),
    (0x1F4FF, 0x1F53D),
    (0x1F550, 0x1F567),
    (0x1F5FA, 0x1F64F),
    (0x1F680, 0x1F6C5),
    (0x1F90C, 0x1F93A),
    (0x1F947, 0x1F978),
    (0x1F97A, 0x1F9CB),
    (0x1F9CD, 0x1F9FF),
    (0x1FA90, 0x1FAA8),
]
WOMAN_EMOJI = [0x1F471, 0x200D, 0x2640, 0xFE0F]
JOINERS = [0x200D, 0x2640, 0x2641, 0x26A5, 0xFE0F]
SKIN_TONES = (0x1F3FB, 0x1F3FF)


def escaped(code: int) -> str:
    return f"\\x{{{code:X}}}"


def range_class(ranges) -> str:
    return "".join(f"{escaped(a)}-{escaped(b)}" for a, b in ranges)


EMOJI_CLASS = range_class(EMOJI_RANGES)
#: The smallest range with all of them; an emoji starts with one.
ANY_EMOJI = range_class([(EMOJI_RANGES[0][0], EMOJI_RANGES[-1][1])])
EMOJI_RE = "".join(escaped(c) for c in WOMAN_EMOJI) + f"|[{EMOJI_CLASS}]"
SKIN_TONE_RE = f"[{range_class([SKIN_TONES])}]"
# an emoji with everything that modifies it or is joined to it
EMOJI_SEQUENCE_RE = (
    f"[{EMOJI_CLASS}](?:[{range_class([SKIN_TONES])}]|{escaped(0xFE0F)}"
    f"|{escaped(0x200D)}[{EMOJI_CLASS}{''.join(escaped(c) for c in (0x2640, 0x2641, 0x26A5))}])*"
)

# Characters named one by one become one table in the regex engine, ranges one call each.
ALNUM = string.digits + string.ascii_letters


def starting(first: str, pattern: str) -> str:
    """``pattern``, tried only where the next character is in the class ``first``: most positions
    of a text are passed with one test instead of one for each alternative."""
    return f"(?=[{first}])(?:{pattern})"


# Replacement patterns of the cleaning recipes.
LINK_RE = starting("h&#x*", r"http\S+|&*#*x200B\S*|\*")
BREAK_RE = starting(r"\n\r.\-", r"[\n\r]|- |[.]{2,}")
KEPT_RE = "[" + ALNUM + r"$&%.,?!'\"‘-’“-”]+"
TOKEN_KEEP_RE = "[^0-9A-Za-z$&%=]"
TOKEN_KEEP_EMOJI_RE = "[^0-9A-Za-z$&%=" + "".join(escaped(c) for c in JOINERS) + EMOJI_CLASS + "]"
QUOTES = [("[“-”]", '"'), ("[‘-’]", "'")]


def post_text(title="title", body="body", sep: str = ". ") -> Column:
    """Title and body in one text; a missing body leaves the bare title."""
    return F.concat_ws(sep, F.col(title), F.col(body))


def strip_emojis(text) -> Column:
    return F.regexp_replace(text, starting(ANY_EMOJI, EMOJI_RE), " ")


def extract_emojis(text) -> Column:
    return F.regexp_extract_all(text, F.lit(starting(ANY_EMOJI, EMOJI_RE)), F.lit(0))


def straighten_quotes(text) -> Column:
    return replace_literals(text, QUOTES)


def strip_links(text) -> Column:
    return F.regexp_replace(text, LINK_RE, " ")


def break_to_stop(text) -> Column:
    return F.regexp_replace(text, BREAK_RE, ". ")


def clean_for_embedding(text) -> Column:
    return straighten_quotes(break_to_stop(strip_links(text)))


def clean_for_topics(text) -> Column:
    return straighten_quotes(strip_emojis(text))


def keep_list(text) -> Column:
    """Kept runs of characters, one space between them.

    Joining what is kept is several times faster than replacing the complement class.
    """
    return F.array_join(F.regexp_extract_all(text, F.lit(KEPT_RE), F.lit(0)), " ")


def keep_list_for_topics(text) -> Column:
    """Links go first, while their punctuation can still be seen, then the keep list."""
    return F.lower(keep_list(strip_links(text)))


def collapse_runs(text, emojis) -> Column:
    """Each run of one emoji, spaces between allowed, becomes that emoji once."""
    out = F.col(text) if isinstance(text, str) else text
    for emoji in emojis:
        # possessive: a run of any length is matched in a loop, without backtracking
        out = F.regexp_replace(out, f"(?:{emoji}\\s*+){{2,}}+", emoji)
    return out


def strip_skin_tone(text) -> Column:
    return F.regexp_replace(text, SKIN_TONE_RE, "")


def replace_literals(text, rules) -> Column:
    """Apply ``(pattern, replacement)`` rules one after the other in one projection."""
    out = F.col(text) if isinstance(text, str) else text
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def count_spaces(text) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def url_key(url, prefix: str) -> Column:
    return F.regexp_extract(url, prefix + r"(\w{6})/", 1)


def wrap(text, width: int = 40, sep: str = "<br>") -> Column:
    """Greedy line wrap: words longer than a line are split, white space collapses."""
    flat = F.regexp_replace(F.replace(text, F.lit('\\"'), F.lit('"')), r"\s+", " ")
    pieces = F.regexp_replace(flat, f"([^ ]{{{width}}})", "$1 ")
    pieces = F.trim(F.regexp_replace(pieces, " +", " "))
    lines = F.regexp_replace(pieces, f"([^\\n]{{1,{width}}})( |$)", f"$1{sep}")
    return F.regexp_replace(lines, f"{sep}$", "")


def hex_codes(text) -> Column:
    """Upper-case hex code points of every character, in order."""
    return F.transform(
        F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.hex(F.ascii(c))
    )
