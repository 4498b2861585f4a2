"""The base views and text expressions as DuckDB SQL, for the oracles."""

from __future__ import annotations

from postlens.functions import text as tx
from postlens.sources.views import DECORATIONS, URL_PREFIX


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CASES = "\n".join(f"WHEN {k} THEN {quoted(v)}" for k, v in DECORATIONS.items())

TITLES = """titles AS (
SELECT doc_id AS id, split_part(text, chr(10), 1) AS title,
       nullif(substr(text, length(split_part(text, chr(10), 1)) + 2), '') AS body
FROM documents)"""
_TEXTS = f"""texts AS (
SELECT id, concat(concat_ws('. ', title, body), CASE id % 12 {_CASES} END) AS text FROM titles)"""
TEXTS = f"{TITLES}, {_TEXTS}"
POSTS = f"""{TITLES}, posts AS (
SELECT t.id, t.title, t.body, e.ts AS timestamp, CAST(floor(e.value) AS BIGINT) AS comms_num,
       concat('{URL_PREFIX}', lpad(CAST(t.id AS VARCHAR), 6, '0'), '/x') AS url
FROM titles t JOIN events e ON e.event_id = t.id * 5)"""
POSTS_AND_TEXTS = f"{POSTS}, {_TEXTS}"

EMOJI = tx.EMOJI_RE
KEEP_CLASS = "[^0-9A-Za-z$&%.,?!'‘’\"“”]+"
TOKEN_SHAPES = r"n't|'[a-z]+|[0-9A-Za-z$&%=]+|[^\sA-Za-z0-9]"
ENDINGS = r"(\w+)(n't|'m|'s|'d|'ve|'re)"


def replace(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(by)}, 'g')"


def extract(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({x}, {quoted(pattern)}, {group})"


def strip_links(x):
    return replace(x, r"http\S+|&*#*x200B\S*|\*", " ")


def break_to_stop(x):
    return replace(x, r"[\n\r]|- |[.]{2,}", ". ")


def straighten(x):
    return f"""translate({x}, '“”‘’', '""''''')"""


def for_embedding(x):
    return straighten(break_to_stop(strip_links(x)))


def for_topics(x):
    return straighten(replace(x, EMOJI, " "))


def keep(x):
    return f"trim({replace(x, KEEP_CLASS, ' ')})"


def keep_for_topics(x):
    return f"lower({keep(strip_links(x))})"


def each(x, expr):
    return f"list_transform({x}, lambda e: {expr})"


def only(x, cond):
    return f"list_filter({x}, lambda e: {cond})"


def words(x):
    return only(f"regexp_split_to_array({x}, '\\s+')", "e <> ''")


def tokens(x, pattern: str = TOKEN_SHAPES):
    return extract(replace(x, ENDINGS, r"\1 \2"), pattern)


def sentences(x, min_len: int = 3):
    return only(each(extract(x, "[^.!?]+[.!?]*"), "trim(e)"), f"length(e) >= {min_len}")


def in_list(x, values):
    return f"{x} IN ({', '.join(quoted(v) for v in values)})"


def case_map(x, entries, default):
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in entries.items())
    return f"CASE {x} {cases} ELSE {default} END"


# (id, num_s, sentence) of cleaned posts
SENTENCES = f"""{TEXTS}, arrays AS (
SELECT id, {sentences(keep(for_embedding('text')))} AS s FROM texts), sents AS (
SELECT id, generate_subscripts(s, 1) - 1 AS num_s, unnest(s) AS sentence FROM arrays)"""
SPACES = "length(sentence) - length(replace(sentence, ' ', ''))"
CHUNKS = f"""{SENTENCES}, running AS (
SELECT id, num_s, sentence, {SPACES} AS space_count,
       CAST(sum({SPACES}) OVER (PARTITION BY id ORDER BY num_s) AS BIGINT) AS running_spaces FROM sents),
raw_chunks AS (
SELECT id AS post_id, CAST(floor(running_spaces / 100) AS BIGINT) AS chunk_key,
       string_agg(sentence, ' ' ORDER BY num_s) AS long_sent FROM running GROUP BY ALL),
chunks AS (
SELECT post_id, row_number() OVER (PARTITION BY post_id ORDER BY chunk_key) - 1 AS chunk_num, long_sent
FROM raw_chunks)"""
WORDS = f"""{TITLES}, words AS (
SELECT id, unnest({words("concat_ws(' ', title, body)")}) AS word FROM titles)"""
TOKENS = f"""{TEXTS}, arrays AS (SELECT id, {tokens('text')} AS a FROM texts), tokens AS (
SELECT id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS token FROM arrays)"""
