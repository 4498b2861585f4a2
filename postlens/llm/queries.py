"""One query per operator over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, functions as F

from postlens.llm import (
    conversations, decontaminate, langid, lengths, licenses, manifest, mixing, near_dedup, quality,
    secrets, spotsigs, token_files, vector_dedup,
)
from postlens.plans.registry import query
from postlens.sources import readers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, folder):
    return readers.table(spark, folder, "documents")


def fold(name: str, folds: int) -> Column:
    """Remainder of the checksum of an id's text, which assigns it to a fold."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(folds))


@query("op1_quality")
def op1_quality(spark, folder):
    """Score of every document by a classifier that has not seen the labels of the held-out fold."""
    docs = documents(spark, folder)
    labels = readers.table(spark, folder, "labels").where(fold("doc_id", 3) != 1)
    return quality.fit(docs, labels).score(docs, ["doc_id", "text"]).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query("op2_decontaminate")
def op2_decontaminate(spark, folder):
    """Contaminated documents, one row per benchmark item found in them."""
    found = decontaminate.matches(documents(spark, folder), readers.table(spark, folder, "benchmark"), partial=True)
    return found.drop("row")


MIXED = f"""
WITH sized AS (
    SELECT coalesce('=' || source, '') AS key, sum(coalesce(length(text), 0) + 1)::BIGINT AS characters
    FROM documents GROUP BY 1),
rates AS (
    SELECT key, (1.0::DOUBLE * (1.0::DOUBLE * (SELECT sum(characters) FROM sized)::DOUBLE))
        / ((SELECT count(*) FROM sized)::DOUBLE * characters::DOUBLE) AS rate FROM sized),
split AS (SELECT key, rate, greatest(1, ceil(rate / {mixing.PART_MEAN}))::INT AS parts FROM rates),
means AS (SELECT *, rate / parts AS mean FROM split),
terms AS (
    WITH RECURSIVE t(key, mean, k, term, total) AS (
        SELECT key, mean, 0, exp(-mean), exp(-mean) FROM means
        UNION ALL
        SELECT key, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1)
        FROM t WHERE k < ceil(mean + 12 * sqrt(mean) + 30))
    SELECT key, list(total ORDER BY k) AS cdf FROM t GROUP BY key),
drawn AS (
    SELECT d.*, m.rate, t.cdf, unnest(range(1, m.parts + 1)) AS part
    FROM (SELECT *, coalesce('=' || source, '') AS key, row_number() OVER () AS place FROM documents) d
    JOIN means m USING (key) JOIN terms t USING (key)),
points AS (
    SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || part), 1, 13))::BIGINT::DOUBLE
        / 4503599627370496.0 AS point FROM drawn),
counted AS (
    SELECT place, any_value(doc_id) AS doc_id, any_value(text) AS text, any_value(lang) AS lang,
        any_value(source) AS source, any_value(n_chars) AS n_chars, any_value(rate) AS rate,
        sum(len(list_filter(cdf, lambda c: c <= point)))::BIGINT AS copies
    FROM points GROUP BY place)
SELECT doc_id, text, lang, source, n_chars, rate, unnest(range(1, copies + 1)) AS copy FROM counted
"""


@query("op4_mix_sources", MIXED)
def op4_mix_sources(spark, folder):
    """The corpus with all sources at the same share of characters, replicated and shuffled."""
    return mixing.mix(documents(spark, folder))


@query("op7_token_files")
def op7_token_files(spark, folder):
    """Place, length and checksum of each document's ids, read back from the token files."""
    return token_files.read(spark, token_files.write(documents(spark, folder), VOCABULARY))


@query("op8_near_duplicates")
def op8_near_duplicates(spark, folder):
    """Class of each document under a weighted similarity of 0.8 of its runs of five words."""
    return near_dedup.classes(documents(spark, folder)).select("doc_id", "class_id")


@query("op3_language")
def op3_language(spark, folder):
    """Language of every document by a field that has not seen the held-out fold."""
    docs = documents(spark, folder)
    field = langid.fit(docs.where(fold("doc_id", 5) != 0))
    return langid.predict(docs, field).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op5_token_counts")
def op5_token_counts(spark, folder):
    """What every context limit keeps of the encoded documents."""
    return lengths.limits(lengths.histogram(documents(spark, folder), VOCABULARY))


@query("op6_licenses")
def op6_licenses(spark, folder):
    """License notices in documents, with coverage and place."""
    return licenses.scan(documents(spark, folder))


@query("op9_spot_signatures")
def op9_spot_signatures(spark, folder):
    """Fingerprints of texts and edited texts, and their likeness."""
    return spotsigs.fingerprints(documents(spark, folder))


@query("op10_secrets")
def op10_secrets(spark, folder):
    """Spans of secrets in every document, by patterns and by character models."""
    found = secrets.scan(documents(spark, folder))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    every = F.array_sort(F.concat("base", "extra"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"), secrets.digest(every).alias("spans"),
        F.size("extra").cast("bigint").alias("n_markov"))


#: Unsigned CRC-32 of an ASCII text. DuckDB has none; the table of bytes is made by its rule.
CRC32 = """crc_bits AS (WITH RECURSIVE t(byte, x, k) AS (
    SELECT b, b, 0 FROM range(256) r(b)
    UNION ALL SELECT byte, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM t WHERE k < 8)
    SELECT list(x ORDER BY byte) AS entries FROM t WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """SQL for the checksum of an expression, in a query from the table crc_bits of CRC32, among others."""
    bytes_ = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), {step}), 4294967295)"


def _encoded_sql(name: str, value: str | None = None) -> str:
    value = value or f"{name}::VARCHAR"
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    parts = [_encoded_sql(c, text if c == "text" else None) for c in manifest.COLUMNS]
    return f"sha256({' || '.join(parts)})"


def _tree_sql(name: str, levels: int) -> str:
    """Tables {name}_1 ... of a tree over {name}_0 (tree, position, n, digest). Trees that are
    finished stay as they are, so a fixed number of levels serves all smaller trees."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_{k + 1} AS (SELECT tree, position // 3 AS position, (max(n) + 2) // 3 AS n,
    max(digest) FILTER (position % 3 = 0) AS c0, max(digest) FILTER (position % 3 = 1) AS c1, max(digest) FILTER (position % 3 = 2) AS c2,
    CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY position)) END AS digest, max(n) > 1 AS hashed
    FROM {name}_{k} GROUP BY tree, position // 3)""")
    return ",\n".join(out)


def _proof_sql(name: str, levels: int, base: str, folded: str) -> str:
    """Tables {base}_p0 ... that follow each row of {base} (tree, position, steps, folded) up its tree."""
    out = [f"{base}_p0 AS (SELECT *, '' AS siblings, {folded} AS fold FROM {base})"]
    for k in range(levels):
        slot = f"(b.position // {3 ** k}) % 3"
        left = f"(CASE WHEN {slot} > 0 THEN t.c0 ELSE '' END || CASE WHEN {slot} > 1 THEN t.c1 ELSE '' END)"
        right = f"(CASE WHEN {slot} < 1 THEN coalesce(t.c1, '') ELSE '' END || CASE WHEN {slot} < 2 THEN coalesce(t.c2, '') ELSE '' END)"
        out.append(f"""{base}_p{k + 1} AS (SELECT b.* REPLACE (
    b.siblings || CASE WHEN t.hashed THEN {left} || {right} ELSE '' END AS siblings,
    CASE WHEN t.hashed THEN sha256({left} || b.fold || {right}) ELSE b.fold END AS fold)
    FROM {base}_p{k} b JOIN {name}_{k + 1} t ON t.tree = b.tree AND t.position = b.position // {3 ** (k + 1)})""")
    return ",\n".join(out)


#: Levels of the SQL: sources of up to 3^12 documents, and up to 3^8 sources.
LEAF_LEVELS, ROOT_LEVELS = 12, 8
MANIFEST = f"""WITH {CRC32}, hashed AS MATERIALIZED (
    SELECT coalesce('=' || source, '') AS tree, doc_id, {_leaf_sql('text')} AS digest,
    {_leaf_sql(f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS found FROM documents, crc_bits),
a_0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS position,
    count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_tree_sql('a', LEAF_LEVELS)},
b_0 AS (SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS position, count(*) OVER () AS n
    FROM a_{LEAF_LEVELS}),
{_tree_sql('b', ROOT_LEVELS)},
{_proof_sql('a', LEAF_LEVELS, 'a_0', 'found')},
joined AS (SELECT p.doc_id, p.digest AS leaf, p.siblings AS below, p.fold AS found, b_0.digest AS subroot, b_0.tree, b_0.position
    FROM a_0_p{LEAF_LEVELS} p JOIN b_0 ON b_0.source = p.tree),
{_proof_sql('b', ROOT_LEVELS, 'joined', 'found')}
SELECT doc_id, leaf, subroot, root, sha256(below || siblings) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM joined_p{ROOT_LEVELS}, (SELECT digest AS root FROM b_{ROOT_LEVELS})"""


@query("op11_manifest", MANIFEST)
def op11_manifest(spark, folder):
    """Leaf, roots and proof of every document, and whether the possibly tampered text still verifies."""
    return manifest.manifest(documents(spark, folder)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def _repair_sql() -> str:
    """Cheapest edits from the last row to the first. A value is its cost in nine digits and its
    edits, so the least text is the cheapest, and of equal cost the least in ASCII order."""
    def add(value, cost, edit):
        return f"(lpad((left({value}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{edit}' || substr({value}, 10))"

    def rows(state):
        keep = {"s": "v1" if state == 0 else None, "u": None if state == 2 else "v2", "a": "v3" if state == 2 else None}
        kept = " ".join(f"WHEN ini = '{r}' THEN {add(v, 'cut', 'K')}" for r, v in keep.items() if v)
        turn = add("v3" if state == 2 else "v2", "1 + cut", "R")
        return (f"least({add(f'v{state}', 2, 'D')}, CASE WHEN fault IN ('b', 'd') THEN 'x' {kept} ELSE 'x' END, "
                f"CASE WHEN fault IN ('b', 'd') THEN 'x' ELSE {turn} END) AS w{state}")

    more = {2: "w3", 3: "w2"}
    full = ", ".join(f"least(w{q}, {add(w, 5, 'I')}) AS v{q}" for q, w in more.items())
    first = ", ".join(f"least(w{q}, {add('v2', 5, 'I')}) AS v{q}" for q in (0, 1))
    return f"""WITH RECURSIVE {CRC32}, drawn AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS draw FROM conversations, crc_bits),
damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
placed AS (SELECT *, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM damaged),
judged AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini AS pair FROM placed),
ids AS (SELECT DISTINCT conv_id FROM conversations),
facts AS (SELECT i.conv_id, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
    FROM ids i LEFT JOIN (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv_id) j ON j.conv_id IS NOT DISTINCT FROM i.conv_id),
best AS (
    SELECT conv_id, n AS pos, '000000000' AS v0, '000000010II' AS v1, '000000005I' AS v2, '000000000' AS v3 FROM facts
    UNION ALL
    SELECT conv_id, pos - 1, {first}, v2, v3 FROM (
        SELECT conv_id, pos, w0, w1, {full} FROM (
            SELECT b.conv_id, b.pos, {", ".join(rows(q) for q in range(4))}
            FROM (SELECT b.*, j.ini, j.fault, CASE WHEN j.fault = 't' THEN 5 ELSE 0 END AS cut FROM best b
                JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.pos = b.pos) b))),
audited AS MATERIALIZED (SELECT conv_id, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM best WHERE pos = 0),
walk AS (
    SELECT conv_id, audit, 0 AS step, 0 AS pos, '' AS state, '' AS repaired, false AS started FROM audited
    UNION ALL
    SELECT conv_id, audit, step + 1, pos, CASE WHEN edit = 'D' THEN state ELSE left(new_role, 1) END,
        CASE WHEN edit = 'D' THEN repaired ELSE repaired || CASE WHEN started THEN chr(10) ELSE '' END || new_role || ':' || new_text END,
        started OR edit <> 'D'
    FROM (SELECT w.conv_id, w.audit, w.step, w.state, w.repaired, w.started, w.edit, w.pos,
            CASE WHEN edit = 'K' THEN j.role WHEN w.state = 'u' THEN 'assistant' ELSE 'user' END AS new_role,
            CASE WHEN edit = 'I' THEN '' ELSE j.text END AS new_text
        FROM (SELECT conv_id, audit, step, state, repaired, started, substr(audit, step + 1, 1) AS edit,
                pos + CASE WHEN substr(audit, step + 1, 1) = 'I' THEN 0 ELSE 1 END AS pos FROM walk WHERE step < length(audit)) w
        LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos))
SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, cost, a.audit, sha256(repaired) AS repaired_sha256
FROM facts f JOIN audited a ON a.conv_id IS NOT DISTINCT FROM f.conv_id
JOIN (SELECT * FROM walk WHERE step = length(audit)) w ON w.conv_id IS NOT DISTINCT FROM f.conv_id"""


@query("op12_conversations", _repair_sql())
def op12_conversations(spark, folder):
    """Faults of every damaged conversation, the cheapest repair, and the digest of the repaired text."""
    return conversations.repair(readers.table(spark, folder, "conversations"))


COSINES = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS z FROM embeddings),
sound AS (SELECT r, vec_id, z, sqrt(list_dot_product(z, z)) AS norm FROM v WHERE z IS NOT NULL
    AND len(list_filter(z, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(z, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.r AS a, b.r AS b, b.vec_id FROM sound a JOIN sound b ON a.r <> b.r AND len(a.z) = len(b.z)
    AND list_dot_product(a.z, b.z) / (a.norm * b.norm) >= {vector_dedup.COSINE}),
reach AS (SELECT r, r AS seen FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.seen GROUP BY reach.r),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(v.vec_id = component_id, false) AS kept
FROM v JOIN least USING (r) LEFT JOIN counts ON counts.a = v.r"""


@query("op13_vector_duplicates", COSINES)
def op13_vector_duplicates(spark, folder):
    """Links, component and representative of every vector at a cosine of 0.95."""
    return vector_dedup.near_duplicates(readers.table(spark, folder, "embeddings"))
