"""License notices and texts in documents: winnowed fingerprints pick candidates, an alignment measures them.

The templates are a versioned file of notices, headers and whole public texts. Their inverted
index (fingerprint to template and place) goes to every task and is of bounded size. Of every two
neighbouring runs of three words the smaller hash is kept, on both sides, so a shared run of four
words always shares a fingerprint. Hits of a short template on close diagonals are one candidate;
a local alignment of words in a band around the diagonals gives the matched share of the template
and the span in the text. Hits of a long one are chained by rising place, and the words between
them are compared. SPDX tags are read by their grammar, whichever license they name.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from difflib import SequenceMatcher
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from postlens.llm import words as W

RUN = 3
KEEP_OF = 2
BAND = 4
COVERAGE = 0.8
#: Templates of more words are chained instead of aligned in a band.
LONG = 120
#: A candidate has a hit for so many words of its template. With a fifth of the words missing,
#: (0.8 n - 3 s) / 2 hits are left if s runs of words are whole, which is n / 20 for s up to 0.23 n.
WORDS_A_HIT = 20
#: Bound on the templates together: words, of which each takes some 100 bytes in a task.
MOST_WORDS = 1_000_000
_LIST = json.loads((Path(__file__).parent / "license_list.json").read_text())
#: Notices, headers and whole texts by license name; the part from # on only tells wordings apart.
TEMPLATES = {x["name"]: x["text"] for x in _LIST["licenses"]}
#: Runs of words, by template, that a match has to contain as they are: family, variant and version.
REQUIRED = {x["name"]: x["required"] for x in _LIST["licenses"]}
_ID = r"[A-Za-z0-9]+(?:[.:+-]+[A-Za-z0-9]+)*\+?"
_TAG = re.compile(rf"SPDX-License-Identifier:[ \t]*+((?:\([ \t]*)*{_ID}(?:[ \t]*+\))*(?:[ \t]++(?:AND|OR|WITH)[ \t]++(?:\([ \t]*)*{_ID}(?:[ \t]*+\))*)*)", re.I)
_NAMED = re.compile(rf"{_ID}(?:[ \t]+WITH[ \t]+{_ID})?", re.I)


def fingerprints(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, row, hash) of the kept runs; a row of one run keeps it."""
    at, doc, h = W.windows(words, RUN)
    keep = np.zeros(len(at), bool)
    for i in range(KEEP_OF):
        same = np.ones(len(at), bool)
        least = h.copy()
        for j in range(KEEP_OF):  # the window of KEEP_OF runs that starts i runs before this one
            other = np.arange(len(at)) - i + j
            there = (other >= 0) & (other < len(at))
            other = np.clip(other, 0, max(0, len(at) - 1))
            there &= doc[other] == doc if len(at) else there
            same &= there
            least = np.where(there, np.minimum(least, h[other]), least)
        keep |= same & (h == least)
    alone = np.bincount(doc, minlength=words.rows)[doc] < KEEP_OF if len(at) else keep
    keep |= alone
    return at[keep], doc[keep], h[keep]


def align(template: list[int], text: list[int], diagonal: int, reach: int):
    """Best local alignment near ``diagonal`` (place in text minus place in template): (matched
    words, first, end) in the text. Match 1, mismatch -1, gap -1; the earliest end at ties."""
    best, above = (0, 0, 0, 0), {}
    for i, word in enumerate(template):
        row = {}
        for j in range(max(0, i + diagonal - BAND), min(len(text), i + diagonal + reach + BAND + 1)):
            options = [(0, 0, j)]
            if text[j] == word:
                s, m, f = above.get(j - 1, (0, 0, j))
                options.append((s + 1, m + 1, f))
            else:
                s, m, f = above.get(j - 1, (0, 0, j))
                options.append((s - 1, m, f))
            for s, m, f in (above.get(j, (0, 0, j)), row.get(j - 1, (0, 0, j))):
                options.append((s - 1, m, f))
            row[j] = max(options, key=lambda x: (x[0], x[1], -x[2]))
            s, m, f = row[j]
            if (s, m) > best[:2]:
                best = (s, m, f, j + 1)
        above = row
    return best[1:]


def chained(template: np.ndarray, text: np.ndarray, place: np.ndarray, at: np.ndarray):
    """(matched words, first, end) of the occurrences of a long template, from hits (place in the
    template, place in the text). An occurrence has diagonals within a quarter of the template."""
    n, reach = len(template), len(template) // 4
    while len(at):
        order = np.argsort(at - place, kind="stable")
        diagonal = (at - place)[order]
        ends = np.searchsorted(diagonal, diagonal + reach, "right")
        peak = int(np.argmax(ends - np.arange(len(order))))
        mine = order[peak: ends[peak]]
        if len(mine) * WORDS_A_HIT < n:
            return
        left = np.ones(len(at), bool)
        left[mine] = False
        mine = mine[np.lexsort((-place[mine], at[mine]))]
        tails, spots, back = [], [], []
        for k, p in enumerate(place[mine].tolist()):
            i = bisect_left(tails, p)
            back.append(spots[i - 1] if i else -1)
            tails[i:i + 1], spots[i:i + 1] = [p], [k]
        chain, k = [], spots[-1]
        while k >= 0:
            chain.append((int(place[mine[k]]), int(at[mine[k]])))
            k = back[k]
        chain.reverse()
        p, x = chain[0]
        head = min(p, x)
        same = np.flatnonzero(template[p - head: p] == text[x - head: x])
        matched, first = len(same), x - head + int(same[0]) if len(same) else x
        for (p, x), (q, y) in zip(chain, chain[1:]):
            if q - p == y - x:
                matched += int((template[p:q] == text[x:y]).sum())
            elif y - x <= 2 * (q - p) + n:  # unequal words between two hits
                blocks = SequenceMatcher(None, template[p:q].tolist(), text[x:y].tolist(), False).get_matching_blocks()
                matched += sum(b.size for b in blocks)
        p, x = chain[-1]
        rest = min(n - p, len(text) - x)
        same = np.flatnonzero(template[p: p + rest] == text[x: x + rest])
        yield matched + len(same), first, x + int(same[-1]) + 1
        place, at = place[left], at[left]


def tags(text: str):
    """(license, start, end) of the identifiers in the SPDX tags of a text."""
    for tag in _TAG.finditer(text):
        for m in _NAMED.finditer(text, tag.start(1), tag.end(1)):
            if m[0].upper() not in ("AND", "OR", "WITH"):
                yield m[0], m.start(), m.end()


def _holds(text: list[int], run: list[int]) -> bool:
    """Whether ``run`` is in ``text`` as neighbouring words."""
    return any(text[i: i + len(run)] == run for i in range(len(text) - len(run) + 1))


def _best(spans: list[tuple]) -> list[tuple]:
    """Of (row, first, end, matched, coverage, template) that overlap in a row, the one of most
    matched words, then of most coverage."""
    kept, ranges = [], {}
    for s in sorted(spans, key=lambda s: (s[0], -s[3], -s[4], s[1], s[5])):
        own = ranges.setdefault(s[0], [])  # disjoint and sorted
        i = bisect_left(own, (s[1], s[2]))
        if (i == 0 or own[i - 1][1] <= s[1]) and (i == len(own) or own[i][0] >= s[2]):
            own.insert(i, (s[1], s[2]))
            kept.append(s)
    return kept


def _scanner(templates: dict[str, str], required: dict[str, list[str]], coverage: float):
    names = list(templates)
    phrases = [[n, p] for n in range(len(names)) for p in required.get(names[n], [])]
    shown = [n.split("#")[0] for n in names]

    def run(batches):
        reader = W.Reader(W.byte_classes())
        known = reader.read(W.folded(W.strings(pa.array([templates[n] for n in names], pa.string()))))
        at, doc, h = fingerprints(known)
        size = known.count
        asked = reader.read(W.folded(W.strings(pa.array([p for _, p in phrases], pa.string()))))
        musts = [[] for _ in names]
        for (n, _), a, b in zip(phrases, asked.first[:-1], asked.first[1:]):
            musts[n].append(asked.hash[a:b].tolist())
        _, which, often = np.unique(np.stack([doc.astype(np.uint64), h]), axis=1, return_inverse=True, return_counts=True)
        use = (size[doc] <= LONG) | (often[which.ravel()] == 1)  # a long template's repeats say nothing of the place
        at, doc, h = at[use], doc[use], h[use]
        order = np.argsort(h, kind="stable")
        index, owner, place = h[order], doc[order], (at - known.first[doc])[order]
        bodies = [known.hash[a:b] for a, b in zip(known.first[:-1], known.first[1:])]
        least = np.maximum(1, -(-size // WORDS_A_HIT))
        for batch in batches:
            texts, ids = W.strings(batch.column("text")), batch.column("doc_id")
            tagged = pc.match_substring(texts, "SPDX-License-Identifier", ignore_case=True)
            for lo, hi in W.blocks(texts):
                part = texts.slice(lo, hi - lo)
                w = reader.read(W.folded(part))
                at, doc, h = fingerprints(w)
                first = np.searchsorted(index, h, "left")
                count = np.searchsorted(index, h, "right") - first
                hit = np.repeat(np.arange(len(h)), count)
                entry = np.repeat(first, count) + np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
                pair = doc[hit] * len(names) + owner[entry]
                _, back, hits = np.unique(pair, return_inverse=True, return_counts=True)
                enough = hits[back] >= least[owner[entry]]
                hit, entry, pair = hit[enough], entry[enough], pair[enough]
                diagonal = at[hit] - w.first[doc[hit]] - place[entry]
                order = np.lexsort((diagonal, pair))
                hit, entry, pair, diagonal = hit[order], entry[order], pair[order], diagonal[order]
                cuts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else pair
                data, offsets = W.raw(part)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                spans_found, found = [], set()
                for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(pair)).tolist()):
                    d, t = divmod(int(pair[a]), len(names))
                    base, body = int(w.first[d]), bodies[t]
                    text = w.hash[base: int(w.first[d + 1])]
                    if len(body) > LONG:
                        spans = chained(body, text, place[entry[a:b]], at[hit[a:b]] - base)
                    else:
                        spans = _banded(body.tolist(), text, diagonal[a:b].tolist(), int(least[t]))
                    for matched, x, y in spans:
                        if matched >= coverage * len(body) and all(_holds(text[x:y].tolist(), m) for m in musts[t]):
                            spans_found.append((d, x, y, matched, matched / len(body), t))
                for d, x, y, _, share, t in _best(spans_found):
                    zero, base = points[offsets[d]], int(w.first[d])
                    found.add((d, shown[t], share, int(points[w.start[base + x]] - zero), int(points[w.end[base + y - 1]] - zero)))
                for d in range(lo, hi):
                    if tagged[d].as_py():
                        found.update((d - lo, name, 1.0, x, y) for name, x, y in tags(texts[d].as_py()))
                found = sorted(found)
                if found:
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([lo + d for d in cols[0]]))] + [pa.array(c) for c in cols[1:]],
                        names=["doc_id", "license", "coverage", "start", "end"])
    return run


def _banded(body: list[int], words: np.ndarray, diagonals: list[int], least: int):
    """(matched words, first, end) of a short template, for each group of close diagonals."""
    k = 0
    while k < len(diagonals):
        low = high = diagonals[k]
        first = k
        while k < len(diagonals) and diagonals[k] <= high + BAND:
            high = diagonals[k]
            k += 1
        if k - first < least:
            continue
        start = max(0, low - BAND)
        text = words[start: high + len(body) + BAND].tolist() if high + len(body) + BAND > 0 else []
        matched, a, b = align(body, text, low - start, high - low)
        if matched:
            yield matched, start + a, start + b


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         required: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, license, coverage, start, end): every place where at least ``coverage`` of a
    template's words are matched in order, and its ``required`` runs of words are there unchanged;
    of places that overlap, the template with the most matched words. Places are in code points, end exclusive. Whole texts have
    names that end in -text; identifiers in SPDX tags are reported as they are written.

    ``templates`` maps names to notices or texts, instead of those of license_list.json; these have
    required words only if ``required`` names them. They go
    to every task (Spark broadcasts what is over 1 MB), so they may have MOST_WORDS words
    together. Text inserted into a long template counts up to a quarter of its length. Null and
    empty texts have none; texts without a match give no row; a notice that occurs twice gives two rows;
    repeated documents give their rows each time. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    templates = dict(TEMPLATES if templates is None else templates)
    if sum(len(t.split()) for t in templates.values()) > MOST_WORDS:
        raise ValueError(f"the templates have more than {MOST_WORDS} words together")
    if required is None:
        required = REQUIRED if templates == TEMPLATES else {}
    run = _scanner(templates, required, coverage)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, license string, coverage double, start bigint, end bigint")
