"""Quality rules: repetition within a text, by suffix arrays.

The words of a batch of texts get one suffix array (prefix doubling; a word's rank also tells its text, so suffixes of
different texts share no prefix).  Adjacent suffixes' longest common prefixes come from the ranks of each round.  The
deepest longest-common-prefix interval that holds a suffix is the longest repeat that begins there; those that no
repeat begun earlier contains are the maximal repeated substrings.  Their spans are united, and limits are set on the
covered share of a text's characters and on its longest repeat.

Each text is worked on by itself, so there is no shuffle, and no key can be hot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import annotate, strings

SYMBOLS = "#*$%&|<>"
_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_repeat_chars long, longest_repeat long, lo array<int>, hi array<int>"


@dataclass(frozen=True)
class Limits:
    """A text is rejected beyond any of these.  Repeats count from min_repeat words on."""

    min_words: int = 10
    min_repeat: int = 5
    repeat_words_percent: int = 20
    repeat_chars_percent: int = 30
    longest_repeat: int = 100


def longest_repeats(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the number of words of the longest substring that begins there and occurs again in its text."""
    n = len(h)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    row = X.row_of(first)
    end = first[row + 1]
    key = X.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable").astype(np.int32)
    same = key[order][1:] == key[order][:-1]
    head = np.concatenate([[True], ~same])
    start = np.flatnonzero(head)
    rank = np.empty(n, np.int32)
    stop = np.append(start[1:], n)
    rank[order] = np.repeat(stop, stop - start)  # one beyond a group's last place, so what a text's end cuts off a group leaves the rest as it is
    before: list[tuple[np.ndarray, np.ndarray]] = []  # suffixes whose rank a round changed, and what it was
    # places in the suffix array whose suffixes aren't told apart yet
    open_ = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]])).astype(np.int32)
    adjacent = np.flatnonzero(same)  # (t, t + 1) share a first word
    step = 1
    while len(open_):
        at = order[open_]
        to = at + np.int64(step)
        both = np.where(to < end[at], rank[np.minimum(to, n - 1)], 0) + rank[at].astype(np.int64) * (n + 2)
        by = np.argsort(both, kind="stable")
        at, both = at[by], both[by]
        order[open_] = at
        new_head = np.concatenate([[True], both[1:] != both[:-1]])
        cut = np.flatnonzero(new_head)
        stop = np.append(cut[1:], len(at))
        now = np.repeat(open_[stop - 1], stop - cut) + np.int32(1)
        changed = rank[at] != now
        before.append((at[changed], rank[at[changed]]))
        rank[at] = now
        single = new_head & np.append(new_head[1:], True)
        open_ = open_[~single]
        step *= 2
    p, q = order[adjacent], order[adjacent + 1]
    length, p_end, q_end = np.zeros(len(p), np.int32), end[p], end[q]
    for k in range(len(before), -1, -1):  # equal ranks after k rounds: 2 ** k words agree
        a, b = p + length, q + length
        ok = (a < p_end) & (b < q_end)
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        length += np.where(ok & (rank[a] == rank[b]), np.int32(1 << k), np.int32(0))
        if k:
            rank[before[k - 1][0]] = before[k - 1][1]
            before.pop()
    np.maximum.at(best, p, length)
    np.maximum.at(best, q, length)
    return best


def measure(texts, min_repeat: int) -> list:
    raw, offs = X.byte_view(strings(texts))
    starts, ends, first = X.words(raw, offs, "space")
    lead = (raw & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(lead)])
    chars = points[ends] - points[starts]
    table = np.zeros(256, bool)
    table[[ord(c) for c in SYMBOLS]] = True
    symbols = X.per_row(table[raw], offs)
    # lines with a word, equal to an earlier one of the text
    breaks = np.flatnonzero(raw == 0x0A)
    inner = offs[1:-1]
    lo = np.unique(np.concatenate([[0], breaks + 1, inner]))
    lo = lo[lo < len(raw)]
    hi = np.append(lo[1:], len(raw))
    hi = hi - (raw[np.maximum(hi - 1, 0)] == 0x0A) if len(raw) else hi
    worded = np.searchsorted(starts, hi) > np.searchsorted(starts, lo)
    lo, hi = lo[worded], hi[worded]
    line_row = np.searchsorted(offs, lo, side="right") - 1
    line = X.mix(X.span_hashes(raw, lo, hi) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(line, return_index=True)
    dup = np.bincount(line_row, minlength=len(texts)) - np.bincount(line_row[at], minlength=len(texts))

    best = longest_repeats(X.span_hashes(raw, starts, ends), first)
    at = np.flatnonzero(best >= min_repeat)
    reach = at + best[at]
    if len(at):
        outer = np.concatenate([[True], reach[1:] > np.maximum.accumulate(reach)[:-1]])  # no earlier repeat contains it
        at, reach = at[outer], reach[outer]
    covered = X.cover(at, reach, len(best))
    per = np.searchsorted(at, first)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, X.row_of(first), best)
    shift = np.repeat(first[:-1], np.diff(per))
    spans = [pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(x - shift, pa.int32())) for x in (at, reach)]
    return [np.diff(first), X.per_row(chars, first), symbols, dup, X.per_row(covered, first), X.per_row(np.where(covered, chars, 0), first), longest, *spans]


def mark(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, limits: Limits = Limits()) -> tuple[DataFrame, str]:
    """The columns `keep` of docs with a struct column: the counts, lo and hi (word spans of the maximal repeated
    substrings), base_failed and kept.

    Words are runs of anything but ASCII white space.  A null or empty text has no words, and fails; repeated rows are
    judged one by one; other columns stay as they are; an empty table gives an empty one.
    """
    df, r = annotate(docs, [text_col], lambda texts: measure(texts, limits.min_repeat), _FIELDS, list(docs.columns if keep is None else keep))
    x = F.col(r)
    failed = _base_failed(x, limits)
    kept = ~failed & (100 * x["n_repeat_chars"] <= limits.repeat_chars_percent * x["word_chars"]) & (x["longest_repeat"] <= limits.longest_repeat)
    return df.withColumn(r, x.withField("base_failed", failed).withField("kept", kept)), r


def _base_failed(x: Column, limits: Limits) -> Column:
    return (x["n_words"] < limits.min_words) | (100 * x["n_repeat_words"] > limits.repeat_words_percent * x["n_words"])


def passing(docs: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    df, r = mark(docs, **options)
    return df.filter(F.col(r)["kept"]).drop(r)


def digest(docs: DataFrame) -> DataFrame:
    """What op4 returns: counts and verdicts for each document."""
    df, r = mark(docs, keep=["doc_id"])
    return df.select("doc_id", *(F.col(r)[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_repeat_chars")))


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i FROM w),
r5 AS (SELECT doc_id, unnest(places) AS i FROM (SELECT doc_id, list(i) AS places FROM p WHERE i + 4 <= n GROUP BY doc_id, array_to_string(ws[i : i + 4], ' ') HAVING count(*) > 1)),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS i FROM r5),
rep AS (SELECT hit.doc_id, count(*) AS n_rep, sum(length(w.ws[hit.i])) AS c_rep FROM hit JOIN w USING (doc_id) GROUP BY hit.doc_id),
long AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM p WHERE i + 100 <= n GROUP BY doc_id, array_to_string(ws[i : i + 100], ' ') HAVING count(*) > 1)),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(c_rep, 0) AS BIGINT) AS n_repeat_chars, long.doc_id IS NOT NULL AS too_long
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN long USING (doc_id)),
g AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_repeat_chars <= 30 * word_chars AND NOT too_long AS kept, n_repeat_chars
FROM g
"""
