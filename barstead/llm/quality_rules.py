"""Operator 1: quality rules with suffix-array repetition.

The words of each text form a sequence. Its suffix array (prefix doubling, many texts per numpy
call) and the longest common prefixes of neighbours give the maximal repeated word runs: the
longest repeat starting at a word is the larger of its two neighbours' common prefixes. The
union of the spans of all repeats of ``min_repeat`` words or more may cover ``max_covered`` of
the words at most, and no repeat may be longer than ``max_longest`` words.

One pass over the rows, no shuffle; texts are processed in groups of bounded bytes.

Words are told apart by 64-bit hashes that aren't verified: in a text of a million words one pair
of unlike words is taken as equal with a chance of 3e-8.

Defined results: null, empty and blank texts have 0 words and fail the base rule (fewer than 10
words). A very long text is one numpy call of its own. Repeated rows and repeated ids get a row
each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

MIN_WORDS = 10
BASE_WINDOW = 5
BASE_PERCENT = 20
MIN_REPEAT = 15
MAX_COVERED_PERCENT = 15
MAX_LONGEST = 40

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def suffix_ranks(words: np.ndarray, text_of: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of all suffixes after each doubling, and the positions whose first word recurs in their text.

    Level k orders suffixes by their first 2**k words inside their own text. Only suffixes that
    still share a rank are sorted again, so unique text costs one sort.
    """
    n = len(words)
    key = C.mix(words + text_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    levels, active = [rank], np.flatnonzero(counts[inverse] > 1)
    recurring, step = active, 1
    while len(active):
        ahead = active + step
        inside = (ahead < n) & (text_of[np.minimum(ahead, n - 1)] == text_of[active])
        follow = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        pair = rank[active] * (n + 1) + follow
        order = np.argsort(pair, kind="stable")
        sorted_pair, at = pair[order], active[order]
        place = np.arange(len(at))
        fresh = np.append(True, sorted_pair[1:] != sorted_pair[:-1])
        group = rank[at]
        opened = np.append(True, group[1:] != group[:-1])
        first_of_pair = np.maximum.accumulate(np.where(fresh, place, 0))
        first_of_group = np.maximum.accumulate(np.where(opened, place, 0))
        rank = rank.copy()
        rank[at] = group + first_of_pair - first_of_group
        levels.append(rank)
        single = fresh & np.append(fresh[1:], True)
        active, step = at[~single], step * 2
    return levels, recurring


def longest_repeats(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest run starting there that occurs again in the same text."""
    n = len(words)
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    levels, recurring = suffix_ranks(words, text_of)
    order = recurring[np.argsort(levels[-1][recurring], kind="stable")]
    left, right = order[:-1], order[1:]
    near = levels[0][left] == levels[0][right]
    left, right = left[near], right[near]
    common = np.zeros(len(left), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        ok = np.maximum(a, b) < n
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        ok &= (text_of[a] == text_of[left]) & (text_of[b] == text_of[right]) & (levels[k][a] == levels[k][b])
        common += ok * (1 << k)
    np.maximum.at(best, left, common)
    np.maximum.at(best, right, common)
    return best


def covered(best: np.ndarray, shortest: int) -> np.ndarray:
    """Positions in the union of all repeated runs of ``shortest`` words or more."""
    n, at = len(best), np.flatnonzero(best >= shortest)
    ends = np.bincount(at + best[at], minlength=n + 1)
    starts = np.bincount(at, minlength=n + 1)
    return np.cumsum(starts - ends)[:n] > 0


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags))[bounds])


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measures(column: pa.Array, min_repeat: int) -> dict[str, np.ndarray]:
    raw_all, offsets_all = C.text_buffer(column)
    parts = []
    for i, j in C.chunks(offsets_all):
        raw = raw_all[offsets_all[i] : offsets_all[j]]
        offsets = offsets_all[i : j + 1] - offsets_all[i]
        starts, ends, bounds = C.word_bounds(raw, offsets)
        words = C.word_hashes(raw, starts, ends)
        text_of = np.repeat(np.arange(j - i), np.diff(bounds))
        best = longest_repeats(words, text_of)
        longest = np.zeros(j - i, dtype=np.int64)
        np.maximum.at(longest, text_of, best)
        data = raw.tobytes()
        parts.append({
            "n_words": np.diff(bounds),
            "word_chars": _sums(((raw & 0xC0) != 0x80) & ~C._SPACES[raw], offsets),
            "n_symbols": _sums(_SYMBOLS[raw], offsets),
            "n_dup_lines": np.array([_dup_lines(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], dtype=np.int64),
            "n_repeat_words": _sums(covered(best, BASE_WINDOW), bounds),
            "covered_words": _sums(covered(best, min_repeat), bounds),
            "longest_repeat": longest,
        })
    if not parts:
        return {}
    return {k: np.concatenate([p[k] for p in parts]).astype(np.int64) for k in parts[0]}


def quality_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered_percent: int = MAX_COVERED_PERCENT, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Per row: doc_id, the base measures, base_failed, kept, covered_words and longest_repeat (words)."""

    def run(batches):
        for batch in batches:
            m = measures(batch.column("text"), min_repeat)
            if not m:
                continue
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
            bad = (100 * m["covered_words"] > max_covered_percent * m["n_words"]) | (m["longest_repeat"] > max_longest)
            cols = {"doc_id": batch.column("doc_id"), **{k: pa.array(m[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}}
            cols |= {"base_failed": pa.array(failed), "kept": pa.array(~failed & ~bad), "covered_words": pa.array(m["covered_words"]), "longest_repeat": pa.array(m["longest_repeat"])}
            yield pa.RecordBatch.from_pydict(cols)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered_words long, longest_repeat long",
    )


def op1_quality_rules(spark, sf_dir):
    return quality_rules(C.documents(spark, sf_dir)).drop("longest_repeat")


_WINDOWS = """
  {name} as (
    select doc_id, count(*) as n from (
      select distinct doc_id, p + o as p from (
        select doc_id, p, count(*) over (partition by doc_id, w) as c from (
          select doc_id, p, array_to_string(list_slice(words, p, p + {k} - 1), ' ') as w
          from (select doc_id, words, unnest(range(1, len(words) - {k} + 2)) as p from t))
      ), (select unnest(range(0, {k})) as o) where c > 1
    ) group by doc_id)"""

OP1_SQL = f"""
with t as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
  {_WINDOWS.format(name="five", k=BASE_WINDOW)},
  {_WINDOWS.format(name="cover", k=MIN_REPEAT)},
  {_WINDOWS.format(name="longest", k=MAX_LONGEST + 1)},
  lines as (
    select doc_id, count(*) - count(distinct line) as n from (
      select doc_id, unnest(string_split(text, chr(10))) as line from t) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id),
  m as (
    select t.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(lines.n, 0)::bigint as n_dup_lines,
      coalesce(five.n, 0)::bigint as n_repeat_words, coalesce(cover.n, 0)::bigint as covered_words, longest.n is not null as too_long
    from t left join five using (doc_id) left join cover using (doc_id) left join longest using (doc_id) left join lines using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} or 100 * n_repeat_words > {BASE_PERCENT} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {BASE_PERCENT} * n_words or 100 * covered_words > {MAX_COVERED_PERCENT} * n_words or too_long) as kept,
  covered_words
from m
"""
