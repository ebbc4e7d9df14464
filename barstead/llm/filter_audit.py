"""Operator 11: audit of how filters interact, by decision diagrams.

Each document has a failure mask, one bit a filter. Masks are counted per part; what remains is at
most 2**k rows for k filters. From these a part's diagram is built: a level per filter, a branch for
"fails" and one for "passes", equal subtrees shared, empty ones absent, and in each node the counts
of the documents below it. Swapping two adjacent levels rebuilds only nodes of the upper one, so all
orders are visited by one swap each. In a diagram with a given order, the path that passes at each
level gives the steps of filtering in that order: what a step removes is what its "fails" branch
counts, what it keeps its "passes" branch.

Counts are additive tuples (documents, good, toxic), so documents never meet: masks come from a text
where it lies, copies are found by the digest of a text, and rows travel as digest and flags.
Where rows meet: the digest (copies collapse per task before they move, and to one row per part and
label afterwards), the doc_id (labels) and the mask. A part's diagram is one small group.

Defined results: a null text is empty; a null part is the empty string; a null doc_id is no copy of
another and makes none one. Rows repeated in full are documents of their own, neither a copy of the
other. A document is good (toxic) if any label row of its id says so; a null id has none. A very long text is one task's
word list. No documents give no rows. Columns that the filters don't name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


# ---------------------------------------------------------------- diagrams


class Diagram:
    """Counts of failure masks as a shared diagram; ``order[i]`` is the filter of level i.

    A node is a number. ``below[node]`` is (level, node that fails, node that passes), a leaf has none; node 0 is empty.
    """

    def __init__(self, k: int, masks: dict[int, tuple[int, ...]]):
        self.order = list(range(k))
        width = len(next(iter(masks.values()), COUNTS))
        self.counts: list[tuple[int, ...]] = [(0,) * width]
        self.below: list[tuple[int, int, int] | None] = [None]
        self.known: dict = {}
        self.root = self._build(masks, 0)

    def _leaf(self, counts: tuple[int, ...]) -> int:
        if not any(counts):
            return 0
        return self._known(counts, None, counts)

    def _node(self, level: int, fails: int, passes: int) -> int:
        if not fails and not passes:
            return 0
        key = (level, fails, passes)
        return self._known(key, key, tuple(map(sum, zip(self.counts[fails], self.counts[passes], strict=True))))

    def _known(self, key, below, counts: tuple[int, ...]) -> int:
        at = (below is None, key)
        if at not in self.known:
            self.known[at] = len(self.counts)
            self.counts.append(counts)
            self.below.append(below)
        return self.known[at]

    def _build(self, masks: dict[int, tuple[int, ...]], level: int) -> int:
        if not masks:
            return 0
        if level == len(self.order):
            return self._leaf(masks[next(iter(masks))])
        bit = 1 << self.order[level]
        sides = [{m: c for m, c in masks.items() if bool(m & bit) == fails} for fails in (True, False)]
        return self._node(level, *(self._build(s, level + 1) for s in sides))

    def branches(self, node: int) -> tuple[int, int]:
        return self.below[node][1:] if node else (0, 0)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next. Nodes above are renewed, nodes further down stay as they are."""
        done: dict[int, int] = {}

        def renewed(node: int) -> int:
            if not node:
                return 0
            if node not in done:
                at, fails, passes = self.below[node]
                if at < level:
                    done[node] = self._node(at, renewed(fails), renewed(passes))
                else:
                    (ff, fp), (pf, pp) = self.branches(fails), self.branches(passes)
                    done[node] = self._node(level, self._node(level + 1, ff, pf), self._node(level + 1, fp, pp))
            return done[node]

        self.root = renewed(self.root)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Filter, counts removed and counts kept of each level, along the path that passes everywhere."""
        node = self.root
        for x in self.order:
            fails, passes = self.branches(node)
            yield x, self.counts[fails], self.counts[passes]
            node = passes

    def failing(self) -> list[tuple[int, ...]]:
        """Counts of all documents that fail each filter, whatever else they fail."""
        out = [self.counts[0]] * len(self.order)
        share = {self.root: 1} if self.root else {}  # paths to each node of a level
        for x in self.order:
            below: dict[int, int] = {}
            for node, paths in share.items():
                fails, passes = self.branches(node)
                out[x] = tuple(a + paths * b for a, b in zip(out[x], self.counts[fails], strict=True))
                for child in filter(None, (fails, passes)):
                    below[child] = below.get(child, 0) + paths
            share = below
        return out


def adjacent_swaps(k: int) -> Iterator[int]:
    """Levels whose swaps with the next visit all k! orders, one new order each."""
    if k < 2:
        return
    place = k - 1
    down = True
    for inner in [*adjacent_swaps(k - 1), None]:
        for _ in range(k - 1):
            place += -1 if down else 1
            yield place if down else place - 1
        if inner is not None:
            # the last filter stands at one end, the others are swapped beside it
            yield inner + (1 if down else 0)
        down = not down


def audited(masks: dict[int, tuple[int, ...]], filters: Sequence[str] = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of the filters."""
    k = len(filters)
    diagram = Diagram(k, masks)
    fails = [c[0] for c in diagram.failing()]
    alone, total, found = [0] * k, [0] * k, []
    for level in [None, *adjacent_swaps(k)]:
        if level is not None:
            diagram.swap(level)
        name = "".join(filters[x] for x in diagram.order)
        for step, (x, removed, kept) in enumerate(diagram.steps(), 1):
            found.append((name, step, x, kept[0], removed))
            total[x] += removed[0]
            if step == k:
                alone[x] = removed[0]
    return [(name, step, kept, gone[0], fails[x] - gone[0], alone[x], gone[1], gone[2], total[x]) for name, step, x, kept, gone in found]


# ---------------------------------------------------------------- masks


def text_failures(text: Column) -> Column:
    """Mask of the filters that a text decides alone: A short, B repetitive, C capitals, D symbols."""
    words = F.regexp_extract_all(text, F.lit(C.WORD), F.lit(0))

    def bits(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        fails = [n < 200, 100 * distinct < 50 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text), text.rlike("[#$%&*|]")]
        out = F.lit(0)
        for i, f in enumerate(fails):
            out = out + F.when(f, 1 << i).otherwise(0)
        return out

    # the word list is made once and lives as long as its row
    return F.get(F.transform(F.array(words), bits), F.lit(0))


def document_masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask and the counts n, good, toxic of its documents: at most 32 rows a part."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), text_failures(text).alias("mask"))
    same = rows.groupBy("doc_id", "digest", "part").agg(F.first("mask").alias("mask"), F.count("*").alias("n"))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    told = same.join(said, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # copies of a text become one row per part and label: how many, the smallest id, how many rows have it
    copies = told.groupBy("digest", "part", "good", "toxic").agg(F.first("mask").alias("mask"), F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    unique = F.when(first, F.col("n_least")).otherwise(0) + F.col("n_null")
    sides = copies.withColumn("unique", unique).select("part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("unique").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("unique")).alias("n")))).alias("s"))
    flag = lambda c: F.sum(F.when(F.col(c), F.col("s.n")).otherwise(0)).alias(c)
    return sides.filter("s.n > 0").groupBy("part", F.col("s.mask").alias("mask")).agg(F.sum("s.n").alias("n"), flag("good"), flag("toxic"))


def audit(masks: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """Per part, order of the filters and step: what it keeps, removes and loses. ``masks`` has part, mask, n, good, toxic, one row for each part and mask."""
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): tuple(map(int, c)) for m, *c in rows[["mask", *COUNTS]].itertuples(index=False)}
        return pd.DataFrame([(rows["part"].iloc[0], *r) for r in audited(counts, filters)], columns=names)

    return masks.groupBy("part").applyInPandas(run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def op11_filter_audit(spark, sf_dir):
    return audit(document_masks(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP11_SQL = r"""
with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
  w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as least from t),
  s as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1),
  m as (
    select part, case when len(words) < 200 then 'A' else '' end || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
        || case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) then 'C' else '' end
        || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end || case when doc_id > least then 'E' else '' end as fails,
      count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
    from w left join s using (doc_id) group by 1, 2),
  l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
  o as (select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
  k as (select filter_order, step, filter_order[step] as x, left(filter_order, step) as upto, left(filter_order, step - 1) as before from o, (select unnest([1, 2, 3, 4, 5]) as step)),
  r as (
    select part, filter_order, step, x,
      coalesce(sum(n) filter (translate(fails, upto, '') = fails), 0) as kept,
      coalesce(sum(n) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as removed,
      coalesce(sum(n) filter (contains(fails, x) and translate(fails, before, '') <> fails), 0) as redundant,
      coalesce(sum(n) filter (fails = x), 0) as unique_fails,
      coalesce(sum(good) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as good_lost,
      coalesce(sum(toxic) filter (contains(fails, x) and translate(fails, before, '') = fails), 0) as toxic_lost
    from m, k group by 1, 2, 3, 4)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, x))::bigint as shapley
from r
"""
