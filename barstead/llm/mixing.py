"""Operator 4 (native): mixing sources to target weights.

The words of a source, documents in a fixed order, form one stream that is packed into blocks of
``block`` words. Targets follow the weights, capped at ``cap`` times a source's words, the excess
reshared until none is above. A source gets as many output slots as its target has blocks.

1. Each output shard of ``shard_slots`` slots draws how many of its slots go to each source: a
   multinomial draw, conditioned on the totals of the sources, since independent draws would put
   several percent of noise on small ones. The draw deals all slots to shards by one pseudorandom
   permutation and counts them by (shard, source); only these counts go on.
2. A shard's slots of a source continue where the earlier shards' end (prefix sums of the counts).
   That index maps through a pseudorandom permutation of the source's block indexes, another one
   for each pass over the source, so a block is taken as often as any other or once more.
3. Slots and documents meet in a join on (source, block).

``dealt`` gives the shards themselves: each slot with the document parts of its block. ``mix`` sums
over all shards. ``sharded_documents`` keeps texts whole, so a text goes to the shard that the first of
its taken blocks was dealt to; ``mixed_documents`` gives them without shard, or ordered by it.

The permutations are swap-or-not shuffles: any domain size, no state, plain integer arithmetic.
Each round is a projection, so that Spark compiles them. Everything is DataFrame and SQL functions.

Skew: positions in a source's stream come from two-level prefix sums: windows run over one of
``BUCKETS`` hash buckets of a source, then over the bucket totals; those of shard counts likewise.
Sources are ranked by range partitions and capped by repeated aggregates, so there may be many.

Defined results: null text has size 0 and is taken 0 times. Null sources are one source, last in
order. Null ids come first in their bucket. Rows of one id and size are ordered by a hash of the
text; repeated rows are documents of their own. Very long texts span many blocks. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 128
SHARD_SLOTS = 4096
BUCKETS = 4096
SLOTS_PER_TASK = 200_000
ROUNDS = 12
SHARD_ROUNDS = 24
PRIME = 2147483647
#: Shards whose counts one window adds up; their totals are added up in a second one.
SHARD_GROUP = 1024


def permuted(df: DataFrame, x: str, n: str, seed: str, name: str, rounds: int = ROUNDS) -> DataFrame:
    """Add ``name``: a permutation of 0..n-1 applied to x. In each round x may swap places with (key - x) mod n."""
    own = df.columns
    df = df.selectExpr(*own, f"{x} as _a", f"{n} as _n", f"({seed}) % {PRIME} as _s")
    for r in range(1, rounds + 1):
        a, b = pow(48271, r, PRIME), pow(69621, r, PRIME)
        key = f"((_s * {a}L + {69621 * r}L) % {PRIME} * 2147483648L + (_s * {b}L + {16807 * r + 11}L) % {PRIME}) % _n"
        df = df.selectExpr(*own, "_a", "_n", "_s", f"({key} - _a + _n) % _n as _b").selectExpr("*", "greatest(_a, _b) as _x")
        df = df.selectExpr("*", f"((_x % {PRIME}) * (_x % {PRIME}) % {PRIME} * 48271L + _x % {PRIME} * 69621L + _x div {PRIME} * 16807L % {PRIME} + _s * {a}L % {PRIME} + {7919 * r}L) % {PRIME} as _h")
        df = df.selectExpr(*own, "_n", "_s", f"if((_h * _h % {PRIME} + _x % {PRIME}) % {PRIME} div 1024 % 2 = 1, _b, _a) as _a")
    return df.selectExpr(*own, f"_a as {name}")


def dealt_places(df: DataFrame, x: str, n: int, seed: int, name: str, rounds: int = SHARD_ROUNDS) -> DataFrame:
    """The same over one domain of all slots, with hashed coins and more rounds: neighbours must not stay together in a shard."""
    own = df.columns
    df = df.selectExpr(*own, f"{x} as _a")
    for r in range(1, rounds + 1):
        df = df.selectExpr(*own, "_a", f"(pmod(xxhash64({r}L, {seed}L), {n}L) - _a + {n}L) % {n}L as _b")
        df = df.selectExpr(*own, f"if(xxhash64(greatest(_a, _b), {seed + r}L) & 1 = 1, _b, _a) as _a")
    return df.selectExpr(*own, f"_a as {name}")


def ranked_sources(sized: DataFrame) -> DataFrame:
    """A row per source: source, source_size, k (rank, by code point, null last), ``part`` (a range of ranks)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source").sortWithinPartitions("last", "source")
    # the id counts rows inside a partition in its lower 33 bits
    per = C.materialise(per.select("source", "source_size", F.spark_partition_id().alias("part"), F.expr("monotonically_increasing_id() & 8589934591L").alias("inner")), "sources")
    before = per.groupBy("part").agg(F.count("*").alias("n")).selectExpr("part", "sum(n) over (order by part) - n as base")  # a row per partition
    return per.join(before, "part").selectExpr("source", "source_size", "part", "base + inner as k")


def targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """A row per source: source, k (rank), source_size, target, blocks, slots, first (its first slot among all)."""
    weight = "element_at(array(" + ", ".join(f"{w}L" for w in weights) + f"), cast(k % {len(weights)} as int) + 1)"
    per = C.materialise(ranked_sources(sized).selectExpr("*", f"{weight} as weight", f"source_size * {cap} as most"), "ranked")
    rest, others, full = None, None, "false"
    while True:
        # resharing: what the capped sources can't take goes to the others; three numbers a round
        row = per.selectExpr(f"sum(source_size) - sum(if({full}, most, 0)) as rest", f"sum(if({full}, 0, weight)) as others").first()
        if (row.rest, row.others) == (rest, others) or not row.others:
            break
        rest, others = row.rest, row.others
        full = f"(cast({rest}L as double) * weight >= cast(most as double) * {others}L)"
    per = per.withColumn("target", F.expr(f"if({full}, cast(most as double), cast({rest or 0}L as double) * weight / {others or 1}L)"))
    per = per.withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    per = per.withColumn("slots", F.expr(f"if(source_size = 0, 0L, least(cast(floor(target * blocks / source_size + 0.5) as long), blocks * {cap}))"))
    parts = per.groupBy("part").agg(F.sum("slots").alias("n")).selectExpr("part as p", "sum(n) over (order by part) - n as base")  # a row per partition
    own = per.withColumn("inner", F.expr("sum(slots) over (partition by part order by k) - slots"))
    return own.join(parts, F.col("part") == F.col("p")).selectExpr("source", "k", "source_size", "target", "blocks", "slots", "base + inner as first")


def all_slots(plan: DataFrame) -> tuple[int, int]:
    """How many slots there are (one number to the driver), and the tasks to deal them to: short rows expand to them, which Spark can't foresee."""
    total = plan.agg(F.sum("slots")).first()[0] or 0
    return total, max(plan.sparkSession.sparkContext.defaultParallelism, total // SLOTS_PER_TASK)


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The draw: shard, k, n (slots of the source in the shard), earlier (its slots in earlier shards), lead (the shard's slots of earlier sources)."""
    plan = plan.filter("slots > 0")
    total, tasks = all_slots(plan)
    runs = plan.selectExpr("k", "slots", "first", "explode(sequence(0L, (slots - 1) div 4096)) as run").repartition(tasks, "k", "run")
    slots = runs.selectExpr("k", "first", "explode(sequence(run * 4096, least(slots, (run + 1) * 4096) - 1)) as j")
    places = dealt_places(slots, "first + j", max(total, 1), 77, "p")
    drawn = C.materialise(places.selectExpr("k", f"p div {shard_slots} as shard").groupBy("shard", "k").agg(F.count("*").alias("n")), "counts")
    groups = drawn.selectExpr("k as gk", f"shard div {SHARD_GROUP} as g", "n").groupBy("gk", "g").agg(F.sum("n").alias("n"))
    groups = groups.selectExpr("gk", "g", "sum(n) over (partition by gk order by g) - n as base")
    inner = drawn.selectExpr("*", f"sum(n) over (partition by k, shard div {SHARD_GROUP} order by shard) - n as inner", "sum(n) over (partition by shard order by k) - n as lead")
    return inner.join(groups, (F.col("k") == F.col("gk")) & (F.expr(f"shard div {SHARD_GROUP}") == F.col("g"))).selectExpr("shard", "k", "n", "base + inner as earlier", "lead")


def draws(plan: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """A row per output slot: shard, slot (in the shard), k, block."""
    counts = shard_counts(plan, shard_slots).join(plan.selectExpr("k as pk", "blocks"), F.col("k") == F.col("pk"))
    slots = counts.repartition(all_slots(plan)[1], "shard", "k").selectExpr("shard", "k", "blocks", "earlier", "lead", "explode(sequence(0L, n - 1)) as i")
    slots = slots.selectExpr("shard", "k", "blocks", "lead + i as slot", "earlier + i as j")
    slots = permuted(slots, "j % blocks", "blocks", "1000003 * (k + 1) + 7919 * (j div blocks)", "block")
    # written, since a filter that a join adds would be pushed down into all rounds
    return C.materialise(slots.select("shard", "slot", "k", "block"), "slots")


def positions(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with k, source_size, target and ``at``, its first word's place in the source's stream."""
    rows = sized.join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    rows = rows.withColumn("bucket", F.expr(f"pmod(coalesce(doc_id, 0) % {PRIME} * 48271, {PRIME}) % {BUCKETS}"))
    totals = rows.groupBy("k", "bucket").agg(F.sum("size").alias("words"))
    before = totals.selectExpr("k as bk", "bucket as bb", "sum(words) over (partition by k order by bucket) - words as base")
    own = rows.withColumn("inner", F.expr("sum(size) over (partition by k, bucket order by doc_id, size, text_key rows unbounded preceding) - size"))
    return own.join(before, (F.col("k") == F.col("bk")) & (F.col("bucket") == F.col("bb"))).withColumn("at", F.col("base") + F.col("inner")).drop("bk", "bb", "bucket", "base", "inner")


def sized_documents(docs: DataFrame, *more: str) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(C.WORD)), F.lit(0)).cast("long").alias("size")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size, C.row_key(docs)["text_key"].alias("text_key"), *more)


def _taken_blocks(placed: DataFrame, drawn: DataFrame, block: int, slots: bool = False) -> DataFrame:
    """Per document with words and block: ``place`` (first word in the document), ``n`` words, ``taken_times``;
    with ``slots`` also ``taken_by``, the (shard, slot) pairs that take it, in order, ``cap`` at most."""
    parts = placed.filter("size > 0").selectExpr("*", f"explode(sequence(at div {block}, (at + size - 1) div {block})) as b")
    by = [F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("taken_by")] if slots else []
    times = drawn.groupBy(F.col("k").alias("dk"), F.col("block").alias("db")).agg(F.count("*").alias("times"), *by)
    # the planner can't see how many slots a short plan expands to: no broadcast here
    joined = parts.join(times.hint("merge"), (F.col("k") == F.col("dk")) & (F.col("b") == F.col("db")), "left")
    return joined.selectExpr("*", f"greatest(b * {block} - at, 0L) as place", f"least((b + 1) * {block}, at + size) - greatest(b * {block}, at) as n", "coalesce(times, 0L) as taken_times")


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words that the mix takes of it)."""
    sized = C.materialise(sized_documents(docs), "sized")
    plan = C.materialise(targets(sized, weights, cap, block), "plan")
    placed = positions(sized, plan)
    taken = _taken_blocks(placed, draws(plan), block).groupBy("k", "at", "doc_id", "size", "source_size", "target").agg(F.sum(F.expr("n * taken_times")).alias("taken"))
    empty = sized.filter("size = 0").join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")))
    return taken.select("doc_id", "size", "source_size", "target", "taken").unionByName(empty.select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))


def dealt(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The shards, a row per slot and document part in its block: shard, slot, source, k, block, doc_id, place (first word in the document), n."""
    sized = C.materialise(sized_documents(docs), "sized")
    plan = C.materialise(targets(sized, weights, cap, block), "plan")
    parts = _taken_blocks(positions(sized, plan), draws(plan, shard_slots), block, slots=True)
    return parts.select("source", "k", F.col("b").alias("block"), "doc_id", "place", "n", F.inline("taken_by")).select("shard", "slot", "source", "k", "block", "doc_id", "place", "n")


def sharded_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as documents: shard, slot and ``doc``, a struct of the columns of ``docs``: a text taken n times whole comes n times;
    what is taken once more of it is one further row with those words, joined by single spaces."""
    keys = ["doc_key", "text_key"]
    keyed = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text", *(e.alias(n) for n, e in C.row_key(docs).items()))
    sized = C.materialise(sized_documents(keyed, "doc_key"), "sized")
    plan = C.materialise(targets(sized, weights, cap, block), "plan")
    parts = _taken_blocks(positions(sized, plan), draws(plan, shard_slots), block, slots=True)
    per = parts.groupBy("k", "at", *keys).agg(
        F.min("taken_times").alias("whole"), F.max("taken_times").alias("most"), F.expr("sort_array(collect_list(if(taken_times > 0, struct(place, n, taken_times, taken_by), null)))").alias("spans")
    )
    copies = per.filter("most > 0").selectExpr(*keys, "explode(sequence(1L, most)) as copy", "whole", "spans")
    # spans matter for the copies that aren't whole; there a block is in or out
    spans = F.expr("if(copy <= whole, null, transform(filter(spans, s -> s.taken_times >= copy), s -> struct(s.place, s.n)))")
    slot = F.expr("get(filter(spans, s -> s.taken_times >= copy), 0).taken_by[cast(copy - 1 as int)]")
    copies = copies.select(*keys, spans.alias("spans"), slot.alias("at")).groupBy(*keys).agg(F.collect_list(F.struct("spans", "at")).alias("copies"))
    # rows that repeat in full have put all their copies under one key
    repeated = not sized.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty()
    once = (keyed.dropDuplicates(keys) if repeated else keyed).select("_row", "text", *keys).join(copies, keys)
    split = F.regexp_extract_all("text", F.lit(C.WORD), F.lit(0))
    once = once.withColumn("_words", F.when(F.exists("copies", lambda c: c["spans"].isNotNull()), split)).withColumn("_copy", F.explode("copies"))
    cut = F.transform(F.col("_copy.spans"), lambda s: F.slice("_words", (s["place"] + 1).cast("int"), s["n"].cast("int")))
    once = once.withColumn("_text", F.when(F.col("_copy.spans").isNull() | F.col("_words").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(cut), " ")))
    columns = [F.col("_text").alias(c) if c == "text" else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"_row.{c}") for c in docs.columns]
    return once.select(F.col("_copy.at.shard").alias("shard"), F.col("_copy.at.slot").alias("slot"), F.struct(*columns).alias("doc"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, by_shard: bool = False) -> DataFrame:
    """``sharded_documents`` with the columns of ``docs``.

    With ``by_shard`` each shard's rows come in one partition, together, in a pseudorandom order of its slots; that moves each text once more.
    """
    rows = sharded_documents(docs, weights, cap, block, shard_slots)
    if not by_shard:
        return rows.select("doc.*")
    return rows.repartition("shard").sortWithinPartitions("shard", F.xxhash64("shard", "slot"), "slot").select("doc.*")


def op4_source_mixing(spark, sf_dir):
    return mix(C.documents(spark, sf_dir))


def _sql_rounds() -> str:
    """The block permutation in plain SQL, a subquery per round over slot (k, blocks, a, s)."""
    steps = []
    for r in range(1, ROUNDS + 1):
        before = "slot" if r == 1 else f"round_{r - 1}"
        one, two = pow(48271, r, PRIME), pow(69621, r, PRIME)
        steps.append(f"""round_{r} as (
    select k, blocks, s, case when (h * h % {PRIME} + x % {PRIME}) % {PRIME} // 1024 % 2 = 1 then b else a end as a from (
      select *, ((x % {PRIME}) * (x % {PRIME}) % {PRIME} * 48271 + x % {PRIME} * 69621 + x // {PRIME} * 16807 % {PRIME} + s * {one} % {PRIME} + {7919 * r}) % {PRIME} as h from (
        select *, greatest(a, b) as x from (
          select *, (((s * {one} + {69621 * r}) % {PRIME} * 2147483648 + (s * {two} + {16807 * r + 11}) % {PRIME}) % blocks - a + blocks) % blocks as b from {before}))))""")
    return ",\n  ".join(steps)


OP4_SQL = f"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
  a as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as k from sized group by source),
  b as (select *, [5, 2, 1][(k % 3 + 1)::int]::bigint as weight, source_size * {CAP} as most, sum(source_size) over () as total from a),
  c as (select *, coalesce(sum(most) over (order by most / weight, k rows between unbounded preceding and 1 preceding), 0) as before,
        sum(weight) over (order by most / weight, k rows between current row and unbounded following) as after from b),
  d as (select *, (total - before)::double * weight >= most::double * after as capped from c),
  e as (select *, total - sum(case when capped then most else 0 end) over () as rest, sum(case when capped then 0 else weight end) over () as others from d),
  f as (select source, k, source_size, case when capped then most::double else rest::double * weight / others end as target, (source_size + {BLOCK - 1}) // {BLOCK} as blocks from e),
  plan as (select *, case when source_size = 0 then 0 else least(floor(target * blocks / source_size + 0.5)::bigint, blocks * {CAP}) end as slots from f),
  slot as (select k, blocks, j % blocks as a, (1000003 * (k + 1) + 7919 * (j // blocks)) % {PRIME} as s from (select k, blocks, unnest(range(0, slots)) as j from plan where slots > 0)),
  {_sql_rounds()},
  drawn as (select k, a as block from round_{ROUNDS}),
  times as (select k, block, count(*) as times from drawn group by k, block),
  placed as (
    select doc_id, size, k, source_size, target,
      (sum(size) over (partition by k order by (doc_id % {PRIME} * 48271) % {PRIME} % {BUCKETS}, doc_id rows unbounded preceding) - size)::bigint as pos
    from sized join plan on sized.source is not distinct from plan.source),
  parts as (select *, unnest(range(pos // {BLOCK}, (pos + size - 1) // {BLOCK} + 1)) as b from placed where size > 0),
  taken as (
    select doc_id, sum((least((b + 1) * {BLOCK}, pos + size) - greatest(b * {BLOCK}, pos)) * coalesce(times.times, 0))::bigint as taken
    from parts left join times on parts.k = times.k and parts.b = times.block group by doc_id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from placed left join taken using (doc_id)
"""
