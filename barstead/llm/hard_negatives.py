"""Operator 13: hard-negative mining by anchor-clustered shared lists.

Anchors are clustered by direction, each label for itself. For a cluster, every candidate has an
angular upper bound on its inner product with any member of norm 1: ``|x| cos(max(0, t - r))``, where
t is the candidate's angle to the cluster's centre and r the widest angle of a member. Candidates are
sorted by this bound once, and all members walk the one list in blocks: a member leaves as soon as
its norm times the next bound is below what it still could use, which is its lower limit or the last
of the k it has found. The bounds carry a margin for rounding, scores are exact integers, so leaving
early never changes a result. Two such searches follow each other: positives of the anchor's label, then
negatives of other labels between the limits that each positive sets.

On Spark: candidates are dealt by hash to shards of at most ``SHARD`` rows, each of which holds its own
sorted lists; anchors, a small share of the rows, visit every shard in the order of their clusters and
stream past the shard's candidates. What a shard finds, k rows at most per search, is ranked over all
shards under a constant bound. So a task holds one shard and ``MEMBERS`` anchors, a label or cluster with
a third of all rows is spread over all shards, and candidates move once a search. Centres are fitted by
numpy on at most ``SAMPLE`` anchors, the first by hash; they decide how early walks end, never what is
found.

Defined results: rows with a null label or vector, or a null or non-finite component, take no part. Of
vectors of different length the shorter ends in zeros. Rows that repeat id, label and vector count once;
rows that share an id alone are rows of their own. Ties go to the smaller id, null ids last (as
null; they are no anchors), then to a hash of label and vector. An anchor without another row of its
label has no positive and no row; a positive without a row between its limits has none. Scores beyond
a long are cut to it. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these shares of the positive's, in tenths.
LOWEST, HIGHEST = 3, 9
#: Candidates of a shard, and anchors that walk at a time, at most.
SHARD, MEMBERS = 200_000, 256
#: Anchors that centres are fitted on; anchors per centre; centres, at most.
SAMPLE, PER_CENTRE, CENTRES = 4096, 100, 64
#: First and largest block of a walk.
BLOCKS = (256, 2048)
_LAST = 2**63 - 1


# ---------------------------------------------------------------- rows


def usable(embeddings: DataFrame, relabel: Column | None = None, vector: str = "embedding") -> DataFrame:
    """vec_id, tie (id, nulls last), label, vector and key of the rows that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long") if relabel is None else relabel.cast("long")
    rows = embeddings.filter(F.col("label").isNotNull() & F.col(vector).isNotNull()).filter(~bad)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col(vector).alias("vector"))
    return rows.select("*", F.coalesce("vec_id", F.lit(_LAST)).alias("tie"), F.xxhash64("label", "vector").alias("key"))


def quantised(column: pa.Array) -> np.ndarray:
    """floor(256 x) of each vector, as whole float64 numbers; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64) * 256)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if most < 2**53:
        return a @ b.T
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(len(m), width) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -_LAST, _LAST).astype(np.int64)


# ---------------------------------------------------------------- centres


def fitted_centres(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of ``k`` centres, by spherical k-means."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = (vectors / np.maximum(norm, 1e-300))[norm[:, 0] > 0]
    k = min(k, len(unit))
    if not k:
        return np.zeros((1, max(1, vectors.shape[1])))
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(rounds):
        of = (unit @ centres.T).argmax(axis=1)
        for c in range(k):
            total = unit[of == c].sum(axis=0)
            if (size := np.linalg.norm(total)) > 0:
                centres[c] = total / size
    return centres


def angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    width = min(vectors.shape[1], centres.shape[1])
    length = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True) * np.maximum(np.linalg.norm(centres, axis=1), 1e-300), 1e-300)
    return np.arccos(np.clip(vectors[:, :width] @ centres[:, :width].T / length, -1, 1))


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """The anchors with their cluster and angle to its centre."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = angles(quantised(batch.column("vector")), centres)
            nearest = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32()), pa.array(apart[np.arange(len(nearest)), nearest])], [*batch.schema.names, "cluster", "angle"])

    return anchors.mapInArrow(run, T.StructType([*anchors.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())]))


# ---------------------------------------------------------------- walks


class Shard:
    """Candidates in the order of (id, key), each once."""

    def __init__(self, parts: list[pa.RecordBatch]):
        tie, key, label = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("tie", "key", "label"))
        order = np.lexsort((key, tie))
        again = np.zeros(len(order), dtype=bool)
        again[1:] = (np.diff(tie[order]) == 0) & (np.diff(key[order]) == 0)
        order = order[~again]
        self.tie, self.key, self.label = tie[order], key[order], label[order]
        self.vectors = stacked([quantised(p.column("vector")) for p in parts])[order]
        self.norms = np.linalg.norm(self.vectors, axis=1)

    def bounded(self, centre: np.ndarray, widest: float, label: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of the label, or of others, by falling upper bound, and these bounds."""
        rows = np.flatnonzero((self.label == label) == same)
        apart = angles(self.vectors[rows], centre[None, :])[:, 0]
        bound = self.norms[rows] * (np.cos(np.maximum(0, apart - widest - 1e-6)) + 1e-9)
        order = np.argsort(-bound, kind="stable")
        return rows[order], bound[order]


def walk(shard: Shard, rows: np.ndarray, bounds: np.ndarray, members: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Search, score and candidate of the first ``k`` of each search, and how many scores were computed.

    Search i is of member ``owner[i]``, for scores from ``low[i]`` to ``high[i]``; ``own`` is each member's own candidate or -1.
    """
    norms = np.linalg.norm(members, axis=1)
    least = low.copy()
    active = np.arange(len(owner))
    held = (np.zeros(0, np.int64),) * 3
    at, size, computed = 0, BLOCKS[0], 0
    while len(active) and at < len(rows):
        active = active[norms[owner[active]] * bounds[at] >= least[active]]
        if not len(active):
            break
        block = rows[at : at + size]
        walking, place = np.unique(owner[active], return_inverse=True)
        found = scores(members[walking], shard.vectors[block])
        computed += found.size
        mine = own[walking][:, None] == block[None, :]
        per = found[place]
        ok = (per >= least[active][:, None]) & (per <= high[active][:, None]) & ~mine[place]
        s, c = np.nonzero(ok)
        if len(s):
            new = (active[s], per[s, c].astype(np.int64), block[c])
            who, score, what = (np.concatenate([a, b]) for a, b in zip(held, new, strict=True))
            order = np.lexsort((what, -score, who))
            who, score, what = who[order], score[order], what[order]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            held = tuple(x[rank < k] for x in (who, score, what))
            full = rank == k - 1
            least[who[full]] = np.maximum(least[who[full]], score[full])
        at, size = at + size, min(size * 2, BLOCKS[1])
    return *held, computed


def searched(rows: DataFrame, anchors: DataFrame, shards: int, centres: np.ndarray, k: int, same: bool) -> DataFrame:
    """What each shard finds for each anchor (and its positives, if ``same`` is false)."""
    kind = rows.schema["vector"].dataType.simpleString()
    empty = F.array().cast("array<bigint>")
    own = ["tie", "key", "label", "vector"]
    anchor = [c if c in anchors.columns else empty.alias(c) for c in ("positive_ids", "positive_scores")]
    visits = anchors.select(*own, "cluster", "angle", *anchor, F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    dealt = rows.select(*own, F.lit(0).alias("cluster"), F.lit(0.0).alias("angle"), empty.alias("positive_ids"), empty.alias("positive_scores"), F.lit(0).alias("kind"), F.pmod(F.xxhash64("tie", "key"), F.lit(shards)).cast("int").alias("shard"))
    both = dealt.unionByName(visits).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "label", "cluster", "angle", "tie", "key")
    names = ["anchor_id", "anchor_key", "slot", "positive_id", "positive_score", "tie", "key", "score"]

    def members_of(shard: Shard, part: pa.RecordBatch):
        ids, keys = part.column("tie").to_numpy(), part.column("key").to_numpy()
        vectors, cluster, label = quantised(part.column("vector")), part.column("cluster")[0].as_py(), part.column("label")[0].as_py()
        order, bounds = shard.bounded(centres[cluster], pc.max(part.column("angle")).as_py(), label, same)
        at = np.searchsorted(shard.tie, ids)
        mine = np.full(len(ids), -1)
        for i, (x, name) in enumerate(zip(ids, keys, strict=True)):  # rows that share an id lie side by side
            j = at[i]
            while j < len(shard.tie) and shard.tie[j] == x:
                if shard.key[j] == name:
                    mine[i] = j
                j += 1
        if same:
            owner = np.arange(len(ids))
            slot, positive, of = owner * 0, owner * 0, owner * 0
            low, high = np.full(len(ids), -_LAST), np.full(len(ids), _LAST)
        else:
            sizes = pc.list_value_length(part.column("positive_scores")).to_numpy()
            owner = np.repeat(np.arange(len(ids)), sizes)
            slot = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            positive, of = (part.column(c).flatten().to_numpy() for c in ("positive_ids", "positive_scores"))
            tens, rest = of // 10, of % 10
            low, high = LOWEST * tens + (LOWEST * rest + 9) // 10, HIGHEST * tens + HIGHEST * rest // 10
        who, score, what, _ = walk(shard, order, bounds, vectors, owner, low, high, mine, k)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids[owner[who]], keys[owner[who]], slot[who], positive[who], of[who], shard.tie[what], shard.key[what], score)], names)

    def run(batches):
        name, held, shard = None, [], None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            group = np.stack([numbers, batch.column("kind").to_numpy(), batch.column("label").to_numpy() * batch.column("kind").to_numpy(), batch.column("cluster").to_numpy()])
            cuts = np.append(0, np.flatnonzero((np.diff(group, axis=1) != 0).any(axis=0)) + 1).tolist() if batch.num_rows else []
            for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if numbers[lo] != name:
                    name, held, shard = numbers[lo], [], None
                if not group[1, lo]:
                    held.append(batch.slice(lo, hi - lo))
                elif held:
                    shard = shard or Shard(held)
                    for at in range(lo, hi, MEMBERS):
                        yield members_of(shard, batch.slice(at, min(MEMBERS, hi - at)))

    assert kind == anchors.schema["vector"].dataType.simpleString()
    return both.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def first(found: DataFrame, per: list[str], k: int) -> DataFrame:
    """The first ``k`` of each search over all shards, with their rank; a task sends k rows a search at most."""
    best = Window.partitionBy(*per).orderBy(F.col("score").desc(), "tie", "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 100, shard: int = SHARD) -> DataFrame:
    """Hard negatives of the rows (as ``usable`` gives them) whose vec_id ``every`` divides."""
    spark = rows.sparkSession
    n = rows.count()
    # a shard's size is bounded by memory; small tables are dealt so that all cores work
    shards = max(1, -(-n // shard), min(2 * spark.sparkContext.defaultParallelism, n // 500))
    anchors = rows.filter((F.col("vec_id") % every == 0)).dropDuplicates(["tie", "key"])
    few = anchors.orderBy(F.xxhash64("tie", "key"), "tie", "key").limit(SAMPLE).select("vector").toArrow()
    k = max(1, min(CENTRES, few.num_rows // PER_CENTRE))
    centres = fitted_centres(quantised(few.column("vector")), k) if few.num_rows else np.zeros((1, 1))
    anchors = C.materialise(clustered(anchors, centres), "anchors")
    positives = first(searched(rows, anchors, shards, centres, POSITIVES, same=True), ["anchor_id", "anchor_key"], POSITIVES)
    own = F.array_sort(F.collect_list(F.struct("rank", "tie", "score")))  # POSITIVES entries at most
    listed = positives.groupBy(F.col("anchor_id").alias("tie"), F.col("anchor_key").alias("key")).agg(own.alias("p"))
    with_positives = C.materialise(anchors.join(listed, ["tie", "key"]).select("tie", "key", "label", "vector", "cluster", "angle", F.col("p.tie").alias("positive_ids"), F.col("p.score").alias("positive_scores")), "positives")
    found = first(searched(rows, with_positives, shards, centres, NEGATIVES, same=False), ["anchor_id", "anchor_key", "slot"], NEGATIVES)
    known = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return found.select("anchor_id", known("positive_id").alias("positive_id"), "rank", known("tie").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), relabelled))


OP13_SQL = """
with e as (
    select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (
    select a.vec_id as anchor_id, r.vec_id as other_id, r.label = a.label as same, list_inner_product(a.v, r.v)::bigint as score
    from e a join e r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id),
  p as (select anchor_id, other_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
  n as (
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as rank, other_id as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
