"""Operator 2: near-duplicate groups by a chosen-path set similarity join.

A document's set are its distinct five-word shingles. Equal sets are one class, so copies never
multiply. Each class has ``COORDS`` minwise tokens. In each of ``trees`` independent trees a node
is a path of chosen tokens: at each step, from the root on, the path itself selects which minwise
tokens to branch on, one or two of them so that 1 / threshold branches are expected and a pair at
the threshold stays together somewhere with a probability that falls slowly with depth.

Only groups matter, so a node isn't expanded into all its pairs. At each level, after one step and
then every ``STEPS``, each member is compared with its node's smallest member, and the links
confirmed on the full shingle sets give provisional groups. A node whose members are one group is
settled and goes no further, however large. A node with up to ``small`` classes, or as few outside
its main group, is a leaf and compared exhaustively; larger ones are branched further. Classes
that are about alike though not linked stay together however often their nodes are branched, and
each step multiplies their rows. Once the classes of the large nodes are so few that to compare
each with each moves no more rows than these nodes have, they become one node, which is compared
in blocks of ``HELD`` and misses no pair. What is larger still after ``LAST_STEPS`` steps is
compared in as many blocks as it takes.

The comparison of a node first looks at set sizes and minwise tokens (4.2 standard deviations of
slack) and names, for each group that may be linked with another, its likeliest pair. These pairs
are confirmed on the full sets and the groups merged. In nodes that then still hold several groups
all likely pairs across groups are confirmed, one by one where classes have few of them, else
block by block. A pair that shares several leaves counts in the first of them only. Texts are
fetched for classes with a likely partner only.

Recall: a pair at the threshold shares a node of a tree with probability 0.87 after one step and
some 0.4 after ``LAST_STEPS``; 16 trees miss it with 5e-15 where all its nodes are leaves of the
first level, and with about 4e-4 where all are branched to the end, less often the more alike it
is. ``tests/llm/near_recall.py`` measures both.

Skew: node and class sizes come from partial aggregates; no group is collected except small
nodes; joins on a frequent class or node are plain equi-joins that Spark can split.

Shingles are told apart by 64-bit hashes that aren't verified: ``n_shingles`` and similarities of
two texts of a million shingles are off by one with a chance of about 1e-7.

Defined results: null, empty and blank texts have an empty set and are linked with nothing. Rows
with a null id take part through their text, but have no id to give: their component is that of
the others, or null. Rows that repeat an id are separate texts; each gets a row. A very long text
is one set, held by one task at a time. An empty table gives no rows. Other columns are ignored
here and kept, whatever their names, by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .graph import components

SHINGLE = 5
THRESHOLD = 85
COORDS = 128
TREES = 16
#: Steps to the first level, between levels, and to the last.
FIRST_STEPS, STEPS, LAST_STEPS = 1, 4, 13
#: Classes of a node, or classes outside its main group, up to which it is a leaf.
SMALL = 64
#: Classes of a node that a task holds at a time.
HELD = 512
#: Name of the node of all classes that branching hasn't divided.
UNDIVIDED = -(2**63)
#: Likely pairs per class and node beyond which texts travel to blocks instead of with each pair.
PAIRS_EACH = 4

_RNG = np.random.default_rng(85)
_A = (_RNG.integers(0, 2**31, COORDS) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 2**32, COORDS).astype(np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array, k: int = SHINGLE):
    """Per group of texts: (range of texts, sorted distinct shingle hashes of each text)."""
    raw_all, offsets_all = C.text_buffer(column)
    for i, j in C.chunks(offsets_all):
        raw, offsets = _LOWER[raw_all[offsets_all[i] : offsets_all[j]]], offsets_all[i : j + 1] - offsets_all[i]
        starts, ends, bounds = C.word_bounds(raw, offsets)
        words = C.word_hashes(raw, starts, ends)
        grams, sets = C.gram_hashes(words, k), []
        for d in range(j - i):
            a, b = bounds[d], bounds[d + 1]
            sets.append(np.unique(grams[a : b - k + 1]) if b - a >= k else C.gram_hashes(words[a:b], b - a) if b > a else grams[:0])
        yield i, j, sets


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """COORDS minwise tokens of each nonempty set."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), dtype=np.uint32)
    for c in range(COORDS):
        out[:, c] = np.minimum.reduceat(x * _A[c] + _B[c], begin)
    return out


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_key, text_key, n_shingles, set_id (digest of the set; null if empty), tokens."""

    def run(batches):
        for batch in batches:
            for i, j, sets in shingle_sets(batch.column("text"), k):
                full = [d for d, s in enumerate(sets) if len(s)]
                tokens, ids = [None] * len(sets), [None] * len(sets)
                if full:
                    for d, row in zip(full, minwise([sets[d] for d in full]), strict=True):
                        tokens[d], ids[d] = row.tobytes(), hashlib.blake2b(sets[d].tobytes(), digest_size=16).digest()
                keys = [batch.column(c).slice(i, j - i) for c in ("doc_key", "text_key")]
                own = [pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.binary())]
                yield pa.RecordBatch.from_arrays([*keys, *own], ["doc_key", "text_key", "n_shingles", "set_id", "tokens"])

    return C.map_arrow(docs, run, "doc_key long, text_key long, n_shingles long, set_id binary, tokens binary")


def _descend(path: np.ndarray, tokens: np.ndarray, steps: int, twice: float) -> tuple[np.ndarray, np.ndarray]:
    """Follow ``steps`` steps; at each the path picks a token or, with probability ``twice``, two. Gives paths and their row."""
    row = np.arange(len(path))
    for _ in range(steps):
        pick = C.mix(path)
        also = (pick >> np.uint64(40)).astype(np.float64) / 2**24 < twice
        first, second = (pick & np.uint64(COORDS - 1)).astype(np.int64), ((pick >> np.uint64(8)) & np.uint64(COORDS - 1)).astype(np.int64)
        also &= first != second
        coordinate, base, row = np.append(first, second[also]), np.append(pick, pick[also]), np.append(row, row[also])
        path = C.mix(base * np.uint64(0x9E3779B97F4A7C15) + C.mix(tokens[row, coordinate].astype(np.uint64) * np.uint64(COORDS) + coordinate.astype(np.uint64)))
    return path, row


def branch(rows: DataFrame, steps: int, trees: int | None, threshold: int) -> DataFrame:
    """(path, set_id) of the nodes ``steps`` below; below the roots of ``trees`` trees if given, else below ``path``."""
    twice = 100 / threshold - 1

    def run(batches):
        for batch in batches:
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), dtype=np.uint32).reshape(-1, COORDS)
            if not len(tokens):
                continue
            if trees:
                above, at = np.tile(np.arange(1, trees + 1, dtype=np.uint64), len(tokens)), np.repeat(np.arange(len(tokens)), trees)
                path, row = _descend(C.mix(above), tokens[at], steps, twice)
                row = at[row]
            else:
                path, row = _descend(np.asarray(batch.column("path")).view(np.uint64), tokens, steps, twice)
            yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column("set_id").take(pa.array(row))], ["path", "set_id"])

    return C.map_arrow(rows, run, "path long, set_id binary")


def members(nodes: DataFrame) -> DataFrame:
    """Nodes of two classes or more: path, set_id, size, least (smallest class of the node)."""
    sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    shared = nodes.join(sizes, "path")
    least = shared.groupBy("path").agg(F.min("set_id").alias("least"))
    return shared.join(least, "path")


def tokens_needed(threshold: int) -> int:
    """Equal tokens that a pair at the threshold has but for one case in some 10**5."""
    s = threshold / 100
    return int(np.floor(COORDS * s - 4.2 * np.sqrt(COORDS * s * (1 - s))))


def likely(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Of (a, b), those that set sizes and minwise tokens allow."""
    need = tokens_needed(threshold)
    side = lambda x: classes.select(F.col("set_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("tokens").alias(f"tokens_{x}"))

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(f"tokens_{x}").to_pylist()), dtype=np.uint32).reshape(-1, COORDS) for x in "ab")
            yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= need))

    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
    return C.map_arrow(both, run, "a binary, b binary")


def texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """set_id and text of the rows in ``wanted`` (set_id, doc_key, text_key)."""
    few = wanted.count() <= C.BROADCAST_KEYS
    return docs.join(F.broadcast(wanted) if few else wanted, ["doc_key", "text_key"]).select("set_id", "text").dropDuplicates(["set_id"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Of (a, b), those whose full sets are that similar; ``docs`` has doc_key, text_key, text."""
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    texts = texts_of(C.materialise(ids.join(classes, "set_id").select("set_id", "doc_key", "text_key"), "wanted"), docs)
    side = lambda x: texts.select(F.col("set_id").alias(x), F.col("text").alias(f"text_{x}"))

    def run(batches):
        for batch in batches:
            sets = [[s for _, _, part in shingle_sets(batch.column(f"text_{x}")) for s in part] for x in "ab"]
            shared = np.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(*sets, strict=True)], dtype=np.int64)
            union = np.array([len(a) + len(b) for a, b in zip(*sets, strict=True)], dtype=np.int64) - shared
            yield batch.select(["a", "b"]).filter(pa.array(100 * shared >= threshold * union))

    return C.map_arrow(pairs.join(side("b"), "b").join(side("a"), "a"), run, "a binary, b binary")


def with_groups(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """``nodes`` with the root of each class's group, itself if it has none."""
    return nodes.join(groups.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))


def unsettled(nodes: DataFrame) -> DataFrame:
    """Of (path, set_id, root), nodes with several groups, with ``all`` (classes), ``most`` (of the main group) and ``main``."""
    counts = nodes.groupBy("path", "root").agg(F.count("*").alias("n"))
    split = counts.groupBy("path").agg(F.count("*").alias("groups"), F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("main"))
    return nodes.join(split.filter("groups > 1").drop("groups"), "path")


def with_leaves(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes of ``nodes``, each with the nodes that hold it (some for each tree): set_id, n_shingles, tokens, leaves."""
    leaves = nodes.groupBy("set_id").agg(F.collect_list("path").alias("leaves"))
    return C.materialise(leaves.join(classes.select("set_id", "n_shingles", "tokens"), "set_id"), "compared")


def in_blocks(held: DataFrame, streams: DataFrame, compared: DataFrame) -> DataFrame:
    """``held`` (node, blocks, set_id, root) dealt to its node's blocks, before ``streams``, which pass by all of them."""
    own = held.select("node", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("streams"), "set_id", "root")
    past = streams.select("node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("streams"), "set_id", "root")
    rows = own.unionByName(past).join(compared, "set_id")
    return rows.repartition("node", "block").sortWithinPartitions("node", "block", "streams")


def blocks_of_nodes(nodes: DataFrame, small: int, compared: DataFrame) -> DataFrame:
    """A node of up to ``small`` classes is held as a whole; of a larger one, what is outside its main group, and the node streams past."""
    blocks = F.when(F.col("all") <= small, 1).otherwise(F.ceil((F.col("all") - F.col("most")) / HELD)).cast("int").alias("blocks")
    own = nodes.select(F.col("path").alias("node"), "set_id", "root", "all", "main", blocks)
    return in_blocks(own.filter((F.col("all") <= small) | (F.col("root") != F.col("main"))), own.filter(F.col("all") > small), compared)


def parts_of(batch: pa.RecordBatch, size: int = 256):
    """Pieces of a batch that lie in one block: (node, block), whether they stream, row numbers, set ids, groups, sizes, tokens, leaves and whose they are."""
    tags = list(zip(*(batch.column(c).to_pylist() for c in ("node", "block", "streams")), strict=True))
    ids, roots, n = batch.column("set_id").to_pylist(), np.array(batch.column("root").to_pylist(), dtype="S16"), np.asarray(batch.column("n_shingles"))
    tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), dtype=np.uint32).reshape(-1, COORDS)
    leaves, many = np.asarray(batch.column("leaves").flatten()), np.asarray(pc.list_value_length(batch.column("leaves")))
    first = np.concatenate(([0], np.cumsum(many)))
    lo = 0
    while lo < len(tags):
        hi = lo
        while hi < len(tags) and tags[hi] == tags[lo] and hi - lo < size:
            hi += 1
        part = {"key": tags[lo][:2], "streams": tags[lo][2], "rows": range(lo, hi), "ids": ids[lo:hi], "roots": roots[lo:hi], "n": n[lo:hi], "tokens": tokens[lo:hi]}
        yield part | {"leaves": leaves[first[lo] : first[hi]], "whose": np.repeat(np.arange(hi - lo), many[lo:hi])}
        lo = hi


def met_before(x: dict, y: dict, pairs: np.ndarray) -> np.ndarray:
    """Which pairs of two pieces also share a leaf before this one."""
    shared = np.intersect1d(x["leaves"], y["leaves"])
    shared = shared[shared < x["key"][0]]
    if not len(shared):
        return np.zeros(len(pairs), dtype=bool)
    holds = []
    for z in (x, y):
        at = np.minimum(np.searchsorted(shared, z["leaves"]), len(shared) - 1)
        here = shared[at] == z["leaves"]
        held = np.zeros((len(z["ids"]), len(shared)), dtype=np.float32)
        held[z["whose"][here], at[here]] = 1
        holds.append(held)
    return (holds[0] @ holds[1].T)[pairs[:, 0], pairs[:, 1]] > 0


def alike(x: dict, y: dict, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of two pieces, of different groups and in no leaf before, that set sizes and tokens allow, and their equal tokens."""
    close = 100 * np.minimum(x["n"][:, None], y["n"][None]) >= threshold * np.maximum(x["n"][:, None], y["n"][None])
    close &= x["roots"][:, None] != y["roots"][None]
    at = np.argwhere(np.triu(close) if x is y else close)
    equal = (x["tokens"][at[:, 0]] == y["tokens"][at[:, 1]]).sum(axis=1)
    enough = equal >= tokens_needed(threshold)
    at, equal = at[enough], equal[enough]
    if len(at):
        here = ~met_before(x, y, at)
        at, equal = at[here], equal[here]
    return at, equal


def meetings(batches, threshold: int, texts: bool = False):
    """Each held piece of a block with each later piece that holds likely pairs: (x, y, pairs, equal tokens); (held, None, None, None) as a block ends."""
    key, held = None, []
    for batch in batches:
        sets = [s for _, _, part in shingle_sets(batch.column("text")) for s in part] if texts else None
        for part in parts_of(batch):
            if texts:
                part["sets"] = [sets[i] for i in part["rows"]]
            if part["key"] != key:
                if held:
                    yield held, None, None, None
                key, held = part["key"], []
            if not part["streams"]:
                held.append(part)
            for x in held:
                pairs, equal = alike(x, part, threshold)
                if len(pairs):
                    yield x, part, pairs, equal
    if held:
        yield held, None, None, None


def likeliest(rows: DataFrame, threshold: int) -> DataFrame:
    """For each group that may be linked with another, its pair with most equal tokens: distinct (a, b)."""

    def run(batches):
        best: dict[bytes, tuple] = {}

        def batch_of():
            root, (equal, a, b) = list(best), zip(*best.values(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(root, pa.binary()), pa.array(equal, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["root", "equal", "a", "b"])

        for x, y, pairs, equal in meetings(batches, threshold):
            if y is None:
                if len(best) > 20_000:
                    yield batch_of()
                    best.clear()
                continue
            order = np.argsort(equal, kind="stable")
            for side, own in ((0, x), (1, y)):
                top = np.full(len(own["ids"]), -1)
                top[pairs[order, side]] = order  # the last of a member's pairs is its likeliest
                for k in top[top >= 0].tolist():
                    i, j = pairs[k]
                    a, b = sorted((x["ids"][i], y["ids"][j]))
                    root, found = own["roots"][pairs[k, side]].ljust(16, b"\0"), (int(equal[k]), a, b)
                    if root not in best or best[root] < found:
                        best[root] = found
        if best:
            yield batch_of()

    found = C.map_arrow(rows, run, "root binary, equal int, a binary, b binary")
    return found.groupBy("root").agg(F.max(F.struct("equal", "a", "b")).alias("p")).select("p.a", "p.b").distinct()


MET = "node long, block int, streams int, set_id binary, root binary, pairs long"


def touching(rows: DataFrame, threshold: int) -> DataFrame:
    """The rows of blocks that may be linked with one of another group, and how many pairs each adds."""

    def run(batches):
        def batch_of(part, hit, pairs):
            at = np.flatnonzero(hit)
            roots = [part["roots"][i].ljust(16, b"\0") for i in at.tolist()]
            node, block = part["key"]
            columns = [[node] * len(at), [block] * len(at), [part["streams"]] * len(at), [part["ids"][i] for i in at.tolist()], roots, pairs[at]]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "block", "streams", "set_id", "root", "pairs"])

        past = None

        def leave():
            if past is not None and past["streams"] and past["hit"].any():
                yield batch_of(past, past["hit"], past["pairs"])

        for x, y, pairs, _ in meetings(batches, threshold):
            if y is not past:
                yield from leave()
                past = y
            if y is None:
                for part in x:
                    if part.get("hit") is not None and part["hit"].any():
                        yield batch_of(part, part["hit"], part["pairs"])
                continue
            for part, side in ((x, 0), (y, 1)):
                if part.get("hit") is None:
                    part["hit"], part["pairs"] = np.zeros(len(part["ids"]), dtype=bool), np.zeros(len(part["ids"]), dtype=np.int64)
                part["hit"][pairs[:, side]] = True
            np.add.at(y["pairs"], pairs[:, 1], 1)
        yield from leave()

    return C.map_arrow(rows, run, MET)


def likely_pairs(rows: DataFrame, threshold: int) -> DataFrame:
    """All likely pairs (a, b) of different groups."""

    def run(batches):
        for x, y, pairs, _ in meetings(batches, threshold):
            if y is not None:
                ordered = [sorted((x["ids"][i], y["ids"][j])) for i, j in pairs.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*ordered, strict=True)], ["a", "b"])

    return C.map_arrow(rows, run, "a binary, b binary").distinct()


def linked(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of a block with that similar full sets, as many as connect its groups."""

    def same(s, t):
        shared = len(np.intersect1d(s, t, assume_unique=True))
        return 100 * shared >= threshold * (len(s) + len(t) - shared)

    def run(batches):
        parent: dict[bytes, bytes] = {}

        def find(r):
            while parent.get(r, r) != r:
                r = parent[r]
            return r

        for x, y, pairs, _ in meetings(batches, threshold, texts=True):
            if y is None:
                parent = {}
                continue
            out = []
            for i, j in pairs.tolist():
                ri, rj = find(x["roots"][i]), find(y["roots"][j])
                if ri != rj and same(x["sets"][i], y["sets"][j]):
                    parent[max(ri, rj)] = min(ri, rj)
                    out.append((x["ids"][i], y["ids"][j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["a", "b"])

    return C.map_arrow(rows, run, "a binary, b binary")


def remaining_links(blocks: DataFrame, compared: DataFrame, classes: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Confirmed links between the groups of ``blocks``, all their likely pairs considered.

    Where classes have few likely partners, the pairs are confirmed one by one. Where they have
    many, texts would travel with each pair; then they travel once to each of their blocks.
    """
    met = C.materialise(touching(blocks, threshold), "touching")
    size = met.agg(F.count("*").alias("rows"), F.sum("pairs").alias("pairs")).first()
    ordered = lambda rows: rows.repartition("node", "block").sortWithinPartitions("node", "block", "streams")
    rows = met.drop("pairs").join(compared, "set_id")
    if (size.pairs or 0) <= PAIRS_EACH * size.rows:
        return confirmed(C.materialise(likely_pairs(ordered(rows), threshold), "pairs"), classes, docs, threshold)
    ids = met.select("set_id").distinct().join(classes.select("set_id", "doc_key", "text_key"), "set_id")
    return linked(ordered(rows.join(texts_of(C.materialise(ids, "wanted"), docs), "set_id")), threshold)


def class_groups(classes: DataFrame, docs: DataFrame, threshold: int, trees: int, small: int) -> DataFrame:
    """(node, root) of the classes that are linked with others; ``docs`` has doc_key, text_key, text."""
    confirm = lambda pairs: C.materialise(confirmed(pairs, classes, docs, threshold), "links")
    below, steps, levels, links, groups = branch(classes, FIRST_STEPS, trees, threshold), FIRST_STEPS, [], None, None
    while True:
        level = C.materialise(members(below), "nodes")
        stars = level.filter("set_id != least").select(F.col("least").alias("a"), F.col("set_id").alias("b")).distinct()
        pairs = C.materialise(likely(stars, classes, threshold), "pairs")
        if links is None or not pairs.isEmpty():
            found = confirm(pairs)
            links = found if links is None else links.union(found)
            groups = components(links)
        level = C.materialise(unsettled(with_groups(level.select("path", "set_id"), groups)), "unsettled")
        wide = (F.col("all") > small) & (F.col("all") - F.col("most") > small)
        size = level.filter(wide).agg(F.count("*").alias("rows"), F.count_distinct("set_id").alias("classes")).first()
        undivided = steps > FIRST_STEPS and 0 < size.classes * -(-size.classes // HELD) <= size.rows
        last = steps >= LAST_STEPS or not size.rows
        levels.append(level if last and not undivided else level.filter(~wide))
        if undivided:
            levels.append(unsettled(level.filter(wide).select(F.lit(UNDIVIDED).alias("path"), "set_id", "root").distinct()))
        if last or undivided:
            break
        rows = level.filter(wide).select("path", "set_id").join(classes.select("set_id", "tokens"), "set_id")
        below, steps = C.materialise(branch(rows, STEPS, None, threshold), "branches"), steps + STEPS

    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    again = lambda: C.materialise(unsettled(with_groups(nodes.select("path", "set_id"), groups)), "unsettled")
    if len(levels) > 1:
        nodes = again()  # earlier levels know earlier groups only
    compared = with_leaves(nodes, classes)
    hints = C.materialise(likeliest(blocks_of_nodes(nodes, small, compared), threshold), "hints")
    if hints.isEmpty():
        return groups
    found = confirm(hints)
    if not found.isEmpty():
        links = links.union(found)
        groups = components(links)
        nodes = again()
    more = C.materialise(remaining_links(blocks_of_nodes(nodes, small, compared), compared, classes, docs, threshold), "links")
    return groups if more.isEmpty() else components(links.union(more))


def keyed_groups(docs: DataFrame, threshold: int = THRESHOLD, trees: int = TREES, small: int = SMALL) -> DataFrame:
    """Per row: doc_key, text_key, n_shingles, component (smallest doc_key reachable), first (whether it is the group's first row)."""
    keyed = C.with_key(docs).select("doc_key", "text_key", "text")
    base = C.materialise(sketches(keyed), "sketches")
    classes = base.filter("set_id is not null").groupBy("set_id").agg(F.min(F.struct("doc_key", "text_key", "n_shingles", "tokens")).alias("r")).select("set_id", "r.*")
    classes = C.materialise(classes, "classes")
    groups = class_groups(classes, keyed, threshold, trees, small)
    named = with_groups(classes.select("set_id", "doc_key", "text_key"), groups)
    least = named.groupBy("root").agg(F.min(F.struct("doc_key", "text_key")).alias("least"))
    table = named.join(least, "root").select("set_id", "least")
    result = base.drop("tokens").join(table, "set_id", "left").withColumn("least", F.coalesce("least", F.struct("doc_key", "text_key")))
    return result.select("doc_key", "text_key", "n_shingles", F.col("least.doc_key").alias("component"), (F.struct("doc_key", "text_key") == F.col("least")).alias("first"))


def near_groups(docs: DataFrame, threshold: int = THRESHOLD, trees: int = TREES, small: int = SMALL) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    null_id = lambda c: F.when(F.col(c) != 2**63 - 1, F.col(c))
    rows = keyed_groups(docs, threshold, trees, small)
    return rows.select(null_id("doc_key").alias("doc_id"), "n_shingles", null_id("component").alias("component_id"), (F.col("doc_key") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, without those that another row of their group stands for: the one with the smallest id, then text hash.

    Of rows that repeat id and text in full, one stays.
    """
    groups = C.materialise(keyed_groups(docs, threshold), "groups")
    kept = C.without(docs, groups.filter("not first"))
    repeated = not groups.filter("first").groupBy("doc_key", "text_key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    if not repeated:
        return kept
    keyed = kept.select("*", *(e.alias(f"_{n}") for n, e in C.row_key(kept).items()))
    return keyed.dropDuplicates(["_doc_key", "_text_key"]).select(*docs.columns)


def op2_near_dedup(spark, sf_dir):
    return near_groups(C.documents(spark, sf_dir))


OP2_SQL = f"""
with recursive t as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents),
  s as (
    select distinct doc_id, array_to_string(list_slice(words, p, p + {SHINGLE - 1}), ' ') as g from (
      select doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE - 2}, least(len(words), 1) + 1))) as p from t)),
  n as (select doc_id, count(*) as n from s group by doc_id),
  pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
  link as (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= {THRESHOLD} * (x.n + y.n - c)),
  edge as (select a, b from link union all select b, a from link),
  reach(doc_id, r) as (select a, a from edge union select reach.doc_id, edge.b from reach join edge on reach.r = edge.a),
  c as (select doc_id, min(r) as component_id from reach group by doc_id)
select t.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.component_id, t.doc_id) as component_id, coalesce(c.component_id, t.doc_id) = t.doc_id as kept
from t left join n using (doc_id) left join c using (doc_id)
"""
