"""Operator 3 (native): personal data by patterns and bootstrapped contextual extraction.

Base: regular expressions with checks give emails, addresses, cards and phones. These are the
seed entities. The two words before an entity are its lexical pattern (also the last of them
alone). Candidates are words that hold a digit, an @ or [at], and runs of digit groups, outside all
base spans. Spark scores a bipartite graph of patterns and instances: a pattern's score is the mean
score of its distinct instances, smoothed, so that a context that also precedes many ordinary
candidates stays low, and 0 unless ``support`` of its instances score ``confident`` or more; an
instance's score is the best among its patterns, and it takes that pattern's kind; seeds keep
score 1. So what one round discovers supports new patterns in the next. After ``rounds`` rounds,
patterns with that support and a score of ``confident`` or more name the candidates they precede.

Everything is DataFrame and SQL functions. Texts are read once; what is found in them goes to the
shared folder, and all later steps move these short rows only. Matches are located by lengths of
the pieces between them, summed in two levels, and candidates are told from base spans in one
ordered pass over both, so the work is near linear in the matches.

Regular expressions use possessive loops and start only where a run begins or the last match
ended, which changes no match but keeps very long runs linear and needs no deep stack.

Skew: a frequent pattern or instance is one row of partial aggregates; patterns with fewer distinct
instances than the support bound are dropped before any join.

Defined results: null text is empty and has no spans. Very long texts are read whole, in one row.
Of patterns with one score, the kind that comes last in order of name is told. Rows get one result
each, repeated rows and null ids included. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone")
#: The base patterns; [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on, in possessive form.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this can't match; saves the costlier pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: What could be an identifier: a run of digit groups, or a word that holds a digit, an @ or [at].
_GROUPS = r"[0-9(+][0-9().+-]*+(?:\x20[0-9(][0-9().-]*+)++(?![^\x20\x09-\x0D])"
_WORD = r"(?:[^\x20\x09-\x0D0-9@\[]|\[(?!at\]))*+(?:[0-9@]|\[at\])[^\x20\x09-\x0D]*+"
CANDIDATE = rf"(?<![^\x20\x09-\x0D])(?:{_GROUPS}|{_WORD})"
MAY_HOLD = r"[0-9@]|\[at\]"
SUPPORT = 3
CONFIDENT = 0.6
SMOOTHING = 2
ROUNDS = 3
#: Characters of each piece before a match in which its pattern words are looked for.
CONTEXT = 80
STEP = 128
#: Spans that one pass over words and base spans holds in a growing list.
BLOCK = 64


SPANS = "cast(array() as array<struct<start: bigint, s: string, before: string>>)"


def locate(df: DataFrame, name: str, pattern: str, wanted: Column) -> DataFrame:
    """Add ``name``: array<struct<start, s, before>> of all matches in ``text``, start in code points from 0.

    ``before`` is some text in front of a match, put together from the two matches and gaps before
    it, each cut to CONTEXT characters. Each step is a column that the next one names more than once: an expression inlined into a
    lambda would run again for each element.
    """
    f, g, p, c, d = (f"_{name}_{x}" for x in "fgpcd")
    none = F.expr("cast(array() as array<string>)")
    df = df.withColumn(f, F.when(wanted, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(f) > 0, F.split("text", pattern, -1)).otherwise(none))
    tail = lambda x: F.substring(x, -CONTEXT, CONTEXT)
    pair = lambda m, x: F.struct(F.coalesce(F.length(x), F.lit(0)).cast("long").alias("gap"), F.coalesce(tail(x), F.lit("")).alias("tail"), m.alias("s"))
    df = df.withColumn(p, F.zip_with(f, F.slice(g, 1, F.size(f)), pair))
    last = lambda i, back, x: F.coalesce(tail(F.get(p, i - back)[x]), F.lit(""))
    before = lambda x, i: F.concat(last(i, 2, "s"), last(i, 1, "tail"), last(i, 1, "s"), x["tail"])
    df = df.withColumn(c, F.when(F.size(p) > 0, F.transform(p, lambda x, i: F.struct(x["gap"].alias("gap"), x["s"].alias("s"), before(x, i).alias("before")))))

    def inner(part: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(SPANS).alias("out"))
        return F.aggregate(
            part,
            start,
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + F.length(x["s"])).cast("long").alias("at"),
                F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), x["s"].alias("s"), x["before"].alias("before")))).alias("out"),
            ),
        )

    steps = F.sequence(F.lit(0), F.floor((F.size(c) - 1) / STEP).cast("int"))
    df = df.withColumn(d, F.when(F.size(c) > 0, F.transform(steps, lambda i: inner(F.slice(c, i * STEP + 1, STEP)))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("offsets"))
    offsets = F.aggregate(d, zero, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["offsets"], F.array(a["at"])).alias("offsets")))["offsets"]
    moved = F.flatten(F.zip_with(d, offsets, lambda x, o: F.transform(x["out"], lambda y: F.struct((y["start"] + o).alias("start"), y["s"].alias("s"), y["before"].alias("before")))))
    return df.withColumn(name, F.coalesce(moved, F.expr(SPANS)))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a digit string passes the check: from the right, each second digit doubled, minus 9 above 9."""
    back = F.split(F.reverse(d), "")
    total = F.aggregate(
        F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def passes(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind == "card":
        return F.length(digits(s)).between(16, 19) & luhn(digits(s))
    if kind == "phone":
        return F.length(digits(s)).between(8, 15)
    return F.lit(True)


def with_base(rows: DataFrame) -> DataFrame:
    """Add ``base``: array<struct<kind, start, stop, s, before>> in order of kind, then start."""
    for kind in KINDS:
        wanted = F.col("text").contains(NEEDS[kind]) if NEEDS[kind] else F.col("text").rlike("[0-9][0-9 -]{14}")
        rows = locate(rows, kind, PATTERNS[kind], wanted)

    def of(kind: str) -> Column:
        good = F.filter(kind, lambda x: passes(kind, x["s"]))
        span = lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["s"])).alias("stop"), x["s"].alias("s"), x["before"].alias("before"))
        return F.transform(good, span)

    return rows.withColumn("base", F.concat(*map(of, KINDS)))


def contexts(before: Column) -> Column:
    """The word at the end of ``before`` and its last two words, in lower case, as far as there are any."""
    before = F.lower(before)
    one = F.regexp_extract(before, r"([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*$", 1)
    two = F.regexp_extract(before, r"([^\x20\x09-\x0D]++[\x20\x09-\x0D]+[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*$", 1)
    return F.filter(F.array(one, F.regexp_replace(two, C.SPACE, " ")), lambda p: p != "")


def with_free(rows: DataFrame) -> DataFrame:
    """Add ``free``: the spans of ``words`` that overlap none of ``base``.

    One pass in order of starts carries the furthest end so far, one back the next start. A list that grows by appending
    is copied at each step, so each pass goes by blocks of spans: first what each block adds, then what each inherits, then
    its own spans. Each step is a column, see ``locate``.
    """
    event = lambda x, word, stop: F.struct(x["start"].alias("start"), F.lit(word).alias("word"), stop.cast("long").alias("stop"), x["s"].alias("s"), x["before"].alias("before"))
    events = F.array_sort(F.concat(F.transform("base", lambda b: event(b, 0, b["stop"])), F.transform("words", lambda w: event(w, 1, w["start"] + F.length(w["s"])))))
    rows = rows.withColumn("_events", F.when((F.size("words") > 0) & (F.size("base") > 0), events))
    numbers = F.sequence(F.lit(0), F.floor((F.size("_events") - 1) / BLOCK).cast("int"))
    rows = rows.withColumn("_blocks", F.when(F.col("_events").isNotNull(), F.transform(numbers, lambda i: F.slice("_events", i * BLOCK + 1, BLOCK))))
    rows = rows.withColumn("_back", F.reverse(F.transform("_blocks", F.reverse)))

    def carried(blocks: str, first: int, value: str, best) -> Column:
        """What each span sees of ``value`` of the base spans up to it."""
        step = lambda at, x: F.when(x["word"] == 0, best(at, x[value])).otherwise(at)
        state = lambda at, out: F.struct(at.cast("long").alias("at"), out.alias("out"))
        start = lambda at: state(at, F.expr("cast(array() as array<bigint>)"))
        own = F.transform(blocks, lambda block: F.aggregate(block, F.lit(first).cast("long"), step))
        before = F.aggregate(own, start(F.lit(first)), lambda a, x: state(best(a["at"], x), F.array_append(a["out"], a["at"])))["out"]
        within = lambda block, at: F.aggregate(block, start(at), lambda a, x: state(step(a["at"], x), F.array_append(a["out"], step(a["at"], x))))["out"]
        return F.flatten(F.zip_with(blocks, before, within))

    rows = rows.withColumn("_ends", carried("_blocks", 0, "stop", F.greatest)).withColumn("_starts", F.reverse(carried("_back", 2**62, "start", F.least)))
    sides = F.arrays_zip("_ends", "_starts")
    marked = F.zip_with("_events", sides, lambda x, y: F.struct(x.alias("x"), y["_ends"].alias("end"), y["_starts"].alias("next")))
    free = F.filter(marked, lambda m: (m["x"]["word"] == 1) & (m["end"] <= m["x"]["start"]) & (m["next"] >= m["x"]["stop"]))
    found = F.transform(free, lambda m: F.struct(m["x"]["start"].alias("start"), m["x"]["s"].alias("s"), m["x"]["before"].alias("before")))
    return rows.withColumn("free", F.coalesce(found, "words")).drop("_events", "_blocks", "_back", "_ends", "_starts")


def extract(docs: DataFrame) -> DataFrame:
    """Per row: row_id, doc_id, base spans, and ``seen``: entities and candidates with their patterns."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = locate(with_base(rows), "words", CANDIDATE, F.col("text").rlike(MAY_HOLD))
    rows = with_free(rows)

    def entry(kind: Column, stop: Column, x: Column) -> Column:
        return F.struct(kind.alias("kind"), x["start"].alias("start"), stop.alias("stop"), F.lower(x["s"]).alias("s"), contexts(x["before"]).alias("patterns"))

    seeds = F.transform("base", lambda b: entry(b["kind"], b["stop"], b))
    others = F.transform("free", lambda w: entry(F.lit(None).cast("string"), w["start"] + F.length(w["s"]), w))
    base = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["stop"].alias("stop")))
    return rows.select("doc_id", base.alias("base"), F.concat(seeds, others).alias("seen"))


def confident_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT, smoothing: float = SMOOTHING) -> DataFrame:
    """(kind, pattern, score) of the patterns that may name new identifiers.

    The graph's edges are distinct (pattern, instance) pairs, so copies of a text add nothing.
    """
    edges = found.select(F.explode("seen").alias("e")).select("e.kind", "e.s", F.explode("e.patterns").alias("pattern")).groupBy("pattern", "s").agg(F.max("kind").alias("kind"))
    usable = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= support).select("pattern")
    edges = C.materialise(edges.join(usable, "pattern"), "edges")
    seeds = edges.filter("kind is not null").groupBy("s").agg(F.max("kind").alias("kind"), F.lit(1.0).alias("score"))
    edges = edges.select("pattern", "s")

    def patterns(scores: DataFrame) -> DataFrame:
        """A candidate without a score counts with 0."""
        facts = F.sum(F.coalesce("score", F.lit(0.0))).alias("w"), F.count("*").alias("n"), F.count_if(F.col("score") >= confident).alias("good")
        per = edges.join(scores, "s", "left").groupBy("pattern", "kind").agg(*facts)
        best = F.max_by("kind", F.struct("good", "w", "kind"))
        per = per.groupBy("pattern").agg((F.sum("w") / (F.sum("n") + smoothing)).alias("score"), F.sum("good").alias("good"), best.alias("kind"))
        return per.filter(F.col("good") >= support).select("pattern", "kind", "score")

    scores = seeds
    for _ in range(rounds):
        best = edges.join(patterns(scores), "pattern").groupBy("s").agg(F.max(F.struct("score", "kind")).alias("b")).select("s", "b.kind", "b.score")
        scores = C.materialise(best.join(seeds.select("s"), "s", "left_anti").unionByName(seeds), "scores")
    return patterns(scores).filter(F.col("score") >= confident).select("kind", "pattern", "score")


def span_text(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, joined by commas."""
    ranked = F.transform(spans, lambda x: F.struct(F.array_position(F.lit(list(KINDS)), x["kind"]).alias("r"), x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(ranked), lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def private_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    found = C.materialise(extract(docs), "found")
    found = found.withColumn("row_id", F.xxhash64("doc_id", F.col("base").cast("string"), F.col("seen").cast("string")))
    patterns = C.materialise(confident_patterns(found), "patterns")
    spots = found.select("doc_id", "row_id", F.explode("seen").alias("e")).filter("e.kind is null").select("doc_id", "row_id", "e.start", "e.stop", F.explode("e.patterns").alias("pattern"))
    best = spots.join(patterns, "pattern").groupBy("doc_id", "row_id", "start", "stop").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    added = best.groupBy("doc_id", "row_id").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))
    joined = found.select("doc_id", "row_id", "base").join(added.withColumnsRenamed({"doc_id": "d", "row_id": "r"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_id") == F.col("r")), "left")
    more = F.coalesce("more", F.expr("cast(array() as array<struct<kind: string, start: bigint, stop: bigint>>)"))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest, spans = F.sha2(span_text(F.col("base")), 256), span_text(F.concat("base", more))
    return joined.select("doc_id", *map(count, KINDS), digest.alias("base_sha256"), spans.alias("spans"), F.size(more).cast("long").alias("n_added"))


def op3_private_data(spark, sf_dir):
    return private_data(C.documents(spark, sf_dir))
