"""The numbered operators on small rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
import subprocess
import sys
import textwrap
from collections import Counter, defaultdict

import near_recall
import numpy as np
import pytest
from pyspark.sql import functions as F

from barstead.llm import chat_format, exact_dedup, graph, language_id, license_scan, mixing, near_dedup, packing, private_data, quality_rules, registry, substring_dedup, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 6))) for _ in range(60)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def odd_texts():
    base = prose(80)
    near = base.split(" ")
    near[40] = "changed"
    return [None, "", " \t\n", "one", "one two three", base, base.replace(" ", "\n\t"), " ".join(near), base + " " + prose(30), "ab " * 300, "x" * 5000, prose(3000), prose(3000) + " " + base]


def docs(spark, texts, more=None):
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 3 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += more or []
    df = spark.createDataFrame(rows, SCHEMA)
    # columns that operators use for themselves elsewhere
    return df.select("*", *(F.lit(1).alias(c) for c in ("size", "kept", "recipe", "tokens", "doc_key", "piece", "root", "block", "score", "words", "base")))


def odd(spark):
    t = odd_texts()
    return docs(spark, t, [(None, t[5], None, None, None), (3, t[3], "en", "s3", 3), (3, "another text", None, None, None)])


def words(t):
    return [w.decode() for w in (t or "").encode().split()]


OPERATORS = {
    "op1": quality_rules.quality_rules,
    "op2": near_dedup.near_groups,
    "op3": private_data.private_data,
    "op4": mixing.mix,
    "op5": substring_dedup.substring_dedup,
    "op6": exact_dedup.exact_groups,
    "op7": license_scan.license_scan,
    "op8": lambda d: packing.pack(d).selectExpr("inline(arrays_zip(doc_ids, pieces))").filter("pieces = 0").selectExpr("doc_ids as doc_id"),
    "op10": language_id.language_id,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_get_a_row_each(spark, name):
    df = odd(spark)
    got = OPERATORS[name](df).collect()
    ids = Counter(r.doc_id for r in got)
    assert ids == Counter(r.doc_id for r in df.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


def brute_base(t):
    w = words(t)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + o for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for o in range(5)}
    longest = 0
    while longest < len(w) and max(Counter(tuple(w[i : i + longest + 1]) for i in range(len(w) - longest)).values(), default=0) > 1:
        longest += 1
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside), longest


def test_quality_measures_equal_brute_force(spark):
    texts = [t for t in odd_texts() if t is None or len(t) < 4000] + ["é# <b> é# <b>\n\né# <b>\n x", "a b c d e f a b c d e f a b c d e f"]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat) for r in quality_rules.quality_rules(docs(spark, texts)).collect()}
    assert got == {i: brute_base(t) for i, t in enumerate(texts)}


def test_quality_verdict(spark):
    passage = prose(50)
    rows = quality_rules.quality_rules(docs(spark, [prose(2000), passage + " " + prose(900) + " " + passage])).orderBy("doc_id").collect()
    assert [(r.base_failed, r.kept) for r in rows] == [(False, True), (False, False)]


def shingles(t):
    w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_near_groups_equal_brute_force(spark):
    rng, texts = random.Random(9), odd_texts()
    for _ in range(6):
        base = [rng.choice(VOCAB) + str(rng.randint(0, 30)) for _ in range(120)]
        for k in range(25):
            w = list(base)
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = "edit" + str(rng.random())
            texts.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs(spark, texts), small=8).collect()}
    assert got == brute_near(texts)


def test_near_recall_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.component_id for r in registry.QUERIES["op2_near_dedup"](spark, "/root/testdata/sf0.01").collect()}
    links = list(near_recall.exact_links(texts, [d for d in texts if d % 20 == 0]))
    assert links and sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)


@pytest.mark.parametrize(("last", "each", "least"), [(1, 0, 1.0), (13, 20, 0.95)])
def test_near_recall_in_large_nodes(spark, monkeypatch, last, each, least):
    """Large nodes of distinct texts around one base, linked in pairs at the threshold: searched whole, block by block, or branched further."""
    texts, branched = near_recall.planted(60, random.Random(1)), []
    monkeypatch.setattr(near_dedup, "LAST_STEPS", last)
    monkeypatch.setattr(near_dedup, "PAIRS_EACH", each)
    monkeypatch.setattr(near_dedup, "HELD", 16)
    branch = near_dedup.branch
    monkeypatch.setattr(near_dedup, "branch", lambda rows, steps, trees, threshold: branched.append(trees) or branch(rows, steps, trees, threshold))
    got = near_recall.found(spark, texts, small=8)
    assert (len(branched) > 1) == (last > 1) and branched[0] == near_dedup.TREES and not any(branched[1:])
    links = list(near_recall.exact_links(texts, list(texts)))
    assert len(links) >= 120 and sum(got[a] == got[b] for a, b in links) >= least * len(links)


def test_near_undivided_nodes_are_compared_at_once(spark, monkeypatch):
    """Texts that are all about alike aren't branched again and again: the rows made for them don't multiply, and no link is missed."""
    texts, made = near_recall.planted(60, random.Random(1)), []
    monkeypatch.setattr(near_dedup, "HELD", 16)
    branch = near_dedup.branch
    monkeypatch.setattr(near_dedup, "branch", lambda *a: made.append(branch(*a).count()) or branch(*a))
    got = near_recall.found(spark, texts, small=8)
    assert len(made) == 2 and sum(made) <= 4 * near_dedup.TREES * len(texts)
    assert {i: root for i, (_, root) in brute_near(list(texts.values())).items()} == got


def test_near_pairs_count_in_one_leaf():
    """Of the leaves that two classes share, exactly one counts their pair; the others are told to leave it."""
    rng = np.random.default_rng(3)
    held = [np.sort(rng.choice(40, rng.integers(1, 9), replace=False)).astype(np.int64) for _ in range(30)]
    counted = {}
    for node in range(40):
        inside = [c for c in range(30) if node in held[c]]
        if len(inside) < 2:
            continue
        part = {"key": (node, 0), "ids": inside, "leaves": np.concatenate([held[c] for c in inside])}
        part["whose"] = np.repeat(np.arange(len(inside)), [len(held[c]) for c in inside])
        pairs = np.array([(i, j) for j in range(len(inside)) for i in range(j)])
        for (i, j), before in zip(pairs.tolist(), near_dedup.met_before(part, part, pairs), strict=True):
            counted.setdefault((inside[i], inside[j]), []).append(not before)
    assert counted and all(sum(times) == 1 for times in counted.values())


def test_near_keep_one_of_repeated_rows(spark):
    base = prose(120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [(3, base, "en", "s", 0)] * 3 + [(3, " ".join(near), "fr", "t", 1), (1, base, None, None, None), (9, None, "en", "s", 0), (9, None, "en", "s", 0), (None, base, "en", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text_key", F.lit(1)).withColumn("least", F.lit("x"))
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, base), (9, None)], key=lambda x: x[0])


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def brute_substring(texts, width=20):
    first, removed, out = {}, defaultdict(set), {}
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - width + 1):
            if first.setdefault(tuple(w[i : i + width]), (d, i)) != (d, i):
                removed[d] |= set(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in removed[d]]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1, 1000])
def test_substring_dedup_equals_brute_force(spark, hot):
    passage = prose(70)
    texts = odd_texts() + [prose(30) + " " + passage + " " + prose(25) for _ in range(12)] + [passage[:200] + " " + passage]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(docs(spark, texts), hot=hot).collect()}
    assert got == brute_substring(texts)


def test_exact_groups_and_colliding_identifiers(spark, monkeypatch):
    texts = odd_texts() + ["a b", "a  b", "A b", "a\nb", " a b"]
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    want = {i: (norm.index(n), norm.count(n), hashlib.sha256(n.encode()).hexdigest()) for i, n in enumerate(norm)}
    df = docs(spark, texts)
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(df).collect()} == want
    kept = exact_dedup.keep_first(odd(spark))
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in odd(spark).collect()})
    ids = [exact_dedup.chunk_id(b"one"), exact_dedup.chunk_id(b"a b")]
    rows = exact_dedup.recipes(df, ids)
    assert rows.filter("text_sha256 = sha2('a b', 256)").first().recipe == hashlib.sha256(b"a b").digest()


def test_private_data_base_equals_regular_expressions(spark):
    base = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        odd_sum = sum(map(int, d[-1::-2]))
        return (odd_sum + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])) % 10 == 0

    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]

    texts = odd_texts() + ["é a@b.co,1.2.3.4 a@b.com_x@d.e 300.1.1.1 4111 1111-1111 1111 +1 (555) 123-4567 a@-.- 1.2.3.4.5.6.7.8 0012.1.1.255 +12 3", "1 " * 2000, "a@b." * 300 + "c"]
    for r in private_data.private_data(docs(spark, texts)).collect():
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in base.items() for m in re.finditer(p, texts[r.doc_id] or "") if good(k, m.group())]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k) for s in spans) for k in base)


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"hello my id is user{i}@mail.org ok {i}" for i in range(20)] + ["hello my id is XK-77 ok", "the year 1999 ok 5"]
    got = {r.doc_id: r.spans for r in private_data.private_data(docs(spark, texts)).filter("n_added > 0").collect()}
    assert got == {20: "email:15:20"}


def test_discoveries_support_further_patterns(spark):
    """Identifiers that no base rule knows, planted behind seeded contexts and, from there, behind contexts without any seed."""
    people = ["ann", "bob", "cyd", "dee", "eve", "fay"]
    texts = [f"please write to u{i}@mail.org today" for i in range(30)]
    texts += [f"please write to {p}[at]mail.org today" for p in people]  # found in the first round
    texts += [f"you can reach {p}[at]mail.org there" for p in people]  # these support a context without seeds
    hidden = [f"you can reach {p}@localhost there" for p in ("gil", "hal", "ida")]
    groups = [f"call us on +44 20 7946 {i:04d} now" for i in range(30)] + ["call us on 0171 555 123 now"]
    clean = [f"in the year {1900 + i} we met @home" for i in range(40)] + [prose(30) + f" {i}" for i in range(40)]
    rows = texts + hidden + groups + clean
    got = {r.doc_id: (r.spans, r.n_added) for r in private_data.private_data(docs(spark, rows)).collect()}
    at = lambda t: next(i for i, x in enumerate(rows) if x == t)
    for t in texts[30:] + hidden:
        word = next(w for w in t.split() if "@" in w or "[at]" in w)
        assert got[at(t)] == (f"email:{t.index(word)}:{t.index(word) + len(word)}", 1), t
    assert got[at(groups[-1])] == ("phone:11:23", 1)
    assert all(got[at(t)] == ("", 0) for t in clean)


def test_candidates_outside_base_spans(spark):
    texts = ["x1 a@b.co y2 1.2.3.4 z3", "1.2.3.4:80 4111 1111 1111 1111 77 88 x", "n4111 1111 1111 1111 1111 5", "a b", "a@b.co", "9 " * 300 + "a@b.co " * 200]
    for r in private_data.extract(docs(spark, texts)).collect():
        spans = [(x.start, x.stop) for x in r.base]
        own = [(x.start, x.stop) for x in r.seen if x.kind is None]
        assert all(b <= x or a >= y for a, b in own for x, y in spans)
        words_of = [(m.start(), m.end()) for m in re.finditer(private_data.CANDIDATE.replace("++", "+").replace("*+", "*"), texts[r.doc_id])]
        assert own == [(a, b) for a, b in words_of if all(b <= x or a >= y for x, y in spans)]


def test_mix_keeps_targets_and_limits(spark):
    texts = [prose(RNG.randint(1, 400)) for _ in range(400)] + [None, ""]
    df = docs(spark, texts)
    rows = mixing.mix(df).collect()
    assert all(r.taken <= 3 * r.size for r in rows)
    by = defaultdict(int)
    for r in rows:
        by[(r.source_size, r.target)] += r.taken
    for (size, target), taken in by.items():
        assert target <= 3 * size and abs(taken - target) <= 0.03 * target + mixing.BLOCK
    assert sum(t for _, t in by) == pytest.approx(sum(r.size for r in rows))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    taken = {r.doc_id: r.taken for r in rows if r.taken}
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == taken


def test_slots_are_dealt_to_shards(spark):
    df = docs(spark, [prose(RNG.randint(1, 400)) for _ in range(400)] + [None, ""])
    size, block = 64, 16
    slots, words_of, by_doc = {}, Counter(), Counter()
    for r in mixing.dealt(df, block=block, shard_slots=size).collect():
        assert slots.setdefault((r.shard, r.slot), (r.k, r.block)) == (r.k, r.block)
        words_of[r.shard, r.slot] += r.n
        by_doc[r.doc_id] += r.n
    total = len(slots)
    assert set(slots) == {divmod(p, size) for p in range(total)} and total > 20 * size
    assert max(words_of.values()) == block
    assert by_doc == {r.doc_id: r.taken for r in mixing.mix(df, block=block).collect() if r.taken}
    counts, all_of = defaultdict(Counter), Counter(k for k, _ in slots.values())
    for (shard, _), (k, _) in slots.items():
        counts[shard][k] += 1
    full = range(total // size)
    for k, n in all_of.items():
        share = n / total
        assert all(abs(counts[s][k] - share * size) <= 5 * (size * share * (1 - share)) ** 0.5 + 1 for s in full)
        assert len({counts[s][k] for s in full}) > 1  # drawn, not a fixed quota
    mixed = mixing.sharded_documents(df, block=block, shard_slots=size).collect()
    assert all((r.shard, r.slot) in slots for r in mixed) and len({r.shard for r in mixed}) >= total // size
    row = lambda r: (r.doc_id, r.text)
    parts = mixing.mixed_documents(df, block=block, shard_slots=size, by_shard=True).withColumn("part", F.spark_partition_id()).collect()
    shards = defaultdict(list)
    for r in sorted(mixed, key=lambda r: (r.shard, r.slot)):
        shards[r.shard].append(row(r.doc))
    written = defaultdict(list)
    for r in parts:
        written[r.part].append(row(r))
    assert Counter(map(row, parts)) == Counter(row(r.doc) for r in mixed)
    starts = {tuple(sorted(x)) for x in shards.values()}
    for own in written.values():
        while own:
            n = next(len(x) for x in starts if tuple(sorted(own[: len(x)])) == x)
            own = own[n:]


def test_targets_by_repeated_resharing(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), ("d", 2000), (None, 3)], "source string, size long")
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 2000, None: 3}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    target, full = {k: sum(sizes.values()) * w / sum(weights.values()) for k, w in weights.items()}, set()
    while over := [k for k in sizes if k not in full and target[k] > 3 * sizes[k]]:
        excess = sum(target[k] - 3 * sizes[k] for k in over)
        full |= set(over)
        target |= {k: 3.0 * sizes[k] for k in over}
        rest = sum(weights[k] for k in sizes if k not in full)
        target |= {k: target[k] + excess * weights[k] / rest for k in sizes if k not in full}
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    assert got == pytest.approx(target)


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1025])
def test_slot_map_is_a_permutation(spark, n):
    for df in (mixing.permuted(spark.range(n), "id", f"{n}L", "5L", "p"), mixing.dealt_places(spark.range(n), "id", n, 5, "p")):
        assert sorted(r.p for r in df.collect()) == list(range(n))


def test_block_permutation_in_plain_integers(spark):
    n, seed, prime = 1000, 123457, mixing.PRIME

    def place(a):
        for r in range(1, mixing.ROUNDS + 1):
            one, two = pow(48271, r, prime), pow(69621, r, prime)
            key = ((seed * one + 69621 * r) % prime * 2**31 + (seed * two + 16807 * r + 11) % prime) % n
            b = (key - a) % n
            x = max(a, b)
            h = (x * x % prime * 48271 + x * 69621 + seed * one % prime + 7919 * r) % prime
            if (h * h % prime + x) % prime // 1024 % 2:
                a = b
        return a

    rows = mixing.permuted(spark.range(n), "id", f"{n}L", f"{seed}L", "p").collect()
    assert all(r.p == place(r.id) for r in rows)
    # neighbours end up apart: of runs of 50, few places follow each other
    by = [r.p for r in sorted(rows, key=lambda r: r.id)]
    assert sum(abs(a - b) == 1 for a, b in zip(by, by[1:])) < 20


def test_many_sources_are_ranked_and_placed(spark):
    rows = [(i, prose(RNG.randint(5, 60)), "en", None if i % 97 == 0 else f"host{i % 151:03d}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.targets(mixing.sized_documents(df)).orderBy("k").collect()
    assert [r.source for r in plan] == [*sorted({r[3] for r in rows if r[3]}), None] and [r.k for r in plan] == list(range(len(plan)))
    assert [r["first"] for r in plan] == [sum(x.slots for x in plan[:i]) for i in range(len(plan))]
    drawn = mixing.shard_counts(mixing.targets(mixing.sized_documents(df)), 32).collect()
    for r in plan:
        own = sorted((x.shard, x.earlier, x.n) for x in drawn if x.k == r.k)
        assert sum(n for _, _, n in own) == r.slots and [e for _, e, _ in own] == [sum(n for _, _, n in own[:i]) for i in range(len(own))]


def test_repeated_rows_and_ids_in_the_mix(spark):
    one, two = prose(300), prose(300)
    rows = [(1, one, "en", "a", 0)] * 3 + [(1, two, "en", "a", 0), (2, "x y", "en", "a", 0), (2, "x y", "en", "a", 0)]
    runs = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        runs.append((sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(df, block=16).collect()), sorted((r.doc_id, r.text) for r in mixing.mixed_documents(df, block=16).collect())))
    assert runs[0] == runs[1] and len(runs[0][0]) == len(rows)
    assert sum(t for _, _, t in runs[0][0]) == sum(len(words(t)) for _, t in runs[0][1])


def plain_best_fit(lengths):
    """Bins of pieces (index, length) by the definition, each opening and each choice by a search over everything."""
    caps, bins = packing.CAPACITIES, []
    cost = {c: c * (1 + c / packing.ATTENTION) + packing.OVERHEAD for c in caps}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        x = lengths[i]
        room = lambda b: b["cap"] - sum(n for _, n in b["own"])
        fits = [b for b in bins if room(b) >= x]
        if fits:
            best = min(map(room, fits))
            b = max((b for b in fits if room(b) == best), key=lambda b: b["moved"])
        else:
            def filled(c):
                m = min(c - x, x - 1)
                return x + min(c - x, sum(n for n in lengths if n <= m))

            b = {"cap": min((c for c in caps if c >= x), key=lambda c: (cost[c] / filled(c), c)), "own": []}
            bins.append(b)
        b["own"].append((i, x))
        b["moved"] = sum(len(x["own"]) for x in bins)
    return [(min(c for c in caps if c >= sum(n for _, n in b["own"])), b["own"]) for b in bins]


def test_best_fit_equals_its_definition():
    rng = random.Random(8)
    for most in (30, 900, 4096):
        lengths = [rng.randint(1, most) for _ in range(150)]
        bins, offsets, sizes = packing.best_fit(np.array(lengths))
        got = defaultdict(list)
        for i in sorted(range(150), key=lambda i: (bins[i], offsets[i])):
            got[int(bins[i])].append((i, lengths[i], int(sizes[i])))
        assert [(own[0][2], [(i, n) for i, n, _ in own]) for _, own in sorted(got.items())] == plain_best_fit(lengths)


def test_packed_tokens(spark):
    texts = [None, "", "one", " \t", prose(5000), "é\u00a0 漢字\u3000 x", "word " * 9000] + [prose(RNG.randint(1, 900)) for _ in range(150)]
    more = [(500, "same row", "en", "s", 8)] * 90 + [(501, "few rows", "en", "s", 8)] * 3 + [(None, "no id", None, None, None), (7, "other text of an id", None, None, None)]
    df = docs(spark, texts, more)
    runs = [packing.pack(df.repartition(n), group_bytes=60_000).collect() for n in (1, 6)]
    assert sorted(map(repr, runs[0])) == sorted(map(repr, runs[1]))
    rows, encoding = runs[0], tokens.encoding_of(open(tokens.VOCABULARY, "rb").read())[0]
    parts = defaultdict(list)
    for r in rows:
        assert sum(r.lengths) == r.n_tokens == len(r.token_ids) and len({len(r.doc_ids), len(r.pieces), len(r.starts), len(r.lengths)}) == 1
        assert r.capacity == (min(c for c in packing.CAPACITIES if c >= r.n_tokens) if r.bin_id else None)
        at = 0
        for d, piece, start, n in zip(r.doc_ids, r.pieces, r.starts, r.lengths, strict=True):
            parts[d].append((piece, start, r.token_ids[at : at + n]))
            at += n
    assert len({r.bin_id for r in rows if r.bin_id}) == sum(r.bin_id is not None for r in rows)
    texts_of = defaultdict(list)
    for d, t in [*enumerate(texts), *((m[0], m[1]) for m in more)]:
        texts_of[d].append(t or "")
    assert set(parts) == set(texts_of)
    for d, own in texts_of.items():
        want = Counter(tuple(encoding.encode_ordinary(t)[i : i + 4096]) for t in own for i in range(0, max(1, len(encoding.encode_ordinary(t))), 4096))
        assert Counter(tuple(x) for _, _, x in parts[d]) == want
        if len(own) == 1:
            assert encoding.decode([x for _, _, ids in sorted(parts[d]) for x in ids]) == own[0]
    full = sum(r.n_tokens for r in rows) / sum(r.capacity or 0 for r in rows)
    assert full > 0.9


def test_chat_round_trip(spark):
    texts = [r"\### Assistant: </turn> ok", "<turn>a<text>b</turn>", r"<\turn> <\\text>", "", None, "é 漢字 🙂 \n\n x", "<turn"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, 0, None, "x"), (2, None, "assistant", "y"), (None, 1, "system", "z"), (1, 0, "user", texts[0])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("size", F.lit(1))
    got = {r.conv_id: r for r in chat_format.format_and_read(df).collect()}
    assert set(got) == {1, 2, None} and got[1].n_turns == len(texts) + 1
    own = sorted([r for r in rows if r[0] == 1], key=lambda r: r[1])
    told = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in own)
    loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.format_and_read(df.limit(0)).collect() == []


def test_language_accuracy_on_held_out_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, total = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert total > 200 and right > 0.97
    none = language_id.language_id(docs(spark, [None, "", "123 456", "..."])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_windows_of_the_network_agree_with_its_gradient_form():
    net = language_id.Net(["a", "b", "c"], np.random.default_rng(1))
    x = np.random.default_rng(2).integers(0, 256, (8, language_id.WINDOW), dtype=np.uint8)
    loss, _ = net.step(x, np.zeros(8, dtype=np.int64))
    assert -net.log_probabilities(x)[:, 0].mean() == pytest.approx(loss, rel=1e-3)


def test_licences(spark):
    body = prose(40)
    texts = [body, body + "\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.\n" + body + "\nAll rights reserved.", "the license of a fishing boat", None, "Licensed under the Apache License, Version 2.0."]
    got = {r.doc_id: (r.families, r.n_confirmed) for r in license_scan.license_scan(docs(spark, texts + [prose(20) for _ in range(50)])).collect()}
    assert [got[i] for i in range(6)] == [("", 0), ("mit", 1), ("cc,reserved", 2), ("", 0), ("", 0), ("apache", 1)]
    assert all(got[i] == ("", 0) for i in range(6, 56))


def test_wrapped_licences(spark):
    notices = {f: max(texts, key=len) for f, texts in license_scan.NOTICES.items() if f in ("mit", "gpl", "bsd")}
    body = prose(40)
    texts, want = [], []
    for f, notice in notices.items():
        for width in (20, 50, 72):
            lines = textwrap.wrap(notice, width)
            texts += [f"{body}\n\n" + "\n".join(lines) + f"\n\n{body}", f"{body}\n" + "\n".join(f" * {x}" for x in lines) + f"\n{body}", "\n".join(textwrap.wrap(f"{body} {notice} {body}", width))]
            want += [(f, 1)] * 3
    texts += ["\n".join(textwrap.fill(n, 72) for n in notices.values()), "Released under the MIT License.\nLicensed under the\nMIT License.", "Released under\n\nthe MIT License."]
    want += [("bsd,gpl,mit", 3), ("mit", 2), ("", 0)]
    rows = [(i, t, "en", "s0", len(t)) for i, t in enumerate(texts)]
    plain = ["\n".join(prose(10) for _ in range(60)) for _ in range(50)]
    got = {r.doc_id: r for r in license_scan.license_scan(docs(spark, texts + plain, rows[:1])).collect()}
    assert [(got[i].families, got[i].n_confirmed) for i in range(len(texts))] == want
    assert all(got[i].n_predicted >= got[i].n_confirmed for i in got)
    assert all((got[i].families, got[i].n_predicted) == ("", 0) for i in range(len(texts), len(texts) + 50))


def test_licence_sample_and_anchors_see_a_frequent_line_once(spark):
    lines = [prose(6, random.Random(i)) for i in range(3000)]
    hashed = spark.createDataFrame([(x,) for x in lines], "x string").orderBy(F.pmod(F.xxhash64("x"), F.lit(2**52)))
    hot = hashed.first().x
    rows = [(i, x, "en", "s", 0) for i, x in enumerate(lines)] + [(10_000 + i, hot + "\nthe software", "en", "s", 0) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    sample = [r.paragraph for r in license_scan.sampled(df, 400).collect()]
    assert len(sample) == len(set(sample)) == 400
    anchors, _ = license_scan.vocabulary(df)
    assert "software" in anchors and "license" in anchors
    common = spark.createDataFrame([(i, f"{x} software", "en", "s", 0) for i, x in enumerate(lines)], SCHEMA)
    assert "software" not in license_scan.vocabulary(common)[0]


def plain_licence(text, model):
    """(families, n_predicted, n_confirmed) by the definition: every run of lines, its grams, softmax, containment, disjoint runs."""
    lines = [re.findall(r"[a-z0-9\u00c0-\u024f]+", x.lower()) for x in (text or "").split("\n")]
    known, anchors, vocabulary = set(license_scan.KNOWN), set(model.anchors), {g: i for i, g in enumerate(model.counter.vocabulary)}
    weights, bias, wide = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray(), license_scan.WIDEST
    grams_of = lambda w, n: [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
    found = []
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            if not all(lines[i : j + 1]) or sum(map(len, lines[i + 1 : j])) > wide and j > i:
                break
            if not (known & set(lines[i]) and known & set(lines[j]) and any(anchors & set(x) for x in lines[i : j + 1])):
                continue
            w = lines[i] if i == j else lines[i][-wide:] + sum(lines[i + 1 : j], []) + lines[j][:wide]
            on = sorted({vocabulary[g] for n in (1, 2, 3) for g in grams_of(w, n) if g in vocabulary})
            z = (weights[:, on].sum(axis=1) + bias) / model.temperature
            p = np.exp(z - z.max())
            p /= p.sum()
            family = model.classes[int(p.argmax())]
            if family != license_scan.UNKNOWN and p.max() >= license_scan.CONFIDENT:
                own = set(grams_of(w, 3))
                share = max(len(own & t) / max(len(t), 1) for t in (set(grams_of(re.findall("[a-z0-9]+", n.lower()), 3)) for n in license_scan.NOTICES[family]))
                found.append((j + 1, -i, family, share >= license_scan.CONTAINED))

    def disjoint(rows):
        end, n = defaultdict(int), 0
        for last, back, family, _ in sorted(rows):
            if 1 - back > end[family]:
                end[family], n = last, n + 1
        return n

    good = [x for x in found if x[3]]
    return ",".join(sorted({x[2] for x in good})), disjoint(found), disjoint(good)


def test_licences_equal_brute_force(spark):
    rng = random.Random(12)
    notices = [(f, n) for f, own in license_scan.NOTICES.items() for n in own]
    texts = [n for _, n in notices] + [None, "", "\n\n", "license", "the software\nis provided"]
    for _ in range(30):
        parts = [rng.choice([prose(12, rng), rng.choice(notices)[1], " ".join(rng.sample(rng.choice(notices)[1].split(), 3)), ""]) for _ in range(6)]
        texts.append("\n".join("\n".join(textwrap.wrap(x, rng.choice([30, 70, 400]))) for x in parts))
    df = docs(spark, texts + [prose(30) for _ in range(60)])
    model = license_scan.train(df)
    got = {r.doc_id: (r.families, r.n_predicted, r.n_confirmed) for r in license_scan.license_scan(df, model).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_licence(t, model), t
    right = sum(f in got[i][0].split(",") for i, (f, _) in enumerate(notices))
    assert right >= 0.95 * len(notices)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    from oracle import same

    same(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], "/root/testdata/sf0.001")


def test_queries_in_fresh_python_workers(tmp_path):
    """Each task in a worker of its own, as after a lost executor: no operator may rely on what another one has imported."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from barstead.llm import registry\n"
        f"conf = {{'spark.python.worker.reuse': 'false', 'spark.sql.shuffle.partitions': '2', 'spark.ui.enabled': 'false', 'spark.checkpoint.dir': 'file://{tmp_path}', 'spark.ui.showConsoleProgress': 'false'}}\n"
        "spark = SparkSession.builder.master('local[4]').config(map=conf).getOrCreate()\n"
        "for name in ('op1_quality_rules', 'op5_substring_dedup', 'op6_exact_dedup', 'op8_best_fit_packing', 'op9_chat_format'):\n"
        "    assert registry.QUERIES[name](spark, '/root/testdata/sf0.001').count() > 0\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600)


def test_every_language_is_learned(spark):
    """70 languages, each with letters of its own: more than any fixed number of classes would hold."""
    rng, rows = random.Random(3), []
    for k in range(70):
        letters = [chr(0x1E00 + 3 * k + i) for i in range(3)] + list("aeiou")
        rows += [(1000 * k + i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(12)), f"l{k:02d}", "s", 0) for i in range(14)]
    df = spark.createDataFrame(rows, SCHEMA)
    sample = language_id.training_rows(df, 10, 1)
    assert len({r.lang for r in sample}) == 70 and max(Counter(r.lang for r in sample).values()) <= 10
    assert len({r.lang for r in language_id.training_rows(df, 250, 1, sample_rows=1)}) == 70
    net = language_id.train(sample, epochs=40)
    assert len(net.classes) == 70
    known = {r[0]: r[2] for r in rows}
    got = language_id.predict(df, net, ["doc_id"]).collect()
    assert sum(known[r.doc_id] == r.lang_pred for r in got) > 0.9 * len(got)


def test_prediction_equals_one_window_at_a_time(spark):
    """The batched tables against the plain definition: embed, convolve, pool, softmax, weighted mean of logs."""
    net = language_id.Net(["a", "b", "c"], np.random.default_rng(4))
    texts = ["é one two", "word " * 150, "漢字 " * 90, prose(200), None, "12 34"]

    def plain(text):
        raw = (text or "").encode()
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        w, total, mass = language_id.WINDOW, np.zeros(3), 0.0
        for at in range(0, len(raw), w):
            cut = raw[max(0, min(at, len(raw) - w)) :][:w].ljust(w, b"\0")
            e = net.p["E"][np.frombuffer(cut, np.uint8)]
            pooled = []
            for width in language_id.WIDTHS:
                filters = net.p[f"W{width}"].reshape(width, language_id.EMBED, language_id.FILTERS)
                z = [sum(e[i + j] @ filters[j] for j in range(width)) for i in range(w - width + 1)]
                pooled.append(np.max(z, axis=0) + net.p[f"b{width}"])
            logits = np.maximum(np.concatenate(pooled), 0) @ net.p["V"] + net.p["c"]
            letters = sum(65 <= c < 91 or 97 <= c < 123 or c > 127 for c in cut) + 1e-3
            total += letters * (logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
            mass += letters
        q = np.exp(total / mass - (total / mass).max())
        return "abc"[int(q.argmax())], float((q / q.sum()).max())

    for r in language_id.predict(docs(spark, texts), net, ["doc_id"]).collect():
        name, score = plain(texts[r.doc_id])
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-3)
