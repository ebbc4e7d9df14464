"""Recall of operator 2 against brute force: python tests/llm/near_recall.py [table folder].

Queries are all documents whose id is divisible by 20, against all documents: of the pairs that
exact shingle sets link, the share that operator 2 puts into one component. A second figure is of
planted pairs at the threshold inside large nodes, which are branched further.
"""

import random
import sys
from collections import Counter, defaultdict

from pyspark.sql import SparkSession

from barstead.llm import common, near_dedup


def shingles(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {hash(tuple(w[i : i + 5])) for i in range(len(w) - 4)} if len(w) >= 5 else {hash(tuple(w))} if w else set()


def exact_links(texts, queries):
    """(query, document) pairs that are linked, queries against all texts by an inverted index."""
    sets = {d: shingles(t) for d, t in texts.items()}
    holders = defaultdict(list)
    for d, own in sets.items():
        for g in own:
            holders[g].append(d)
    for q in queries:
        shared = Counter(d for g in sets[q] for d in holders[g] if d != q)
        for d, n in shared.items():
            if 100 * n >= 85 * (len(sets[q]) + len(sets[d]) - n):
                yield q, d


def planted(pairs, rng, words=400):
    """Texts around one base: any two of different pairs at about 0.8, the two of a pair at 0.85 or a little more."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = {}

    def edited(w, n):
        w = list(w)
        for i in rng.sample(range(words), n):
            w[i] = f"e{rng.random()}"
        return w

    while len(texts) < 2 * pairs:
        stem = edited(base, 2)
        one, two = (" ".join(edited(stem, 3)) for _ in range(2))
        a, b = shingles(one), shingles(two)
        if 100 * len(a & b) >= 85 * len(a | b):
            texts |= {len(texts): one, len(texts) + 1: two}
    return texts


def found(spark, texts, **more):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: r.component_id for r in near_dedup.near_groups(df, **more).collect()}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    texts = {r.doc_id: r.text for r in common.documents(spark, sf).select("doc_id", "text").collect()}
    own = {r.doc_id: r.component_id for r in near_dedup.op2_near_dedup(spark, sf).select("doc_id", "component_id").collect()}
    links = list(exact_links(texts, [d for d in texts if d % 20 == 0]))
    print(f"{sf}: {len(links)} links of queries, recall {sum(own[a] == own[b] for a, b in links) / len(links):.4f}")
    hidden = planted(300, random.Random(1))
    got = found(spark, hidden, small=8)
    print(f"planted pairs in nodes branched to the end: recall {sum(got[i] == got[i + 1] for i in range(0, len(hidden), 2)) / (len(hidden) / 2):.4f}")
    spark.stop()


if __name__ == "__main__":
    main()
