"""Operator 10: language identification by a byte convolutional network.

Filters of several widths run over embedded bytes; each is max-pooled over a window of fixed
length, and a softmax layer gives the languages. Training is plain numpy (Adam) on the driver
over a bounded sample of labelled texts: at most ``per_language`` documents of each language
(smallest hash of the id first, so reruns agree), fewer where ``SAMPLE_ROWS`` hold no more for all
languages together, but ``LEAST_EACH`` of any language, so every language that occurs is a class;
``cuts_each`` windows of a document. Prediction covers whole texts: every window of every text, batched; the
windows' log-probabilities are averaged with their letters as weight.

Learned from text and lang of documents outside the held-out fold only; a prediction sees the
text alone. At prediction the first layer is two table lookups per byte pair, since a width-4
filter over embedded bytes is a sum of a function of the first pair and one of the second.

Defined results: null text, or text without a letter: ``und``, score 0. With no labelled row to
learn from, every row is ``und``. Of classes with one score the first in order of name is told.
Very long texts are read whole, some windows at a time. Repeated rows get a row each. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW = 192
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANGUAGE = 250
SAMPLE_ROWS = 16_000
LEAST_EACH = 8
CUTS_EACH = 4
EPOCHS = 5
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_LETTER_BYTE = np.zeros(256, dtype=bool)
_LETTER_BYTE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS, F.lit(0))


def training_rows(docs: DataFrame, per_language: int, cuts_each: int, sample_rows: int = SAMPLE_ROWS) -> list:
    """Rows (lang, cuts) of bounded size on the driver: ``sample_rows`` at most, or LEAST_EACH per language where that is more."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold() != HELD_OUT)).select("doc_id", "lang", "text")
    counts = C.materialise(labelled.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = min(per_language, max(LEAST_EACH, sample_rows // max(counts.count(), 1)))
    # a hash bound keeps about three times the rows wanted, so that ranking moves little at any size
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**52)) / float(2**52)
    near = labelled.join(counts, "lang").filter(unit < (3 * each + 50) / F.col("n")).drop("n")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
    few = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each)
    spread = F.expr(f"transform(sequence(0, {cuts_each - 1}), i -> substring(text, cast(1 + floor(i * greatest(length(text) - {WINDOW}, 0) / {cuts_each}) as int), {WINDOW}))")
    rows = few.select("lang", "r", F.array_distinct(spread).alias("cuts"))
    return sorted(rows.collect(), key=lambda x: (x.lang, x.r))


class Net:
    """Weights and the classes in order."""

    def __init__(self, classes: list[str], rng: np.random.Generator):
        self.classes, k = classes, len(classes)
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"E": scale(256, EMBED) * np.float32(4)}
        for w in WIDTHS:
            self.p |= {f"W{w}": scale(w * EMBED, FILTERS), f"b{w}": np.zeros(FILTERS, np.float32)}
        self.p |= {"V": scale(FILTERS * len(WIDTHS), k), "c": np.zeros(k, np.float32)}

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients on windows ``x`` (n, WINDOW) of bytes with labels ``y``."""
        p, n = self.p, len(x)
        e, pooled, where = p["E"][x], [], []
        for w in WIDTHS:
            size = WINDOW - w + 1
            flat = np.lib.stride_tricks.sliding_window_view(e.reshape(n, -1), w * EMBED, axis=1)[:, ::EMBED]
            z = np.ascontiguousarray(flat).reshape(-1, w * EMBED) @ p[f"W{w}"]
            z = z.reshape(n, size, FILTERS)
            top = z.argmax(axis=1)
            where.append(top)
            pooled.append(np.take_along_axis(z, top[:, None], axis=1)[:, 0] + p[f"b{w}"])
        h = np.concatenate(pooled, axis=1)
        a = np.maximum(h, 0)
        logits = a @ p["V"] + p["c"]
        q = np.exp(logits - logits.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        loss = float(-np.log(q[np.arange(n), y] + 1e-9).mean())
        q[np.arange(n), y] -= 1
        q /= n
        g = {"V": a.T @ q, "c": q.sum(axis=0), "E": np.zeros_like(p["E"])}
        back = (q @ p["V"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            d = back[:, i * FILTERS : (i + 1) * FILTERS]
            g[f"b{w}"] = d.sum(axis=0)
            at = where[i][:, :, None] + np.arange(w)
            seen = x[np.arange(n)[:, None, None], at]
            g[f"W{w}"] = np.einsum("nfwe,nf->wef", p["E"][seen], d).reshape(w * EMBED, FILTERS)
            toward = d[:, :, None, None] * p[f"W{w}"].reshape(w, EMBED, FILTERS).transpose(2, 0, 1)[None]
            np.add.at(g["E"], seen.ravel(), toward.reshape(-1, EMBED))
        return loss, g

    @functools.cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """First layer by byte pairs: a filter's value at i is first[pair at i] + second[pair at i + 2]."""
        single = np.zeros((4, 256, FILTERS * len(WIDTHS)), dtype=np.float32)
        for i, w in enumerate(WIDTHS):
            for j in range(w):
                single[j, :, i * FILTERS : (i + 1) * FILTERS] = self.p["E"] @ self.p[f"W{w}"].reshape(w, EMBED, FILTERS)[j]
        pair = lambda j: (single[j][:, None, :] + single[j + 1][None]).reshape(65536, -1)
        return pair(0), pair(2)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, classes) for windows of bytes (n, WINDOW)."""
        first, second = self.tables
        bias = np.concatenate([self.p[f"b{w}"] for w in WIDTHS])
        out = np.empty((len(windows), len(self.classes)), dtype=np.float32)
        for lo in range(0, len(windows), 32):
            x = np.zeros((len(windows[lo : lo + 32]), WINDOW + 4), dtype=np.int32)
            x[:, :WINDOW] = windows[lo : lo + 32]
            pair = x[:, :-1] * 256 + x[:, 1:]
            top = None
            z = first[pair[:, :WINDOW]]
            z += second[pair[:, 2 : WINDOW + 2]]
            for i, w in enumerate(WIDTHS):
                part = z[:, : WINDOW - w + 1, i * FILTERS : (i + 1) * FILTERS].max(axis=1)
                top = part if top is None else np.concatenate([top, part], axis=1)
            logits = np.maximum(top + bias, 0) @ self.p["V"] + self.p["c"]
            logits -= logits.max(axis=1, keepdims=True)
            out[lo : lo + 32] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out


def _window(cut: bytes) -> np.ndarray:
    return np.frombuffer(cut[:WINDOW].ljust(WINDOW, b"\0"), dtype=np.uint8)


def train(rows: list, epochs: int = EPOCHS, seed: int = 7) -> Net | None:
    """Fit on rows (lang, cuts); part of the cuts are shortened, since short texts occur as well."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    classes = sorted({r.lang for r in rows})
    data = []
    for r in rows:
        for i, cut in enumerate(r.cuts):
            cut = cut.encode()
            data.append((cut, r.lang))
            if i == 0:
                data.append((cut[: int(rng.integers(8, 80))], r.lang))
    x = np.stack([_window(c) for c, _ in data])
    y = np.searchsorted(classes, [k for _, k in data])
    net = Net(classes, rng)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    t, batch = 0, 64
    for epoch in range(epochs):
        order, rate = rng.permutation(len(x)), 0.004 * (1 - epoch / epochs)
        for lo in range(0, len(order), batch):
            at = order[lo : lo + batch]
            _, g = net.step(x[at], y[at])
            t += 1
            for k, v in net.p.items():
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.01 * (g[k] ** 2 - s[k])
                v -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return net


def predict(docs: DataFrame, net: Net | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score; one pass, no shuffle."""
    rows = docs.select(*keep, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.col("text").alias("_text"))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            letters = np.asarray(batch.column("_letters").to_numpy(zero_copy_only=False), dtype=bool)
            names, scores = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
            if net is not None and n:
                raw_all, offsets_all = C.text_buffer(batch.column("_text"))
                for i, j in C.chunks(offsets_all):
                    raw, offsets = raw_all[offsets_all[i] : offsets_all[j]], offsets_all[i : j + 1] - offsets_all[i]
                    size = np.where(letters[i:j], np.diff(offsets), 0)
                    many = -(-size // WINDOW)
                    if not many.sum():
                        continue
                    doc = np.repeat(np.arange(j - i), many)
                    place = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                    # the last window of a text ends with it, so that only short texts are padded
                    start = np.minimum(place * WINDOW, np.maximum(size[doc] - WINDOW, 0))
                    at = (offsets[doc] + start)[:, None] + np.arange(WINDOW)
                    inside = (start[:, None] + np.arange(WINDOW)) < size[doc][:, None]
                    x = np.where(inside, raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint8)
                    weight = _LETTER_BYTE[x].sum(axis=1) + 1e-3
                    logs = net.log_probabilities(x) * weight[:, None]
                    full = np.flatnonzero(many)
                    first = (np.cumsum(many) - many)[full]
                    mean = np.add.reduceat(logs, first) / np.add.reduceat(weight, first)[:, None]
                    q = np.exp(mean - mean.max(axis=1, keepdims=True))
                    q /= q.sum(axis=1, keepdims=True)
                    names[i + full] = np.array(net.classes, dtype=object)[q.argmax(axis=1)]
                    scores[i + full] = np.clip(q.max(axis=1), 0, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return C.map_arrow(rows, run, schema)


def learned(docs: DataFrame, per_language: int = PER_LANGUAGE, cuts_each: int = CUTS_EACH) -> Net | None:
    return train(training_rows(docs, per_language, cuts_each))


def language_id(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == HELD_OUT).alias("held_out"), "text")
    return predict(rows, learned(docs), ["doc_id", "held_out"])


def with_known_language(docs: DataFrame, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told with ``least_score`` or more; ``lang`` is the predicted one."""
    known = predict(docs.select(*(F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)), "text"), learned(docs), [f"_c{i}" for i in range(len(docs.columns))])
    known = known.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return known.select(*(F.col("lang_pred" if c == "lang" else f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))


def op10_language_id(spark, sf_dir):
    return language_id(C.documents(spark, sf_dir))
