"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few dozen shape features (``features``), each feature is cut into at most
``BINS`` quantile bins, and the model is one lookup table per feature plus one per chosen pair of
features.  Tables are learned by cyclic boosting: in every round each feature in turn fits one
shallow tree (at most ``LEAVES`` leaves over its bins) to the gradient of the log loss, shrunk by
``RATE``, and the tree is added to the feature's table.  Then the pairs that explain most of what
is left are boosted the same way with trees of one cut on either side.  A score is the logistic
of the intercept plus vectorised table look-ups; lang, source and ids play no part.

The fit runs on at most ``fit_rows`` labelled rows (a documented bound, drawn by hash from all
labelled rows); features and scores cover every document and whole texts.

Cases: null text is an empty text and gets a score like any other; rows with a null label are not
learned from; repeated rows are scored (and learned) one by one; without any label every score is
0.5, and ``good_documents`` then rejects nothing; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

FIT_ROWS = 20_000
BINS = 64
LEAVES = 4
RATE = 0.15
ROUNDS = 60
PAIRS = 8
PAIR_BINS = 12
PAIR_ROUNDS = 25
THRESHOLD = 0.7

FEATURES = ("log_bytes", "word_len", "upper", "symbol", "digit", "comma_stop", "distinct_words", "repeated_next",
            "newline", "repeated_lines", "pipe", "bang", "symbol_end", "capital_words", "line_len", "other_alphabet",
            "one_letter", "line_upper", "line_symbol", "line_repeat", "long_words", "caps_words")

_CLASS = {
    "upper": range(65, 91), "lower": [*range(97, 123), *range(0xC3, 0xE0)], "digit": range(48, 58),
    "symbol": b"!#$%&*|@^~_=+<>{}[]\\/", "stop": b".,", "pipe": b"|", "bang": b"!", "newline": b"\n",
    "wide": range(0x80, 0xC0)}
_MASK = {k: U.byte_class(v) for k, v in _CLASS.items()}


def _per(sums: np.ndarray, off: np.ndarray) -> np.ndarray:
    return (sums[off[1:]] - sums[off[:-1]]).astype(np.float64)


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _max_by(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, group, value)
    return out


def _distinct(group: np.ndarray, prints: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct fingerprints of each group (``group`` is sorted)."""
    if not len(prints):
        return np.zeros(n)
    order = np.lexsort((prints, group))
    g, p = group[order], prints[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1])
    return np.bincount(g[first], minlength=n).astype(np.float64)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The features of all texts, one row each."""
    n, size = len(off) - 1, np.diff(off).astype(np.float64)
    if not n:
        return np.zeros((0, len(FEATURES)), np.float32)
    runs = {k: _running(m[data]) for k, m in _MASK.items()}
    count = {k: _per(r, off) for k, r in runs.items()}
    s, e, words = U.word_spans(data, off, U.NOSPACE)
    doc = np.repeat(np.arange(n), words)
    prints = U.Prints(data)
    word = prints.of(s, e) if len(s) else np.zeros(0, np.uint64)
    length = (e - s).astype(np.float64)
    per_word = lambda flag: np.bincount(doc[flag], minlength=n) / np.maximum(words, 1)
    again = np.zeros(len(s), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    first, last = (data[s], data[e - 1]) if len(s) else (np.zeros(0, np.uint8),) * 2
    capitals = runs["upper"][e] - runs["upper"][s]
    # lines
    breaks = np.flatnonzero(data == 10)
    ls = np.union1d(off[:-1][size > 0], breaks + 1)
    ls = ls[ls < len(data)]
    le = np.append(ls[1:], len(data))
    line_doc = np.searchsorted(off, ls, "right") - 1
    width = np.maximum(le - ls, 1).astype(np.float64)
    lines = np.bincount(line_doc, minlength=n).astype(np.float64)
    over = lambda r: r[le] - r[ls]
    line_words = np.searchsorted(s, le) - np.searchsorted(s, ls)
    rep = _running(again)
    line_rep = (rep[np.searchsorted(s, le)] - rep[np.searchsorted(s, ls)]) / np.maximum(line_words, 4)
    body = np.maximum(size, 1)
    letters = np.maximum(count["upper"] + count["lower"], 1)
    some = np.maximum(words, 1)
    out = np.stack([
        np.log1p(size), np.bincount(doc, length, minlength=n) / some, count["upper"] / letters, count["symbol"] / body,
        count["digit"] / body, count["stop"] / some, _distinct(doc, word, n) / some, per_word(again),
        count["newline"] / some,
        1 - _distinct(line_doc, prints.of(ls, le) if len(ls) else word[:0], n) / np.maximum(lines, 1),
        count["pipe"] / some, count["bang"] / some, per_word(_MASK["symbol"][last]), per_word(_MASK["upper"][first]),
        np.log1p(size / np.maximum(lines, 1)), count["wide"] / body, per_word(length <= 1),
        _max_by(line_doc, over(runs["upper"]) / width, n), _max_by(line_doc, over(runs["symbol"]) / width, n),
        _max_by(line_doc, line_rep, n), per_word(length > 20), per_word((capitals >= 2) & (capitals * 2 >= length))], axis=1)
    return out.astype(np.float32)


#: Bytes of text whose features are computed at once: the work arrays hold some 150 times as much.
FEATURE_BYTES = 256 << 10


def _features(text: pa.Array) -> np.ndarray:
    """Features of a batch, some texts at a time."""
    groups = U.bulk([pa.RecordBatch.from_arrays([text], ["text"])], "text", FEATURE_BYTES)
    return np.concatenate([features(*U.text_bytes(g.column("text"))) for g in groups] or [np.zeros((0, len(FEATURES)), np.float32)])


def features_udf():
    def run(text: pa.Array) -> pa.Array:
        f = _features(text)
        return pa.ListArray.from_arrays(np.arange(len(f) + 1, dtype=np.int32) * len(FEATURES), pa.array(f.reshape(-1)))
    run.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<float>")


# --- the model ---------------------------------------------------------------------------


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values over ordered bins of the greedy tree with at most ``leaves`` leaves."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain_of = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                c = np.arange(a + 1, b)
                gain = gain_of(a, c) + gain_of(c, b) - gain_of(a, b)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], k, int(c[i]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best table with one cut on either side, and its gain."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    a, b = g.shape
    corners = lambda c: np.stack([
        c[1:a, 1:b], c[1:a, b:] - c[1:a, 1:b], c[a:, 1:b] - c[1:a, 1:b], c[a:, b:] - c[1:a, b:] - c[a:, 1:b] + c[1:a, 1:b]])
    if a < 2 or b < 2:
        return np.zeros_like(g), 0.0
    sg, sh = corners(cg), corners(ch)
    gain = (sg ** 2 / (sh + 1.0)).sum(axis=0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = sg[:, i, j] / (sh[:, i, j] + 1.0)
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return out, float(gain[i, j])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Additive:
    """Bin edges, one table per feature, chosen pairs and their tables."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
        n, k = x.shape
        self.learned = n > 0
        self.edges, self.coarse = [], []
        for f in range(k):
            for bins, keep in ((BINS, self.edges), (PAIR_BINS, self.coarse)):
                keep.append(np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)).astype(np.float32) if n else np.zeros(0, np.float32))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        self.start = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))) if n else 0.0
        if n:
            self._fit(x, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        k = x.shape[1]
        fine, rough = self._bins(x, self.edges), self._bins(x, self.coarse)
        z = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            for f in range(k):
                p = _logistic(z)
                size = len(self.tables[f])
                step = RATE * _tree(np.bincount(fine[f], y - p, size), np.bincount(fine[f], p * (1 - p), size), LEAVES)
                self.tables[f] += step
                z += step[fine[f]]
        p = _logistic(z)
        found = []
        for a in range(k):
            for b in range(a + 1, k):
                found.append((self._grid(rough, a, b, y - p, p * (1 - p))[1], a, b))
        self.pairs = [(a, b) for _, a, b in sorted(found, reverse=True)[:PAIRS]]
        self.pair_tables = [np.zeros((len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)) for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for t, (a, b) in zip(self.pair_tables, self.pairs):
                p = _logistic(z)
                step = RATE * self._grid(rough, a, b, y - p, p * (1 - p))[0]
                t += step
                z += step[rough[a], rough[b]]

    def _grid(self, rough, a, b, g, h):
        shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
        cell = rough[a] * shape[1] + rough[b]
        return _quadrants(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        if len(x):
            fine, rough = self._bins(x, self.edges), self._bins(x, self.coarse)
            for f, t in enumerate(self.tables):
                z += t[fine[f]]
            for t, (a, b) in zip(self.pair_tables, self.pairs):
                z += t[rough[a], rough[b]]
        return _logistic(z)


# --- on Spark ----------------------------------------------------------------------------


def id_hash(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text (a null id as empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def with_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    U.small_batches(docs.sparkSession)
    return U.stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), features_udf()(F.col(text_col)).alias("x")), "quality-features")


def fit(known: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS,
        learn_from: Column | None = None) -> Additive:
    """Learn from a frame of ``with_features`` and a table of labels by ``doc_id``."""
    seen = labels.select("doc_id", F.col(label).cast("double").alias("y")).filter("y is not null")
    seen = seen.filter(learn_from if learn_from is not None else F.pmod(id_hash(), F.lit(4)) != 2)
    rows = U.stored(known.join(seen, "doc_id").select("x", "y", F.xxhash64("doc_id", "x", "y").alias("h")), "quality-labelled")
    n = rows.count()
    share = min(1.0, 1.1 * fit_rows / max(n, 1))
    drawn = rows.filter(F.col("h") <= min(2 ** 63 - 1, int(-2 ** 63 + share * 2 ** 64))).orderBy("h").limit(fit_rows).toArrow()
    x = np.array(drawn.column("x").to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return Additive(x, drawn.column("y").to_numpy())


def score_features(model: Additive):
    def run(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return pa.array(model.score(flat))
    run.__annotations__ = {"x": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")


def score_texts(model: Additive):
    def run(text: pa.Array) -> pa.Array:
        return pa.array(model.score(_features(text)))
    run.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    known = with_features(docs)
    model = fit(known, labels, **options)
    out = known.select("doc_id", (F.pmod(id_hash(), F.lit(4)) == 2).alias("held_out"), score_features(model)(F.col("x")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that the classifier does not reject, all columns kept; all documents if it
    saw no labelled row."""
    model = fit(with_features(docs, text_col=text_col), labels, **options)
    if not model.learned:
        return docs
    U.small_batches(docs.sparkSession)
    return docs.filter(score_texts(model)(F.col(text_col)) >= THRESHOLD)
