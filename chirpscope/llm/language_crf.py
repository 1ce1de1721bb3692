"""Language identification with a linear-chain conditional random field over words.

Every word is a position of the chain and every learned language a label.  A word's features are
its affixes and byte n-grams (cut from ``^word$``, so those at an edge are prefixes and suffixes)
and, for words of the training sample, the word itself (the lexicon).  Label weights, transitions
and start weights are learned by gradient ascent on the conditional likelihood; the training
chains splice runs of different languages, so the transitions know code-switched text.
Forward-backward then gives every word of a text its probability of each language.  A document's
language is the one with the largest mean probability, which is its score; ``label_runs`` gives
the labelled stretches themselves.

Forward-backward runs over all texts of a batch at once: chains are cut into blocks of ``BLOCK``
words whose transfer matrices carry the messages from block to block, so a text of any length
takes part whole.

The fit uses at most ``fit_rows`` labelled rows for each language (drawn by hash from all of
them) and ``WINDOWS`` stretches of each - documented bounds; predictions read whole texts and
nothing but the text.

Cases: null texts and texts without a letter give ``und`` with score 0, as does any text if
nothing could be learned; rows with a null language are not learned from; repeated rows are judged
one by one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpscope.llm import common as U

FIT_ROWS = 500
WINDOWS = 4
CHAIN = 48
ROUNDS = 60
STEP = 0.5
DECAY = 1e-4
NGRAMS = (2, 3, 4)
BUCKETS = 1 << 18
BLOCK = 32
SEED = 29
UNKNOWN = "und"

#: Word bytes after lower-casing: a-z and everything beyond ASCII.
LETTERS = U.byte_class([*range(97, 123), *range(0x80, 0x100)])


# --- features ------------------------------------------------------------------------------


def word_features(words: pa.Array, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after the other, and how many each has.  ``lexicon``:
    sorted fingerprints of the words that are features themselves."""
    data, off = U.text_bytes(words)
    n, lens = len(off) - 1, np.diff(off)
    start = off[:-1] + 2 * np.arange(n)
    padded = np.empty(len(data) + 2 * n, np.uint8)
    padded[start] = ord("^")
    padded[start + lens + 1] = ord("$")
    padded[np.arange(len(data)) + 2 * np.repeat(np.arange(n), lens) + 1] = data
    prints = U.Prints(padded)
    feats, owner = [], []
    for k in NGRAMS:
        count = np.maximum(lens + 3 - k, 0)
        at = U.spread(start, count)
        feats.append(prints.of(at, at + k))
        owner.append(np.repeat(np.arange(n), count))
    whole = prints.of(start, start + lens + 2)
    known = np.flatnonzero(np.isin(whole, lexicon))
    feats.append(whole[known])
    owner.append(known)
    owner, feats = np.concatenate(owner), (np.concatenate(feats) % np.uint64(BUCKETS)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return feats[order], np.bincount(owner, minlength=n)


def fingerprints(words: pa.Array) -> np.ndarray:
    data, off = U.text_bytes(pc.binary_join_element_wise(pa.scalar(b"^"), words, pa.scalar(b"$"), pa.scalar(b"")))
    return U.Prints(data).of(off[:-1], off[1:])


def cut_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all (lower-cased) texts, dictionary-coded; the words of each text; spans."""
    data, off = U.text_bytes(pc.utf8_lower(texts))
    s, e, n = U.word_spans(data, off, LETTERS)
    lens = e - s
    flat = data[U.spread(s, lens)]
    arr = pa.Array.from_buffers(pa.large_binary(), len(s), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))])
    first = np.repeat(off[:-1], n)
    return arr.dictionary_encode(), n, s - first, e - first


# --- the model ------------------------------------------------------------------------------


class Crf:
    def __init__(self, langs: list[str], lexicon: np.ndarray):
        self.langs, self.lexicon = langs, lexicon
        k = len(langs)
        self.w = np.zeros((BUCKETS, k), np.float32)
        self.trans, self.start = np.zeros((k, k)), np.zeros(k)

    def emissions(self, words: pa.Array) -> np.ndarray:
        feats, n = word_features(words, self.lexicon)
        return _sum_by(self.w[feats], n)

    def marginals(self, emit: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Probabilities of the labels of every word; ``words``: the length of each chain."""
        e = np.exp(emit - emit.max(axis=1, keepdims=True)).astype(np.float64)
        k, step = e.shape[1], np.exp(self.trans - self.trans.max())
        first = np.exp(self.start - self.start.max())
        blocks = -(-words // BLOCK)
        total = int(blocks.sum())
        head = np.cumsum(blocks) - blocks                         # first block of each chain
        chain = np.repeat(np.arange(len(words)), blocks)
        nth = np.arange(total) - head[chain]
        at = (np.cumsum(words) - words)[chain] + nth * BLOCK       # first word of each block
        size = np.minimum(BLOCK, words[chain] - nth * BLOCK)
        most = int(size.max(initial=0))
        # transfer matrix of each block: rows are the label before it, columns the one at its end
        move = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for j in range(most):
            live = np.flatnonzero(size > j)
            m = (move[live].reshape(-1, k) @ step).reshape(-1, k, k) * e[at[live] + j][:, None, :]
            move[live] = m / m.max(axis=(1, 2), keepdims=True)
        # messages into each block, from both sides
        ahead, behind = np.ones((total, k)), np.ones((total, k))
        live, r = np.flatnonzero(blocks > 0), 0
        a = np.zeros((len(words), k))
        while len(live):
            b = head[live] + r
            if r:
                ahead[b] = a[live]
                out = (a[live][:, None, :] @ move[b])[:, 0, :]
            else:                                                 # a chain begins with the start weights, not a step
                out = np.ones((len(live), k))
            a[live] = out / out.max(axis=1, keepdims=True)
            if r == 0:
                a[live] = self._first_block(e, at[b], size[b], first, step)
            r += 1
            live = live[blocks[live] > r]
        for r in range(int(blocks.max(initial=0)) - 1, 0, -1):
            live = np.flatnonzero(blocks > r)
            b = head[live] + r
            x = (move[b] @ behind[b][:, :, None])[:, :, 0]
            behind[b - 1] = x / x.max(axis=1, keepdims=True)
        # within the blocks
        alpha = np.empty_like(e)
        now = ahead
        for j in range(most):
            live = np.flatnonzero(size > j)
            x = now[live] @ step
            if j == 0:
                x[nth[live] == 0] = first
            x = x * e[at[live] + j]
            now[live] = x / x.max(axis=1, keepdims=True)
            alpha[at[live] + j] = now[live]
        now = behind
        for j in range(most - 1, -1, -1):
            live = np.flatnonzero(size > j)
            w = at[live] + j
            alpha[w] *= now[live]
            x = (now[live] * e[w]) @ step.T
            now[live] = x / x.max(axis=1, keepdims=True)
        return alpha / alpha.sum(axis=1, keepdims=True)

    @staticmethod
    def _first_block(e, at, size, first, step):
        x = first * e[at]
        x /= x.max(axis=1, keepdims=True)
        for j in range(1, int(size.max(initial=0))):
            live = np.flatnonzero(size > j)
            y = (x[live] @ step) * e[at[live] + j]
            x[live] = y / y.max(axis=1, keepdims=True)
        return x


def _sum_by(rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    if not len(n):
        return np.zeros((0, rows.shape[1]))
    total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
    end = np.cumsum(n)
    return total[end] - total[end - n]


def learn(windows: list[tuple[str, list[bytes]]], rounds: int = ROUNDS) -> Crf | None:
    """Fit on stretches of words of known language."""
    langs = sorted({l for l, w in windows if w})
    if not langs:
        return None
    rng = np.random.default_rng(SEED)
    windows = sorted((langs.index(l), w) for l, w in windows if w)
    vocabulary = pa.array(sorted({x for _, w in windows for x in w}), pa.binary())
    number = {x: i for i, x in enumerate(vocabulary.to_pylist())}
    model = Crf(langs, np.sort(fingerprints(vocabulary)))
    # chains of CHAIN words: half of one language, half spliced from two
    word, label = [], []
    for i, other in enumerate(rng.permutation(len(windows))):
        a, b = windows[i], windows[other if i % 2 else i]
        cut = int(rng.integers(1, CHAIN))
        seq = [(number[x], a[0]) for x in a[1][:cut]] + [(number[x], b[0]) for x in b[1][cut if b is a else 0:CHAIN - cut + (cut if b is a else 0)]]
        word.append([x for x, _ in seq])
        label.append([y for _, y in seq])
    lens = np.array([len(x) for x in word])
    order = np.argsort(-lens, kind="stable")
    lens = lens[order]
    ids, gold = np.zeros((len(lens), lens[0]), np.int64), np.zeros((len(lens), lens[0]), np.int64)
    for r, o in enumerate(order):
        ids[r, :lens[r]], gold[r, :lens[r]] = word[o], label[o]
    feats, n = word_features(vocabulary, model.lexicon)
    k = len(langs)
    truth, seen = np.zeros((len(vocabulary), k)), np.zeros((k, k))
    live = np.arange(ids.shape[1])[None, :] < lens[:, None]
    np.add.at(truth, (ids[live], gold[live]), 1)
    both = live[:, 1:]
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    begun = np.bincount(gold[:, 0], minlength=k).astype(float)
    used = np.unique(feats)
    feats = np.searchsorted(used, feats)
    w, scale = np.zeros((len(used), k)), float(live.sum())
    power = [np.full(x.shape, 1e-8) for x in (w, model.trans, model.start)]
    owner = np.repeat(np.arange(len(n)), n)
    for _ in range(rounds):
        emit = _sum_by(w[feats], n)
        expected, moved, opened = _expect(emit[ids], lens, model.trans, model.start)
        miss = truth.copy()
        np.add.at(miss, ids[live], -expected[live])
        grads = (np.stack([np.bincount(feats, miss[owner, j], len(used)) for j in range(k)], axis=1) / scale - DECAY * w,
                 (seen - moved) / scale, (begun - opened) / scale)
        for x, g, p in zip((w, model.trans, model.start), grads, power):
            p += g * g
            x += STEP * g / np.sqrt(p)
    model.w[used] = w
    return model


def _expect(emit: np.ndarray, lens: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Label probabilities, expected transitions and starts of chains sorted by falling length."""
    n, most, k = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    t = np.exp(trans - trans.max())
    alpha, beta = np.zeros((n, most, k)), np.ones((n, most, k))
    x = np.exp(start - start.max()) * e[:, 0]
    alpha[:, 0] = x / x.sum(axis=1, keepdims=True)
    live = [int((lens > j).sum()) for j in range(most)]
    for j in range(1, most):
        m = live[j]
        x = (alpha[:m, j - 1] @ t) * e[:m, j]
        alpha[:m, j] = x / x.sum(axis=1, keepdims=True)
    moved = np.zeros((k, k))
    for j in range(most - 1, 0, -1):
        m = live[j]
        y = e[:m, j] * beta[:m, j]
        x = y @ t.T
        beta[:m, j - 1] = x / x.sum(axis=1, keepdims=True)
        pair = alpha[:m, j - 1][:, :, None] * t[None] * y[:, None, :]
        moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    p = alpha * beta
    p /= np.maximum(p.sum(axis=2, keepdims=True), 1e-300)
    return p, moved, p[:, 0].sum(axis=0)


# --- on Spark ---------------------------------------------------------------------------------


def id_hash(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Crf | None:
    """Learn from labelled rows.  Counts of all rows set the share of each language that the
    hash lets through; the driver receives at most ``fit_rows`` rows a language, WINDOWS
    stretches of CHAIN words each."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = known.groupBy(F.col(lang_col).alias("lang")).count()
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(2 ** 63 - 1, -2 ** 63 + min(1.0, fit_rows / r["count"]) * 2 ** 64))) for r in counts.collect()],
        "lang string, most long")
    rows = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    drawn = rows.join(F.broadcast(share), "lang").filter("h <= most").select("lang", "text", "h")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n, _, _ = cut_words(b.column("text"))
            flat, at = words.dictionary.take(words.indices), 0
            out, langs, keys = [], [], []
            for lang, h, k in zip(b.column("lang").to_pylist(), b.column("h").to_pylist(), n.tolist()):
                rng = np.random.default_rng(h % (1 << 32))
                starts = np.unique(rng.integers(0, max(1, k - CHAIN), WINDOWS)) if k else []
                for s in starts:
                    out.append(flat.slice(at + int(s), min(CHAIN, k)).to_pylist())
                    langs.append(lang)
                    keys.append(h)
                at += k
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "words": pa.array(out, pa.list_(pa.binary())),
                                              "h": pa.array(keys, pa.int64())})

    U.small_batches(docs.sparkSession)
    most = share.count() * fit_rows * WINDOWS
    got = (drawn.mapInArrow(stretches, "lang string, words array<binary>, h long").orderBy("h", "words").limit(max(1, most)).collect())
    return learn([(r["lang"], [bytes(x) for x in r["words"]]) for r in got])


def predict(docs: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    U.small_batches(docs.sparkSession)
    size = U.GROUP_BYTES * 16 // max(16, len(model.langs) ** 2) if model else U.GROUP_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*(model.langs if model else []), UNKNOWN])
        for b in U.bulk(batches, "text", size):
            best, score = np.full(b.num_rows, len(names) - 1), np.zeros(b.num_rows)
            if model:
                p, n = _probabilities(model, b.column("text"))
                mean = _sum_by(p, n) / np.maximum(n, 1)[:, None]
                letter = pc.fill_null(pc.match_substring_regex(b.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False) & (n > 0)
                best = np.where(letter, mean.argmax(axis=1), best)
                score = np.where(letter, np.clip(mean.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "lang_pred": names.take(pa.array(best)), "score": score})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def _probabilities(model: Crf, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, n, _, _ = cut_words(texts)
    if not len(words):
        return np.zeros((0, len(model.langs))), n
    emit = model.emissions(words.dictionary)
    return model.marginals(emit[words.indices.to_numpy()], n), n


def label_runs(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and runs: stretches of words of one language, with byte offsets in the lower-cased
    text, language and mean probability."""
    U.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in U.bulk(batches, "text"):
            p, n = _probabilities(model, b.column("text"))
            _, _, s, e = cut_words(b.column("text"))
            out, at = [], 0
            for k in n.tolist():
                best = p[at:at + k].argmax(axis=1)
                cut = np.flatnonzero(np.diff(best)) + 1
                out.append([{"begin": int(s[at + x]), "end": int(e[at + y - 1]), "lang": model.langs[best[x]],
                             "prob": float(p[at + x:at + y, best[x]].mean())}
                            for x, y in zip([0, *cut], [*cut, k])] if k else [])
                at += k
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "runs": pa.array(out, pa.list_(pa.struct([
                ("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("prob", pa.float64())])))})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, runs array<struct<begin:long,end:long,lang:string,prob:double>>")


def language_ids(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; rows with crc32(doc_id) mod 5 = 0 are
    held out of learning."""
    held = F.pmod(id_hash(), F.lit(5)) == 0
    model = fit(docs.filter(~held), fit_rows=fit_rows)
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
