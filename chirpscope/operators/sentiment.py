"""Sentiment: lexicon polarity (a join, or an in-row lookup for tiny lexicons),
three-class labels, incremental scoring, a naive Bayes scorer and a plug-in model.

Polarity = mean lexicon score over all token hits of the text; no hit → 0.
Tokens are ``[a-z]+`` runs of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpscope import constants as C
from chirpscope.functions import text as TX
from chirpscope.operators.bloom import anti_join
from chirpscope.session import checkpoint_dir

TOKEN_PATTERN = "[a-z]+"
# a lexicon up to this many entries is applied in-row (map lookup is a linear scan)
INLINE_LEXICON_MAX = 64
# tokens of a lexicon or model that every task may hold, and the longest of them
COMMON_TOKENS = 100_000
COMMON_LENGTH = 64


def tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(TX.text_or_empty(c)), F.lit(TOKEN_PATTERN), 0)


def clean_lexicon(lexicon: DataFrame) -> DataFrame:
    """One score per token: null tokens and scores are left out, a repeated token has its mean."""
    return (lexicon.select(F.col("token").cast("string").alias("token"), F.col("score").cast("double").alias("score"))
            .where(F.col("token").isNotNull() & F.col("score").isNotNull())
            .groupBy("token").agg(F.avg("score").alias("score")))


def row_key(id_col: str, text_col: str) -> Column:
    """A key of (id, text): rows with equal keys have equal scores, null ids and texts included."""
    return F.sha2(F.concat_ws("\u0000", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), TX.text_or_empty(text_col)), 256)


def lexicon_polarity(df: DataFrame, lexicon: DataFrame, text_col: str = "tweet_text",
                     id_col: str = "tweet_id", out: str = "polarity", digits: int | None = 6) -> DataFrame:
    """Add ``out`` = mean score of the text's lexicon hits (0 when none) (NLP1, JN6, AGG12).

    Two plans, one result; each row's value depends on its own text only:
    * tiny lexicon (≤ INLINE_LEXICON_MAX, counted): an in-row map lookup — no
      explode, no shuffle, the text never leaves its task;
    * otherwise: one sum per key from the broadcast part of the lexicon, and distinct
      (key, token) counts for the tokens it lacks, if any (``token_sums``) → left join
      back on the key of (id, text).
    """
    lex = clean_lexicon(lexicon)
    pairs = lex.limit(INLINE_LEXICON_MAX + 1).collect()          # bounded
    if len(pairs) <= INLINE_LEXICON_MAX:
        if not pairs:
            pol = F.lit(0.0)
        else:
            m = F.map_from_arrays(F.lit([r["token"] for r in pairs]), F.lit([float(r["score"]) for r in pairs]))
            acc0 = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("c"))

            def step(acc, t):
                v = F.try_element_at(m, t)
                return F.struct((acc["s"] + F.coalesce(v, F.lit(0.0))).alias("s"),
                                (acc["c"] + F.when(v.isNull(), 0).otherwise(1)).alias("c"))

            pol = F.aggregate(tokens(text_col), acc0, step, lambda acc: F.when(
                acc["c"] > 0, acc["s"] / acc["c"]).otherwise(F.lit(0.0)))
        if digits is not None:
            pol = F.round(pol, digits) + F.lit(0.0)     # + 0.0 turns -0.0 into 0.0
        return df.withColumn(out, pol)
    checkpoint_dir(df.sparkSession)
    lex = lex.checkpoint(eager=True).withColumn("_seen", F.lit(0))
    if lex.count() > COMMON_TOKENS:
        # which tokens are frequent, in the lexicon or not, is seen in one row of 32; it changes no score
        some = df.where(F.pmod(F.xxhash64(id_col), F.lit(32)) == 0).select(F.explode(tokens(text_col)).alias("token"))
        lex = lex.drop("_seen").join(some.groupBy("token").agg(F.count(F.lit(1)).alias("_seen")), "token", "full").checkpoint(eager=True)
    common, rest = common_tokens(lex, F.col("_seen").desc_nulls_last(), F.length("token"))
    keyed = df.withColumn("_key", row_key(id_col, text_col))
    scores = token_sums(keyed, text_col, common, rest, {"score": None})
    pol = F.coalesce(F.try_divide("score", "_hits"), F.lit(0.0))
    if digits is not None:
        pol = F.round(pol, digits) + F.lit(0.0)
    kept = scores.select("_key", pol.alias("_pol"))
    return keyed.join(kept, "_key", "left").withColumn(out, F.coalesce("_pol", F.lit(0.0))).drop("_pol", "_key")


def common_tokens(table: DataFrame, *order: Column) -> tuple[DataFrame, DataFrame | None]:
    """The ``COMMON_TOKENS`` first tokens in ``order`` (none over ``COMMON_LENGTH``), to be broadcast, and
    the others: None if there are none.  ``table`` has one row a token; what no text yields is left out."""
    table = table.where(F.col("token").rlike(r"\A" + TOKEN_PATTERN + r"\z"))
    n, longest = table.agg(F.count(F.lit(1)), F.max(F.length("token"))).first()
    if n <= COMMON_TOKENS and (longest or 0) <= COMMON_LENGTH:
        return F.broadcast(table), None
    common = table.where(F.length("token") <= COMMON_LENGTH).orderBy(*order, "token").limit(COMMON_TOKENS)
    return F.broadcast(common), table.join(F.broadcast(common.select("token")), "token", "left_anti")


def token_sums(keyed: DataFrame, text_col: str, common: DataFrame, rest: DataFrame | None,
               values: dict[str, float | None]) -> DataFrame:
    """(_key, _rows, _hits, sum of each value column) over all tokens of all rows of a key.  A token that
    neither table holds, or holds without values, adds the given number, with None nothing; the others
    are ``_hits``.

    Tokens of ``common`` are summed up in the task that holds the text; only the others leave it."""
    first = next(iter(values))
    # an empty token more in each row counts the rows of a key in the same pass
    every = (keyed.select("_key", F.explode(F.concat(tokens(text_col), F.array(F.lit("")))).alias("token"))
             .join(common.select("token", F.lit(True).alias("_c"), *values), "token", "left"))
    row, found = F.col("token") == "", F.col(first).isNotNull()
    other = ~row & F.col("_c").isNull()
    sums = [F.sum(F.when(row, 1).otherwise(0)).alias("_rows"), F.sum(F.when(found, 1).otherwise(0)).alias("_hits"),
            F.sum(F.when(other, 1).otherwise(0)).alias("_n"), *[F.sum(F.coalesce(F.col(v), F.when(F.col("_c"), F.lit(miss)))).alias(v) for v, miss in values.items()]]
    if rest is None:
        part = every.groupBy("_key").agg(*sums).withColumns({f"_{v}": F.lit(None).cast("double") for v in values})
        seen = F.lit(False)
    else:
        # what is summed up already goes under a name that is no token, one of many
        name = F.when(other, F.col("token")).otherwise(F.concat(F.lit("#"), F.pmod(F.xxhash64("_key"), F.lit(4096)).cast("string")))
        part = (every.groupBy("_key", name.alias("_t")).agg(*sums)
                .join(rest.select(F.col("token").alias("_t"), *[F.col(v).alias(f"_{v}") for v in values]), "_t", "left"))
        seen = F.col(f"_{first}").isNotNull()
    total = [F.sum(F.coalesce(F.col(v), F.lit(0.0)) + F.col("_n") * F.coalesce(F.col(f"_{v}"), F.lit(0.0 if miss is None else miss))).alias(v)
             for v, miss in values.items()]
    return part.groupBy("_key").agg(F.sum("_rows").alias("_rows"), F.sum(F.col("_hits") + F.when(seen, F.col("_n")).otherwise(0)).alias("_hits"), *total)


def score_lexicon(df: DataFrame, lexicon: DataFrame, text_col: str = "tweet_text",
                  id_col: str = "tweet_id") -> DataFrame:
    """Polarity once, then the class from it (NLP1 + NLP2); ``sentiment`` overwritten."""
    p = lexicon_polarity(df, lexicon, text_col, id_col)
    return p.withColumn("sentiment", TX.polarity_class("polarity"))


def incremental_scoring(posts: DataFrame, scored_keys: DataFrame | None, lexicon: DataFrame,
                        key: str = "tweet_id") -> DataFrame:
    """Only posts not scored yet (left anti on the key), scored (NLP3, JN1)."""
    todo = posts if scored_keys is None else anti_join(posts, scored_keys, key)
    return score_lexicon(todo, lexicon, id_col=key)


# ---------------------------------------------------------------------------
# naive Bayes scoring (NLP4), fitted and applied with aggregations and joins
# ---------------------------------------------------------------------------

@dataclass
class NaiveBayes:
    """``tokens``: token, its number n and its log-probability in each class (columns lp0, lp1, …);
    ``prior`` and ``unseen``: log-probabilities of each class and of a token it never held."""

    classes: list[str]
    tokens: DataFrame
    prior: list[float]
    unseen: list[float]


def fit_naive_bayes(labelled: DataFrame, text_col: str = "text", label_col: str = "label",
                    max_fit_rows: int | None = None) -> NaiveBayes:
    """Multinomial naive Bayes with add-one smoothing over whole texts.  ``max_fit_rows`` (off by
    default) bounds the labelled rows, drawn by hash.  Only the classes' totals reach the driver."""
    import math
    rows = labelled.select(F.col(label_col).alias("label"), tokens(text_col).alias("t")).where("label is not null")
    if max_fit_rows is not None:
        rows = rows.orderBy(F.xxhash64("label", "t")).limit(max_fit_rows)
    counts = rows.select("label", F.explode("t").alias("token")).groupBy("label", "token").agg(F.count(F.lit(1)).alias("n"))
    checkpoint_dir(labelled.sparkSession)
    counts = counts.checkpoint(eager=True)          # the texts are read once
    docs = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sums = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    words = counts.select("token").distinct().count()
    classes = sorted(docs)
    total = [sums.get(c, 0) + words for c in classes]
    lp = [F.log((F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)) + 1) / F.lit(float(max(n, 1)))).alias(f"lp{k}")
          for k, (c, n) in enumerate(zip(classes, total))]
    table = counts.groupBy("token").agg(F.sum("n").alias("n"), *lp) if classes else counts.select("token", "n")
    return NaiveBayes(classes, table, [math.log(docs[c] / sum(docs.values())) for c in classes],
                      [math.log(1.0 / max(n, 1)) for n in total])


def score_naive_bayes(df: DataFrame, model: NaiveBayes, text_col: str = "tweet_text", id_col: str = "tweet_id",
                      digits: int = 6) -> DataFrame:
    """Add ``label`` (most probable class, ties by name) and ``score`` (its probability) from the
    whole text; without any class both are null."""
    if not model.classes:
        return df.withColumn("label", F.lit(None).cast("string")).withColumn("score", F.lit(None).cast("double"))
    k = range(len(model.classes))
    keyed = df.withColumn("_key", row_key(id_col, text_col))
    # the most frequent tokens are broadcast
    common, rest = common_tokens(model.tokens.select("token", "n", *[F.col(f"lp{i}").alias(f"_s{i}") for i in k]), F.col("n").desc())
    part = token_sums(keyed, text_col, common, rest, {f"_s{i}": model.unseen[i] for i in k})
    out = keyed.join(part, "_key", "left")
    for i in k:
        out = out.withColumn(f"_s{i}", F.coalesce(F.col(f"_s{i}") / F.col("_rows"), F.lit(0.0)) + F.lit(model.prior[i]))
    top = F.array_max(F.array(*[F.col(f"_s{i}") for i in k]))
    out = out.withColumn("_m", top)
    label = F.coalesce(*[F.when(F.col(f"_s{i}") == F.col("_m"), F.lit(model.classes[i])) for i in k])
    share = F.lit(1.0) / sum((F.exp(F.col(f"_s{i}") - F.col("_m")) for i in k), F.lit(0.0))
    return (out.withColumn("label", label).withColumn("score", F.round(share, digits))
            .drop("_key", "_m", "_rows", "_hits", *[f"_s{i}" for i in k]))


# ---------------------------------------------------------------------------
# plug-in model: a caller's function, loaded once per partition
# ---------------------------------------------------------------------------

Predict = Callable[[list[str]], list[tuple[str, float]]]


def score_model(df: DataFrame, load: Callable[[], Predict], text_col: str = "tweet_text",
                max_chars: int | None = None) -> DataFrame:
    """Add ``label`` / ``score`` from a caller's model over whole texts (NLP4, FN9).

    Only the texts go to Python, in Arrow batches; the model is loaded once per partition.  A failing
    batch is retried row by row; a failing row gets label ``ERROR`` and a null score.  ``max_chars``
    cuts the texts for models that ask for it (FN8)."""
    @F.pandas_udf("label string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(text: str) -> tuple:
            try:
                return model([text])[0]
            except Exception:
                return C.MODEL_ERROR_LABEL, None

        for texts in batches:
            texts = texts.fillna("").astype(str).tolist()
            try:
                found = model(texts)
            except Exception:
                found = [one(t) for t in texts]
            yield pd.DataFrame({"label": [f[0] for f in found], "score": pd.Series([f[1] for f in found], dtype="float64")})

    text = TX.text_or_empty(text_col) if max_chars is None else TX.truncate_chars(text_col, max_chars)
    return df.withColumn("_p", predict(text)).withColumn("label", F.col("_p.label")).withColumn("score", F.col("_p.score")).drop("_p")


def fixture_lexicon(spark) -> DataFrame:
    """The small inline lexicon used by the catalogue (token, score)."""
    # fixed values: test lexicon of the driver fixtures
    rows = [("the", 0.5), ("und", -0.6), ("le", 0.2), ("and", -0.1),
            ("der", 0.3), ("la", -0.4), ("de", 0.1), ("por", 0.7)]
    return spark.createDataFrame(rows, "token string, score double")


def class_from_labels(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Driver ``labels`` as classes: quality=1 positive, toxic=1 negative, else neutral."""
    return (F.when(F.col(quality) == 1, F.lit(C.POSITIVE))
            .when(F.col(toxic) == 1, F.lit(C.NEGATIVE))
            .otherwise(F.lit(C.NEUTRAL)))
