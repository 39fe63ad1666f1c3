"""Toxicity by a classifier chain.

The categories are predicted one after another by linear (logistic) models; each
model sees the text's features and the probabilities of the categories before
it.  While training, those earlier probabilities are out-of-fold predictions, so
a later model learns from what an earlier one really knows about unseen texts.

Features are hashed distinct words and word beginnings of the whole text (a
stem's inflections share their beginnings); each model keeps the features that
tell its category apart best.  The fit sees at most ``fit_rows`` labelled rows,
chosen by a seeded hash of doc_id.  Their features are counted in Spark by feature,
categories and fold (at most 2^HASH_BITS features), all models choose theirs from
those counts, and only the chosen features of each row (at most MAX_FEATURES a
model) come to the driver, however long the texts are; prediction is a narrow map over whole texts with a broadcast model of
bounded width.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import Scratch, alnum_words, arrow_map, shield

HASH_BITS = 20
PREFIXES = (4, 5, 6)
FIT_ROWS = 4000
MAX_FEATURES = 1024
#: A feature counts if it stands in so many fitted texts.
MIN_DOCS = 5
#: Least standard score of a feature's difference between the classes; below it is chance.
MIN_SCORE = 4.0
FOLDS = 3
ROUNDS = 300
PENALTY = 1e-4
REJECT_AT = 0.5
SEED = 9
_CACHE = 1 << 18

#: The chain over the labels table: category, SQL condition (null: not in the category).
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"), ("toxic_low_quality", "toxic = 1 AND quality = 0"))


def word_features(word: bytes) -> list[int]:
    """Hashed numbers of the word and of its beginnings."""
    mask = (1 << HASH_BITS) - 1
    return [zlib.crc32(word) & mask,
            *(zlib.crc32(word[:p], p) & mask for p in PREFIXES if len(word) > p)]


def text_features(text: str | None) -> list[int]:
    """Sorted distinct feature numbers of a whole text."""
    found: set[int] = set()
    for words in alnum_words(text):
        for w in set(words):
            found.update(word_features(w))
    return sorted(found)


# ------------------------------------------------------------------ fitting
@dataclass
class Linear:
    """A logistic model over chosen features and the probabilities of earlier categories."""

    features: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: float

    def logit(self, x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return x @ self.weights + earlier @ self.chained + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Feature numbers of fitted texts, as (row, feature) pairs."""

    def __init__(self, lists: Sequence[Sequence[int]]) -> None:
        self.n = len(lists)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.feature = np.concatenate([np.asarray(x, np.int64) for x in lists]) if self.row.size else np.zeros(0, np.int64)

    def dense(self, features: np.ndarray, pick: np.ndarray) -> np.ndarray:
        """0/1 matrix of the picked rows over the (sorted) features."""
        where = np.full(self.n, -1)
        where[pick] = np.arange(len(pick))
        at = np.searchsorted(features, self.feature)
        ok = (at < len(features)) & (where[self.row] >= 0)
        ok[ok] = features[at[ok]] == self.feature[ok]
        out = np.zeros((len(pick), len(features)), np.float32)
        out[where[self.row[ok]], at[ok]] = 1
        return out


@dataclass
class Counts:
    """Fitted texts by (feature, categories as bits, fold): columns of equal length; and for each
    (categories, fold) the texts in all and the weight of one."""

    feature: np.ndarray
    kind: np.ndarray
    fold: np.ndarray
    n: np.ndarray
    texts: dict[tuple[int, int], int]
    weight: dict[int, float]

    def best(self, category: int, folds: Sequence[int]) -> np.ndarray:
        """The features whose presence differs most between the classes (score test) over the texts
        of these folds, sorted."""
        use = np.isin(self.fold, folds)
        f, n, kind = self.feature[use], self.n[use].astype(float), self.kind[use]
        names, at = np.unique(f, return_inverse=True)
        w = n * np.array([self.weight.get(k, 1.0) for k in range(max(self.weight, default=0) + 1)])[kind]
        docs, seen = np.bincount(at, n), np.bincount(at, w)
        pos = np.bincount(at, w * (kind >> category & 1))
        total = sum(c * self.weight[k] for (k, d), c in self.texts.items() if d in folds)
        base = sum(c * self.weight[k] for (k, d), c in self.texts.items() if d in folds and k >> category & 1)
        rate = base / total
        spread = seen * (1 - seen / total) * rate * (1 - rate)
        score = np.where((docs >= MIN_DOCS) & (spread > 0), np.abs(pos - seen * rate) / np.sqrt(np.maximum(spread, 1e-12)), 0)
        top = np.argsort(-score, kind="stable")[:MAX_FEATURES]
        return np.sort(names[top[score[top] >= MIN_SCORE]])

    def chosen(self, categories: int) -> dict[tuple[int, int], np.ndarray]:
        """Features of every model: by category and the fold left out (-1: none)."""
        out = {}
        for c in range(categories):
            for left_out in range(-1, FOLDS):
                folds = [f for f in range(FOLDS) if f != left_out]
                known = {k >> c & 1 for (k, d) in self.texts if d in folds}
                out[c, left_out] = self.best(c, folds) if len(known) == 2 else np.zeros(0, np.int64)
        return out


def fit_linear(rows: _Rows, y: np.ndarray, weight: np.ndarray, earlier: np.ndarray, pick: np.ndarray,
               features: np.ndarray) -> Linear:
    """Weighted logistic regression over the given features with an L2 penalty, by accelerated gradient steps."""
    p = float(np.clip((weight[pick] * y[pick]).sum() / max(weight[pick].sum(), 1e-9), 1e-4, 1 - 1e-4)) if len(pick) else 1e-4
    bias = float(np.log(p / (1 - p)))
    if not len(pick) or len(np.unique(y[pick])) < 2:
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), bias)
    x = np.concatenate([rows.dense(features, pick), earlier[pick].astype(np.float32), np.ones((len(pick), 1), np.float32)], axis=1)
    t, w = y[pick].astype(np.float32), (weight[pick] / weight[pick].sum()).astype(np.float32)
    coef = np.zeros(x.shape[1], np.float32)
    coef[-1] = bias
    penalty = np.full(x.shape[1], PENALTY, np.float32)
    penalty[-1] = 0
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # largest curvature, for the step
        v = x.T @ (w * (x @ v))
        v /= max(float(np.linalg.norm(v)), 1e-9)
    step = 1 / (0.25 * float(np.linalg.norm(x.T @ (w * (x @ v)))) + PENALTY)
    look = coef
    for k in range(ROUNDS):
        grad = x.T @ (w * (_sigmoid(x @ look) - t)) + penalty * look
        new = look - step * grad
        look = new + (k / (k + 3)) * (new - coef)
        coef = new
    n = len(features)
    return Linear(features, coef[:n].astype(float), coef[n:-1].astype(float), float(coef[-1]))


@dataclass
class Chain:
    """Models in chain order, over one common sorted list of features."""

    names: list[str]
    features: np.ndarray
    weights: np.ndarray  # (features, categories)
    chained: list[np.ndarray]
    bias: list[float]

    def predict(self, sums: np.ndarray) -> np.ndarray:
        """Probabilities (rows, categories) from the summed feature weights of each row."""
        out = np.zeros_like(sums)
        for c in range(len(self.names)):
            out[:, c] = _sigmoid(sums[:, c] + out[:, :c] @ self.chained[c] + self.bias[c])
        return out


def fit_chain(lists: Sequence[Sequence[int]], y: np.ndarray, weight: np.ndarray, fold: np.ndarray,
              names: Sequence[str], chosen: dict[tuple[int, int], np.ndarray]) -> Chain:
    """Chain over labelled texts: y (rows, categories), ``fold`` numbers 0..FOLDS-1, ``chosen``: the
    features of each model (:meth:`Counts.chosen`)."""
    rows, every = _Rows(lists), np.arange(len(lists))
    earlier = np.zeros((len(lists), 0))
    models: list[Linear] = []
    for c in range(len(names)):
        target = y[:, c]
        held = np.zeros(len(lists))
        for f in range(FOLDS):
            test = np.flatnonzero(fold == f)
            if len(test):
                m = fit_linear(rows, target, weight, earlier, np.flatnonzero(fold != f), chosen[c, f])
                held[test] = _sigmoid(m.logit(rows.dense(m.features, test), earlier[test]))
        models.append(fit_linear(rows, target, weight, earlier, every, chosen[c, -1]))
        earlier = np.concatenate([earlier, held[:, None]], axis=1)
    features = np.unique(np.concatenate([m.features for m in models]))
    weights = np.zeros((len(features), len(names)))
    for c, m in enumerate(models):
        weights[np.searchsorted(features, m.features), c] = m.weights
    return Chain(list(names), features, weights, [m.chained for m in models], [m.bias for m in models])


def train(docs: DataFrame, labels: DataFrame, *, categories: Sequence[tuple[str, str]] = CATEGORIES, doc_id: str = "doc_id",
          text: str = "text", fit_rows: int = FIT_ROWS, seed: int = SEED) -> Chain:
    """Chain learned from at most ``fit_rows`` labelled rows of ``docs``: half of them in any
    category as far as there are, the rest in none, weighted back to their true shares.

    Rows without a label, with a null doc_id or a null text do not count; a
    repeated label counts once (any category it ever had).  Without usable rows,
    or with one class only, a category's model is its constant share.
    """
    names = [n for n, _ in categories]
    wanted = F.struct(*[F.coalesce(F.expr(cond), F.lit(False)).cast("int").alias(n) for n, cond in categories])
    one = (labels.where(F.col("doc_id").isNotNull()).select("doc_id", wanted.alias("y"))
           .groupBy(F.col("doc_id").alias("__id")).agg(*[F.max(f"y.{n}").alias(n) for n in names]))
    any_of = F.greatest(*map(F.col, names), F.lit(0)) if len(names) > 1 else F.col(names[0])
    order = F.xxhash64(F.lit(seed), F.col("__id"))
    sizes = {r["any"]: r["n"] for r in one.groupBy(any_of.alias("any")).agg(F.count(F.lit(1)).alias("n")).collect()}
    half = fit_rows // 2
    room = {1: half, 0: fit_rows - half}
    for a, b in ((1, 0), (0, 1)):  # a class with few rows leaves its room to the other
        room[a] += max(0, room[b] - sizes.get(b, 0))
    parts = [one.where(any_of == a).orderBy(order, "__id").limit(room[a]) for a in (0, 1)]
    # At most fit_rows rows: the bound of this broadcast.
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    body = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    joined = body.join(sample, body["__doc"] == F.col("__id"))

    def numbers(batch: pa.RecordBatch) -> dict:
        return {"features": [text_features(t.as_py()) for t in batch.column(batch.schema.get_field_index("__text"))]}

    scratch = Scratch(docs.sparkSession)
    kind = sum((F.col(n) * (1 << c) for c, n in enumerate(names)), F.lit(0))
    rows = scratch.cut(arrow_map(joined, numbers, T.StructType([T.StructField("features", T.ArrayType(T.IntegerType()))]),
                                 keep=["__id", *names])
                       .groupBy("__id").agg(F.min_by("features", F.struct(F.size("features"), F.xxhash64("features"))).alias("features"),
                                            *[F.max(n).alias(n) for n in names])
                       .select("__id", "features", kind.cast("int").alias("kind"),
                               F.pmod(F.xxhash64(F.lit(seed), F.lit("fold"), "__id"), F.lit(FOLDS)).cast("int").alias("fold")), "toxic-sample")
    texts = {(r["kind"], r["fold"]): r["n"] for r in rows.groupBy("kind", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = {a: sum(n for (k, _), n in texts.items() if (k > 0) == bool(a)) for a in (0, 1)}
    weight = {k: sizes.get(int(k > 0), 0) / found[int(k > 0)] for k, _ in texts}
    per = rows.select("kind", "fold", F.explode("features").alias("feature")).groupBy("feature", "kind", "fold").agg(F.count(F.lit(1)).alias("n"))
    often = per.groupBy("feature").agg(F.sum("n").alias("docs")).where(F.col("docs") >= MIN_DOCS).select("feature")
    table = per.join(often, "feature").toArrow()
    column = lambda n: table.column(n).to_numpy().astype(np.int64)
    chosen = Counts(column("feature"), column("kind"), column("fold"), column("n"), texts, weight).chosen(len(names))
    # At most MAX_FEATURES numbers for each model.
    wanted = np.unique(np.concatenate([*chosen.values(), np.zeros(0, np.int64)]))

    def of_interest(batch: pa.RecordBatch) -> dict:
        lists = batch.column(batch.schema.get_field_index("all"))
        return {"features": [np.intersect1d(v.values.to_numpy(), wanted).tolist() for v in lists]}

    got = (arrow_map(rows.withColumnRenamed("features", "all"), of_interest, T.StructType([T.StructField("features", T.ArrayType(T.IntegerType()))]), keep=["__id", "kind", "fold"])
           .orderBy(F.xxhash64("__id"), "__id").toArrow())
    scratch.release()
    kinds = got.column("kind").to_numpy()
    lists = [v.values.to_numpy() for v in got.column("features").combine_chunks()] if len(kinds) else []
    y = np.stack([(kinds >> c & 1).astype(float) for c in range(len(names))], axis=1) if len(kinds) else np.zeros((0, len(names)))
    return fit_chain(lists, y, np.array([weight[k] for k in kinds.tolist()]), got.column("fold").to_numpy(), names, chosen)


# ------------------------------------------------------------------ prediction
def predict(docs: DataFrame, chain: Chain, *, text: str = "text", reject_on: str = "toxic", reject_at: float = REJECT_AT,
            keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` plus p_<category> (double) for each category of the chain and rejected (boolean).

    ``rejected``: the probability of ``reject_on`` is at least ``reject_at``.
    Null, empty and word-free texts carry no evidence: probability 0 in every
    category, not rejected.  Repeated rows get equal results; input columns named
    like an added one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.names
    decisive = names.index(reject_on)
    add = T.StructType([*[T.StructField(f"p_{n}", T.DoubleType()) for n in names], T.StructField("rejected", T.BooleanType())])
    state: dict = {}

    def rows(batch: pa.RecordBatch) -> dict:
        model = shared.value
        number = state.setdefault("number", {f: i for i, f in enumerate(model.features.tolist())})
        known = state.setdefault("known", {})
        texts = batch.column(batch.schema.get_field_index(text))
        sums = np.zeros((len(texts), len(names)))
        words_in = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            found: set[int] = set()
            for words in alnum_words(t.as_py()):
                distinct = set(words)
                words_in[i] |= bool(distinct)
                for w in distinct:
                    own = known.get(w)
                    if own is None:
                        if len(known) >= _CACHE:
                            known.clear()
                        own = known[w] = tuple(number[f] for f in word_features(w) if f in number)
                    if own:
                        found.update(own)
            if found:
                sums[i] = model.weights[sorted(found)].sum(axis=0)
        p = np.where(words_in[:, None], model.predict(sums), 0.0)
        return {f"p_{n}": p[:, c] for c, n in enumerate(names)} | {"rejected": p[:, decisive] >= reject_at}

    return arrow_map(docs, rows, add, keep)


def remove_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that the chain, trained on ``docs`` and ``labels``, rejects."""
    chain = train(docs, labels, **options)
    safe, back = shield(docs, [*(f"p_{n}" for n in chain.names), "rejected"])
    marked = predict(safe, chain, text=options.get("text", "text"))
    return marked.where(~F.col("rejected")).select(*safe.columns).withColumnsRenamed(back)
