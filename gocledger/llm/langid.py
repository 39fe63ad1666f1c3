"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed byte 3-grams of its letters.  Per
language, spherical k-means over a bounded sample of labelled texts gives several
centroids; a text takes the language of the centroid with the largest cosine and
is marked as rejected when it lies farther from it than almost all of the
centroid's own texts.

The document frequencies of the grams are counted over all labelled texts (sums of
fixed width, one per task).  Only the centroids are fitted on a sample: about
``fit_rows`` vectors of fixed width, the same number of every language and at least
one, chosen by a seeded hash of doc_id and made by the executors.  No language is
left out, so the sample has max(fit_rows, languages) rows at most, and the model
that prediction broadcasts no more centroids than that (16 KB each).  Prediction is
a narrow map over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import CHUNK_BYTES, arrow_map, utf8

DIMS = 4096
CLUSTERS = 3
FIT_ROWS = 4000
ROUNDS = 12
#: Languages up to which their table of counts is broadcast (a name and two numbers each).
BROADCAST_LANGS = 20_000
#: Part of a centroid's own texts that may lie beyond the rejection distance.
REJECT = 0.005
UNDETERMINED = "und"
SEED = 5

_LETTER = re.compile(r"[^\W\d_]")
_TABLE = np.full(256, 32, dtype=np.uint32)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed byte 3-grams of a whole text; all but letters count as one blank."""
    data = utf8(text)
    out = np.zeros(DIMS, dtype=np.float32)
    for at in range(0, max(len(data) - 2, 0), CHUNK_BYTES):
        b = _TABLE[np.frombuffer(data[at:at + CHUNK_BYTES + 2], dtype=np.uint8)]
        blank = b == 32
        ok = ~(blank[:-1] & blank[1:])
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        code = code[ok[:-1] & ok[1:]]
        out += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


@dataclass
class Model:
    """idf (DIMS), centroids (n, DIMS, unit length), language and least cosine of each centroid."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    least: np.ndarray


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def idf_of(n: int, frequencies: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of every gram slot, from ``n`` texts."""
    return (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)


def fit(counts: np.ndarray, langs: Sequence[str], clusters: int = CLUSTERS, seed: int = SEED,
        idf: np.ndarray | None = None) -> Model:
    """Model of labelled gram counts; ``idf``: of the whole corpus (default: of these counts)."""
    if idf is None:
        idf = idf_of(len(counts), (counts > 0).sum(axis=0))
    x = _unit(np.log1p(counts) * idf)
    names = np.array(langs)
    rng = np.random.Generator(np.random.PCG64(seed))
    cents, owners, least = [], [], []
    for lang in sorted(set(langs)):
        own = x[names == lang]
        c = own[np.sort(rng.choice(len(own), size=min(clusters, len(own)), replace=False))]
        for _ in range(ROUNDS):
            near = np.argmax(own @ c.T, axis=1)
            c = _unit(np.stack([own[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))]))
        cos = own @ c.T
        near = np.argmax(cos, axis=1)
        for i in range(len(c)):
            mine = cos[near == i, i]
            cents.append(c[i])
            owners.append(lang)
            least.append(float(np.quantile(mine, REJECT)) if len(mine) else 1.0)
    width = counts.shape[1] if len(counts) else DIMS
    return Model(idf, np.stack(cents) if cents else np.zeros((0, width), np.float32), owners, np.array(least))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """The IDF of every gram slot over a whole column of texts (column ``text``, no nulls)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(DIMS + 1, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                found[:DIMS] += gram_counts(t.as_py()) > 0
            n += len(batch)
        found[DIMS] = n  # the last slot counts texts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1, dtype=np.int32)), pa.array(found)], names=["slot", "n"])

    per_slot = texts.mapInArrow(sums, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(DIMS + 1, dtype=np.int64)
    total[per_slot.column("slot").to_numpy()] = per_slot.column("n").to_numpy()
    return idf_of(int(total[DIMS]), total[:DIMS])


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS,
          clusters: int = CLUSTERS, seed: int = SEED) -> Model:
    """Model learned from the rows of ``docs`` with a label and a letter: document frequencies
    from all of them, centroids from about ``fit_rows``, the same number of each language as far
    as there are and one at least (smallest seeded hashes first).

    Rows with a null label or text do not count; without any usable row the model is empty.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        ((F.xxhash64(F.lit(seed), F.col(doc_id), F.xxhash64(F.col(text))) / F.lit(float(1 << 63))) / 2 + 0.5).alias("u"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n_langs = sizes.count()
    if not n_langs:
        return fit(np.zeros((0, DIMS), np.float32), [])
    each = max(1, fit_rows // n_langs)
    # Twice the share, then the exact number by rank: the window sees about 2 * fit_rows rows.  The
    # first of each language is taken in any case.
    share = sizes.select("lang", (F.lit(2.0 * each) / F.col("n") + 1e-6).alias("share"))
    first = rows.groupBy("lang").agg(F.min("u").alias("first"))
    share = share.join(first, "lang")
    met = rows.join(F.broadcast(share) if n_langs <= BROADCAST_LANGS else share, "lang")
    some = met.where((F.col("u") < F.col("share")) | (F.col("u") == F.col("first"))).drop("share", "first")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u"))
    picked = some.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "text", "u")

    def vectors(batch: pa.RecordBatch) -> dict:
        return {"grams": [gram_counts(t.as_py()).tobytes() for t in batch.column(batch.schema.get_field_index("text"))]}

    got = arrow_map(picked, vectors, T.StructType([T.StructField("grams", T.BinaryType())]), keep=["lang", "u"]).toArrow()
    order = np.argsort(got.column("u").to_numpy(), kind="stable")
    counts = np.frombuffer(b"".join(got.column("grams").to_pylist()), dtype=np.float32).reshape(-1, DIMS)
    langs = got.column("lang").to_pylist()
    return fit(counts[order], [langs[i] for i in order], clusters, seed, document_frequencies(rows.select("text")))


ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("rejected", T.BooleanType())])


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` plus lang_pred, score (cosine with the nearest centroid, 0 to 1) and rejected.

    ``und``, 0 and rejected for null texts, texts without a letter, and under an
    empty model.  Every other text gets a learned language; ``rejected`` tells
    that it is farther from its centroid than nearly all learned texts.  Ties go
    to the first language in code-point order.  Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> dict:
        m = shared.value
        texts = batch.column(batch.schema.get_field_index(text))
        out: dict[str, list] = {n: [] for n in ADDED.names}
        for at in range(0, len(texts), 256):
            part = [t.as_py() for t in texts[at:at + 256]]
            usable = np.array([has_letter(t) and len(m.langs) > 0 for t in part])
            if len(m.langs):
                cos = _unit(np.log1p(np.stack([gram_counts(t) for t in part])) * m.idf) @ m.centroids.T
                best = np.argmax(cos, axis=1)
                top = np.clip(cos[np.arange(len(part)), best], 0, 1)
            else:
                best = top = np.zeros(len(part), dtype=np.int64)
            out["lang_pred"] += [m.langs[b] if u else UNDETERMINED for b, u in zip(best.tolist(), usable.tolist())]
            out["score"] += np.where(usable, top, 0.0).astype(float).tolist()
            out["rejected"] += [not u or t < m.least[b] for t, b, u in zip(top.tolist(), best.tolist(), usable.tolist())]
        out["rejected"] = [bool(x) for x in out["rejected"]]
        return out

    return arrow_map(docs, rows, ADDED, keep)
