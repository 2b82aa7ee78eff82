"""Language identification by nearest centroid.

A text is the vector of its hashed byte 1- to 4-grams, with logarithmic counts, weighted by inverse document
frequency and brought to length one. Each language has several centroids, found by spherical k-means over its
training texts. A text gets the language of the centroid with the largest cosine; it is rejected if the cosine is
below what that centroid's own training texts have, all but a small share of them.

The fit takes a bounded sample: at most ``TRAIN_DOCS`` texts of each language, in the order of a hash of the text
id, and at most ``TRAIN_BYTES`` of text in all, taken evenly from the languages. Prediction covers every text as a whole.

Defined results: NULL texts, and texts without a letter, are ``und`` with score 0; so is everything if nothing could
be learned; equal cosines go to the language first by name; equal texts get equal results. Very long texts are one vector,
counted piece by piece; empty tables stay empty. Other columns are kept, and must not bear one of the names added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.common import flat, slices
from telemetry_lake.llm.grams import hashed, pieces

TRAIN_DOCS, TRAIN_BYTES = 800, 8 << 20
# Parts of a language whose first texts are found apart.
PARTS = 64
SIZES, BITS = (1, 2, 3, 4), 14
CENTROIDS, ROUNDS, SEED = 4, 8, 11
# Share of a centroid's training texts that lie beyond its rejection distance.
BEYOND = 0.005
CHUNK_BYTES = 4 << 20
UNKNOWN = "und"

_LATIN = re.compile(rb"[A-Za-z]")

ADDED = [
    T.StructField("language", T.StringType(), False),
    T.StructField("cosine", T.DoubleType(), False),
    T.StructField("rejected", T.BooleanType(), False),
]


def counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number and gram counts of each text that has any."""
    data, offsets = flat(column)
    size, open_text, total = 1 << BITS, -1, None
    for joined, owner in pieces(data, offsets):
        keys = [owner[np.minimum(at + 1, len(owner) - 1)] * size + bucket for at, bucket in hashed(joined, SIZES, BITS)]
        # A gram that begins with the blank between two texts belongs to the second one.
        found, number = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        text = found // size
        for i in np.unique(text).tolist():
            a, b = np.searchsorted(text, [i, i + 1])
            if i != open_text:
                if total is not None:
                    yield open_text, total
                open_text, total = i, np.zeros(size)
            total[found[a:b] - i * size] += number[a:b]
    if total is not None:
        yield open_text, total


def has_letter(text: bytes) -> bool:
    """Whether a text has a character of one of the letter categories; numerals of any script are none."""
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


class Centroids:
    def __init__(self, languages: list[str], names: np.ndarray, rows: np.ndarray, idf: np.ndarray, radius: np.ndarray):
        self.languages, self.names, self.rows, self.idf, self.radius = languages, names, rows, idf, radius

    def vector(self, total: np.ndarray) -> np.ndarray:
        vector = np.log1p(total) * self.idf
        return vector / max(np.sqrt(vector @ vector), 1e-12)

    def predict(self, column: pa.Array) -> list[tuple[str, float, bool]]:
        """Language, cosine and whether the text is too far from every centroid."""
        out = [(UNKNOWN, 0.0, True)] * len(column)
        if not len(self.rows):
            return out
        letters = [v.is_valid and has_letter(v.as_py()) for v in column.cast(pa.large_binary())]
        for i, total in counts(column):
            if letters[i]:
                cosines = self.rows @ self.vector(total)
                best = int(np.argmax(cosines))
                score = float(min(1.0, max(0.0, cosines[best])))
                out[i] = (self.languages[self.names[best]], score, bool(cosines[best] < self.radius[best]))
        return out


def fit(texts: list[str], languages: list[str]) -> Centroids:
    """Centroids of each language from whole texts."""
    size = 1 << BITS
    known = sorted(set(languages))
    # Only the counts that are not zero are kept of all texts; whole vectors are made of one language at a time.
    found, frequency = [], np.zeros(size)
    for i, total in counts(pa.array(texts, pa.large_string())):
        at = np.flatnonzero(total)
        frequency[at] += 1
        found.append((i, at.astype(np.uint16), total[at].astype(np.float32)))
    idf = np.log((1.0 + len(found)) / (1.0 + frequency)) + 1.0
    model = Centroids(known, np.zeros(0, int), np.zeros((0, size)), idf, np.zeros(0))
    random = np.random.default_rng(SEED)
    names, rows, radius = [], [], []
    for number, language in enumerate(known):
        mine = [(at, number_of) for i, at, number_of in found if languages[i] == language]
        if not mine:
            continue
        own = np.empty((len(mine), size), np.float32)
        for row, (at, number_of) in zip(own, mine, strict=True):
            total = np.zeros(size)
            total[at] = number_of
            row[:] = model.vector(total)
        middle = own[random.choice(len(own), min(CENTROIDS, len(own)), replace=False)]
        for _ in range(ROUNDS):
            nearest = (own @ middle.T).argmax(1)
            sums = np.stack([own[nearest == k].sum(0) if (nearest == k).any() else middle[k] for k in range(len(middle))])
            middle = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        cosines = own @ middle.T
        nearest = cosines.argmax(1)
        for k in range(len(middle)):
            if (nearest == k).any():
                names.append(number)
                rows.append(middle[k])
                radius.append(np.quantile(cosines[nearest == k, k], BEYOND))
    if rows:
        model.names, model.rows, model.radius = np.array(names), np.stack(rows), np.array(radius)
    return model


def sample(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> list[tuple[str, str]]:
    """The bounded training sample, texts and languages. ``learn`` says of a row whether it may be used.

    The first texts of each language are taken in every task before they meet, first within parts of a language and
    then among what each part has left, so that no task sees a language whole.
    """
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).alias("_id"), F.col(lang).alias("_lang"), F.octet_length(text).alias("_bytes"))
    first = rows.withColumn("_part", F.pmod(F.xxhash64("_id", "_bytes"), F.lit(PARTS)))
    for keys in (["_lang", "_part"], ["_lang"]):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("_id"), "_id", "_bytes")
        first = first.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= TRAIN_DOCS)
    first = first.drop("_part")
    chosen, total = [], 0
    for row in first.orderBy("_rank", "_lang").collect():
        if total + row._bytes <= TRAIN_BYTES:
            chosen.append((row._id, row._lang))
            total += row._bytes
    if not chosen:
        return []
    kind = T.StructType([T.StructField("_id", docs.schema[key].dataType), T.StructField("_lang", T.StringType())])
    ids = docs.sparkSession.createDataFrame(chosen, kind).distinct()
    texts = docs.filter(learn).select(F.col(key).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    texts = texts.join(F.broadcast(ids), ["_id", "_lang"])
    texts = texts.groupBy("_id", "_lang").agg(F.min("_text").alias("_text")).orderBy(F.xxhash64("_id"), "_id", "_lang")
    return [(row._text, row._lang) for row in texts.collect()]


def identify(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """``docs`` with ``language`` (of the nearest centroid), its ``cosine`` and ``rejected``. No shuffle."""
    if clash := {f.name for f in ADDED} & set(docs.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, CHUNK_BYTES):
                found = shared.value.predict(part.column(text))
                names, cosines, rejected = zip(*found, strict=True) if found else ((), (), ())
                new = [pa.array(names, pa.string()), pa.array(cosines, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *[f.name for f in ADDED]])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *ADDED]))
