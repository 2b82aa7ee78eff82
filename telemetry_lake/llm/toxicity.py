"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character 3- to 6-grams with word ends, hashed into a fixed table, so that an unseen
spelling shares most of its vectors with the word it comes from. A passage of a few dozen words is the mean of
its vectors, and a linear softmax over that mean gives its class. A text is as toxic as its worst passage,
however long it is; in training the gradient of a text goes to its worst passage, in embeddings and softmax
alike. The table starts from the smoothed log odds of each bucket in one dimension and noise in the others.

The fit takes a bounded sample: at most ``TRAIN_DOCS`` labelled texts of each class and ``TRAIN_BYTES`` of text in
all, in the order of a hash of the text id. Scoring covers every text as a whole.

Defined results: NULL and empty texts, and texts without words, get the score of an empty passage, a small one;
equal texts get equal scores; a text labelled twice counts as toxic if one label says so; without labels
of both classes every score is the share of toxic labels (0 without any). Very long texts are scored whole, passage by
passage; empty tables stay empty. Other columns are kept, and must not bear the name of the one added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.common import flat, slices
from telemetry_lake.llm.grams import hashed, pieces

TRAIN_DOCS, TRAIN_BYTES = 3_000, 16 << 20
SIZES, BITS, DIMS = (3, 4, 5, 6), 17, 8
# Words of a passage; bytes of text scored at a time.
PASSAGE, CHUNK_BYTES = 24, 4 << 20
# A passage of fewer grams counts as filled up with empty vectors, so that a few words alone prove little.
LEAST_GRAMS = 200
EPOCHS, RATE, START, SEED = 25, 0.1, 4.0, 7


def passages(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of passages: buckets of all grams, the passage of each, and the text of each passage."""
    for joined, owner in pieces(data, offsets):
        word = joined != 32
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        number = np.cumsum(begins) - 1  # word of each position; a blank belongs to the word before it
        of_word = owner[np.flatnonzero(begins)]
        if not len(of_word):
            continue
        # Words counted from 0 in each text give the passage; passages are numbered through.
        first = np.flatnonzero(np.concatenate([[True], of_word[1:] != of_word[:-1]]))
        rank = np.arange(len(of_word)) - np.repeat(first, np.diff(np.append(first, len(of_word))))
        fresh = rank % PASSAGE == 0
        passage = np.cumsum(fresh) - 1
        grams, where = [], []
        for at, bucket in hashed(joined, SIZES, BITS):
            grams.append(bucket)
            where.append(passage[number[at + 1]])  # the second byte of a gram is always in its word
        yield np.concatenate(grams), np.concatenate(where), of_word[fresh]


class Model:
    """Scalars that the trained softmax needs: the class difference of every bucket's vector, and of the bias."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), float(bias)

    def logits(self, grams: np.ndarray, where: np.ndarray, count: int) -> np.ndarray:
        total = np.bincount(where, self.weight[grams], count)
        return total / np.maximum(np.bincount(where, minlength=count), LEAST_GRAMS) + self.bias

    def ordered(self, grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """As ``logits``, for grams in the order of their passages."""
        total = np.concatenate([[0.0], np.cumsum(self.weight[grams], dtype=np.float64)])[edges]
        return np.diff(total) / np.maximum(np.diff(edges), LEAST_GRAMS) + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = flat(column)
        best = np.full(len(offsets) - 1, -np.inf)
        for grams, where, text in passages(data, offsets):
            np.maximum.at(best, text, self.logits(grams, where, len(text)))
        best[np.isinf(best)] = self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(best, -40, 40)))


def train(texts: list[str], labels: list[int]) -> Model:
    """Embeddings and softmax from whole texts and their classes (1: toxic)."""
    truth = np.array(labels, np.float64)
    if len(truth) == 0 or truth.min() == truth.max():
        share = float(truth.mean()) if len(truth) else 0.0
        return Model(np.zeros(1 << BITS), 40.0 if share == 1 else -40.0)
    data, offsets = flat(pa.array(texts, pa.large_string()))
    runs, size = [], 1 << BITS  # grams of a run in the order of its passages, and where each passage begins
    odds = np.zeros((2, size))
    for grams, where, owner in passages(data, offsets):
        order = np.argsort(where, kind="stable")
        grams, where = grams[order].astype(np.int32), where[order]
        runs.append((grams, np.searchsorted(where, np.arange(len(owner) + 1)), owner))
        seen = np.unique(owner[where].astype(np.int64) << BITS | grams)
        toxic = truth[seen >> BITS] > 0
        odds += [np.bincount(seen[~toxic] & (size - 1), minlength=size), np.bincount(seen[toxic] & (size - 1), minlength=size)]
    if not runs:
        return Model(np.zeros(size), -40.0)
    of_run = np.repeat(np.arange(len(runs)), [len(owner) for _, _, owner in runs])
    in_run = np.concatenate([np.arange(len(owner)) for _, _, owner in runs])
    owner = np.concatenate([owner for _, _, owner in runs])

    # Start: in how many texts of each class a bucket occurs, as smoothed log odds.
    n1, n0 = truth.sum(), len(truth) - truth.sum()
    random = np.random.default_rng(SEED)
    table = random.normal(0, 0.05, (size, DIMS)).astype(np.float32)
    table[:, 0] = (np.log((odds[1] + 1.0) / (n1 + 2.0)) - np.log((odds[0] + 1.0) / (n0 + 2.0))) * (odds.sum(0) > 1)
    soft = np.zeros((2, DIMS))
    soft[:, 0] = -START, START
    bias = np.array([1.0, -1.0])

    weight_of_text = np.where(truth > 0, 0.5 / n1, 0.5 / n0) * len(truth)
    square_table, square_soft, square_bias = np.full(size, 1e-6), np.full(soft.shape, 1e-6), np.full(2, 1e-6)
    batches = np.array_split(random.permutation(len(truth)), max(1, len(truth) // 256))
    for _ in range(EPOCHS):
        now = Model(table @ (soft[1] - soft[0]), bias[1] - bias[0])
        logit = np.concatenate([now.ordered(grams, edges) for grams, edges, _ in runs])
        # The worst passage of every text.
        ranked = np.lexsort((logit, owner))
        last = np.append(owner[ranked][1:] != owner[ranked][:-1], True)
        worst = np.full(len(truth), -1)
        worst[owner[ranked][last]] = ranked[last]
        for batch in batches:
            chosen = worst[batch][worst[batch] >= 0]
            if not len(chosen):
                continue
            bags = [runs[r][0][runs[r][1][k] : runs[r][1][k + 1]] for r, k in zip(of_run[chosen], in_run[chosen], strict=True)]
            lengths = np.array([len(bag) for bag in bags])
            row, weight = np.repeat(np.arange(len(bags)), lengths), 1.0 / np.maximum(lengths, LEAST_GRAMS)
            used, at = np.unique(np.concatenate(bags), return_inverse=True)
            own = table[used]
            mean = np.stack([np.bincount(row, own[at, d], len(bags)) for d in range(DIMS)], 1) * weight[:, None]
            score = mean @ soft.T + bias
            share = np.exp(score - score.max(1, keepdims=True))
            slope = share / share.sum(1, keepdims=True)
            slope[np.arange(len(bags)), truth[owner[chosen]].astype(int)] -= 1
            slope *= weight_of_text[owner[chosen]][:, None] / len(bags)
            back = (slope @ soft) * weight[:, None]
            g_soft, g_bias = slope.T @ mean, slope.sum(0)
            g_table = np.stack([np.bincount(at, back[row, d], len(used)) for d in range(DIMS)], 1)
            square_soft += g_soft**2
            square_bias += g_bias**2
            square_table[used] += (g_table**2).mean(1)
            soft -= RATE * g_soft / np.sqrt(square_soft)
            bias -= RATE * g_bias / np.sqrt(square_bias)
            table[used] -= (RATE * g_table / np.sqrt(square_table[used])[:, None]).astype(np.float32)
    return Model(table @ (soft[1] - soft[0]), bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", key: str = "doc_id") -> list[tuple[str, int]]:
    """The bounded training sample: texts and classes. ``learn`` says of a label row whether it may be used."""
    known = labels.filter(learn & F.col(key).isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(key).alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = None
    for toxic in (0, 1):
        part = known.filter(F.col("_toxic") == toxic).orderBy(*order).limit(TRAIN_DOCS)
        picked = part if picked is None else picked.union(part)
    # The ids are a bounded set, so that the join needs no shuffle of the texts.
    sizes = docs.select(F.col(key).alias("_id"), F.octet_length(text).alias("_bytes")).join(F.broadcast(picked), "_id")
    rows = sizes.groupBy("_id", "_toxic").agg(F.max("_bytes").alias("_bytes")).orderBy(*order).collect()
    chosen, total = [], 0
    for row in rows:
        if total + (row._bytes or 0) <= TRAIN_BYTES:
            chosen.append((row._id, row._toxic))
            total += row._bytes or 0
    if not chosen:
        return []
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    ids = spark.createDataFrame(chosen, T.StructType([T.StructField("_id", kind), T.StructField("_toxic", T.IntegerType())]))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(ids), "_id")
    rows = rows.groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")).orderBy(*order).collect()
    return [(row._text or "", row._toxic) for row in rows]


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``, 0 to 1. The model has a fixed size; no shuffle."""
    if "toxicity" in docs.columns:
        raise ValueError("the input already has a column toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, CHUNK_BYTES):
                found = pa.array(shared.value.scores(part.column(text)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, "toxicity"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType(), False)]))
