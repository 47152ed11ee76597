"""Supervised subword embeddings for quality scores.

A document is its words, the character n-grams of each word, a feature for
every word that repeats the word before it, and one end feature; each is hashed
to a row of a vector table.  The average of the rows goes through a softmax.
Table and softmax are trained together by stochastic gradient descent in numpy
on a bounded sample of labelled rows (``SAMPLE`` per label, weighted back to
the labels' shares); features of the sample are made on the executors.

Scoring uses that everything after the lookup is linear: a feature's vector
times the softmax weights is one number, so a word's share of a document's
logit is the sum over its features, which each worker keeps for the words it
has met in a cache of bounded size.  The model sent to the workers is one float
per hash bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from trendstream.llm.common import hash_below, held_out, quoted, text_or_empty

SAMPLE = 1000          # labelled rows of each label to learn from, at most
BUCKETS = 1 << 17
DIM = 16
EPOCHS = 8
RATE = 6.0
GRAMS = (3, 4)
CACHE = 200_000        # words a worker remembers
LONGEST = 64           # longer words are not remembered
REPEAT, END = 0, 1     # buckets of the repeat and the end feature
_RESERVED = 2


def word_features(word: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    marked = f"<{word}>"
    if marked.isascii():
        marked = marked.encode()                       # its slices are the n-grams' bytes
        grams = [marked] + [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    else:
        grams = [marked.encode("utf-8", "replace")] + [
            marked[i:i + n].encode("utf-8", "replace") for n in GRAMS for i in range(len(marked) - n + 1)]
    size = buckets - _RESERVED
    return [_RESERVED + crc32(g) % size for g in grams]


def document_features(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    words = text.split()
    counts: dict[int, int] = {END: 1}
    repeats = sum(map(eq, words, words[1:]))
    if repeats:
        counts[REPEAT] = repeats
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    for w, n in seen.items():
        for f in word_features(w, buckets):
            counts[f] = counts.get(f, 0) + n
    return np.fromiter(counts, np.int32, len(counts)), np.fromiter(counts.values(), np.int32, len(counts))


def train(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray,
          buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 7) -> np.ndarray:
    """Logit (label 1 over label 0) of each bucket, by stochastic gradient descent on document averages."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out = np.zeros((2, dim), dtype=np.float32)
    shares = [(c / c.sum()).astype(np.float32) for c in counts]
    steps, done = epochs * len(ids), 0
    for _ in range(epochs):
        for d in rng.permutation(len(ids)):
            lr = rate * (1 - done / steps) * weights[d]
            done += 1
            rows = table[ids[d]]
            hidden = shares[d] @ rows
            logits = out @ hidden
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[d]] -= 1
            back = p @ out
            out -= lr * np.outer(p, hidden)
            table[ids[d]] = rows - lr * np.outer(shares[d], back)
    return (table @ (out[1] - out[0])).astype(np.float64)


class WordLogits(dict):
    """word -> complex(sum of its features' logits, number of features); bounded."""

    def __init__(self, logits: np.ndarray):
        super().__init__()
        self.logits = logits.tolist()

    def __missing__(self, word: str) -> complex:
        f = word_features(word, len(self.logits))
        value = complex(sum(map(self.logits.__getitem__, f)), len(f))
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value

    def score(self, text: str) -> float:
        words = text.split()
        repeats = sum(map(eq, words, words[1:]))
        total = sum(map(self.__getitem__, words), complex(self.logits[END] + repeats * self.logits[REPEAT],
                                                          1 + repeats))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, total.real / total.imag))))


def _sample(labels: DataFrame, id_col: str, label_col: str, most: int, learn: Column) -> DataFrame:
    """(id, label, n): at most ``most`` rows of each label by the order of the id's hash; n counts the label's rows."""
    known = (labels.filter(learn & F.col(quoted(label_col)).isin(0, 1) & F.col(quoted(id_col)).isNotNull())
             .select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("int").alias("label"))
             .distinct())
    shares = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("label").orderBy("h", "id")
    return (known.withColumn("h", F.xxhash64("id")).join(F.broadcast(shares), "label")     # two rows
            .filter(hash_below(F.col("h"), most, F.col("n")))
            .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).select("id", "label", "n"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE, buckets: int = BUCKETS) -> np.ndarray:
    """Logits learned from labelled rows that are not held out."""
    chosen = _sample(labels, id_col, label_col, sample, ~held_out(F.col(quoted(id_col))))

    @pandas_udf("ids array<int>, counts array<int>")
    def features(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([document_features(t, buckets) for t in texts], columns=["ids", "counts"])

    # at most 2 * sample ids, one row each: of an id's texts the one that sorts last (so no empty one)
    rows = (docs.select(F.col(quoted(id_col)).cast("long").alias("id"),
                        text_or_empty(F.col(quoted(text_col))).alias("text"))
            .join(F.broadcast(chosen), "id").groupBy("id", "label", "n").agg(F.max("text").alias("text"))
            .select("id", "label", "n", features("text").alias("f")).select("id", "label", "n", "f.*")
            .toPandas().sort_values(["id", "label"], kind="stable"))
    if rows.empty:
        return np.zeros(buckets)
    label = rows["label"].to_numpy()
    weight = rows["n"].to_numpy() / rows.groupby("label")["id"].transform("count").to_numpy()
    return train([np.asarray(x, np.int32) for x in rows["ids"]], [np.asarray(x, np.float32) for x in rows["counts"]],
                 label, weight / weight.mean(), buckets)


def with_scores(docs: DataFrame, logits: np.ndarray, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out``: the probability of label 1 of each whole text.

    Null and empty texts get the score of the end feature alone.  Without
    labelled rows every score is 0.5.  Repeated rows get equal scores; a column
    of the same name is replaced; an empty table gives an empty result.
    """
    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordLogits(logits)
        for t in texts:
            yield pd.Series([words.score(x) for x in t], dtype="float64")
    return docs.withColumn(out, score(text_or_empty(F.col(quoted(text_col)))))
