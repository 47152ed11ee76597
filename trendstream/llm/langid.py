"""Language identification by a byte convolutional network.

Windows of a fixed number of bytes go through byte embeddings, filters of
several widths, a rectifier, the maximum over the window and a softmax.  The
network is trained in numpy on windows of a bounded sample of labelled texts
(``SAMPLE`` rows of each language); its weights, some ten thousand numbers, go
to the workers, which apply it to all windows of every whole text in batches of
fixed size and add up the windows' log-probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from trendstream.llm.common import hash_below, held_out, quoted, text_or_empty

UNKNOWN = "und"
SAMPLE = 600           # labelled rows of each language to learn from, at most
TOTAL = 76_800         # labelled rows in all: with more than TOTAL / SAMPLE languages each has fewer (one at least)
WINDOW = 256           # bytes
WINDOWS_A_TEXT = 4     # windows of a text to learn from
WIDTHS = (2, 3, 4)
FILTERS = 16           # of each width
EMBED = 8
PAD = 256              # the byte after a text's end
EPOCHS = 3
BATCH = 64             # windows


@dataclass
class ByteNet:
    languages: list[str]
    embed: np.ndarray      # (257, EMBED)
    filters: np.ndarray    # (max width * EMBED, FILTERS * len(WIDTHS)), zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray        # (filters, languages)
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximum and its place for each window and filter, and the patches."""
        n, width = len(windows), max(WIDTHS)
        padded = np.concatenate([windows, np.full((n, width - 1), PAD, windows.dtype)], axis=1)
        rows = self.embed[padded].reshape(n, -1)
        patches = np.lib.stride_tricks.sliding_window_view(rows, width * EMBED, axis=1)[:, ::EMBED]
        patches = np.ascontiguousarray(patches).reshape(-1, width * EMBED)
        conv = (patches @ self.filters).reshape(n, windows.shape[1], -1)
        place = conv.argmax(axis=1) if self._learning else None
        best = conv.max(axis=1) + self.bias
        return np.maximum(best, 0), place, patches

    _learning: bool = False

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        logits = self.pooled(windows)[0] @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def windows_of(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in windows of ``size``, padded at each text's end; the text of each window."""
    counts = [-(-len(t) // size) for t in texts]
    out = np.full((sum(counts), size), PAD, dtype=np.int16)
    flat, at = out.reshape(-1), 0
    for t, n in zip(texts, counts):
        flat[at:at + len(t)] = np.frombuffer(t, np.uint8)
        at += n * size
    return out, np.repeat(np.arange(len(texts)), counts)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS,
          rate: float = 0.004, seed: int = 5) -> ByteNet:
    """Adam on the cross-entropy of single windows, in batches."""
    rng = np.random.default_rng(seed)
    width, filters, n_out = max(WIDTHS), FILTERS * len(WIDTHS), len(languages)
    keep = np.concatenate([np.repeat(np.arange(width)[:, None] < w, FILTERS, axis=1) for w in WIDTHS], axis=1)
    keep = np.repeat(keep, EMBED, axis=0).astype(np.float32)
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = ByteNet(languages, 0.5 * normal(PAD + 1, EMBED), 0.3 * keep * normal(width * EMBED, filters),
                  np.zeros(filters, np.float32), 0.1 * normal(filters, n_out), np.zeros(n_out, np.float32),
                  _learning=True)
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x, n = windows[pick], len(pick)
            hidden, place, patches = net.pooled(x)
            logits = hidden @ net.out + net.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), labels[pick]] -= 1
            p /= n
            back = (p @ net.out.T) * (hidden > 0)                        # (n, filters)
            at_patch = (place + np.arange(n)[:, None] * x.shape[1])       # patch of each maximum
            taken = patches[at_patch]                                     # (n, filters, width * EMBED)
            to_patch = back[:, :, None] * net.filters.T[None]
            to_embed = np.zeros_like(net.embed)
            padded = np.concatenate([x, np.full((n, width - 1), PAD, x.dtype)], axis=1)
            for k in range(width):
                byte = padded[np.arange(n)[:, None], place + k].astype(np.int64)
                np.add.at(to_embed, byte.reshape(-1), to_patch[:, :, k * EMBED:(k + 1) * EMBED].reshape(-1, EMBED))
            grads = [to_embed, np.einsum("nf,nfw->wf", back, taken) * keep, back.sum(axis=0),
                     hidden.T @ p, p.sum(axis=0)]
            step += 1
            for q, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    net._learning = False
    return net


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE, total: int = TOTAL) -> ByteNet | None:
    """The network learned from text and non-null language of rows that are not held out; None without such rows.

    Every language is learned; the rows of each shrink as languages grow.
    """
    known = (docs.filter(~held_out(F.col(quoted(id_col))) & F.col(quoted(lang_col)).isNotNull()
                         & F.col(quoted(text_col)).isNotNull())
             .select(F.xxhash64(F.col(quoted(id_col)), F.col(quoted(lang_col))).alias("h"),
                     F.col(quoted(id_col)).alias("id"), F.col(quoted(lang_col)).alias("lang")).distinct())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    names = sorted(r["lang"] for r in counts.select("lang").collect())     # the labels, which the network's output has one by one
    sample = max(1, min(sample, total // max(1, len(names))))
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = (known.join(F.broadcast(counts), "lang")                     # one row a label
              .filter(hash_below(F.col("h"), sample, F.col("n"))).withColumn("nth", F.row_number().over(order))
              .filter(F.col("nth") <= sample).select("id", "lang"))
    data = F.col(quoted(text_col)).cast("binary")
    span = F.greatest(F.octet_length(data) - WINDOW, F.lit(0))
    starts = [1 + F.floor(span * i / (WINDOWS_A_TEXT - 1)).cast("int") for i in range(WINDOWS_A_TEXT)]
    # at most ``total`` ids, one row each: of an id's texts the one whose windows sort last (so no empty one)
    rows = (docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(lang_col)).alias("lang"),
                        F.array(*[F.substring(data, s, F.lit(WINDOW)) for s in starts]).alias("windows"))
            .join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.max("windows").alias("windows"))
            .select("id", "lang", F.array_distinct("windows").alias("windows")).toPandas().sort_values(["id", "lang"], kind="stable"))
    parts = [(bytes(w), lang) for ws, lang in zip(rows["windows"], rows["lang"]) for w in ws if w]
    if not parts:
        return None
    lengths = np.random.default_rng(1).integers(8, WINDOW // 2, len(parts))       # and short texts
    data = [w for w, _ in parts] + [w[:n] for (w, _), n in zip(parts, lengths)]
    return train(windows_of(data)[0], np.array([names.index(x) for _, x in parts] * 2), names)


def predict(net: ByteNet | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, probability) of whole texts; (``und``, 0.0) for a text without a letter."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    some = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    if net is None or not some:
        return out
    for at in range(0, len(some), 256):
        pick = some[at:at + 256]
        windows, of = windows_of([texts[i].encode("utf-8", "replace") for i in pick])
        total = np.zeros((len(pick), len(net.languages)))
        for k in range(0, len(windows), BATCH):
            np.add.at(total, of[k:k + BATCH], net.log_probabilities(windows[k:k + BATCH]))
        mean = total / np.bincount(of, minlength=len(pick))[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for i, row in zip(pick, p):
            out[i] = (net.languages[int(row.argmax())], float(row.max()))
    return out


def with_language(docs: DataFrame, net: ByteNet | None, text_col: str = "text", out: str = "lang_pred",
                  score: str = "score") -> DataFrame:
    """``docs`` plus ``out`` and ``score``: language of each whole text and its probability.

    Null texts and texts without a letter (so empty ones) are ``und`` with score
    0; so is every text when no row could be learned from.  Columns of the same
    names are replaced; repeated rows get equal results; an empty table gives an
    empty result.
    """
    @pandas_udf("lang string, score double")
    def language(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            yield pd.DataFrame(predict(net, t.tolist()), columns=["lang", "score"])
    found = docs.withColumn("__language", language(text_or_empty(F.col(quoted(text_col)))))
    kept = [c for c in docs.columns if c.lower() not in (out.lower(), score.lower())]
    return found.select(*[F.col(quoted(c)) for c in kept], F.col("__language.lang").alias(out),
                        F.col("__language.score").alias(score))
