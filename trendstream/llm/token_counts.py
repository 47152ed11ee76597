"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the corpus's frequent pre-tokens and their token
counts, broadcast with the job: a frequent-items sketch over all documents finds
them, so only bounded sketches travel and no pre-token is ever shuffled.  Tier
two is each worker's own cache of what the library gave for the rest.  The
tables only save work: a count is the library's whether its pre-token was
frequent, cached or new.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from trendstream.llm.common import quoted, text_or_empty
from trendstream.llm.pieces import NO_IDS, Encoder, Slots, hashes, split, worker_encoder
from trendstream.session import materialize

FREQUENT = 16384       # entries of the broadcast table
TRACKED = 65536        # items a sketch holds
SLOT_BITS = 17         # 2**17 slots of 28 bytes: 3.7 MB to broadcast
FAN = 16               # sketches that meet in a merge
# Pre-tokens as the JVM finds them; differences to the library's only cost hits.
PATTERN = (r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def frequent_pieces(docs: DataFrame, text_col: str, most: int = FREQUENT) -> list[str]:
    """The frequent pre-tokens of all documents, at most ``most`` (bounded, so they may be collected)."""
    words = docs.select(F.explode(F.expr(
        f"regexp_extract_all({quoted(text_col)}, r\"{PATTERN}\", 0)")).alias("piece"))
    # a tree of merges: the tasks of a level grow with the input's splits
    groups = -(-docs.rdd.getNumPartitions() // FAN)
    part = F.floor(F.spark_partition_id() / FAN).alias("part")
    sketches = materialize(words.groupBy(part).agg(F.expr(f"approx_top_k_accumulate(piece, {TRACKED})").alias("sketch")), "sketches")
    while groups > 1:
        groups = -(-groups // FAN)
        sketches = materialize(sketches.groupBy(F.floor(F.col("part") / FAN).alias("part")).agg(
            F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch")), "sketches")
    top = sketches.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    return [r["item"] for r in (top["top"] if top else []) if r["item"]]


def length_table(pieces: list[str], tokenizer: str, bits: int = SLOT_BITS) -> Slots:
    """Read-only slots of the pieces' token counts; of two in one slot the earlier stays."""
    slots = Slots(bits)
    if pieces:
        counts = Encoder(tokenizer, bits=10).count(pieces)
        cp, starts, ends = split(pieces)
        h1, h2 = hashes(cp, starts, ends)
        real = np.flatnonzero(cp[starts] != 0x110000)
        text_of = np.cumsum(cp[starts] == 0x110000)[real]
        single = np.bincount(text_of, minlength=len(pieces))[text_of] == 1
        at, of = real[single][::-1], text_of[single][::-1]
        slots.put(h1[at], h2[at], counts[of], NO_IDS)
    return slots


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "n_tokens",
                 frequent: int = FREQUENT) -> DataFrame:
    """``docs`` plus ``out``: the tokens of each whole text as the library counts them, without added tokens.

    Null and empty texts have 0 tokens.  Special strings inside a text count as
    the library's default has it.  A column of the same name is replaced;
    repeated rows each get their count; an empty table gives an empty result.
    """
    table = length_table(frequent_pieces(docs, text_col, frequent), tokenizer)

    @pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = worker_encoder(tokenizer, "counts")
        encoder.frequent = table
        for t in texts:
            yield pd.Series(encoder.count(t.tolist()))
    return docs.withColumn(out, count(text_or_empty(F.col(quoted(text_col)))))
