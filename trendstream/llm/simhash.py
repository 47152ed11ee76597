"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits over word shingles hashed with XXH64.  Two fingerprints
are linked when at most ``radius`` bits differ.  2^(radius+1) - 1 structured bit
masks guarantee that such a pair agrees under at least one mask: bit position i
carries a nonzero vector m(i) of radius+1 bits, mask v holds the positions with
odd <v, m(i)>, and for any ``radius`` positions some nonzero v is orthogonal to
all of their vectors.  With radius 2 that is seven tables.

Inside a bucket no pairs are enumerated.  A bucket's members agree on the
mask's bits, so each emits itself and its variants with up to radius/2 of the
other bits flipped; fingerprints within the radius share a variant, and those
that share a variant are within the radius.  A variant has a bounded number of
members however large the bucket, and linking them to their smallest member
keeps every component.  Exact copies of a fingerprint are collapsed first.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from trendstream.llm.common import quoted
from trendstream.llm.components import connected_components
from trendstream.session import materialize

BITS = 64
SEED = 42
NO_ID = 2 ** 63 - 1
_CHUNK = 1 << 15


def simhash(text: str | None, words: int = 3) -> int:
    """Signed 64-bit fingerprint of a whole text (0 without words)."""
    from xxhash import xxh64_intdigest
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        part = w[at:min(at + _CHUNK, n) + words - 1]
        shingles = zip(*(part[i:] for i in range(words))) if len(w) >= words else [w]
        hashes = np.array([xxh64_intdigest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")
    return fp(text)


def masks(radius: int, bits: int = BITS) -> list[int]:
    """The covering family for ``radius`` as signed 64-bit masks."""
    top = 2 ** (radius + 1)
    out = []
    for v in range(1, top):
        m = sum(1 << i for i in range(bits) if (v & (1 + i % (top - 1))).bit_count() % 2)
        out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def _flips(mask: int, most: int) -> list[int]:
    free = [i for i in range(BITS) if not (mask >> i) & 1]
    out = []
    for k in range(most + 1):
        for c in combinations(free, k):
            f = sum(1 << i for i in c)
            out.append(f - (1 << 64) if f >= 1 << 63 else f)
    return out


def fingerprint_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of nodes (node struct with field fp; fp): same components as all pairs within ``radius``."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be an even number of bits")
    family = masks(radius)
    tables = nodes.select("node", "fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in family])).alias("t", "key"))
    shared = materialize(tables.groupBy("t", "key").count().filter("count > 1").select("t", "key"),
                         "covering-buckets")
    members = tables.join(shared.hint("merge"), ["t", "key"], "left_semi")
    variants = F.lit(None)
    for t, m in enumerate(family):
        flips = F.array(*[F.lit(f) for f in _flips(m, radius // 2)])
        variants = F.when(F.col("t") == t, flips).otherwise(variants)
    groups = (members.select("node", "t", "fp", F.explode(variants).alias("flip"))
              .select("node", "t", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
              .groupBy("t", "variant").agg(F.collect_list("node").alias("near"))
              .filter(F.size("near") > 1))
    return (groups.select(F.array_min("near").alias("b"), F.explode("near").alias("a"))
            .filter("a <> b").select("a", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, radius: int = 2) -> DataFrame:
    """(row, uid, fp, component_id) for each row of ``docs``.

    ``row`` holds all columns, ``uid`` numbers the rows, component_id is the
    smallest id reachable over links (the row's own id included).  Texts
    without words (null, empty, white space) have fingerprint 0 and are linked
    like any other.  Null ids count as larger than every other id; a component
    of null ids only has a null component_id.  Repeated rows share one
    fingerprint.  An empty table gives an empty result.
    """
    rows = materialize(docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        fingerprint(F.col(quoted(text_col)).cast("string"), words).alias("fp"),
        F.monotonically_increasing_id().alias("uid")), "simhash-rows")
    nodes = materialize(
        rows.groupBy("fp").agg(F.coalesce(F.min(F.col("row")[id_col].cast("long")), F.lit(NO_ID)).alias("id"))
        .select(F.struct("id", "fp").alias("node"), "fp"), "simhash-nodes")
    components = connected_components(fingerprint_links(nodes, radius))
    named = materialize(
        nodes.join(components.hint("merge"), "node", "left")
        .select("fp", F.coalesce(F.col("root.id"), F.col("node.id")).alias("component")), "simhash-components")
    return rows.join(named.hint("merge"), "fp").select(
        "row", "uid", "fp",
        F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id; same columns."""
    marked = near_duplicates(docs, id_col, text_col, words, radius)
    own = F.struct(F.col("row")[id_col].isNull().alias("none"),
                   F.col("row")[id_col].cast("long").alias("id"), F.col("uid").alias("uid"))
    stays = materialize(marked.select("component_id", own.alias("own"))
                        .groupBy("component_id").agg(F.min("own").alias("own"))
                        .select(F.col("own.uid").alias("uid")), "simhash-stays")
    return marked.join(stays.hint("merge"), "uid", "left_semi").select("row.*")
