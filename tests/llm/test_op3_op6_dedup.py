"""Exact dedup against a dictionary, SimHash groups against all pairs."""

import hashlib
import random
import re

import pytest
from xxhash import xxh64_intdigest

from trendstream.llm import queries as Q
from trendstream.llm.components import connected_components
from trendstream.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from trendstream.llm.simhash import drop_near_duplicates, masks, near_duplicates, simhash
from tests.conftest import SF_SMALL
from trendstream.plans.verify import compare

DDL = "doc_id long, text string, kept string, group_size int"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def edge_rows():
    rng = random.Random(4)
    long = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(20000))
    rows = [(1, None, "x", 1), (2, "", None, None), (3, " \t\n", "x", 2), (4, " ", "x", 2), (None, "hello  world", "a", 1),
            (7, "hello world", "b", 2), (5, "hello\nworld", "c", 3), (5, "hello\nworld", "c", 3), (8, "hello world!", "c", 3),
            (9, long, "l", 0), (10, long.replace(" ", "\t"), "l", 0), (11, long + "x", "l", 0), (12, long[:-1] + "é", "l", 0),
            (13, "a" * 64, "l", 0), (14, "a" * 64, "l", 0), (15, "a" * 65, "l", 0), (None, "only null", "n", 1),
            (None, "only null", "n", 1), (16, "no break", "n", 1), (17, "no break", "n", 1)]
    rows += [(100 + i, "copy " * 40, "h", i) for i in range(60)]
    rows += [(300 + i, "p" * 70 + f"{i % 7}", "h", i) for i in range(40)]
    return rows


def brute_exact(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(norm(r[1]), []).append(i)
    out = []
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(g)) for i in g]
    return out, groups


def test_exact_duplicates_edge_rows(spark):
    rows = edge_rows()
    got = exact_duplicates(spark.createDataFrame(rows, DDL).repartition(5), first=8, growth=2).collect()
    want, groups = brute_exact(rows)
    key = repr
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=key) == sorted(want, key=key)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop_keeps_columns_and_one_row_of_each_text(spark):
    rows = edge_rows()
    out = drop_exact_duplicates(spark.createDataFrame(rows, DDL))
    assert out.dtypes == spark.createDataFrame(rows, DDL).dtypes
    texts = [norm(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in rows})


def test_exact_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], DDL)).collect() == []


def test_op3_query(spark, duck_small):
    ok, msg = compare(Q.op3_exact_dedup(spark, SF_SMALL), duck_small, Q.ORACLES["op3_exact_dedup"])
    assert ok, msg


def brute_fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in (text or ""))) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.setdefault((rows[i][0], fps[i], min(ids) if ids else None), 0)
        out[rows[i][0], fps[i], min(ids) if ids else None] += 1
    return out


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("text", [None, "", " \t", "one", "Two Words", "a b c", "ÀB c ÀB c ÀB c", "x " * 70000, "\x1fa\x1fb c d"])
def test_fingerprint_of_edge_texts(text):
    assert simhash(text) == signed(brute_fingerprint(text))


def test_masks_cover_every_pair_within_the_radius():
    family = masks(2)
    assert len(family) == 7
    for i in range(64):
        for j in range(64):
            differ = (1 << i) | (1 << j)
            assert any(not (m & ((1 << 64) - 1)) & differ for m in family)


def near_rows():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, None, "k", 0), (2, "", "k", 0), (None, " ", "k", 0), (3, "x", "k", 0), (3, "x", "k", 0), (None, "lonely null id", "k", 0)]
    for base in range(30):
        text = [rng.choice(words) for _ in range(250)]
        for c in range(rng.randint(1, 4)):
            copy = list(text)
            if c:
                copy[rng.randrange(250)] = rng.choice(words)
            rows.append((1000 - 20 * base + c, " ".join(copy), "k", c))
    return rows


def test_components_match_all_pairs(spark):
    rows = near_rows()
    got = near_duplicates(spark.createDataFrame(rows, DDL).repartition(4)).collect()
    want = brute_components(rows)
    count = {}
    for r in got:
        k = (r.row.doc_id, r.fp & ((1 << 64) - 1), r.component_id)
        count[k] = count.get(k, 0) + 1
    assert count == want


def test_drop_near_keeps_one_row_of_each_component(spark):
    rows = near_rows()
    out = drop_near_duplicates(spark.createDataFrame(rows, DDL))
    assert out.columns == ["doc_id", "text", "kept", "group_size"]
    want = {c for (_, _, c) in brute_components(rows)}
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(map(repr, want))


def test_near_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DDL)).collect() == []


def test_op6_query_against_all_pairs(spark):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in Q.op6_simhash(spark, SF_SMALL).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got == {(d, f"{fp:016x}", c) for (d, fp, c) in brute_components(rows)}


def test_components_of_a_long_chain_and_a_large_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(5000, 5000 + i) for i in range(1, 300)]
    links = chain[::2] + [(b, a) for a, b in chain[1::2]] + star + [(9000, 9000), (None, 4)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{5000 + i: 5000 for i in range(300)}}


def test_sha_column_is_of_the_normalised_text(spark):
    r = Q.op3_exact_dedup(spark, SF_SMALL).filter("doc_id = 1").first()
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("doc_id = 1").first().text
    assert r.text_sha256 == hashlib.sha256(norm(text).encode()).hexdigest()
