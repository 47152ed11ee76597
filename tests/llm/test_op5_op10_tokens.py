"""Token counts and packing against the tokenizer library and exact reassembly."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendstream.llm import packing, pieces
from trendstream.llm import queries as Q
from trendstream.llm.packing import Packer, pack
from trendstream.llm.token_counts import frequent_pieces, token_counts
from trendstream.session import ship_package
from tests.conftest import SF_SMALL

DDL = "doc_id long, text string, n_tokens string, part int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(Q.tokenizer_path())


def random_texts(n, seed=1, longest=30):
    rng = random.Random(seed)
    letters = [*"abst'vrelmd  \n\t.!?12éß ", "'s", "'re", "'ll", "'ve", "　", "\x1c", "\x85", "½", "Ⅷ", "漢", "字", "́",
               "🙂", "<|endoftext|>", "​", "\xa0", "\r\n", "_", "'S", "'RE", " '", "''s"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_ids_and_counts_match_the_library(library):
    texts = random_texts(5000)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = pieces.Encoder(Q.tokenizer_path(), bits=8)           # slots are replaced all the time
    assert list(encoder.count(texts)) == [len(w) for w in want]
    assert [list(i) for i in encoder.ids(texts)] == want
    assert list(encoder.count(texts)) == [len(w) for w in want]


def test_every_character_is_split_as_the_library_does(library):
    texts = ["a" + chr(c) + "a 1" + chr(c) + " " + chr(c) + chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(i) for i in pieces.Encoder(Q.tokenizer_path()).ids(texts)] == want


def test_long_texts_are_cut_where_a_piece_starts(library, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENT", 50)
    texts = [t.replace("<|endoftext|>", "") for t in random_texts(200, 2, 1000)] + ["x" * 500, " " * 500, ""]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(i) for i in pieces.Encoder(Q.tokenizer_path()).ids(texts)] == want


def test_token_counts_edge_rows(spark, library):
    ship_package(spark)
    texts = [None, "", " ", "a", "a", "word " * 30000, "<|endoftext|>x<|endoftext|>", *random_texts(300, 3)]
    rows = [(i if i != 3 else None, t, "clash", i) for i, t in enumerate(texts)] + [(4, "a", "clash", 4)]
    got = token_counts(spark.createDataFrame(rows, DDL).repartition(3), Q.tokenizer_path()).collect()
    want = [(r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_token_counts_empty_table(spark):
    ship_package(spark)
    assert token_counts(spark.createDataFrame([], DDL), Q.tokenizer_path()).collect() == []


def test_frequent_pieces_are_the_frequent_ones(spark):
    df = spark.createDataFrame([("the cat the dog the end",), (None,)] * 20 + [("rare",)], "text string")
    assert set(frequent_pieces(df, "text", 2)) <= {" the", "the", " cat", " dog", " end"}
    assert " the" in frequent_pieces(df, "text", 2)


def test_op10_query(spark, library):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, len(r.text.encode()), n, n > 1024) for r in docs
            for n in [len(library.encode(r.text, add_special_tokens=False).ids)]}
    assert {tuple(r) for r in Q.op10_token_counts(spark, SF_SMALL).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()} == want


def check_pieces(rows, documents, window):
    """rows: dicts of pieces; documents: list of (doc_id, ids).  Every document comes back whole."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id in {d for d, _ in documents}:
        left = sorted([i for d, i in documents if d == doc_id])
        found = sorted(by_doc.get(doc_id, []), key=lambda r: r["start"])
        open_parts = []
        for r in found:                                   # repeated documents: each piece continues one of them
            if r["start"] == 0:
                open_parts.append([r["ids"], r["doc_tokens"]])
                continue
            part = next(p for p in open_parts if len(p[0]) == 4 * r["start"] and p[1] == r["doc_tokens"])
            part[0] = part[0] + r["ids"]
        made = sorted(list(np.frombuffer(p[0], "<u4")) for p in open_parts)
        assert made == [list(i) for i in left]
    return sequences


def padding(sequences, window):
    lost = total = 0
    for s in sequences.values():
        n = sum(r["length"] for r in s)
        total += n
        lost += 0 if n & (n - 1) == 0 else window - n
    return lost, total


def test_pack_edge_rows(spark, library):
    ship_package(spark)
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "null id", "x", 1), (3, "word " * 9000, "x", 1), (4, "same", "x", 1),
            (4, "same", "x", 1)] + [(100 + i, t, "x", i) for i, t in enumerate(random_texts(400, 5, 200))]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    got = [r.asDict() for r in pack(df, Q.tokenizer_path(), window=256, open_windows=4, fan=2).collect()]
    documents = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    lost, total = padding(check_pieces(got, documents, 256), 256)
    assert lost <= 0.04 * total


def test_pack_empty_table_and_bad_window(spark):
    ship_package(spark)
    assert pack(spark.createDataFrame([], DDL), Q.tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], DDL), Q.tokenizer_path(), window=100)


def test_packer_places_best_fit_and_emits_the_fullest():
    p = Packer(0, 0, 64, 2, slack=2)
    for i, n in enumerate([40, 50, 12, 24, 30, 36]):
        p.add(i, np.arange(n, dtype=np.uint32))
    # 12 fits best behind 50, 24 fills the window of 40; 36 fits nowhere, so the fullest
    # (50 + 12, within the slack) goes as it is, and 36 opens a window
    assert [(r[0], r[2], r[6]) for r in p.rows] == [(0, 40, 0), (3, 24, 40), (1, 50, 0), (2, 12, 50)]
    p.close()
    assert sorted(sum(r[2] for r in p.rows if r[5] == s) for s in {r[5] for r in p.rows}) == [2, 62, 64, 64]


def test_op5_query(spark, library):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: np.array(library.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for r in docs}
    got = Q.op5_packing(spark, SF_SMALL).collect()
    for d, all_ids in ids.items():
        parts, at = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start), 0
        for r in parts:
            assert r.start == at and r.doc_tokens == len(all_ids)
            assert r.ids_crc32 == zlib.crc32(all_ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(all_ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r.asDict())
    lost, total = padding(sequences, packing.WINDOW)
    assert lost <= 0.01 * total
    assert all(sum(r["length"] for r in s) <= 2048 for s in sequences.values())


def test_sketches_of_many_partitions_merge_as_a_tree(spark):
    from trendstream.llm.token_counts import frequent_pieces
    df = spark.range(0, 4000, 1, 300).selectExpr("id AS doc_id", "concat('common word', if(id % 500 = 0, ' rare', '')) AS text")
    assert set(frequent_pieces(df, "text", 2)) == {" word", "common"}
