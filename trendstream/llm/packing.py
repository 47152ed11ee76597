"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows.  A document's ids are cut
into whole windows as long as they last; the rest goes to the open window it
fits best.  When none fits and no further window may be opened, the fullest is
emitted, topped up first by cutting what is being placed when its gap is more
than ``slack``.  Windows still open when a partition ends are merged: their
pieces, at most ``open_windows`` windows a partition, are packed again by the
same rule for ``fan`` partitions at a time, until one group is left.  No task
ever holds more than its open windows and those of ``fan`` others.

A sequence is padded to the window size, or not at all when its length is a
power of two; so the last few windows are filled up from each other and the
very last one is emitted in pieces whose lengths are powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstream.llm.common import quoted, text_or_empty
from trendstream.llm.pieces import worker_encoder
from trendstream.session import materialize

WINDOW = 2048
OPEN_WINDOWS = 32
SLACK = 8
FAN = 16
# A worker's table of pre-tokens stays with it through the stages that follow: 15 MB of slots, 8 MB of ids.
CACHE = {"bits": 19, "pool": 1 << 20}
SLICE = 64             # texts encoded at a time
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
          "sequence_id long, offset long, part long, open boolean")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("part", pa.int64()), ("open", pa.bool_())])
_COLUMNS = [f.name for f in _ARROW]


class Packer:
    """Open windows of one partition; ``rows`` collects what has been emitted."""

    def __init__(self, round_no: int, part: int, window: int, open_windows: int, slack: int):
        self.window, self.most, self.slack = window, open_windows, slack
        self.part, self.windows, self.rows = part, [], []
        self.next_id = (round_no << 58) + (part << 34)

    def _emit(self, pieces: list, is_open: bool = False) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), total, ids.astype("<u4").tobytes(),
                              self.next_id, at, self.part, is_open))
            at += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray, start: int = 0, total: int | None = None) -> None:
        total = len(ids) if total is None else total
        while len(ids) >= self.window:
            self._emit([(doc_id, start, ids[:self.window], total)])
            ids, start = ids[self.window:], start + self.window
        while len(ids):
            n, gaps = len(ids), [w[0] for w in self.windows]
            fits = [(g, i) for i, g in enumerate(gaps) if g >= n]
            if not fits and len(gaps) < self.most:
                self.windows.append([self.window, []])
                continue
            at = min(fits)[1] if fits else gaps.index(min(gaps))
            gap, pieces = self.windows[at]
            take = n if fits else gap if gap > self.slack else 0
            if take:
                pieces.append((doc_id, start, ids[:take], total))
                self.windows[at][0] -= take
            ids, start = ids[take:], start + take
            if not fits or self.windows[at][0] == 0:
                self._emit(self.windows.pop(at)[1])

    def leave_open(self) -> None:
        for _, pieces in self.windows:
            self._emit(pieces, True)
        self.windows = []

    def close(self) -> None:
        """Emit what is open: full windows, then one rest in lengths that are powers of two."""
        left = [p for _, pieces in sorted(self.windows, key=lambda w: w[0]) for p in pieces]
        room = sum(len(p[2]) for p in left)
        self.windows, at, out = [], 0, []
        for doc_id, start, ids, total in left:
            while len(ids):
                size = self.window if room >= self.window else 1 << (room.bit_length() - 1)
                take = min(size - at, len(ids))
                out.append((doc_id, start, ids[:take], total))
                ids, start, at = ids[take:], start + take, at + take
                if at == size:
                    self._emit(out)
                    room, at, out = room - size, 0, []

    def take_batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [[]] * len(_COLUMNS)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = 1, open_windows: int = OPEN_WINDOWS,
         slack: int = SLACK, fan: int = FAN) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids, sequence_id, offset).

    A document is its ids without added tokens, then ``end_id``; null and empty
    texts are that one id.  ``ids`` holds a piece's ids as little-endian unsigned
    32-bit numbers, ``start`` counts its document's ids before it, ``offset`` the
    ids before it in its sequence.  Every row of ``docs`` is a document of its
    own, also when ids repeat or are null.  Other columns are not read.  An empty
    table gives an empty result.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, "ids", **CACHE)
        packer = Packer(0, TaskContext.get().partitionId(), window, open_windows, slack)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                ids_of, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                for doc_id, ids in zip(ids_of, encoder.ids(texts)):
                    packer.add(doc_id, np.concatenate([ids, end]))
                if len(packer.rows) >= 512:
                    yield packer.take_batch()
        packer.leave_open()
        yield packer.take_batch()

    source = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"),
                         text_or_empty(F.col(quoted(text_col))).alias("text"))
    packed = materialize(source.mapInArrow(pack_partition, SCHEMA), "packed")
    done = packed.filter("NOT open")
    rest, round_no = packed.filter("open"), 0
    while True:
        groups = rest.agg(F.max("part")).first()[0]
        last = groups is None or groups < fan
        round_no += 1
        merged = materialize(_merge(rest, round_no, last, window, open_windows, slack, fan), "packed-rest")
        done = done.unionByName(merged.filter("NOT open"))
        if last:
            break
        rest = merged.filter("open")
    return done.drop("part", "open")


def _merge(rest: DataFrame, round_no: int, last: bool, window: int, open_windows: int, slack: int,
           fan: int) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        order = [("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")]
        rows = table.sort_by(order).select(_COLUMNS).to_pylist()
        packer = Packer(round_no, rows[0]["part"] // fan, window, open_windows, slack)
        for r in rows:
            packer.add(r["doc_id"], np.frombuffer(r["ids"], "<u4"), r["start"], r["doc_tokens"])
        packer.close() if last else packer.leave_open()
        return pa.Table.from_batches([packer.take_batch()])

    return (rest.withColumn("group", F.floor(F.col("part") / fan)).groupBy("group")
            .applyInArrow(lambda t: merge(t), SCHEMA))
