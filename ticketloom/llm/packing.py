"""Packing of tokenised documents into fixed windows by multiway differencing.

A document is its token ids and one end id. Whole windows are cut off its front and stand alone. What is
left, its tail, is packed with other tails: tails are dealt into groups, and each group is divided into
windows by the largest differencing method (Karmarkar and Karp): every tail starts as a partition with one
loaded window, and the two partitions with the largest imbalance are merged again and again, heavy windows
onto light ones, which leaves windows of nearly equal load. While a window exceeds the capacity, the number
of windows rises, so in the end every tail lies whole in a window. Only then is the padding taken out: the
emptiest windows are dissolved and poured into the room of the others, where tails may be cut, and the last,
partly filled one is cut into powers of two, as sequences of such lengths are not padded.

Tasks hold one group of tails, some hundred documents, at a time.

Inputs: documents (doc_id, text). Cases: null or empty text is the end id alone; repeated rows, null or
repeated doc_ids are packed as documents of their own; texts of any length are cut at every whole window;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ticketloom.llm.common import buckets_for, released, stored, table
from ticketloom.llm.registry import query
from ticketloom.llm.tokens import TOKENIZER, encoder, slices

CAPACITY = 2048
END_ID = 1
GROUP = 512

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "row_key long, ids binary"
)
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _tokenised(name: str, capacity: int, end: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per whole window, placed, and one per tail with its ids, not placed yet."""
    encode = encoder(name)
    key = TaskContext.get().partitionId() << 33
    width = 4 * capacity
    for batch in batches:
        for part in slices(batch, "text"):
            columns: list[list] = [[] for _ in range(9)]
            for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"))):
                ids += end
                total = len(ids) // 4
                for at in range(0, len(ids), width):
                    piece = ids[at : at + width]
                    full = len(piece) == width
                    # whole windows have odd sequence ids, packed ones even ids
                    row = (doc, at // 4, len(piece) // 4, zlib.crc32(piece), total, 2 * key + 1 if full else None, 0)
                    for c, v in zip(columns, (*row, key, None if full else piece)):
                        c.append(v)
                    key += 1
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:8]), pa.array(columns[8], pa.binary())],
                names=[x.split()[0] for x in _PIECES.split(", ")],
            )


Window = tuple[int, list]


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``k`` sets of nearly equal sum, by multiway largest differencing."""
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size if k > 1 else 0, i, [(size, (i,))]))
    heapq.heapify(heap)
    fresh = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # windows are sorted by falling load, those not listed are empty: heavy ones of a meet light ones of b
        over = max(0, len(a) + len(b) - k)
        keep_a, keep_b = len(a) - over, len(b) - over
        merged = a[:keep_a] + b[:keep_b]
        merged += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[keep_a:], reversed(b[keep_b:]))]
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], fresh, merged))
        fresh += 1
    out = []
    for _, members in heap[0][2] if heap else []:
        flat, todo = [], [members]
        while todo:
            x = todo.pop()
            if len(x) == 1:
                flat.append(x[0])
            else:
                todo += x
        out.append(sorted(flat))
    return out + [[] for _ in range(k - len(out))]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start in the item, length), none longer than ``capacity``; each item is covered once.

    No item may be longer than ``capacity``.
    """
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = difference(sizes, k)
        over = sum(1 for s in sets if sum(sizes[i] for i in s) > capacity)
        if not over:
            break
        k += max(1, over // 4)
    windows, rest = [], []
    for members in sets:
        pieces = [(i, 0, sizes[i]) for i in sorted(members, key=lambda i: sizes[i])]
        windows.append((capacity - sum(p[2] for p in pieces), pieces))
    windows.sort(key=lambda w: w[0])
    # the emptiest windows are dissolved into the room of the others, until only they have room
    while len(windows) > 1 and windows[-1][0] and sum(p[2] for p in rest) < sum(w[0] for w in windows[:-1]):
        rest += windows.pop()[1]
    for room, pieces in windows:
        while room and rest:
            i, start, length = rest.pop()
            fits = min(room, length)
            pieces.append((i, start, fits))
            room -= fits
            if fits < length:
                rest.append((i, start + fits, length - fits))
    out = [pieces for room, pieces in windows if pieces and not room]
    rest += [p for room, pieces in windows if room for p in pieces]
    while rest:  # what is left over fills whole windows, and then powers of two
        used = min(capacity, sum(p[2] for p in rest))
        now = []
        while used:
            i, start, length = rest.pop()
            fits = min(used, length)
            now.append((i, start, fits))
            used -= fits
            if fits < length:
                rest.append((i, start + fits, length - fits))
        out += _powers(now, sum(p[2] for p in now))
    return out


def _powers(pieces: list[tuple[int, int, int]], used: int) -> list[list[tuple[int, int, int]]]:
    """The pieces of one window as sequences whose lengths are the powers of two that add up to ``used``."""
    out, todo = [], pieces[::-1]
    for bit in reversed(range(used.bit_length())):
        room, now = used & (1 << bit), []
        while room:
            i, start, length = todo.pop()
            fits = min(room, length)
            now.append((i, start, fits))
            room -= fits
            if fits < length:
                todo.append((i, start + fits, length - fits))
        if now:
            out.append(now)
    return out


def _packed_group(capacity: int, group: pa.Table) -> pa.Table:
    rows = group.select(["doc_id", "start", "length", "doc_tokens", "row_key", "ids", "__group"]).sort_by("row_key").to_pylist()
    columns: list[list] = [[] for _ in range(7)]
    for n, pieces in enumerate(pack([r["length"] for r in rows], capacity)):
        offset = 0
        for i, start, length in pieces:
            r = rows[i]
            crc = zlib.crc32(r["ids"][4 * start : 4 * (start + length)])
            row = (r["doc_id"], r["start"] + start, length, crc, r["doc_tokens"], 2 * ((r["__group"] << 20) + n), offset)
            for c, v in zip(columns, row):
                c.append(v)
            offset += length
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in _PACKED.split(", ")])


def pack_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group: int = GROUP,
) -> DataFrame:
    """A row per piece: document, place in it, CRC-32 of its ids, sequence and offset there."""
    end = np.array([end_id], dtype="<u4").tobytes()
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stored(source.mapInArrow(lambda it: released(_tokenised(tokenizer, capacity, end, it)), _PIECES))
    tails = pieces.where(F.col("sequence_id").isNull())
    groups = buckets_for(tails.count(), group)
    dealt = tails.withColumn("__group", F.pmod(F.xxhash64("row_key"), F.lit(groups)))
    packed = dealt.groupBy("__group").applyInArrow(lambda t: _packed_group(capacity, t), _PACKED)
    whole = pieces.where(F.col("sequence_id").isNotNull()).select(*[x.split()[0] for x in _PACKED.split(", ")])
    return whole.unionByName(packed)


@query("op2_pack")
def op2_pack(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
