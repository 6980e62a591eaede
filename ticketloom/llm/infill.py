"""Fill-in-the-middle: documents are cut at line ends into prefix, middle and suffix and reordered.

A document's lines (``[^\\n]*\\n|[^\\n]+``) are its units. Two cuts, drawn from a hash of the doc_id, end the
prefix and the middle; the suffix is the rest. Forms, with a marker before each part:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text: an empty one, one that holds a marker itself, or one left as it is by ``rate``

The bytes of a whole batch are moved at once. Line ends found by one scan give the byte of every cut; a part's
shift, its place in the output less that in the input, goes as a difference into an array at the part's first
byte, so a running sum gives every byte of the batch its shift, and one scatter builds all outputs. ``restore``
finds the markers in the outputs, makes the shifts from them alone, and gathers the bytes back. Sums run in
blocks of ``BLOCK`` bytes, so besides texts and outputs only some arrays of that length are held.

Inputs: documents (doc_id, text). Cases: a null text is empty; a null doc_id draws as an empty number does;
repeated rows give equal rows; texts of any length are moved whole; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import table, text_of
from ticketloom.llm.registry import query
from ticketloom.llm.tokens import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Shares in percent: of documents transformed, and among these of the form spm.
RATE, SPM = 100, 50
BATCH_BYTES = 8_000_000
BLOCK = 1 << 20

_TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_MARK = len(PREFIX)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text starts and ends among them."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def _places(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where ``mark`` occurs."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at


def _move(source: np.ndarray, out: np.ndarray, first: np.ndarray, place: np.ndarray, scatter: bool) -> None:
    """Moves every byte: the part that starts at ``first[k]`` of one side starts at ``place[k]`` of the other.

    Shifts belong to the bytes of ``source`` if they are scattered, else to those of ``out``, which are gathered.
    Parts may be empty: the last one that starts at a byte counts.
    """
    shift = place - first
    lead = np.diff(shift, prepend=0)
    own = source if scatter else out
    before = 0
    for lo in range(0, len(own), BLOCK):
        hi = min(lo + BLOCK, len(own))
        a, b = np.searchsorted(first, (lo, hi))
        change = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(change, first[a:b] - lo, lead[a:b])
        change[0] += before
        moved = np.cumsum(change)
        before = int(moved[-1])
        moved += np.arange(lo, hi)
        if scatter:
            out[moved] = source[lo:hi]
        else:
            out[lo:hi] = source[moved]


def _held(data: np.ndarray, offsets: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where ``mark`` lies within a text, and in which one."""
    at = _places(data, mark)
    owner = np.searchsorted(offsets, at, side="right") - 1
    inside = at + len(mark) <= offsets[owner + 1]
    return at[inside], owner[inside]


def _interleaved(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def infill(
    texts: pa.Array, draws: np.ndarray, rate: int = RATE, spm: int = SPM
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Units, form (0 plain, 1 psm, 2 spm), code points of prefix and middle, and output of each text.

    ``draws`` has four columns: two for the cuts, one against ``rate``, one against ``spm``.
    """
    data, offsets = _bytes(texts)
    start, end = offsets[:-1], offsets[1:]
    breaks = np.flatnonzero(data == 10) + 1  # a unit ends behind every line feed, and where a text ends without one
    lo, hi = np.searchsorted(breaks, start, side="right"), np.searchsorted(breaks, end, side="right")
    filled = end > start
    open_end = filled & (data[np.maximum(end - 1, 0)] != 10) if len(data) else filled
    units = hi - lo + open_end
    marked = np.zeros(len(start), dtype=bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked[_held(data, offsets, mark)[1]] = True
    plain = ~filled | marked | (draws[:, 2] % 100 >= rate)
    swapped = ~plain & (draws[:, 3] % 100 < spm)
    form = np.where(plain, 0, np.where(swapped, 2, 1))
    cuts = np.sort(draws[:, :2] % (units[:, None] + 1), axis=1)

    def byte_after(unit: np.ndarray) -> np.ndarray:
        at = lo + unit - 1
        inside = breaks[np.clip(at, 0, len(breaks) - 1)] if len(breaks) else at
        return np.where(unit == 0, start, np.where(at < hi, inside, end))

    one, two = (byte_after(cuts[:, k]) for k in (0, 1))
    one, two = np.where(plain, end, one), np.where(plain, end, two)
    out_size = end - start + np.where(plain, 0, 3 * _MARK)
    out_offsets = np.concatenate([[0], np.cumsum(out_size)])
    base = out_offsets[:-1]
    suffix = np.where(plain, 0, end - two)
    # places of prefix, suffix and middle in the output; each but those of plain texts has its marker before it
    prefix_at = base + np.where(plain, 0, np.where(swapped, suffix + 2 * _MARK, _MARK))
    suffix_at = np.where(plain, base + end - start, np.where(swapped, base + _MARK, prefix_at + (one - start) + _MARK))
    middle_at = np.where(plain, base + end - start, out_offsets[1:] - (two - one))
    out = np.empty(out_offsets[-1], dtype=np.uint8)
    _move(data, out, _interleaved(start, one, two), _interleaved(prefix_at, middle_at, suffix_at), True)
    for mark, at in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        for k, byte in enumerate(mark):
            out[at[~plain] - _MARK + k] = byte
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    return units, form, points[one] - points[start], points[two] - points[one], _strings(out, out_offsets)


def restore(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The exact texts, from the outputs and their forms (0 plain, 1 psm, 2 spm) alone."""
    data, offsets = _bytes(outputs)
    start, end = offsets[:-1], offsets[1:]
    plain = form == 0
    # a text that holds a marker is plain, so in the others each marker is found once
    at = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        found, owner = _held(data, offsets, mark)
        place = end.copy()
        place[owner] = found + _MARK
        at[mark] = np.where(plain, end, place)
    swapped = form == 2
    prefix = np.where(plain, start, at[PREFIX])
    middle, suffix = at[MIDDLE], at[SUFFIX]
    prefix_end = np.where(plain, end, np.where(swapped, middle, suffix) - _MARK)
    suffix_end = np.where(plain, end, np.where(swapped, at[PREFIX], middle) - _MARK)
    text_offsets = np.concatenate([[0], np.cumsum(prefix_end - prefix + end - middle + suffix_end - suffix)])
    base = text_offsets[:-1]
    one = base + prefix_end - prefix
    two = one + end - middle
    out = np.empty(text_offsets[-1], dtype=np.uint8)
    _move(data, out, _interleaved(base, one, two), _interleaved(prefix, middle, suffix), False)
    return _strings(out, text_offsets)


FORMS = np.array(["plain", "psm", "spm"])


def _transformed(rate: int, spm: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", BATCH_BYTES):
            draws = np.stack([part.column(f"h{k}").to_numpy() for k in range(1, 5)], axis=1)
            units, form, prefix, middle, output = infill(part.column("text"), draws, rate, spm)
            plain = form == 0
            columns = [
                part.column("doc_id"), pa.array(units), pa.array(FORMS[form]),
                pa.array(prefix, mask=plain), pa.array(middle, mask=plain), output,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _TRANSFORMED.split(", ")])


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "output", BATCH_BYTES):
            form = np.searchsorted(FORMS, part.column("form").to_numpy(zero_copy_only=False))
            columns = [*part.columns, restore(part.column("output"), form)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "restored"])


def draws(doc_id: str = "doc_id", seed: str = "7:") -> list[Column]:
    """Four numbers per document: the first 8-digit groups of a hash, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def infill_documents(docs: DataFrame, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """A row per document: units, form, code points of prefix and middle (null if plain), and the output text."""
    source = docs.select(F.col("doc_id").cast("long"), text_of(F.col("text").cast("string")).alias("text"))
    return source.select("*", *draws()).mapInArrow(partial(_transformed, rate, spm), _TRANSFORMED)


def restored(found: DataFrame) -> DataFrame:
    """Adds ``restored``, the text made from ``output`` and ``form``, to what ``infill_documents`` returns."""
    return found.mapInArrow(_restored, f"{_TRANSFORMED}, restored string")


SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units,
    CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM drawn
), parts AS (
  SELECT doc_id, text, len(units) AS n, units,
    least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
      THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), texts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') AS p,
    array_to_string(list_slice(units, a + 1, b), '') AS m, array_to_string(list_slice(units, b + 1, n), '') AS s
  FROM parts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM texts
"""


@query("op12_infill", SQL)
def op12_infill(spark, sf_dir):
    found = restored(infill_documents(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
