"""Token ids with a bounded memory of words, and the files of independent frames."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from llm_helpers import token_ids
from pyspark.sql import functions as F

from ticketloom.llm import frames
from ticketloom.llm.tokens import Encoder, slices

PARTS = [*"abz é\n\n  .,,'’s0 9-<|>\tß中😀ł×·", " the", " of,", " and.", "\nthe", " Ok", "ing", " don't"]


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*made, None, "", " ", "\n", "  ", "\n\n", "\x00", "a\x00b"]


@pytest.mark.parametrize("known", [1 << 19, 300])
def test_ids_are_those_of_the_tokenizer(known):
    texts = odd_texts(4000)
    encode = Encoder(known=known)
    got = [x for lo in range(0, len(texts), 997) for x in encode(pa.array(texts[lo : lo + 997], pa.string()))]
    assert got == [x[:-1].tobytes() for x in token_ids([t or "" for t in texts])]
    assert len(encode.known.used) <= known


def test_slices_are_bounded_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["x" * 10, None, "y" * 100, "z", "", "w" * 30], pa.string())})
    parts = [p.column("text").to_pylist() for p in slices(batch, "text", 40)]
    assert parts == [["x" * 10, None], ["y" * 100], ["z", "", "w" * 30]]
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_file_of_frames(monkeypatch):
    monkeypatch.setattr(frames, "FRAME_IDS", 4)
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (1, 4, 5, 13)]
    names = [None, -3, 7, 7]
    out = io.BytesIO()
    writer = frames.FrameWriter(out)
    for name, data in zip(names, ids):
        writer.add(name, data)
    writer.close()
    data = out.getvalue()
    assert len(data) == writer.bytes and writer.tokens == 23
    # any zstandard reader unpacks the frames as one stream and skips the tables
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(ids)
    reader = frames.FrameReader(io.BytesIO(data), len(data))
    assert [reader.document(k) for k in range(len(reader))] == ids
    assert reader.start.tolist() == [0, 1, 5, 10, 23]
    assert [list(reader.places(d)) for d in (-3, 7, 8)] == [[1], [2, 3], []]
    broken = bytearray(data)
    broken[int(reader.at[2]) - 1] ^= 1
    reader = frames.FrameReader(io.BytesIO(bytes(broken)), len(broken))
    assert reader.document(0) == ids[0]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.document(1)


def test_reading_touches_only_the_frames_asked_for():
    class Counting(io.BytesIO):
        seen = 0

        def read(self, n=-1):
            data = super().read(n)
            Counting.seen += len(data)
            return data

    rng = np.random.default_rng(1)
    out = io.BytesIO()
    writer = frames.FrameWriter(out)
    for d in range(200):
        writer.add(d, rng.integers(0, 50_000, 1000).astype("<u4").tobytes())
    writer.close()
    source = Counting(out.getvalue())
    reader = frames.FrameReader(source, len(out.getvalue()))
    Counting.seen = 0
    reader.document(117)
    assert 0 < Counting.seen < len(out.getvalue()) / 100


def want_rows(rows):
    """(doc_id, start, n_tokens, ids_crc32) in order of doc_id."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, out = 0, []
    for (d, _), x in zip(ordered, token_ids([t or "" for _, t in ordered])):
        x[-1] = 0
        out.append((d, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    return out


def read(docs, folder, **parts):
    manifest = frames.write_frames(docs, folder)
    return manifest, [tuple(r) for r in frames.token_rows(frames.read_frames(manifest, folder)).collect()]


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FILE_BYTES", 1_000)
    rows = [(d * 7 % 101 - 20, t) for d, t in enumerate(odd_texts(93))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("file"), F.lit(2).alias("__mark"))
    manifest, got = read(docs.repartition(5), str(tmp_path / "a"))
    assert manifest.count() > 3
    assert sorted(got) == want_rows(rows)
    wanted = spark.createDataFrame([(-20,), (3,), (50,), (50,), (999,), (None,)], "doc_id long")
    some = frames.token_rows(frames.read_documents(manifest, str(tmp_path / "a"), wanted)).collect()
    assert sorted(map(tuple, some)) == [r for r in want_rows(rows) if r[0] in (-20, 3, 50)]


def test_odd_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FRAME_IDS", 100)
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(None, "no id"), (None, "no id"), (1, None), (2, ""), (2, ""), (3, long), (4, "x"), (4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest, got = read(docs, str(tmp_path / "b"))
    want = want_rows(rows)
    assert sorted((r[0] or 0, *r[2:]) for r in got) == sorted((r[0] or 0, *r[2:]) for r in want)
    assert sorted(r[1] for r in got) == [*np.cumsum([0] + [r[2] for r in sorted(got, key=lambda r: r[1])])[:-1]]
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [r[0] for r in want]
    found = frames.read_documents(manifest, str(tmp_path / "b"), spark.createDataFrame([(4,), (3,)], "doc_id long"))
    assert sorted(r.doc_id for r in found.collect()) == [3, 4, 4]
    manifest, got = read(docs.limit(0), str(tmp_path / "c"))
    assert got == [] and manifest.count() == 0
    assert frames.read_documents(manifest, str(tmp_path / "c"), docs).count() == 0


def test_equal_ids_spread_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FILE_BYTES", 1_000)
    rows = [(5, f"text number {i}") for i in range(300)] + [(i, "other") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest, got = read(docs, str(tmp_path / "d"))
    assert manifest.agg(F.max("documents")).first()[0] < 160
    assert sorted((r[0], *r[2:]) for r in got) == sorted((r[0], *r[2:]) for r in want_rows(rows))
    five = frames.read_documents(manifest, str(tmp_path / "d"), spark.createDataFrame([(5,)], "doc_id long"))
    assert five.count() == 301 and five.select("start").distinct().count() == 301


def test_query(spark, sf):
    from ticketloom.llm.catalog import load

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, load()[0]["op11_token_frames"](spark, sf).collect())) == want_rows(docs)
