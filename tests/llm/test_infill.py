"""Fill-in-the-middle against a plain version, and back."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def slow(text, h, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("block", "rate"), [(1 << 20, 100), (1, 100), (3, 60)])
def test_moves_and_restores(monkeypatch, block, rate):
    monkeypatch.setattr(infill, "BLOCK", block)
    rng = random.Random(block)
    parts = [*"ab\n\né😀<>PSM", "<P>", "\n"]
    for _ in range(150):
        texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 0, 3, 20]))) for _ in range(rng.randint(0, 12))]
        h = np.array([[rng.randrange(2**32) for _ in range(4)] for _ in texts], dtype=np.int64).reshape(len(texts), 4)
        column = pa.array(["left out", *texts], pa.string())[1:]
        units, form, prefix, middle, output = infill.infill(column, h, rate)
        for k, text in enumerate(texts):
            cut = (None, None) if form[k] == 0 else (prefix[k], middle[k])
            assert (units[k], infill.FORMS[form[k]], *cut, output[k].as_py()) == slow(text, h[k].tolist(), rate)
        assert infill.restore(output, form).to_pylist() == texts


def draws(doc_id):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def test_documents(spark):
    long = "".join(f"line {i} é\n" for i in range(200_000))
    rows = [
        (1, "a\nb\nc\nd"), (2, None), (3, ""), (4, "\n"), (5, "\n\n\n"), (6, "no end"), (7, "holds <M>\nitself\n"),
        (8, long), (9, "a\nb\nc\nd"), (9, "a\nb\nc\nd"), (None, "x\ny\nz\n"), (10, "\r\n\x0b \nline\n😀"),
    ]
    clash = ["h1", "form", "output", "n", "restored"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in clash])
    got = infill.restored(infill.infill_documents(docs)).collect()
    want = [(d, *slow(t or "", draws(d)), t or "") for d, t in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert infill.restored(infill.infill_documents(docs.limit(0))).count() == 0


def test_rate_and_share(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\n").alias("text"))
    got = infill.infill_documents(docs, rate=40, spm=10).collect()
    assert sorted(map(tuple, got)) == sorted((d, *slow("a\nb\nc\n", draws(d), 40, 10)) for d in range(400))
    assert 0 < sum(r.form == "spm" for r in got) < sum(r.form == "psm" for r in got) < 200
