"""Slow, plain versions of the corpus operators to compare with."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array(x.ids + [1], dtype="<u4") for x in t.encode_batch(texts, add_special_tokens=False)]


def check_packing(rows, texts):
    """Pieces cover each document once, sequences are gapless, and little is padded."""
    ids = dict(zip(texts, token_ids([texts[d] or "" for d in texts])))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert pieces.keys() == ids.keys()
    for d, found in pieces.items():
        at = 0
        for start, length in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == len(ids[d])
    padding = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.01 * sum(map(len, ids.values()))


def slow_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = Counter()
    for s in shingles:
        h = xxh64_intdigest(s, 42)
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def slow_components(marks):
    root = {d: d for d in marks}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in ids}


def repeated_words(docs, least=50):
    words = {d: (t or "").encode().lower().split() for d, t in docs}
    holders = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - least + 1):
            holders[tuple(w[i : i + least])].add(d)
    covered = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                covered[d].update(range(i, i + least))
    return words, dict(covered)


def area_under_curve(labels, scores):
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    labels = np.array(labels)
    good = labels.sum()
    return (rank[labels == 1].sum() - good * (good + 1) / 2) / (good * (len(labels) - good))


def check_shards(rows, texts, shards=16):
    assert len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
