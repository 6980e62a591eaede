"""Token ids of whole texts, with a bounded memory of words already tokenised."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ticketloom.llm.common import worker_state
from ticketloom.llm.words import hashes_of

TOKENIZER = "byte_bpe_50k.json"
#: Keys whose ids a worker keeps, some 40 bytes each; beyond that the half used least lately goes.
KNOWN = 1 << 19
#: Bytes of text tokenised together, one text at least.
BATCH_BYTES = 2_000_000
#: Unseen words tokenised in one call.
JOINED = 100

#: Latin and Cyrillic letters, the same in every version of the character tables.
_LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2af}\x{400}-\x{481}]+"


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch``, of about ``most`` bytes in ``column`` or a single row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Known:
    """Ids by key: sorted hashes point at entries, whose keys are compared as well."""

    def __init__(self, limit: int):
        self.limit, self.clock = limit, 0
        self.keys = pa.array([], pa.large_string())
        self.starts = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")
        self.used = np.zeros(0, dtype=np.int32)
        self.ranked = np.zeros(0, dtype=np.uint64)  # hashes in order, and the entry of each
        self.order = np.zeros(0, dtype=np.int32)

    def find(self, keys: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        self.clock += 1
        if not len(self.ranked):
            return np.full(len(keys), -1, dtype=np.int64)
        entry = self.order[np.minimum(np.searchsorted(self.ranked, hashes), len(self.ranked) - 1)].astype(np.int64)
        same = pc.equal(self.keys.take(pa.array(entry)), keys).to_numpy(zero_copy_only=False)
        entry[~same] = -1
        self.used[entry[same]] = self.clock
        return entry

    def add(self, keys: pa.Array, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.keys = pa.concat_arrays([self.keys, keys])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(hashes)
        at = np.searchsorted(self.ranked, hashes[order])
        self.ranked = np.insert(self.ranked, at, hashes[order])
        self.order = np.insert(self.order, at, (order + len(self.used)).astype(np.int32))
        self.used = np.concatenate([self.used, np.full(len(keys), self.clock, dtype=np.int32)])

    def shrink(self) -> None:
        """Drops the entries used least lately, if there are more than the limit."""
        n = len(self.used)
        if n <= self.limit:
            return
        keep = np.zeros(n, dtype=bool)
        keep[np.argsort(-self.used, kind="stable")[: self.limit // 2]] = True
        kept = np.flatnonzero(keep)
        lengths = np.diff(self.starts)[kept]
        self.ids = self.ids[spans(self.starts[kept], lengths)]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.keys = self.keys.take(pa.array(kept))
        self.used = self.used[kept]
        place = np.cumsum(keep) - 1  # of each kept entry among them
        ranked = keep[self.order]
        self.ranked, self.order = self.ranked[ranked], place[self.order[ranked]].astype(np.int32)


class Encoder:
    """Token ids of whole texts, from the ids of the stretches between spaces and line feeds.

    A byte-level vocabulary of this kind never lets a token reach from a visible character over the white
    space behind it, so a text may be cut before every run of spaces and line feeds. A stretch of letters with
    one blank before it or one point or comma behind it is the ids of its letters and those of the marks.
    Distinct letters and other stretches are tokenised once and kept as long as there is room. Texts with other
    white space or markup of special tokens go through the tokenizer as a whole.
    """

    WHOLE = (
        r"<\||[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    )

    def __init__(self, name: str = TOKENIZER, known: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.sep in name else public_tokenizers.path(name))
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: b for b in plain} | {b: 256 + n for n, b in enumerate(x for x in range(256) if x not in plain)}
        self.line, self.comma, self.point = (self._whole([c])[0][0] for c in "\n,.")
        # a letter that no longer token holds: words on both sides of it are merged as if they stood alone
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        joined = {letter for token in vocabulary if len(token) > 1 for letter in token}
        self.apart = next(c for c in map(chr, self.letters.values()) if c in vocabulary and c not in joined)
        self.apart_id = vocabulary[self.apart]
        self.spelt = self.letters | {0: ord(self.apart)}
        self.known = Known(known)

    def _wholes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._whole(texts)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=lengths.sum()), lengths

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters with at most one space before them, one after the other, and how many each has."""
        ids: list[int] = []
        for lo in range(0, len(words), JOINED):
            joined = "\x00".join(words[lo : lo + JOINED]).encode().decode("latin-1").translate(self.spelt)
            ids += [t.id for t in self.tokenizer.model.tokenize(joined)]
            ids.append(self.apart_id)
        found = np.array(ids, dtype="<u4")
        end = found == self.apart_id
        at = np.flatnonzero(end)
        return found[~end], np.diff(at, prepend=-1) - 1

    def _entries(self, keys: pa.Array) -> np.ndarray:
        """The place of each distinct key among the known ones; new ones are tokenised."""
        hashes = hashes_of(keys)
        entry = self.known.find(keys, hashes)
        new = entry < 0
        letters = pc.match_substring_regex(keys, f"^ ?{_LETTERS}$").to_numpy(zero_copy_only=False)
        rows = np.concatenate([np.flatnonzero(new & letters), np.flatnonzero(new & ~letters)])
        if len(rows):
            strings = keys.take(pa.array(rows))
            words = int((new & letters).sum())
            found = (self._words(strings[:words].to_pylist()), self._wholes(strings[words:].to_pylist()))
            entry[rows] = len(self.known.used) + np.arange(len(rows))
            self.known.add(strings, hashes[rows], *(np.concatenate(x) for x in zip(*found)))
        return entry

    def add(self, keys: pa.Array, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.keys = pa.concat_arrays([self.keys, keys])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(hashes)
        at = np.searchsorted(self.ranked, hashes[order])
        self.ranked = np.insert(self.ranked, at, hashes[order])
        self.order = np.insert(self.order, at, (order + len(self.used)).astype(np.int32))
        self.used = np.concatenate([self.used, np.full(len(keys), self.clock, dtype=np.int32)])

    def shrink(self) -> None:
        """Drops the entries used least lately, if there are more than the limit."""
        n = len(self.used)
        if n <= self.limit:
            return
        keep = np.zeros(n, dtype=bool)
        keep[np.argsort(-self.used, kind="stable")[: self.limit // 2]] = True
        kept = np.flatnonzero(keep)
        lengths = np.diff(self.starts)[kept]
        self.ids = self.ids[spans(self.starts[kept], lengths)]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.keys = self.keys.take(pa.array(kept))
        self.used = self.used[kept]
        place = np.cumsum(keep) - 1  # of each kept entry among them
        ranked = keep[self.order]
        self.ranked, self.order = self.ranked[ranked], place[self.order[ranked]].astype(np.int32)


class Encoder:
    """Token ids of whole texts, from the ids of the stretches between spaces and line feeds.

    A byte-level vocabulary of this kind never lets a token reach from a visible character over the white
    space behind it, so a text may be cut before every run of spaces and line feeds. A stretch of letters with
    one blank before it or one point or comma behind it is the ids of its letters and those of the marks.
    Distinct letters and other stretches are tokenised once and kept as long as there is room. Texts with other
    white space or markup of special tokens go through the tokenizer as a whole.
    """

    WHOLE = (
        r"<\||[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    )

    def __init__(self, name: str = TOKENIZER, known: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.sep in name else public_tokenizers.path(name))
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: b for b in plain} | {b: 256 + n for n, b in enumerate(x for x in range(256) if x not in plain)}
        self.line, self.comma, self.point = (self._whole([c])[0][0] for c in "\n,.")
        # a letter that no longer token holds: words on both sides of it are merged as if they stood alone
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        joined = {letter for token in vocabulary if len(token) > 1 for letter in token}
        self.apart = next(c for c in map(chr, self.letters.values()) if c in vocabulary and c not in joined)
        self.apart_id = vocabulary[self.apart]
        self.spelt = self.letters | {0: ord(self.apart)}
        self.known = Known(known)

    def _wholes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._whole(texts)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=lengths.sum()), lengths

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters with at most one space before them, one after the other, and how many each has."""
        ids: list[int] = []
        for lo in range(0, len(words), JOINED):
            joined = "\x00".join(words[lo : lo + JOINED]).encode().decode("latin-1").translate(self.spelt)
            ids += [t.id for t in self.tokenizer.model.tokenize(joined)]
            ids.append(self.apart_id)
        found = np.array(ids, dtype="<u4")
        end = found == self.apart_id
        at = np.flatnonzero(end)
        return found[~end], np.diff(at, prepend=-1) - 1

    def _entries(self, keys: pa.Array) -> np.ndarray:
        """The place of each distinct key among the known ones; new ones are tokenised."""
        hashes = hashes_of(keys)
        entry = self.known.find(keys, hashes)
        new = entry < 0
        letters = pc.match_substring_regex(keys, f"^ ?{_LETTERS}$").to_numpy(zero_copy_only=False)
        for kind, tokenise in ((letters, self._words), (~letters, self._wholes)):
            rows = np.flatnonzero(new & kind)
            if len(rows):
                strings = keys.take(pa.array(rows))
                entry[rows] = len(self.known.used) + np.arange(len(rows))
                self.known.add(strings, hashes[rows], *tokenise(strings.to_pylist()))
        return entry

    def _stretches(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches, one after the other, and the number of ids of each."""
        plain = pc.match_substring_regex(distinct, f"^[ \n]?{_LETTERS}[.,]?$")
        line = pc.and_(plain, pc.starts_with(distinct, "\n")).to_numpy(zero_copy_only=False)
        comma = pc.and_(plain, pc.ends_with(distinct, ",")).to_numpy(zero_copy_only=False)
        point = pc.and_(plain, pc.ends_with(distinct, ".")).to_numpy(zero_copy_only=False)
        bare = pc.utf8_rtrim(pc.utf8_ltrim(distinct, "\n"), ".,")
        keys = pc.if_else(plain, bare, distinct).dictionary_encode()
        entry = self._entries(keys.dictionary)[keys.indices.to_numpy()]
        start, core = self.known.starts[entry], np.diff(self.known.starts)[entry]
        size = core + line + comma + point
        ends = np.cumsum(size)
        out = np.empty(ends[-1] if len(ends) else 0, dtype="<u4")
        first = ends - size
        out[spans(first + line, core)] = self.known.ids[spans(start, core)]
        out[first[line]] = self.line
        out[ends[comma] - 1] = self.comma
        out[ends[point] - 1] = self.point
        self.known.shrink()
        return out, size

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Unsigned little-endian 32-bit ids of each text; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        apart = pc.match_substring_regex(texts, self.WHOLE).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        rows = np.flatnonzero(apart)
        for row, ids in zip(rows.tolist(), self._whole(texts.take(pa.array(rows)).to_pylist())):
            out[row] = np.array(ids, dtype="<u4").tobytes()
        rows = np.flatnonzero(~apart & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
        if not len(rows):
            return out
        texts = texts.take(pa.array(rows))
        if pc.any(pc.match_substring_regex(texts, r"[ \n][ \n]")).as_py():
            cut = pc.replace_substring_regex(texts, r"([^ \n])([ \n])", "\\1\x00\\2")
        else:  # a blank at the very start leaves an empty stretch before it
            cut = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
            cut = pc.utf8_ltrim(cut, "\x00")
        lists = pc.split_pattern(cut, "\x00")
        words = lists.flatten().dictionary_encode()
        ids, size = self._stretches(words.dictionary)
        at = words.indices.to_numpy()
        lengths = size[at]
        flat = ids[spans((np.cumsum(size) - size)[at], lengths)]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        bounds = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
        for k, row in enumerate(rows.tolist()):
            out[row] = flat[bounds[k] : bounds[k + 1]].tobytes()
        return out


def encoder(name: str = TOKENIZER) -> Encoder:
    """The encoder of this worker."""
    state = worker_state()
    if name not in state:
        state[name] = Encoder(name)
    return state[name]
