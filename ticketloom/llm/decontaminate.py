"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton accepts every run of consecutive item words. Training tokens are streamed through it; at
each word it knows the longest run that ends there. A run of ``window`` words is an occurrence, and so is
a whole item that is shorter. Words inside occurrences are hit; a document is contaminated if it has hits
and they make up at least ``1 / coverage`` of its words. ``remove_spans`` cuts every span of hit words, which
exceeds the length limit, out of the text, from its first word to its last, and removes the documents that
exceed the coverage limit; ``drop_contaminated`` only does the latter.

Only stretches of words whose neighbours also stand side by side in some item can hold an occurrence, so
everything else is skipped by array lookups before the automaton runs.

Inputs: documents (doc_id, text), items (item_id, text). Cases: null or empty text has no words; an item
without words is no window; items with a null item_id cause hits but are not named or counted; repeated
items count once, repeated documents give one row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import opened, released, shared, stored, table, with_row_key
from ticketloom.llm.registry import query

WINDOW = 13
COVERAGE = 20
#: A word is what lies between ASCII characters other than letters and digits.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Words of items that one automaton holds, some 900 bytes each in a worker; more items are taken in several
#: passes over the documents.
MAX_ITEM_WORDS = 150_000

#: Rows scanned together.
ROWS = 2_000

_PART = "doc_id long, row_key long, n_words long, hits array<struct<s:int,e:int>>, items array<string>"
_CLEAN = f"{_PART}, clean string"


def words_of(text: str | None) -> list[str]:
    return [w for w in _GAPS.split((text or "").translate(_UPPER)) if w]


class ItemAutomaton:
    """Suffix automaton over several word sequences, with the items of every window."""

    def __init__(self, items: Iterable[tuple[str | None, list[str]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for i, ws in items if ws]
        pairs = set()
        for _, seq in sequences:
            last = 0
            for token in seq:
                last = self._extend(last, token)
            pairs.update(zip(seq, seq[1:]))
        #: state -> size of an occurrence that ends there -> items
        self.found: dict[int, dict[int, set[str]]] = {}
        sizes = set()
        for item, seq in sequences:
            size = min(window, len(seq))
            sizes.add(size)
            for i in range(len(seq) - size + 1):
                state = 0
                for token in seq[i : i + size]:
                    state = self.next[state][token]
                self.found.setdefault(state, {}).setdefault(size, set()).update([] if item is None else [item])
        self.shortest = min(sizes, default=0)
        n = max(1, len(self.vocabulary))
        self.pairs = np.unique(np.array([a * n + b for a, b in pairs], dtype=np.int64))
        self.terms = pa.array(list(self.vocabulary), pa.string())

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            old = self.next[last][token]
            return old if self.length[old] == self.length[last] + 1 else self._split(last, token, old)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            old = self.next[at][token]
            self.link[new] = old if self.length[old] == self.length[at] + 1 else self._split(at, token, old)
        return new

    def _split(self, at: int, token: int, old: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[old]))
        self.link[copy] = self.link[old]
        self.link[old] = copy
        while at >= 0 and self.next[at].get(token) == old:
            self.next[at][token] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def stream(self, tokens: list[int], start: int) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of every occurrence in a stretch of tokens that begins at ``start``."""
        state, longest = 0, 0
        for i, token in enumerate(tokens):
            while state and token not in self.next[state]:
                state = self.link[state]
                longest = self.length[state]
            if token not in self.next[state]:
                continue
            state, longest = self.next[state][token], longest + 1
            at = state
            while at > 0:
                for size, items in self.found.get(at, {}).items():
                    if size <= longest:
                        yield start + i + 1 - size, start + i + 1, items
                at = self.link[at]

    def stretches(self, tokens: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
        """Maximal (start, end) of at least the shortest window whose neighbouring words are item neighbours."""
        n = max(1, len(self.vocabulary))
        known = tokens >= 0
        joined = np.zeros(len(tokens), dtype=bool)  # word i continues word i - 1
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(self.pairs):
            codes = tokens[both - 1].astype(np.int64) * n + tokens[both]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            joined[both] = self.pairs[at] == codes
        joined[breaks[breaks < len(tokens)]] = False
        starts = np.flatnonzero(known & ~joined)
        ends = np.append(np.flatnonzero(~joined)[1:], len(tokens)) if len(tokens) else starts
        ends = ends[np.searchsorted(np.flatnonzero(~joined), starts)] if len(starts) else starts
        keep = ends - starts >= self.shortest
        yield from zip(starts[keep].tolist(), ends[keep].tolist())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words [first, end) of each span and what lies between them; spans are disjoint, in order."""
    words = [m.span() for m in re.finditer(WORD, text.translate(_UPPER))]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : words[first][0]])
        at = words[end - 1][1]
    return "".join([*out, text[at:]])


def _cut_texts(texts: list[str | None], hits: list) -> list[str | None]:
    """Texts of rows with hits, cut; None for the others."""
    return [cut_text(t, [(x["s"], x["e"]) for x in h]) if h else None for t, h in zip(texts, hits)]


def _scan(automaton, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = opened(automaton)
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            text = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
            spaced = pc.ascii_trim(pc.replace_substring_regex(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " ")
            lists = pc.split_pattern(spaced, " ")
            words, offsets = lists.flatten(), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            empty = pc.equal(spaced, "").to_numpy(zero_copy_only=False)
            tokens = pc.index_in(words, value_set=a.terms).fill_null(-1).to_numpy(zero_copy_only=False)
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            for s, e in a.stretches(tokens, offsets):
                row = int(np.searchsorted(offsets, s, side="right")) - 1
                for begin, end, names in a.stream(tokens[s:e].tolist(), s - int(offsets[row])):
                    spans.setdefault(row, []).append((begin, end))
                    items.setdefault(row, set()).update(names)
            n = np.where(empty, 0, np.diff(offsets))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("row_key"),
                    pa.array(n, pa.int64()),
                    pa.array(
                        [[{"s": s, "e": e} for s, e in _merged(spans.get(i, []))] for i in range(part.num_rows)],
                        pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])),
                    ),
                    pa.array([sorted(items.get(i, ())) for i in range(part.num_rows)], pa.list_(pa.string())),
                ],
                names=["doc_id", "row_key", "n_words", "hits", "items"],
            )


def _automata(items: DataFrame, window: int, max_words: int) -> Iterator[Broadcast]:
    """Broadcast automata over groups of at most ``max_words`` item words (a longer item alone)."""
    group, size = [], 0
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null")
    for item, text in rows.distinct().toLocalIterator():
        words = words_of(text)
        if group and size + len(words) > max_words:
            yield shared(items.sparkSession, ItemAutomaton(group, window))
            group, size = [], 0
        group.append((item, words))
        size += len(words)
    yield shared(items.sparkSession, ItemAutomaton(group, window))


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_item_words: int = MAX_ITEM_WORDS
) -> DataFrame:
    """Per row: doc_id, row_key, n_words, hits (merged word spans), items (names, sorted as strings).

    ``clean`` is the text without the spans, where there are any. An automaton of at most ``max_item_words``
    words is broadcast; with more items the documents are read once per group of items and the findings are
    united.
    """
    source = with_row_key(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    automata = list(_automata(items, window, max_item_words))
    if len(automata) == 1:
        return source.mapInArrow(lambda it: released(_cleaned(_scanned_with_text(automata[0], it))), _CLEAN)
    source = stored(source)  # fixes the row keys
    found = _found(source, automata)
    hit = found.where(F.size("hits") > 0).join(source.select("row_key", "text"), "row_key")
    clean = hit.select(*[x.split()[0] for x in _PART.split(", ")], "text").mapInArrow(_cleaned, _CLEAN)
    return clean.unionByName(found.where(F.size("hits") == 0).withColumn("clean", F.lit(None).cast("string")))


def _scanned_with_text(automaton, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for part in _scan(automaton, iter([batch])):
            text = batch.column("text").slice(done, part.num_rows)
            done += part.num_rows
            yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "text"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = batch.column("hits")
        rows = np.flatnonzero(pc.greater(pc.list_value_length(hits), 0).to_numpy(zero_copy_only=False))
        some = pa.array(rows)
        clean = np.full(batch.num_rows, None, dtype=object)
        clean[rows] = _cut_texts(batch.column("text").take(some).to_pylist(), hits.take(some).to_pylist())
        columns = [batch.column(x.split()[0]) for x in _PART.split(", ")]
        names = [x.split()[0] for x in _CLEAN.split(", ")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(clean, pa.string())], names=names)


def _found(source: DataFrame, automata: list[Broadcast]) -> DataFrame:
    parts = [source.mapInArrow(lambda it, a=a: _scan(a, it), _PART) for a in automata]
    if len(parts) == 1:
        return parts[0]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("hits", F.expr(_MERGE))


#: Sorted spans folded into disjoint ones.
_MERGE = """aggregate(array_sort(hits), cast(array() as array<struct<s:int,e:int>>), (out, x) -> if(
    size(out) > 0 and x.s <= element_at(out, -1).e,
    concat(slice(out, 1, size(out) - 1),
           array(named_struct('s', element_at(out, -1).s, 'e', greatest(x.e, element_at(out, -1).e)))),
    concat(out, array(x))))"""


def contamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """The digest per document: counts, the item names' hash, the verdict, and the hash of the text without the spans."""
    found = find_contamination(docs, items, window)
    hit = F.expr("cast(aggregate(hits, 0, (n, x) -> n + x.e - x.s) as long)")
    return found.withColumn("n_hit", hit).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))).alias("contaminated"),
        F.sha2("clean", 256).alias("clean_sha256"),
    )


def _cut(automaton, columns: list[str], coverage: int, spans: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = columns.index("text")
    for batch in batches:
        ids = pa.array(np.zeros(batch.num_rows, dtype=np.int64))
        source = pa.RecordBatch.from_arrays([ids, batch.column(at), ids], ["doc_id", "text", "row_key"])
        bad, clean = [np.zeros(0, dtype=bool)], []
        for part in _scanned_with_text(automaton, iter([source])):
            n, hits = part.column("n_words").to_numpy(), part.column("hits").to_pylist()
            hit = np.array([sum(x["e"] - x["s"] for x in h) for h in hits], dtype=np.int64)
            bad.append((hit > 0) & (hit * coverage >= n))
            if spans:
                texts = part.column("text").to_pylist()
                clean += [t if c is None else c for t, c in zip(texts, _cut_texts(texts, hits))]
        kept = pa.array(~np.concatenate(bad))
        if spans:
            batch = batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.column(at).type))
        yield batch.filter(kept)


def _without(docs: DataFrame, items: DataFrame, window: int, coverage: int, max_item_words: int, spans: bool) -> DataFrame:
    automata = list(_automata(items, window, max_item_words))
    if len(automata) == 1:
        columns = docs.columns
        return docs.mapInArrow(lambda it: released(_cut(automata[0], columns, coverage, spans, it)), docs.schema)
    keyed = stored(with_row_key(docs.select(F.struct("*").alias("row"))))
    source = keyed.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").cast("string").alias("text"), "row_key"
    )
    found = stored(_found(source, automata).where(F.size("hits") > 0))
    n_hit = F.expr("aggregate(hits, 0, (n, x) -> n + x.e - x.s)")
    over = n_hit * coverage >= F.col("n_words")
    kept = keyed.join(found.where(over).select("row_key"), "row_key", "left_anti")
    if not spans:
        return kept.select("row.*")
    hit = found.where(~over).join(source.select("row_key", "text"), "row_key")
    clean = hit.select(*[x.split()[0] for x in _PART.split(", ")], "text").mapInArrow(_cleaned, _CLEAN).select("row_key", "clean")
    field = lambda c: F.col("row").getField(c)
    return kept.join(clean, "row_key", "left").select(
        *[(F.coalesce("clean", field(c)) if c == "text" else field(c)).alias(c) for c in docs.columns]
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """The rows of ``docs``, all columns, without the contaminated ones.

    One narrow pass for one automaton; with more, hits are united by row before the verdict.
    """
    return _without(docs, items, window, coverage, max_item_words, spans=False)


def remove_spans(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """The rows that are not contaminated, all columns, with every span of hit words cut out of their text."""
    return _without(docs, items, window, coverage, max_item_words, spans=True)


SQL = r"""
WITH item_words AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size,
         array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS gram
  FROM item_words, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS gram
  FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
hits AS (SELECT doc_id, g.size, i, item FROM grams g JOIN windows x ON x.gram = g.gram AND x.size = g.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT DISTINCT doc_id, size, i FROM hits), unnest(range(i, i + size)) AS u(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id),
spots AS (SELECT DISTINCT doc_id, p FROM (SELECT DISTINCT doc_id, size, i FROM hits), unnest(range(i, i + size)) AS u(p)),
pieces AS (
  SELECT doc_id, piece, nth, count(*) FILTER (regexp_matches(piece, '^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]'))
           OVER (PARTITION BY doc_id ORDER BY nth) AS word, regexp_matches(piece, '^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]') AS is_word
  FROM (SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS nth
        FROM (SELECT doc_id, regexp_extract_all(text,
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ps
              FROM documents WHERE doc_id IN (SELECT doc_id FROM spots)))),
clean AS (
  SELECT p.doc_id, sha256(coalesce(string_agg(piece, '' ORDER BY nth) FILTER (
    CASE WHEN is_word THEN here.p IS NULL ELSE here.p IS NULL OR next.p IS NULL END), '')) AS clean_sha256
  FROM pieces p LEFT JOIN spots here ON here.doc_id = p.doc_id AND here.p = p.word
    LEFT JOIN spots next ON next.doc_id = p.doc_id AND next.p = p.word + 1
  GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       clean_sha256
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN clean USING (doc_id)
"""


@query("op9_decontaminate", SQL)
def op9_decontaminate(spark, sf_dir):
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
