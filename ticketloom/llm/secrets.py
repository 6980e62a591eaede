r"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A ledger, two tables in a folder,
remembers which (blob, rule version) pairs were scanned and what was found. A run scans only pairs that are
not in the ledger, each distinct blob once however many paths and versions have it, and joins the findings
back to all paths.

Rules are regular expressions with a version; a changed rule gets a new version and is run again over old
blobs. Matches of a rule are leftmost and do not overlap; those that are too short are dropped. Spans are
(rule, start, end) in code points, end exclusive. All work is done by built-in expressions: positions come
from the lengths of the pieces between matches.

Inputs: documents (doc_id, text), or versions (path, text). Cases: null text is empty and has no spans; empty
and repeated rows, null doc_ids and several versions of a path give one row each; texts of any length are
scanned whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import stored, table, text_of
from ticketloom.llm.registry import query
from ticketloom.operators.joins import key_filter, only_possible
from ticketloom.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``group`` is the part of a match whose length must be at least ``least``."""

    name: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}:{self.version}"


#: Kinds every scan has, in the order in which spans with equal starts are listed.
BASE = (
    Rule(
        "assign",
        r"""(?:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        least=8,
        group=2,
    ),
    # a run of these characters is matched as a whole or not at all, so its least length can be in the pattern
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Kinds with a format of their own.
FORMATS = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + FORMATS

_SPAN = "array<struct<start:int,kind:int,end:int>>"
#: Characters of a text that are masked together.
CHUNK = 4096


def pieces_of(text: Column, rule: Rule) -> Column:
    """Lengths of the pieces between the matches of a rule, of the matches, and of what counts of them.

    They alternate, so running sums of them are the positions. NULL for a text without a match.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    value = matches if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    joined = F.arrays_zip(gaps.alias("gap"), matches.alias("hit"), value.alias("value"))
    lengths = F.transform(
        joined,
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            F.coalesce(F.length(x["hit"]), F.lit(0)).alias("hit"),
            F.coalesce(F.length(x["value"]), F.lit(-1)).alias("value"),
        ),
    )
    return F.when(F.regexp_like(text, pattern), lengths)


def _blobs(versions: DataFrame) -> DataFrame:
    """(blob, text), one row per distinct content. Copies meet inside tasks before they are shuffled."""
    return versions.groupBy("blob").agg(F.first("text").alias("text"))


def _scanned(versions: DataFrame, rules: tuple[Rule, ...], seen: DataFrame | None) -> DataFrame:
    """(blob, rules, hits, text) of the blobs with rules that are not ``seen``.

    ``hits`` has (kind, pieces) of the rules that match; the text is kept where there are any.
    """
    blobs, keys = _blobs(versions), {r.key: i for i, r in enumerate(rules)}
    todo = {k: F.lit(True) for k in keys}
    fresh = F.array(*[F.lit(k) for k in keys])
    if seen is not None:
        # of the ledger only what may be about these blobs is shuffled
        own = only_possible(seen.where(F.col("rule").isin(list(keys))), key_filter(versions, ["blob"]), ["blob"])
        known = own.groupBy("blob").agg(F.collect_set("rule").alias("known"))
        blobs = blobs.join(known, "blob", "left").where(F.coalesce(F.size("known"), F.lit(0)) < len(keys))
        todo = {k: ~F.coalesce(F.array_contains("known", k), F.lit(False)) for k in keys}
        fresh = F.array_except(fresh, F.coalesce("known", F.array().cast("array<string>")))
    tried = [
        F.struct(F.lit(keys[r.key]).alias("kind"), F.when(todo[r.key], pieces_of(F.col("text"), r)).alias("pieces"))
        for r in rules
    ]
    found = blobs.select("blob", "text", fresh.alias("rules"), F.filter(F.array(*tried), lambda x: x["pieces"].isNotNull()).alias("hits"))
    return found.select("blob", "rules", "hits", F.when(F.size("hits") > 0, F.col("text")).alias("text"))


def _spans(scanned: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, start, end), a row per span; positions are running sums over a rule's pieces of one blob."""
    hits = scanned.select("blob", F.explode("hits").alias("hit"))
    each = hits.select("blob", F.col("hit.kind").alias("kind"), F.posexplode("hit.pieces").alias("at", "piece"))
    upto = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("piece.gap") + F.col("piece.hit")).over(upto).cast("int"))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("kind") + 1)
    return placed.where(F.col("piece.value") >= least).select("blob", "kind", (F.col("end") - F.col("piece.hit")).alias("start"), "end")


class Ledger:
    """Scanned pairs and findings, as two growing tables under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    @property
    def scanned(self) -> DataFrame | None:
        """(blob, rule) pairs."""
        return self._read("scanned")

    @property
    def findings(self) -> DataFrame | None:
        """(blob, rule, start, end)."""
        return self._read("findings")

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans what is new in ``versions`` (blob, text) and records it.

        Findings are written before the pairs: a run that fails in between is repeated as a whole, and its
        findings are the same rows again, which reading counts once.
        """
        fresh = stored(_scanned(versions, rules, self.scanned))
        names = F.array(*[F.lit(r.key) for r in rules])
        found = _spans(fresh, rules).withColumn("rule", F.element_at(names, F.col("kind") + 1))
        found.select("blob", "rule", "start", "end").write.mode("append").parquet(f"{self.path}/findings")
        pairs = fresh.select("blob", F.explode("rules").alias("rule"))
        pairs.write.mode("append").parquet(f"{self.path}/scanned")


def content_address(text: str = "text") -> Column:
    """SHA-256 of a text; null is empty."""
    return F.sha2(text_of(text), 256)


def _by_blob(findings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per blob with findings: the sorted spans of all rules."""
    kind = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    span = F.struct("start", kind[F.col("rule")].alias("kind"), "end")
    return (
        findings.where(F.col("rule").isin([r.key for r in rules]))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(span)).alias("found"))
    )


def _shown(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.name) for r in rules])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _versions(docs: DataFrame) -> DataFrame:
    return docs.select(content_address().alias("blob"), text_of().alias("text"))


def _found(docs: DataFrame, ledger: Ledger | None, rules: tuple[Rule, ...], texts: bool = False) -> DataFrame:
    """(blob, found) of the contents of ``docs`` that have findings, sorted; with ``texts`` their text as well."""
    versions = _versions(docs)
    if ledger is None:
        fresh = stored(_scanned(versions, rules, None))
        by_blob = _spans(fresh, rules).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
        contents = fresh.where("text is not null").select("blob", "text")
    else:
        ledger.scan(versions, rules)
        own = only_possible(ledger.findings, key_filter(versions, ["blob"]), ["blob"])
        by_blob = stored(_by_blob(own, rules))
        contents = _blobs(versions.join(by_blob.select("blob"), "blob", "left_semi"))
    return stored(by_blob.join(contents, "blob")) if texts else by_blob


def scan_secrets(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, blob and found, the spans (start, kind, end) of its content; all from the ledger.

    Without a ledger the blobs of this call are scanned as if it were empty.
    """
    paths = docs.select("doc_id", content_address().alias("blob"))
    return paths.join(_found(docs, ledger, rules), "blob", "left").select(
        "doc_id", "blob", F.coalesce("found", F.expr(f"cast(array() as {_SPAN})")).alias("found")
    )


def secret_report(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """Per document the counts and the digest of the base kinds, and all spans."""
    found = scan_secrets(docs, ledger)
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[count(k).alias(f"n_{r.name}") for k, r in enumerate(BASE)],
        F.sha2(_shown(base, RULES), 256).alias("base_sha256"),
        _shown(F.col("found"), RULES).alias("spans"),
    )


def _clean_texts(contents: DataFrame, mark: str) -> DataFrame:
    """(blob, clean): the texts with each run of overlapping spans replaced by one mark, chunk by chunk."""
    spans = contents.select("blob", F.explode("found").alias("s")).select("blob", "s.start", "s.end")
    order = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    parted = spans.withColumn("new", (F.col("start") >= F.coalesce(F.max("end").over(order), F.lit(-1))).cast("int"))
    upto = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = parted.withColumn("run", F.sum("new").over(upto)).groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    chunks = F.sequence(F.floor(F.col("start") / CHUNK).cast("int"), F.floor((F.col("end") - 1) / CHUNK).cast("int"))
    held = runs.withColumn("chunk", F.explode(chunks)).withColumn("low", F.col("chunk") * CHUNK)
    hole = F.struct(
        F.greatest(F.col("start") - F.col("low"), F.lit(0)).alias("start"),
        F.least(F.col("end") - F.col("low"), F.lit(CHUNK)).alias("end"),
        F.when(F.col("start") >= F.col("low"), F.lit(mark)).otherwise("").alias("mark"),
    )
    holes = held.groupBy("blob", "chunk").agg(F.array_sort(F.collect_list(hole)).alias("holes"))
    parts = contents.select("blob", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{CHUNK}}})"), 1)).alias("chunk", "part"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(F.col("part"), s["at"] + 1, x["start"] - s["at"])
        return F.struct(x["end"].alias("at"), F.concat(s["out"], gap, x["mark"]).alias("out"))

    rest = lambda s: F.concat(s["out"], F.substring(F.col("part"), s["at"] + 1, F.lit(CHUNK)))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked_part = F.when(F.col("holes").isNull(), F.col("part")).otherwise(F.aggregate("holes", state, step, rest))
    done = parts.join(holes, ["blob", "chunk"], "left").select("blob", F.struct("chunk", masked_part.alias("part")).alias("p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "")
    return done.groupBy("blob").agg(joined.alias("clean"))


def masked(docs: DataFrame, ledger: Ledger | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with every span replaced; overlapping spans become one mark."""
    clean = stored(_clean_texts(_found(docs, ledger, RULES, texts=True), mark))
    rows = docs.select(F.struct("*").alias("row"), content_address().alias("blob")).join(clean, "blob", "left")
    field = lambda c: F.col("row").getField(c)
    return rows.select(*[(F.coalesce("clean", field(c)) if c == "text" else field(c)).alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rules AS (SELECT * FROM (VALUES
  (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  (1, 'access', '(AKIA[A-Z0-9]+)', 1, 16), (2, 'hex', '([0-9a-f]+)', 1, 32),
  (3, 'jwt', '(eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})', 1, 1),
  (4, 'pem', '(-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)', 1, 1), (5, 'forge', '(gh[pousr]_[A-Za-z0-9]{36,})', 1, 1))
  AS t(kind, name, pattern, grp, least)),
raw AS (
  SELECT doc_id, kind, name, least, regexp_extract_all(text, pattern, 0) AS hits,
         CASE WHEN grp = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 0) END AS vals,
         string_split_regex(text, pattern) AS gaps
  FROM d, rules),
spans AS (
  SELECT doc_id, kind, name, length(vals[i]) >= least AS ok,
         list_sum([length(g) for g in gaps[1:i]]) + coalesce(list_sum([length(h) for h in hits[1:i-1]]), 0) AS s,
         length(hits[i]) AS n
  FROM raw, unnest(range(1, len(hits) + 1)) AS u(i)),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, kind)
           FILTER (kind < 3) AS base,
         string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, kind) AS spans
  FROM spans WHERE ok GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)
"""


@query("op3_secrets", SQL)
def op3_secrets(spark, sf_dir):
    """Every document's content through a ledger that starts empty; the findings are read back from it."""
    ledger = Ledger(spark, scratch_path(spark, "secret-ledger"))
    return secret_report(table(spark, sf_dir, "documents"), ledger)
