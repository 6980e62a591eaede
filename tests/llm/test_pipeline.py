"""Every stage of the pipeline against a brute-force version of it, on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
from llm_helpers import check_packing, slow_components, slow_fingerprint

from ticketloom.llm.common import table
from ticketloom.llm.quality import score_quality, train


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.stored(stage(spark, docs, sf))
        kept[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns

    before, after = kept["quality classifier"]
    source = table(spark, sf, "documents")
    scored = score_quality(source, train(source, table(spark, sf, "labels")))
    assert {r.doc_id for r in after} == {r.doc_id for r in scored.where("predicted = 1").collect()}

    before, after = kept["near duplicates"]
    component = slow_components({r.doc_id: slow_fingerprint(r.text) for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(component.values()))

    before, after = kept["decontamination"]
    gaps = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    split = lambda t: [w for w in gaps.split(re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
    windows = set()
    for r in table(spark, sf, "benchmark").collect():
        w = split(r.text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}
    clean = []
    for r in before:
        w, hit = split(r.text), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append(r)
    assert sorted(clean) == sorted(after)

    before, after = kept["secret scans"]
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    later = {r.doc_id: r for r in after}
    assert later.keys() == {r.doc_id for r in before}
    for r in before:
        spans = [m.span() for m in assign.finditer(r.text) if len(m[2]) >= 8]
        spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", r.text)]
        text = later[r.doc_id].text
        assert (text == r.text) == (not spans)
        assert later[r.doc_id].n_chars == len(text)
        assert not re.search("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", text)
        assert all(r.text[s:e] not in text for s, e in spans)

    before, after = kept["packing"]
    check_packing(after, {r.doc_id: r.text for r in before})


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "token: abcdefgh12 and more words"), (5, "the same text of a few words"),
    (6, "the same text of a few words"), (6, "the same text of a few words"), (None, "no id"), (7, "word " * 50_000),
]


def odd_documents(spark, rows):
    """The columns of documents and some that carry the names of internal ones."""
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'src' AS source", "cast(length(text) as bigint) AS n_chars"
    )
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in ("row_key", "clean", "blob", "score", "component_id", "__mark", "found")])


def test_odd_documents_pass_the_stages(spark, sf):
    plain = [(i, f"a plain sentence number {i} about nothing much") for i in range(100, 160)]
    docs = odd_documents(spark, ODD + plain)
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    for name in ("near duplicates", "decontamination", "secret scans"):
        docs = corpus_pipeline.stored(stages[name](spark, docs, sf))
        assert docs.columns == columns
    left = {r.doc_id: r for r in docs.collect()}
    # blank texts are one group, equal ones another; a row without an id stays; secrets are masked
    assert set(left) - {d for d, _ in plain} == {1, 4, 5, 7, None}
    assert left[4].text == "[SECRET] and more words" and left[4].n_chars == len(left[4].text)
    pieces = stages["packing"](spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == set(left)


def test_no_documents_pass_the_stages(spark, sf):
    docs = odd_documents(spark, ODD).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf))
        assert docs.count() == 0, name


def test_quality_stage_takes_odd_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    odd = odd_documents(spark, [(d if d is None else d + 10**6, t) for d, t in ODD]).select(docs.columns)
    kept = corpus_pipeline.quality(spark, docs.unionByName(odd), sf)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count() + len(ODD)
