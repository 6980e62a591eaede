"""What the monitoring loop stores on its way: nothing wider than its steps read, and one whole snapshot."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq

from ticketloom import session
from ticketloom.catalog import standins as S
from ticketloom.operators import feedback, textvec
from ticketloom.plans import monitor
from ticketloom.sources import snapshots


def test_texts_are_stored_once(spark, sf, tmp_path, monkeypatch):
    stored, store = [], session.cut_lineage

    def noted(df):
        table = store(df)
        stored.append((df.columns, table.inputFiles()))
        return table

    monkeypatch.setattr(session, "cut_lineage", noted)
    monkeypatch.setattr(monitor, "cut_lineage", noted)
    monkeypatch.setattr(textvec, "cut_lineage", noted)
    log = feedback.apply_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    params = monitor.LoopParams(trials=1, folds=2, space={"max_depth": ("choice", [3]), "n_estimators": ("choice", [2])}, keywords=S.TEST_KEYWORDS)
    enriched, root = S.enriched(spark, sf), str(tmp_path / "snap")
    cache = S.embedding_cache(spark, sf).limit(0)
    monitor.monitor_and_retrain(enriched, log, cache, textvec.HashEncoder(16, "tiny"), S.NOW, "2024-01-01", root, "20240131_000000", params).collect()
    texts = {"body", "answer", "body_clean", "answer_clean"}
    assert not [columns for columns, _ in stored if texts & set(columns)]
    # new vectors are not needed once the features are stored
    vectors = [files for columns, files in stored if "embedding" in columns]
    assert vectors and not [f for files in vectors for f in files if os.path.exists(f.removeprefix("file://"))]
    # the snapshot itself is whole
    snapshot = snapshots.read_latest_snapshot(spark, root)
    assert set(enriched.columns) <= set(snapshot.columns) and snapshot.where("id >= 0").count() == enriched.count()
    part = glob.glob(f"{root}/snapshot=*/*.parquet")[0]
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"
