from collections import defaultdict
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import SF01
from tabflow.operators import registry
from tabflow.plans import fixtures as fx


def _replay(events):
    """Sequential replay of the event log (the registry's own semantics)."""
    stage, tags, seen = {}, defaultdict(dict), {}
    for e in sorted(events, key=lambda r: r.seq):
        v = (e.name, e.version)
        seen.setdefault(v, e.seq)
        stage.setdefault(v, "None")
        if e.kind == "stage":
            stage[v] = e.to_stage
            if e.archive_existing:
                for w, s in stage.items():
                    if w != v and w[0] == e.name and s == e.to_stage:
                        stage[w] = "Archived"
        else:
            tags[v][e.key] = e.value
    return stage, tags


def test_current_stage_equals_replay(spark):
    ev = fx.version_events(spark, SF01)
    stage, tags = _replay(ev.collect())
    got = {(r.name, r.version): r.stage for r in registry.current_stage(ev).collect()}
    assert got == stage
    assert sum(s == "Archived" for s in got.values()) > 0
    got_tags = defaultdict(dict)
    for r in registry.current_tags(ev).collect():
        got_tags[(r.name, r.version)][r.key] = r.value
    assert dict(got_tags) == {k: v for k, v in tags.items() if v}


def test_gate_is_monotone(spark):
    ev = fx.version_events(spark, SF01)
    tags = registry.current_tags(ev)
    stages = registry.current_stage(ev)
    before = {(r.name, r.version): r.rejected for r in registry.gate(tags, stages).collect()}
    # turning one check into a failure can only reject more versions
    worse = tags.withColumn("value", F.when(F.col("key") == "predicts", F.lit("0")).otherwise(F.col("value")))
    after = {(r.name, r.version): r.rejected for r in registry.gate(worse, stages).collect()}
    assert all(after[k] or not before[k] for k in before)
    retrain = registry.gate(tags, stages, flow="retrain").collect()
    assert {r.next_stage for r in retrain if not r.rejected} <= {"Production"}
    assert {r.next_stage for r in retrain if r.rejected} <= {"None"}


def test_versions_numbered_per_model(spark):
    ev = fx.version_events(spark, SF01)
    v = registry.versions(ev).collect()
    by = defaultdict(list)
    for r in v:
        by[r.name].append((r.registered_seq, r.version_number))
    for rows in by.values():
        rows.sort()
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))


def test_select_run_ties_and_floor(spark):
    t = datetime(2024, 1, 1)
    rows = [registry.run_row(spark, "a", "lgbm", {"test_accuracy_score": 0.9}, end_time=t),
            registry.run_row(spark, "b", "lgbm", {"test_accuracy_score": 0.8}, end_time=t),
            registry.run_row(spark, "c", "lgbm", {"test_accuracy_score": 0.7}, end_time=datetime(2025, 1, 1)),
            registry.run_row(spark, "d", "other", {"test_accuracy_score": 0.95}, end_time=datetime(2025, 1, 1))]
    runs = rows[0]
    for r in rows[1:]:
        runs = runs.unionByName(r)
    best = registry.select_run(runs, run_name="lgbm").collect()
    assert [r.run_id for r in best] == ["b"]  # tie on end time: larger run id
    none = registry.select_run(runs, floor=0.99).collect()
    assert none == []
    lb = registry.leaderboard(runs, "test_accuracy_score", 2).collect()
    assert [r.run_id for r in lb] == ["d", "a"]


def test_latest_and_release(spark):
    ev = [registry.register_event(spark, 1, "m", 1, "stage", "staging"),
          registry.register_event(spark, 2, "m", 2, "stage", "Staging"),
          registry.register_event(spark, 3, "m", 1, "tag", key="overall status", value=registry.STATUS_RELEASE),
          registry.register_event(spark, 4, "m", 2, "tag", key="overall status", value=registry.STATUS_RECHECK),
          registry.register_event(spark, 5, "m", 3, "stage", "Production", archive_existing=True)]
    df = ev[0]
    for e in ev[1:]:
        df = df.unionByName(e)
    st = registry.current_stage(df)
    assert {r.version: r.stage for r in st.collect()} == {1: "Staging", 2: "Staging", 3: "Production"}
    assert [tuple(r) for r in registry.latest_versions(st, ["staging"]).collect()] == [("m", "Staging", 2)]
    rel = registry.find_release(st, registry.current_tags(df)).collect()
    assert [(r.name, r.version) for r in rel] == [("m", 1)]


def test_tags_as_map_last_write_wins(spark):
    ev = [registry.register_event(spark, 1, "m", 1, "tag", key="predicts", value="0"),
          registry.register_event(spark, 2, "m", 1, "tag", key="predicts", value="1"),
          registry.register_event(spark, 3, "m", 1, "tag", key="description", value="d")]
    df = ev[0].unionByName(ev[1]).unionByName(ev[2])
    row = registry.tags_as_map(registry.current_tags(df)).first()
    assert row.tags == {"predicts": "1", "description": "d"}
