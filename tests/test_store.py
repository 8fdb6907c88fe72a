"""The stored table: batches that cannot delete, buckets, compaction, steps that were cut off."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from jobsift.plans import load as load_mod
from jobsift.plans.load import load_folder
from jobsift.schema import LISTING_COLUMNS
from jobsift.sources import batches
from jobsift.sources import store as st
from jobsift.streaming import ingest as ingest_mod
from jobsift.streaming.ingest import ingest_drop_folder

HEADER = ",".join(LISTING_COLUMNS) + "\n"
TEXT = ", ".join(f"{c} string" for c in LISTING_COLUMNS)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _file(drop, name, ids, site="Indeed"):
    _write(f"{drop}/{name}.csv", HEADER + "".join(f"{i},{site},Dev,Acme,https://x/{i},2024-01-01 08:00:00,Remote,\n" for i in ids))


def _rows(spark, ids, site="Indeed"):
    return spark.createDataFrame([(str(i), site, "t", "c", "l", "2024-01-01 08:00:00", None, None) for i in ids], TEXT)


def _ids(spark, store):
    return sorted((r.listing_id for r in st.read_listings(spark, store).collect()), key=lambda x: (len(x), x))


def _old_store(spark, store, batch, ids, site="Indeed"):
    """A batch as it was written before there were buckets and manifests."""
    st.conform_listing(_rows(spark, ids, site)).write.partitionBy("source").parquet(batches.batch_dir(store, batch))


@pytest.mark.parametrize("old", [False, True])
def test_a_load_under_a_taken_id_never_deletes(spark, tmp_dir, old):
    """Rows 1 and 2 stay under batch 7, however often another file is loaded under that id."""
    store, drop = tmp_dir + "/store", tmp_dir + "/drop"
    if old:
        _old_store(spark, store, "7", [1, 2])
    else:
        st.append_listings(_rows(spark, [1, 2]), store, "7")
    _file(drop, "Indeed_20240101_0800", [9])
    for _ in range(3):
        with pytest.raises(ValueError):
            load_folder(spark, drop, store, "7", tmp_dir + "/out")
        assert _ids(spark, store) == ["1", "2"]
    assert not os.path.exists(tmp_dir + "/out")
    load_folder(spark, drop, store, "8", tmp_dir + "/out")
    assert _ids(spark, store) == ["1", "2", "9"]


def test_a_lost_inputs_folder_or_manifest_does_not_replace(spark, tmp_dir):
    store, drop = tmp_dir + "/store", tmp_dir + "/drop"
    _file(drop, "Indeed_20240101_0800", [1, 2])
    load_folder(spark, drop, store, "7")
    batches.delete(spark, f"{store}/load_batch=7/{batches.MANIFEST}")
    with pytest.raises(ValueError):
        load_folder(spark, drop, store, "7")


def test_of_two_concurrent_loads_of_an_id_one_fails(spark, tmp_dir, monkeypatch):
    """Both have planned and written before either publishes."""
    store = tmp_dir + "/store"
    gate, real, results = threading.Barrier(2), batches.publish, []

    def publish(*args):
        gate.wait(60)
        return real(*args)

    monkeypatch.setattr(batches, "publish", publish)

    def load(i):
        try:
            st.append_listings(_rows(spark, [i]), store, "7")
            results.append((i, "stored"))
        except batches.BatchExists:
            results.append((i, "failed"))

    threads = [threading.Thread(target=load, args=(i,)) for i in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r for _, r in results) == ["failed", "stored"]
    assert _ids(spark, store) == [str(i) for i, r in results if r == "stored"]
    assert os.listdir(store + "/_staging") == []


def test_a_batch_is_published_whole(spark, tmp_dir, monkeypatch):
    """A run that ends before the rename leaves nothing that a reader sees."""
    store = tmp_dir + "/store"
    st.append_listings(_rows(spark, [1]), store, "a")
    monkeypatch.setattr(batches, "rename", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        st.append_listings(_rows(spark, [2]), store, "b")
    monkeypatch.undo()
    assert _ids(spark, store) == ["1"]
    assert st.append_listings(_rows(spark, [2]), store, "b", identity="x")
    assert not st.append_listings(_rows(spark, [3]), store, "b", identity="x")  # the same batch again
    with pytest.raises(batches.BatchExists):
        st.append_listings(_rows(spark, [3]), store, "b", identity="y")
    assert _ids(spark, store) == ["1", "2"]
    with pytest.raises(ValueError):
        st.append_listings(_rows(spark, [3]), store, "compacted-000001")


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_reads_the_buckets_of_its_keys(spark, tmp_dir, monkeypatch):
    store, drop = tmp_dir + "/store", tmp_dir + "/drop"
    st.append_listings(_rows(spark, range(500)).unionByName(_rows(spark, range(500), "Dice")), store, "0", buckets=64)
    assert st.store_buckets(spark, store) == 64
    st.append_listings(_rows(spark, [500]), store, "1", buckets=8)  # the store's own number counts
    seen = {}
    real = load_mod.plan_batch

    def plan(rows, known, *args, **kw):
        seen["plan"] = _executed(known)
        seen["files"] = known.select(F.input_file_name()).distinct().count()
        return real(rows, known, *args, **kw)

    monkeypatch.setattr(load_mod, "plan_batch", plan)
    _file(drop, "Indeed_20240101_0800", [7, 499, 1000])
    load_folder(spark, drop, store, "2", tmp_dir + "/out")
    assert "PartitionFilters" in seen["plan"] and "bucket" in seen["plan"] and "ReadSchema: struct<listing_id:string>" in seen["plan"]
    assert 1 <= seen["files"] <= 4  # of 129: files with rows that are read
    r, = spark.read.parquet(tmp_dir + "/out").collect()
    assert (r.n_rows, r.n_new, r.n_loaded) == (3, 1, 1)
    # the buckets hold what their hash says
    rows = spark.read.schema(st.STORE_SCHEMA).parquet(store)
    assert rows.filter(st.bucket_of(rows.listing_id, 64) != rows.bucket).count() == 0


def test_an_old_store_is_still_read_and_grows(spark, tmp_dir):
    store, drop = tmp_dir + "/store", tmp_dir + "/drop"
    _old_store(spark, store, "0", [1, 2])
    _old_store(spark, store, "1", [3], "Dice")
    assert _ids(spark, store) == ["1", "2", "3"]
    _file(drop, "Indeed_20240101_0800", [2, 4])
    load_folder(spark, drop, store, "2", tmp_dir + "/out")
    assert _ids(spark, store) == ["1", "2", "3", "4"]
    assert {tuple(r) for r in st.read_known_keys(spark, store, ["Indeed"]).collect()} == {(i, "Indeed") for i in "124"}
    assert {r.load_batch for r in st.read_store(spark, store).collect()} == {"0", "1", "2"}


@pytest.mark.parametrize("old", [False, True])
def test_compaction_keeps_rows_keys_and_identities(spark, tmp_dir, old):
    store, drop = tmp_dir + "/store", tmp_dir + "/drop"
    if old:
        _old_store(spark, store, "old", [100, 101])
    for k in range(3):
        _file(f"{drop}{k}", "Indeed_20240101_0800", range(10 * k, 10 * k + 12))
        load_folder(spark, f"{drop}{k}", store, f"b{k}", tmp_dir + "/out")
    before = sorted(map(tuple, st.read_store(spark, store).collect()))
    name = st.compact_store(spark, store)
    assert name == "compacted-000001" and st.compact_store(spark, store) is None
    assert sorted(map(tuple, st.read_store(spark, store).collect())) == before
    assert sorted(map(tuple, st.read_known_keys(spark, store).collect())) == sorted((r[0], r[1]) for r in before)
    assert len(st.live_paths(spark, store)) == 1
    # a compacted batch is known: the same files are done, others an error
    load_folder(spark, f"{drop}1", store, "b1", tmp_dir + "/again")
    assert [(r.n_rows, r.n_loaded) for r in spark.read.parquet(tmp_dir + "/again").collect()] == [(12, 10)]
    with pytest.raises(ValueError):
        load_folder(spark, f"{drop}2", store, "b1")
    with pytest.raises(ValueError):
        st.append_listings(_rows(spark, [5000]), store, "b2")
    assert sorted(map(tuple, st.read_store(spark, store).collect())) == before
    # it goes on growing, compacts again, and drops what was replaced
    _file(f"{drop}9", "Indeed_20240101_0800", [0, 900])
    load_folder(spark, f"{drop}9", store, "b9")
    assert st.compact_store(spark, store, keep_hours=0) == "compacted-000002"
    assert len(_ids(spark, store)) == len(before) + 1
    assert {r.load_batch for r in st.read_store(spark, store).collect()} == {r[-1] for r in before} | {"b9"}
    batches.remove_replaced(spark, store, 0)
    assert sorted(x for x in os.listdir(store) if x.startswith("load_batch")) == ["load_batch=compacted-000002"]
    assert len(_ids(spark, store)) == len(before) + 1
    with pytest.raises(ValueError):
        load_folder(spark, f"{drop}2", store, "b1")


@pytest.mark.parametrize("at", ["write", "publish", "delete"])
def test_a_killed_compaction_leaves_the_store_readable(spark, tmp_dir, monkeypatch, at):
    store = tmp_dir + "/store"
    for k in range(3):
        st.append_listings(_rows(spark, [k]), store, f"b{k}")

    def killed(*a, **k):
        raise RuntimeError("killed")

    monkeypatch.setattr(batches, {"write": "publish", "publish": "rename", "delete": "delete"}[at], killed)
    if at == "delete":
        assert st.compact_store(spark, store, keep_hours=0)
        with pytest.raises(RuntimeError):
            batches.remove_replaced(spark, store, 0)
    else:
        with pytest.raises(RuntimeError):
            st.compact_store(spark, store)
    monkeypatch.undo()
    assert _ids(spark, store) == ["0", "1", "2"]
    st.append_listings(_rows(spark, [3]), store, "b3")
    assert st.compact_store(spark, store) is not None
    assert _ids(spark, store) == ["0", "1", "2", "3"]


def test_a_step_cut_off_is_finished_whatever_arrives(spark, tmp_dir, monkeypatch):
    """The batch was stored, the read log not; another file arrives and a read one is corrected before the next run."""
    drop, root = tmp_dir + "/drop", tmp_dir + "/s"
    _file(drop, "Indeed_20240101_0800", [1, 2])
    _file(drop, "Dice_20240101_0800", [5], "Dice")
    real = load_mod.write_outcomes
    monkeypatch.setattr(load_mod, "write_outcomes", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(RuntimeError):
        ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out")
    monkeypatch.setattr(load_mod, "write_outcomes", real)
    _file(drop, "Indeed_20240102_0800", [2, 3])
    os.remove(drop + "/Dice_20240101_0800.csv")
    ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out", archive_dir=tmp_dir + "/archive")
    assert _ids(spark, root + "/store") == ["1", "2", "3", "5"]
    got = {(r.file_name, r.n_rows, r.n_loaded, r.outcome) for r in spark.read.parquet(root + "/out").collect()}
    assert got == {("Indeed_20240101_0800.csv", 2, 2, "LOADED"), ("Dice_20240101_0800.csv", 1, 1, "LOADED"),
                   ("Indeed_20240102_0800.csv", 2, 1, "LOADED")}
    assert sorted(os.listdir(tmp_dir + "/archive")) == ["Indeed_20240101_0800.csv", "Indeed_20240102_0800.csv"]
    # a corrected file of an archived name is loaded and archived in its place
    _file(drop, "Indeed_20240101_0800", [1, 2, 8])
    ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out", archive_dir=tmp_dir + "/archive")
    assert _ids(spark, root + "/store") == ["1", "2", "3", "5", "8"]
    assert [x for x in os.listdir(drop) if not x.startswith(".")] == []


def test_a_step_cut_off_before_it_is_stored_runs_again(spark, tmp_dir, monkeypatch):
    drop, root = tmp_dir + "/drop", tmp_dir + "/s"
    _file(drop, "Indeed_20240101_0800", [1, 2])
    real = load_mod.append_listings
    monkeypatch.setattr(load_mod, "append_listings", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(RuntimeError):
        ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out")
    monkeypatch.setattr(load_mod, "append_listings", real)
    _file(drop, "Indeed_20240102_0800", [2, 3])
    ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out")
    assert _ids(spark, root + "/store") == ["1", "2", "3"]
    assert len({r.load_batch for r in spark.read.parquet(root + "/out").collect()}) == 1


def test_the_read_log_does_not_grow_with_the_history(spark, tmp_dir, monkeypatch):
    drop, root = tmp_dir + "/drop", tmp_dir + "/s"
    monkeypatch.setattr(ingest_mod, "LOG_FOLDERS", 3)
    for k in range(7):
        _file(drop, f"Indeed_2024010{k + 1}_0800", [k, k + 1])
        ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out", archive_dir=tmp_dir + "/archive" if k % 2 else None)
    log = ingest_mod.read_log(spark, root + "/out")
    assert len(batches.live(batches.folders(spark, ingest_mod.read_log_path(root + "/out")))) <= 3
    assert log.count() <= 3 + 3  # what the folder holds, and the steps since
    assert _ids(spark, root + "/store") == [str(i) for i in range(8)]
    assert spark.read.parquet(root + "/out").count() == 7  # every file was read once
    ingest_drop_folder(spark, drop, root + "/store", root + "/ckpt", root + "/out")
    assert spark.read.parquet(root + "/out").count() == 7
