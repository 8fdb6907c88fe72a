"""Listing files: CSV edge cases, discovery, store, streaming ingest."""

import os


from jobsift.plans.load import load_folder
from jobsift.schema import LISTING_COLUMNS
from jobsift.sources import listing_csv as csvio
from jobsift.sources import store as st
from jobsift.streaming.ingest import ingest_drop_folder

HEADER = ",".join(LISTING_COLUMNS) + "\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _drop(tmp_dir):
    d = tmp_dir + "/drop"
    _write(d + "/LinkedIn_20240101_0800.csv", HEADER
           + '1,LinkedIn,"say ""hi"", you",Acme,https://l/1,2024-01-01 08:00:00,"Columbus,\nOH",\n'
           + "x9,LinkedIn,Dev,Acme,https://l/x9,2024-01-01 08:00:00,Remote,$1K Annually\n")
    _write(d + "/Indeed_20240101_0800.csv", HEADER
           + "7,Indeed,Dev,Acme,https://i/7,bad,Remote,\n"
           + "8,Indeed,Dev,Acme,https://i/8,2024-01-01 08:00:00,Remote,\n")
    _write(d + "/BuiltIn_20240101_0800.csv", HEADER
           + "5,BuiltIn,QA,Acme,https://b/5,2024-01-01 08:00:00,,\n")
    _write(d + "/Dice_20240101_0800.csv", HEADER)  # a search that found nothing
    _write(d + "/Processed/LinkedIn_20231231_0800.csv", HEADER + "2,LinkedIn,a,b,c,2024-01-01 08:00:00,,\n")
    _write(d + "/Indeed_20231231_0800.CSV", HEADER + "3,Indeed,a,b,c,2024-01-01 08:00:00,,\n")
    _write(d + "/notes.txt", "not a listing file\n")
    return d


def test_csv_quotes_newlines_and_nulls(spark, tmp_dir):
    d = _drop(tmp_dir)
    rows = {r.listing_id: r for r in csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()}
    assert set(rows) == {"1", "x9", "7", "8", "5"}
    assert rows["1"].title == 'say "hi", you'
    assert rows["1"].location == "Columbus,\nOH"
    assert rows["1"].compensation is None and rows["5"].location is None
    assert rows["7"].time_when_scraped == "bad"
    assert rows["1"].file_name == "LinkedIn_20240101_0800.csv"


def test_discovery_skips_subfolders_and_other_suffixes(spark, tmp_dir):
    d = _drop(tmp_dir)
    got = {r.file_name: r.n_rows for r in csvio.discover_listing_files(spark, d).collect()}
    assert got == {"LinkedIn_20240101_0800.csv": 2, "Indeed_20240101_0800.csv": 2,
                   "BuiltIn_20240101_0800.csv": 1, "Dice_20240101_0800.csv": 0}


def test_write_read_round_trip(spark, tmp_dir):
    d = _drop(tmp_dir)
    src = csvio.read_listings_csv(spark, csvio.top_level_csv(d))
    out = tmp_dir + "/out"
    csvio.write_result_set_csv(src.drop("file_time"), out)
    back = csvio.read_listings_csv(spark, csvio.top_level_csv(out)).drop("file_time")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.drop("file_time").collect()))


def test_bulk_load_outcomes_and_replay(spark, tmp_dir):
    d = _drop(tmp_dir)
    store, outcomes = tmp_dir + "/store", tmp_dir + "/outcomes"
    load_folder(spark, d, store, "b1", outcomes)
    res = {r.file_name: r.outcome for r in spark.read.parquet(outcomes).collect()}
    assert res == {"LinkedIn_20240101_0800.csv": "LOADED",  # x9 dropped by the id rule
                   "Indeed_20240101_0800.csv": "ERROR",  # 'bad' time quarantines the whole file
                   "BuiltIn_20240101_0800.csv": "LOADED",
                   "Dice_20240101_0800.csv": "EMPTY"}
    assert sorted(r.listing_id for r in st.read_listings(spark, store).collect()) == ["1", "5"]
    # a replay of the same batch replaces it; a new batch finds nothing new
    load_folder(spark, d, store, "b1", outcomes)
    assert st.read_listings(spark, store).count() == 2
    load_folder(spark, d, store, "b2", outcomes)
    again = {r.file_name: r.outcome for r in spark.read.parquet(outcomes).filter("load_batch = 'b2'").collect()}
    assert again["LinkedIn_20240101_0800.csv"] == "NO_NEW"
    assert st.read_listings(spark, store).count() == 2


def test_streaming_ingest_is_incremental(spark, tmp_dir):
    d = _drop(tmp_dir)
    root = tmp_dir + "/s"
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes", max_files_per_trigger=1)
    first = st.read_listings(spark, root + "/store").count()
    assert first == 2
    res = {r.file_name: r.outcome for r in spark.read.parquet(root + "/outcomes").collect()}
    assert res["Dice_20240101_0800.csv"] == "EMPTY" and res["Indeed_20240101_0800.csv"] == "ERROR"
    # a new file arrives; a rerun picks up only it
    _write(d + "/Indeed_20240102_0800.csv", HEADER + "9,Indeed,QA,Acme,https://i/9,2024-01-02 08:00:00,Remote,\n"
           + "8,Indeed,Dev,Acme,https://i/8,2024-01-01 08:00:00,Remote,\n")
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes", max_files_per_trigger=1)
    ids = sorted(r.listing_id for r in st.read_listings(spark, root + "/store").collect())
    assert ids == ["1", "5", "8", "9"]


def test_known_keys_scan_is_pruned(spark, tmp_dir):
    d = _drop(tmp_dir)
    store = tmp_dir + "/store"
    load_folder(spark, d, store, "b1")
    keys = st.read_known_keys(spark, store, sources=["LinkedIn"])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<listing_id:string>" in plan and "PartitionFilters" in plan
    assert [tuple(r) for r in keys.collect()] == [("1", "LinkedIn")]


def test_streaming_ingest_can_archive_files(spark, tmp_dir):
    d = _drop(tmp_dir)
    root = tmp_dir + "/a"
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes", archive_dir=tmp_dir + "/archive")
    assert st.read_listings(spark, root + "/store").count() == 2
    outcomes = {r.file_name: r.outcome for r in spark.read.parquet(root + "/outcomes").collect()}
    assert outcomes["Indeed_20240101_0800.csv"] == "ERROR"


def test_replayed_batch_is_written_once(spark, tmp_dir, monkeypatch):
    """A batch that fails after its append (before the stream commits it) is replayed on
    restart: it replaces its own partition and does not see its own rows as stored."""
    import pytest

    import jobsift.plans.load as load_mod

    d = _drop(tmp_dir)
    root = tmp_dir + "/r"
    real = load_mod.write_outcomes
    calls = {"n": 0}

    def flaky(outcomes, path, batch_id):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("lost the driver after the append")
        return real(outcomes, path, batch_id)

    monkeypatch.setattr(load_mod, "write_outcomes", flaky)
    with pytest.raises(RuntimeError):
        ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    assert st.read_listings(spark, root + "/store").count() == 2  # appended, not committed
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    assert sorted(r.listing_id for r in st.read_listings(spark, root + "/store").collect()) == ["1", "5"]
    res = {r.file_name: r.outcome for r in spark.read.parquet(root + "/outcomes").collect()}
    assert res["LinkedIn_20240101_0800.csv"] == "LOADED" and res["Indeed_20240101_0800.csv"] == "ERROR"


def test_stream_and_bulk_batches_do_not_collide(spark, tmp_dir):
    d = _drop(tmp_dir)
    store = tmp_dir + "/store"
    load_folder(spark, d, store, "0")  # a bulk load named like a micro-batch number
    _write(d + "/Indeed_20240102_0800.csv", HEADER + "9,Indeed,QA,Acme,https://i/9,2024-01-02 08:00:00,Remote,\n")
    ingest_drop_folder(spark, d, store, tmp_dir + "/ckpt", tmp_dir + "/outcomes")
    batches = {r.load_batch for r in spark.read.parquet(store).select("load_batch").distinct().collect()}
    assert "0" in batches and any(b.startswith("stream-") for b in batches)
    assert sorted(r.listing_id for r in st.read_listings(spark, store).collect()) == ["1", "5", "9"]


def test_header_only_result_sets(spark, tmp_dir):
    names = spark.createDataFrame([("Dice_20240101_0800.csv",), ("Indeed_20240101_1200.csv",)], "file_name string")
    csvio.write_empty_result_sets(names, tmp_dir + "/drop")
    got = {r.file_name: r.n_rows for r in csvio.discover_listing_files(spark, tmp_dir + "/drop").collect()}
    assert got == {"Dice_20240101_0800.csv": 0, "Indeed_20240101_1200.csv": 0}
    assert csvio.read_listings_csv(spark, csvio.top_level_csv(tmp_dir + "/drop")).count() == 0


def test_empty_id_quarantines_its_file(spark, tmp_dir):
    d = tmp_dir + "/drop"
    _write(d + "/Indeed_20240105_0800.csv", HEADER + ",Indeed,Dev,Acme,https://i/x,2024-01-05 08:00:00,Remote,\n"
           + "21,Indeed,QA,Acme,https://i/21,2024-01-05 08:00:00,Remote,\n")
    _write(d + "/BuiltIn_20240105_0800.csv", HEADER + "22,BuiltIn,QA,Acme,https://b/22,2024-01-05 08:00:00,,\n")
    rows = csvio.read_listings_csv(spark, csvio.top_level_csv(d)).collect()
    assert any(r.listing_id is None for r in rows)
    load_folder(spark, d, tmp_dir + "/store", "b1", tmp_dir + "/out")
    res = {r.file_name: (r.n_new, r.n_bad, r.outcome) for r in spark.read.parquet(tmp_dir + "/out").collect()}
    assert res == {"Indeed_20240105_0800.csv": (2, 1, "ERROR"), "BuiltIn_20240105_0800.csv": (1, 0, "LOADED")}
    assert [r.listing_id for r in st.read_listings(spark, tmp_dir + "/store").collect()] == ["22"]


def test_file_names_with_odd_characters_and_folders(spark, tmp_dir):
    d = tmp_dir + "/drop.csv"  # a drop folder whose own name ends in .csv
    _write(d + "/Indeed Jobs_20240101_1200.csv", HEADER + "1,Indeed,Dev,Acme,https://i/1,2024-01-01 12:00:00,Remote,\n")
    _write(d + "/a+b%c#d_20240101_1200.csv", HEADER + "2,Indeed,QA,Acme,https://i/2,bad,Remote,\n")
    got = {r.file_name: r.n_rows for r in csvio.discover_listing_files(spark, d).collect()}
    assert got == {"Indeed Jobs_20240101_1200.csv": 1, "a+b%c#d_20240101_1200.csv": 1}
    load_folder(spark, d, tmp_dir + "/store", "b1", tmp_dir + "/out")
    res = {r.file_name: r.outcome for r in spark.read.parquet(tmp_dir + "/out").collect()}
    assert res == {"Indeed Jobs_20240101_1200.csv": "LOADED", "a+b%c#d_20240101_1200.csv": "ERROR"}
    assert [r.listing_id for r in st.read_listings(spark, tmp_dir + "/store").collect()] == ["1"]


def test_file_name_rules(spark):
    from jobsift.functions.text import file_name_of_path, file_name_time
    paths = ["file:/d/X_20240101_0800.csv", "file:/d/file_name=Y_20240101_0800.csv/part-00000-1.c000.csv",
             "file:/d/Z.csv/part-00001.csv", "file:/d.csv/W_20241399_1200.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [(r.n, r.t) for r in df.select(file_name_of_path(df.p).alias("n"),
                                          file_name_time(file_name_of_path(df.p)).alias("t")).collect()]
    assert [n for n, _ in got] == ["X_20240101_0800.csv", "Y_20240101_0800.csv", "Z.csv", "W_20241399_1200.csv"]
    assert got[3][1] is None and got[2][1] is None and got[0][1] is not None


def test_rewriting_a_result_set_replaces_it(spark, tmp_dir):
    d = _drop(tmp_dir)
    src = csvio.read_listings_csv(spark, csvio.top_level_csv(d)).drop("file_time")
    out = tmp_dir + "/out"
    csvio.write_result_set_csv(src, out)
    csvio.write_result_set_csv(src.filter("source = 'LinkedIn'"), out)  # the LinkedIn run is written again
    again = csvio.read_listings_csv(spark, csvio.top_level_csv(out)).drop("file_time")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)


def test_empty_drop_folder_is_a_no_op(spark, tmp_dir):
    import os
    d = tmp_dir + "/empty"
    os.makedirs(d + "/Processed")
    assert csvio.discover_listing_files(spark, d).count() == 0
    assert csvio.read_listings_csv(spark, csvio.top_level_csv(d), empty_if_no_match=True).count() == 0
    load_folder(spark, d, tmp_dir + "/store", "b1", tmp_dir + "/out")
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):  # a named file that is gone is an error, not 'no rows'
        csvio.read_listings_csv(spark, [d + "/Gone_20240101_0800.csv"])


def test_stream_loads_a_multi_part_result_set_whole(spark, tmp_dir):
    d = tmp_dir + "/drop"
    rs = d + "/file_name=Indeed_20240101_0800.csv"
    _write(rs + "/part-00000-a.csv", HEADER + "1,Indeed,Dev,Acme,https://i/1,2024-01-01 08:00:00,Remote,\n")
    _write(rs + "/part-00001-a.csv", HEADER + "2,Indeed,,Acme,https://i/2,2024-01-01 08:00:00,Remote,\n")
    root = tmp_dir + "/s"
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes", max_files_per_trigger=1)
    # the NULL title in the second part quarantines the whole result set, first part included
    res = [(r.file_name, r.n_rows, r.outcome) for r in spark.read.parquet(root + "/outcomes").collect()]
    assert res == [("Indeed_20240101_0800.csv", 2, "ERROR")]
    import pytest
    from pyspark.errors import AnalysisException
    try:
        n = st.read_listings(spark, root + "/store").count()
    except AnalysisException:
        n = 0
    assert n == 0


def test_stream_reloads_a_rewritten_result_set(spark, tmp_dir):
    src = spark.createDataFrame([("1", "Indeed", "Dev", "Acme", "https://i/1", "2024-01-01 08:00:00", "Remote", None,
                                  "Indeed_20240101_0800.csv")],
                                ", ".join(f"{c} string" for c in LISTING_COLUMNS) + ", file_name string")
    d, root = tmp_dir + "/drop", tmp_dir + "/s"
    csvio.write_result_set_csv(src, d)
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    # the same result set is scraped again (same name) with one more listing
    more = src.union(src.selectExpr("'2' AS listing_id", *[c for c in src.columns if c != "listing_id"]))
    csvio.write_result_set_csv(more, d)
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    assert sorted(r.listing_id for r in st.read_listings(spark, root + "/store").collect()) == ["1", "2"]
    outcomes = sorted((r.load_batch, r.outcome) for r in spark.read.parquet(root + "/outcomes").collect())
    assert [o for _, o in outcomes] == ["LOADED", "LOADED"]


def _text_rows(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in LISTING_COLUMNS))


def test_a_reused_batch_id_never_deletes(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException
    one = _text_rows(spark, ("1", "LinkedIn", "a", "c", "l", "2024-01-01 08:00:00", None, None))
    st.append_listings(one, tmp_dir + "/store", "7")
    with pytest.raises(AnalysisException):
        st.append_listings(one.selectExpr("'3' AS listing_id", *LISTING_COLUMNS[1:]), tmp_dir + "/store", "7")
    assert [r.listing_id for r in st.read_listings(spark, tmp_dir + "/store").collect()] == ["1"]


def test_a_bulk_batch_id_with_other_files_is_an_error(spark, tmp_dir):
    import pytest
    d, store = tmp_dir + "/drop", tmp_dir + "/store"
    _write(d + "/Indeed_20240101_0800.csv", HEADER + "1,Indeed,Dev,Acme,https://i/1,2024-01-01 08:00:00,Remote,\n")
    load_folder(spark, d, store, "b1")
    _write(d + "/Indeed_20240102_0800.csv", HEADER + "2,Indeed,Dev,Acme,https://i/2,2024-01-02 08:00:00,Remote,\n")
    with pytest.raises(ValueError):
        load_folder(spark, d, store, "b1")
    assert [r.listing_id for r in st.read_listings(spark, store).collect()] == ["1"]


def test_columns_are_taken_by_header_name(spark, tmp_dir):
    d = tmp_dir + "/drop"
    swapped = "listing_id,source,company,title,link,time_when_scraped,location,compensation\n"
    _write(d + "/Indeed_20240101_0800.csv", swapped + "1,Indeed,Acme,Dev,https://i/1,2024-01-01 08:00:00,Remote,\n")
    _write(d + "/Indeed_20240101_0900.csv", "listing_id,source,title\n2,Indeed,Dev\n")
    load_folder(spark, d, tmp_dir + "/store", "b1", tmp_dir + "/outcomes")
    assert [(r.title, r.company) for r in st.read_listings(spark, tmp_dir + "/store").collect()] == [("Dev", "Acme")]
    res = {r.file_name: r.outcome for r in spark.read.parquet(tmp_dir + "/outcomes").collect()}
    assert res == {"Indeed_20240101_0800.csv": "LOADED", "Indeed_20240101_0900.csv": "ERROR"}


def test_a_broken_file_ends_in_error_alone(spark, tmp_dir):
    d = tmp_dir + "/drop"
    _write(d + "/Indeed_20240101_0800.csv", HEADER + "1,Indeed,Dev,Acme,https://i/1,2024-01-01 08:00:00,Remote,\n")
    _write(d + "/Indeed_20240101_0900.csv", HEADER + "2,Indeed,Dev,Acme,https://i/2,2024-01-01 08:00:00,Remote" + "," * 30000 + "x\n")
    load_folder(spark, d, tmp_dir + "/store", "b1", tmp_dir + "/outcomes")
    res = {r.file_name: r.outcome for r in spark.read.parquet(tmp_dir + "/outcomes").collect()}
    assert [r.listing_id for r in st.read_listings(spark, tmp_dir + "/store").collect()] == ["1"]
    assert res["Indeed_20240101_0800.csv"] == "LOADED" and res["Indeed_20240101_0900.csv"] == "ERROR", res


CHAIN = [("A", [("1", "Dev")]), ("B", [("1", None), ("2", "Dev")]), ("C", [("2", None), ("3", "Dev")]),
         ("D", [("3", None), ("3", "Dev")]), ("E", [("4", "Dev"), ("4", "Dev")]), ("F", [("4", None), ("5", "Dev")])]


def test_bulk_equals_one_file_at_a_time_on_chains(spark, tmp_dir):
    import os
    d = tmp_dir + "/drop"
    for k, (name, rows) in enumerate(CHAIN):
        path = f"{d}/{name}_20240101_0800.csv"
        _write(path, HEADER + "".join(f"{i},Indeed,{t or ''},Acme,https://i/{i},2024-01-01 08:00:00,Remote,\n" for i, t in rows))
        os.utime(path, (1_700_000_000 + 60 * k,) * 2)
    for n, root in ((None, tmp_dir + "/bulk"), (1, tmp_dir + "/single")):
        ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes", max_files_per_trigger=n)
    loaded = [sorted(r.listing_id for r in st.read_listings(spark, f"{tmp_dir}/{m}/store").collect()) for m in ("bulk", "single")]
    outcome = [{r.file_name[0]: r.outcome for r in spark.read.parquet(f"{tmp_dir}/{m}/outcomes").collect()} for m in ("bulk", "single")]
    # A, B and C load one after the other; D only has what C supplied; E repeats a key; F has a bad copy of what nobody supplied
    assert loaded[0] == loaded[1] == ["1", "2", "3"]
    assert outcome[0] == outcome[1] == {"A": "LOADED", "B": "LOADED", "C": "LOADED", "D": "NO_NEW", "E": "ERROR", "F": "ERROR"}


def test_a_corrected_and_a_late_old_file_are_read(spark, tmp_dir):
    import os
    d, root = tmp_dir + "/drop", tmp_dir + "/s"
    bad = d + "/Indeed_20240101_0800.csv"
    _write(bad, HEADER + "1,Indeed,,Acme,https://i/1,2024-01-01 08:00:00,Remote,\n")
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    _write(bad, HEADER + "1,Indeed,Dev,Acme,https://i/1,2024-01-01 08:00:00,Remote,\n")
    old = d + "/Indeed_20230101_0800.csv"
    _write(old, HEADER + "2,Indeed,Dev,Acme,https://i/2,2023-01-01 08:00:00,Remote,\n")
    os.utime(old, (1_000_000_000,) * 2)
    ingest_drop_folder(spark, d, root + "/store", root + "/ckpt", root + "/outcomes")
    assert sorted(r.listing_id for r in st.read_listings(spark, root + "/store").collect()) == ["1", "2"]
    assert sorted(r.outcome for r in spark.read.parquet(root + "/outcomes").collect()) == ["ERROR", "LOADED", "LOADED"]
