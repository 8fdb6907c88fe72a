import datetime as dt

from jobsift.operators import dedupe as D
from jobsift.operators import quality as Q
from jobsift.operators import relations as R

TEXT = "listing_id string, source string, title string, company string, link string, " \
       "time_when_scraped string, location string, compensation string"


def test_numeric_id_rule(spark):
    df = spark.createDataFrame([("12", "LinkedIn"), ("a1", "LinkedIn"), (None, "LinkedIn"), ("a1", "Indeed"),
                                (None, "Indeed")], "listing_id string, source string")
    assert sorted(map(tuple, Q.numeric_listing_id(df).collect()), key=str) == sorted(
        [("12", "LinkedIn"), ("a1", "Indeed"), (None, "Indeed")], key=str)


def test_conform_and_not_null(spark):
    df = spark.createDataFrame([("1", "X", None, "c", "l", "bad", None, None),
                                ("2", "X", "t", "c", "l", "2024-01-01 10:00:00", None, None)], TEXT)
    c = Q.conform_listing(df)
    assert c.schema["time_when_scraped"].dataType.typeName() == "timestamp_ntz"
    got = sorted(tuple(r) for r in Q.not_null_check(c).collect())
    assert got == [("1", "X", "time_when_scraped"), ("1", "X", "title")]


def test_anti_join_keeps_null_keys(spark):
    inc = spark.createDataFrame([("1", "A"), (None, "A"), ("2", "A")], "listing_id string, source string")
    known = spark.createDataFrame([("1", "A"), (None, "A")], "listing_id string, source string")
    assert sorted(map(tuple, D.new_listings(inc, known).collect()), key=str) == [("2", "A"), (None, "A")]
    big = D.new_listings(inc, known, broadcast_key_limit=1)  # shuffle path
    assert sorted(map(tuple, big.collect()), key=str) == [("2", "A"), (None, "A")]


def test_anti_join_plan_does_not_shuffle_the_store(spark):
    inc = spark.createDataFrame([("1", "A")], "listing_id string, source string")
    known = spark.range(1000).selectExpr("cast(id as string) listing_id", "'A' source")
    plan = D.new_listings(inc, known)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_latest_and_first_file(spark):
    df = spark.createDataFrame([("1", "A", "r", "old", 0), ("1", "A", "r", "new", 1), ("2", "A", "r", "x", 0)],
                               "listing_id string, source string, run_time string, title string, seq int")
    got = {r.listing_id: r.title for r in D.latest_per_listing(df).collect()}
    assert got == {"1": "new", "2": "x"}
    t = dt.datetime(2024, 1, 1)
    f = spark.createDataFrame([("1", "A", "late", "b.csv", t + dt.timedelta(hours=1)),
                               ("1", "A", "early", "c.csv", t), ("1", "A", "tie", "a.csv", t + dt.timedelta(hours=1))],
                              "listing_id string, source string, title string, file_name string, file_time timestamp")
    assert [r.title for r in D.first_file_wins(f, "file_time").collect()] == ["early"]


def test_outcomes(spark):
    rows = spark.createDataFrame([("a.csv", "1", "X"), ("b.csv", "2", "X"), ("c.csv", "3", "X"), ("c.csv", "3", "X")],
                                 "file_name string, listing_id string, source string")
    new = rows.filter("file_name != 'a.csv'").selectExpr("*", "false AS null_bad")
    files = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",), ("d.csv",)], "file_name string")
    got = {r.file_name: r.outcome for r in Q.ingest_outcome(rows, new, files).collect()}
    assert got == {"a.csv": "NO_NEW", "b.csv": "LOADED", "c.csv": "ERROR", "d.csv": "EMPTY"}


def test_member_of_array_empty_for_no_membership(spark):
    roles = spark.createDataFrame([("1", "admin"), ("2", "alice"), ("3", "bob"), ("4", "rdsadmin")],
                                  "oid string, rolname string")
    members = spark.createDataFrame([("1", "2"), ("4", "2")], "roleid string, member string")
    got = {r.rolname: r.memberof for r in R.member_of_array(roles, members).collect()}
    assert got == {"admin": [], "alice": ["admin", "rdsadmin"], "bob": []}


def test_same_listing_in_two_good_files(spark):
    from jobsift.plans.load import plan_batch
    rows = spark.createDataFrame(
        [("1", "Indeed", "a", "c", "l", "2024-01-01 08:00:00", None, None, "Indeed_20240101_0800.csv"),
         ("1", "Indeed", "b", "c", "l", "2024-01-01 12:00:00", None, None, "Indeed_20240101_1200.csv"),
         ("2", "Indeed", "b", "c", "l", "2024-01-01 12:00:00", None, None, "Indeed_20240101_1300.csv")],
        TEXT + ", file_name string")
    known = spark.createDataFrame([], "listing_id string, source string")
    to_append, outcomes = plan_batch(rows, known, checkpoint=False)
    assert sorted((r.listing_id, r.title) for r in to_append.collect()) == [("1", "a"), ("2", "b")]
    got = {r.file_name: (r.n_new, r.n_loaded, r.outcome) for r in outcomes.collect()}
    # the later file's copy is shadowed by the earlier file: not new, as when files load one at a time
    assert got == {"Indeed_20240101_0800.csv": (1, 1, "LOADED"), "Indeed_20240101_1200.csv": (0, 0, "NO_NEW"),
                   "Indeed_20240101_1300.csv": (1, 1, "LOADED")}


def test_first_file_wins_puts_undated_files_last(spark):
    t = dt.datetime(2024, 1, 1)
    f = spark.createDataFrame([("a", "X", "undated", "f2.csv", None), ("a", "X", "dated", "f1.csv", t)],
                              "listing_id string, source string, title string, file_name string, file_time timestamp")
    assert [r.title for r in D.first_file_wins(f, "file_time").collect()] == ["dated"]


def test_duplicated_store_keys_stay_bounded(spark):
    inc = spark.createDataFrame([("1", "A"), ("2", "A")], "listing_id string, source string")
    known = spark.range(5000).selectExpr("'1' AS listing_id", "'A' AS source")  # one key stored 5000 times
    out = D.new_listings(inc, known)
    assert [tuple(r) for r in out.collect()] == [("2", "A")]


def test_conform_takes_wall_clock_of_zoned_times(spark):
    df = spark.createDataFrame([("1", "X", "t", "c", "l", dt.datetime(2024, 1, 1, 10), None, None)],
                               TEXT.replace("time_when_scraped string", "time_when_scraped timestamp"))
    c = Q.conform_listing(df)
    assert c.schema["time_when_scraped"].dataType.typeName() == "timestamp_ntz"
    assert c.collect()[0].time_when_scraped == dt.datetime(2024, 1, 1, 10)


def test_member_of_array_is_ordered_and_takes_one_name(spark):
    roles = spark.createDataFrame([("1", "zed"), ("2", "amy"), ("3", "rdsadmin")], "oid string, rolname string")
    members = spark.createDataFrame([], "roleid string, member string")
    assert [r.rolname for r in R.member_of_array(roles, members, exclude="rdsadmin").collect()] == ["amy", "zed"]


def test_bad_copy_of_a_listing_an_earlier_file_supplies(spark):
    """Loading files one at a time, B's copies of listing 1 are cut as already stored, so B loads listing 2."""
    from jobsift.plans.load import plan_batch
    rows = spark.createDataFrame(
        [("1", "Indeed", "a", "c", "l", "2024-01-01 08:00:00", None, None, "A_20240101_0800.csv"),
         ("1", "Indeed", "a", "c", "l", "2024-01-01 09:00:00", None, None, "B_20240101_0900.csv"),
         ("1", "Indeed", None, "c", "l", "2024-01-01 09:00:00", None, None, "B_20240101_0900.csv"),
         ("2", "Indeed", "b", "c", "l", "2024-01-01 09:00:00", None, None, "B_20240101_0900.csv"),
         ("3", "Indeed", None, "c", "l", "2024-01-01 09:30:00", None, None, "C_20240101_0930.csv")],
        TEXT + ", file_name string")
    known = spark.createDataFrame([], "listing_id string, source string")
    to_append, outcomes = plan_batch(rows, known, checkpoint=False)
    assert sorted((r.listing_id, r.file_name) for r in to_append.collect()) == [
        ("1", "A_20240101_0800.csv"), ("2", "B_20240101_0900.csv")]
    got = {r.file_name: (r.n_new, r.n_bad, r.outcome) for r in outcomes.collect()}
    assert got == {"A_20240101_0800.csv": (1, 0, "LOADED"), "B_20240101_0900.csv": (1, 0, "LOADED"),
                   "C_20240101_0930.csv": (1, 1, "ERROR")}


def test_one_time_per_file_and_repeated_listing_entries(spark):
    from jobsift.plans.load import plan_batch
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [("k", "Indeed", "a", "c", "l", "2024-01-01 08:00:00", None, None, "A.csv", t),
         ("j", "Indeed", "a", "c", "l", "2024-01-01 08:00:00", None, None, "A.csv", t + dt.timedelta(hours=3)),
         ("k", "Indeed", None, "c", "l", "2024-01-01 08:00:00", None, None, "B.csv", t + dt.timedelta(hours=2)),
         ("j", "Indeed", None, "c", "l", "2024-01-01 08:00:00", None, None, "B.csv", t + dt.timedelta(hours=2))],
        TEXT + ", file_name string, file_time timestamp")
    known = spark.createDataFrame([], "listing_id string, source string")
    files = spark.createDataFrame([("A.csv", t), ("A.csv", t + dt.timedelta(days=1)), ("B.csv", t)],
                                  "file_name string, file_time timestamp")  # A listed twice
    # A's time is its earliest part: both of B's bad copies are shadowed, B adds nothing
    for f in (None, files.filter("file_name = 'A.csv'")):
        to_append, outcomes = plan_batch(rows, known, files=f, checkpoint=False)
        got = {r.file_name: r.outcome for r in outcomes.collect()}
        assert got == {"A.csv": "LOADED", "B.csv": "NO_NEW"}
        assert sorted(r.listing_id for r in to_append.collect()) == ["j", "k"]
