"""Property: any text survives write_result_set_csv -> read_listings_csv.

An empty string reads back as NULL (like a missing value; the original CSV
writer also writes both as an empty field).
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobsift.schema import LISTING_COLUMNS
from jobsift.sources import listing_csv as csvio

ALPHABET = st.sampled_from(list('ab ,"\'\n\r\t;|\\é✓#$%') + ["\r\n"])
TEXT = st.one_of(st.none(), st.lists(ALPHABET, max_size=12).map("".join))
ROW = st.tuples(*[TEXT] * 8)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.data_too_large,
                                                                HealthCheck.too_slow, HealthCheck.large_base_example])
@given(st.lists(st.lists(ROW, min_size=1, max_size=12), min_size=25, max_size=25))
def test_round_trip(spark, tmp_dir, result_sets):
    """25 result sets a run, written and read together: 100 in all."""
    import uuid
    folder = f"{tmp_dir}/{uuid.uuid4().hex}"
    rows = [(*r, f"LinkedIn_20240101_08{k:02d}.csv") for k, rs in enumerate(result_sets) for r in rs]
    schema = ", ".join(f"{c} string" for c in [*LISTING_COLUMNS, "file_name"])
    csvio.write_result_set_csv(spark.createDataFrame(rows, schema), folder)
    back = csvio.read_listings_csv(spark, csvio.top_level_csv(folder))

    def norm(r):
        return tuple("<NULL>" if v is None or v == "" else v for v in r)

    expect = sorted(norm(r) for r in rows)
    got = back.collect()
    assert all(r.file_error is None for r in got)
    assert expect == sorted(norm((*(r[c] for c in LISTING_COLUMNS), r.file_name)) for r in got)
