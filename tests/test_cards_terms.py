from pyspark.sql import functions as F

from jobsift.functions.text import search_location_rewrite
from jobsift.operators import cards as X
from jobsift.operators.search import search_term_match
from jobsift.sources.terms import load_search_terms

LINKEDIN = ('<div data-job-id="11"><a class="job-card-container__link" aria-label="Dev &amp; Ops" tabindex="0"></a>'
            '<span class="x job-card-container__primary-description">Acme</span>'
            '<div class="artdeco-entity-lockup__caption">  Columbus,   OH </div>'
            '<div class="artdeco-entity-lockup__metadata">$90K/yr</div></div>'
            '<div data-job-id="12"><a class="job-card-container__link" aria-label="QA" tabindex="0"></a>'
            '<span class="job-card-container__primary-description">Acme</span>'
            '<div class="artdeco-entity-lockup__caption"></div></div>'
            '<ul><li><button aria-current="true" aria-label="Page 3">3</button></li>'
            '<li><button aria-label="Page 4">4</button></li></ul>')
BUILTIN = ('<div data-id="job-card"><div data-id="company-title" data-builtin-track-job-id="7">Acme</div>'
           '<h2><a href="/job/7">Dev</a></h2><div class="bounded-attribute-section"><div>'
           '<div><div>at</div><div>Remote</div></div><div><div>pay</div><div>90K-100K Hourly</div></div>'
           '</div></div></div><a aria-label="Go to Next Page" href="?page=2">next</a>')
INDEED = ('<div class="cardOutline job_5"><h2><a data-jk="5"><span id="jobTitle-5" title="Dev">Dev</span></a></h2>'
          '<span data-testid="company-name">Acme</span><div data-testid="text-location">Remote</div></div>')


def _pages(spark, html, url="https://example.com/s/search?page=1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_linkedin_skips_card_without_pay(spark):
    rows = X.extract_linkedin_cards(_pages(spark, LINKEDIN)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.listing_id, r.title, r.company, r.location, r.compensation) == (
        "11", "Dev & Ops", "Acme", "Columbus, OH", "$90K/yr")
    assert r.link == "https://www.linkedin.com/jobs/view/11"


def test_builtin_and_dice_links_and_pay_gate(spark):
    b = X.extract_builtin_cards(_pages(spark, BUILTIN)).collect()[0]
    assert (b.listing_id, b.link, b.location, b.compensation) == ("7", "https://example.com/job/7", "Remote", None)
    d = X.extract_dice_cards(_pages(spark, BUILTIN)).collect()[0]
    assert d.link == "https://example.com/job/7" and d.source == "Dice"


def test_indeed_optional_pay(spark):
    r = X.extract_indeed_cards(_pages(spark, INDEED)).collect()[0]
    assert (r.listing_id, r.title, r.company, r.compensation) == ("5", "Dev", "Acme", None)
    assert r.link == "https://www.indeed.com/viewjob?jk=5"


def test_next_page(spark):
    df = spark.createDataFrame([
        ("LinkedIn", LINKEDIN), ("BuiltIn", BUILTIN), ("Indeed", INDEED),
        ("LinkedIn", '<button aria-current="true" aria-label="Page 4">4</button>'),
        ("BuiltIn", '<a aria-label="Go to Next Page" href="/jobs/remote?search=dev&amp;page=3">next</a>'),
        ("Indeed", '<a href="/jobs?q=dev&amp;start=10" aria-label="Next Page" data-testid="pagination">2</a>')],
        "source string, html string")
    src, html = F.col("source"), F.col("html")
    got = [tuple(r) for r in df.select(X.has_next_page(src, html), X.next_page(src, html),
                                        X.next_page_link(src, html)).collect()]
    odd = spark.createDataFrame([("BuiltIn", '<a aria-label="Go to Next Page" href="?q=a&#38;page=99999999999">x</a>'),
                                 ("LinkedIn", '<button aria-current="true" aria-label="Page 2147483647">x</button>')],
                                "source string, html string")
    assert [tuple(r) for r in X.with_pager(odd).select("has_next", "next_page", "next_link").collect()] == \
        [(True, None, "?q=a&page=99999999999"), (False, None, None)]
    assert got == [(True, 4, None), (True, 2, "?page=2"),
                   (False, None, None), (False, None, None),
                   (True, 3, "/jobs/remote?search=dev&page=3"), (True, None, "/jobs?q=dev&start=10")]


def test_search_terms_and_location_rewrite(spark):
    t = load_search_terms(spark)
    counts = {r.source: r["count"] for r in t.groupBy("source").count().collect()}
    assert counts == {"LinkedIn": 8, "Indeed": 8, "BuiltIn": 6, "Dice": 8}
    first = t.filter("source = 'BuiltIn' AND idx = 0").collect()[0]
    assert (first.keyword, first.location) == ("Developer", "Remote")
    q = {(r.source, r.q) for r in t.select("source", search_location_rewrite("source", "location").alias("q"))
         .filter("location = 'Remote'").collect()}
    assert q == {("LinkedIn", "Remote"), ("Indeed", "Remote"), ("BuiltIn", "United States"), ("Dice", "Remote")}


def test_search_term_match_tokens(spark):
    lst = spark.createDataFrame([("1", "Indeed", "Junior Software Developer", "Columbus, OH"),
                                 ("2", "Indeed", "Developer Junior", "Remote"),
                                 ("3", "BuiltIn", "QA Analyst", "Columbus, OH")],
                                "listing_id string, source string, title string, location string")
    got = {(r.listing_id, r.keyword, r.search_location) for r in
           search_term_match(lst, load_search_terms(spark)).collect()}
    assert ("1", "Junior Developer", "Columbus, OH") in got
    assert ("2", "Junior Developer", "Remote") in got and ("2", "Junior Developer", "Columbus, OH") in got
    assert ("3", "QA", "Columbus, OH, USA") in got and ("3", "QA", "Remote") not in got


def test_all_sites_in_one_pass(spark):
    pages = spark.createDataFrame([("LinkedIn", 1, "https://e.com/a", LINKEDIN), ("BuiltIn", 2, "https://e.com/b", BUILTIN),
                                   ("Indeed", 3, "https://e.com/c", INDEED)],
                                  "source string, page_id long, url string, html string")
    got = sorted((r.source, r.listing_id) for r in X.extract_listing_cards(pages).collect())
    assert got == [("BuiltIn", "7"), ("Indeed", "5"), ("LinkedIn", "11")]


def test_file_name_collisions(spark):
    from jobsift.functions.text import file_name_collisions, result_set_file_name
    sets = spark.createDataFrame([("LinkedIn", "2024-01-01 08:00:10", 0), ("LinkedIn", "2024-01-01 08:00:50", 1),
                                  ("LinkedIn", "2024-01-01 08:01:00", 2), ("Indeed", "2024-01-01 08:00:10", 0)],
                                 "source string, ts string, term_idx int")
    named = sets.select(result_set_file_name(F.col("source"), F.col("ts").cast("timestamp_ntz")).alias("file_name"),
                        "term_idx")
    assert [tuple(r) for r in file_name_collisions(named).collect()] == [("LinkedIn_20240101_0800.csv", 2)]


def test_terms_from_a_json_file(spark, tmp_dir):
    import json
    path = tmp_dir + "/terms.json"
    with open(path, "w") as fh:
        json.dump({"Indeed_Search_Terms": [{"keyword": "QA", "location": "Remote"},
                                           {"keyword": "Developer", "location": "Columbus, OH"}]}, fh)
    from jobsift.sources.terms import read_search_terms_json
    for df in (load_search_terms(spark, path), read_search_terms_json(spark, path)):
        assert [tuple(r) for r in df.orderBy("idx").collect()] == [("Indeed", 0, "QA", "Remote"),
                                                                    ("Indeed", 1, "Developer", "Columbus, OH")]


def test_generic_page_fields(spark):
    html = ('<html><head><title> A &amp; B </title></head><body><nav><a href="/x">x</a><nav><a href="/y">y</a>'
            '<a>no href</a></nav></nav><article><p>intro</p><h1>Head <b>line</b></h1></article>'
            '<script>var t = "</p><h1>no</h1>";</script></body></html>')
    df = spark.createDataFrame([(1, html), (2, "<p>nothing</p>")], "page_id long, html string")
    got = {r.page_id: (r.title, r.h1, r.n_nav_links) for r in X.extract_page_fields(df).collect()}
    assert got == {1: ("A & B", "Head line", 2), 2: (None, None, 0)}


def test_terms_with_empty_and_odd_sites(spark, tmp_dir):
    import json
    from jobsift.sources.terms import read_search_terms_json, terms_values_sql
    path = tmp_dir + "/t.json"
    with open(path, "w") as fh:
        json.dump({"Dice_Search_Terms": [], "Indeed_Search_Terms": [{"keyword": "QA", "location": "Remote", "x": 1},
                                                                     {"keyword": None, "location": "O'Hare"}],
                   "notes": []}, fh)
    for df in (load_search_terms(spark, path), read_search_terms_json(spark, path)):
        assert sorted(map(tuple, df.collect()), key=str) == sorted([("Indeed", 0, "QA", "Remote"),
                                                                    ("Indeed", 1, None, "O'Hare")], key=str)
    assert "NULL" in terms_values_sql(path) and "O''Hare" in terms_values_sql(path)


def test_dom_text_and_tree_rules():
    from jobsift.functions import html as H
    doc = H.parse('<div id="a"><div>Remote</div><div>Columbus, OH</div></div><span id="b">a<br>b</span>'
                  '<div id="c">a<noscript>NO</noscript><template>T</template></div>'
                  '<a id="d" href="/job/1" href="/job/2">x</a><ul id="e"><li>a<li>b</ul><p id="f">a<div>b</div>'
                  '<div id="g"/><span>inside</span>')
    by = {n.get("id"): n for n in H.find_all(doc, has=("id",))}
    assert by["a"].text() == "Remote\nColumbus, OH" and by["b"].text() == "a\nb" and by["c"].text() == "a"
    assert by["d"].get("href") == "/job/1"
    assert [li.text() for li in H.find_all(by["e"], tag="li")] == ["a", "b"]
    assert H.find(by["f"], tag="div") is None  # the div closes the open p
    assert by["g"].text() == "inside"  # '<div/>' stays open
    nested = H.parse('<div class="s"><div class="s"><div><div>x</div><div>in</div></div></div></div>')
    inner = H.find_chain(nested, [{"tag": "div", "class_token": "s"}, {"tag": "div"}, {"tag": "div", "nth": 2}])
    assert inner is not None and inner.text() == "in"


def test_a_page_without_rules_fails_the_job(spark):
    import pytest
    from pyspark.errors import PythonException
    pages = spark.createDataFrame([("linkedin", 4, "https://e.com/d", INDEED)], "source string, page_id long, url string, html string")
    with pytest.raises(PythonException, match="no card rules for site 'linkedin'"):
        X.extract_listing_cards(pages).collect()


def test_pager_reads_buttons_in_either_quotes_and_no_scripts(spark):
    df = spark.createDataFrame([
        ("LinkedIn", "<button aria-current='true' aria-label='Page 2'>2</button><button aria-label='Page 3'>3</button>"),
        ("LinkedIn", '<button aria-current="true" aria-label="Page 2">2</button><script>x = \'aria-label="Page 3"\'</script>'),
        ("LinkedIn", '<button aria-current="true" aria-label="Page 2">2</button><!-- <button aria-label="Page 3"> -->'),
        ("LinkedIn", '<button aria-current="true" aria-label="Page 2">2</button><div aria-label="Page 3">3</div>'),
        ("Indeed", "<a data-x='1' aria-label='Next Page' href='?page=7'>7</a>")], "source string, html string")
    got = [tuple(r) for r in X.with_pager(df).select("has_next", "next_page", "next_link").collect()]
    assert got == [(True, 3, None)] + [(False, None, None)] * 3 + [(True, 7, "?page=7")]


def test_grams_of_terms_are_not_sorted_in_as_few_tasks_as_aqe_likes(spark):
    """However small the tables look: the terms' grams are no build side, and are sorted by term in the session's count of tasks."""
    rows = spark.range(400).selectExpr("cast(id as string) listing_id", "'Dice' source", "concat('title ', id) title", "'Remote' location", "id idx",
                                       "concat('tit ', id) keyword")
    out = search_term_match(rows.drop("idx", "keyword"), rows.select("source", "idx", "keyword", "location"), broadcast_limit=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    by_term = [line for line in plan.splitlines() if "hashpartitioning(_no" in line]
    assert "ShuffledHashJoin" in plan and any(f", {parts}), REPARTITION_BY_NUM" in line for line in by_term)
    assert out.count() == sum(str(k) in f"title {i}" for i in range(400) for k in range(400))
