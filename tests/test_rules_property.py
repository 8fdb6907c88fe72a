"""Property: the screening rules equal a brute-force model of the SQL semantics.

* ``ILIKE '%p%'``: case-insensitive substring.
* ``~* '\\yw\\y'``: case-insensitive whole word; letters (accented ones too), digits and
  underscore are word characters.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobsift.functions import rules
from jobsift.operators import screen as S

PIECES = ["ai", "AI", "Ai", "ml", "ML", "rpa", "RPA", "é", "ç", "_", "1", " ", "-", ".", ",", "/", "(", ")",
          "senior", "Sr.", "tech", "data", "lead", "Email", "html", "curiosity", "Junior", "dev", "x", "ö"]
TITLE = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)

WORD = re.compile(r"(?<![^\W])(?:ml|ai|rpa)(?![^\W])", re.IGNORECASE)


def excluded(title: str) -> bool:
    low = title.lower()
    return any(p in low for p in rules.TITLE_EXCLUDED_SUBSTRINGS) or WORD.search(title) is not None


@settings(max_examples=100, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TITLE, min_size=1, max_size=60, unique=True))
def test_title_rules_match_model(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    kept = {r.title for r in df.filter(S.title_not_excluded("title")).collect()}
    assert kept == {t for t in titles if not excluded(t)}
