"""Result pages -> listing rows (the scrapers' data work, as a Spark job).

X1-X4 parse each page in the task that holds it (``mapInPandas``; one page in,
its cards out; no shuffle; scales with the page count). The per-site rules are
data. X5-X7 are built-in Column expressions.
"""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import rules

CARD_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("card_no", T.IntegerType()),
    T.StructField("listing_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("compensation", T.StringType()),
])

CARD_COLUMNS = ["listing_id", "source", "title", "company", "link", "location", "compensation"]

_BOUNDED = {"tag": "div", "class_token": "bounded-attribute-section"}

# Rules per card layout: where a card and its fields are (child-combinator chains, see ``html.find_chain``).
_LINKEDIN_RULES = {
    "card": [{"has": ("data-job-id",)}],
    "title": [{"tag": "a", "class_token": "job-card-container__link", "has": ("aria-label",), "attrs": {"tabindex": "0"}}],
    "company": [{"tag": "span", "class_has": "job-card-container__primary-description"}],
    "location": [{"tag": "div", "class_has": "artdeco-entity-lockup__caption"}],
    "pay": [{"tag": "div", "class_has": "artdeco-entity-lockup__metadata"}],
}
_INDEED_RULES = {
    "card": [{"tag": "a", "has": ("data-jk",)}],
    "titled": [{"has": ("id",)}],
    "box": [{"tag": "div", "class_has": "job_"}],
    "company": [{"tag": "span", "attrs": {"data-testid": "company-name"}}],
    "location": [{"tag": "div", "attrs": {"data-testid": "text-location"}}],
    "pay": [{"tag": "div", "class_has": "salary-snippet-container"}],
}
_BUILTIN_RULES = {
    "card": [{"tag": "div", "attrs": {"data-id": "job-card"}}],
    "company": [{"tag": "div", "attrs": {"data-id": "company-title"}}],
    "title": [{"tag": "h2"}, {"tag": "a"}],
    "location": [_BOUNDED, {"tag": "div"}, {"tag": "div"}, {"tag": "div", "nth": 2}],
    "pay": [_BOUNDED, {"tag": "div"}, {"tag": "div", "nth": 2}, {"tag": "div", "nth": 2}],
}


def _text(n):
    return n.text() if n is not None else None


def _linkedin(page, url):
    for card in page.found["card"]:
        lid = card.get("data-job-id")
        fields = [page.first(name, card) for name in ("title", "company", "location", "pay")]
        if any(f is None for f in fields):
            continue  # any missing field skips the card
        a, company, location, pay = fields
        yield (lid, a.get("aria-label"), _text(company), rules.LINKEDIN_VIEW_BASE + lid, _text(location), _text(pay))


def _boxes(page):
    """Per listing id of the page the first box whose class holds ``job_<id>`` anywhere, as the
    site's selector has it (so id 1 also fits ``job_12``): each box names its ids by the text after ``job_``."""
    ids = {card.get("data-jk") for card in page.found["card"]}
    longest = max(map(len, ids), default=0)
    out = {}
    for box in page.found["box"]:
        for text in box.get("class").split("job_")[1:]:
            for n in range(min(len(text), longest) + 1):
                if text[:n] in ids:
                    out.setdefault(text[:n], box)
    return out


def _indeed(page, url):
    boxes = _boxes(page)
    titled: dict = {}
    for n in page.found["titled"]:
        titled.setdefault(n.get("id"), []).append(n)
    for card in page.found["card"]:
        lid = card.get("data-jk")
        t = next((n for n in titled.get(f"jobTitle-{lid}", ()) if card.number < n.number <= card.last), None)
        box = boxes.get(lid)
        company, location, pay = (page.first(name, box) if box else None for name in ("company", "location", "pay"))
        yield (lid, t.get("title") if t is not None else None, _text(company), rules.INDEED_VIEW_BASE + lid,
               _text(location), _text(pay))


def _builtin_like(resolve_href):
    def extract(page, url):
        for card in page.found["card"]:
            ct, a = page.first("company", card), page.first("title", card)
            lid = ct.get("data-builtin-track-job-id") if ct is not None else None
            href = a.get("href") if a is not None else None
            pay = _text(page.first("pay", card))
            if pay is not None and rules.ANNUAL_PAY_MARKER not in pay:
                pay = None
            yield (lid, _text(a), _text(ct), resolve_href(url, href), _text(page.first("location", card)), pay)
    return extract


def _resolve_href(url, href):
    """The link as a browser reports an anchor's ``href``: resolved against the page url."""
    return urljoin(url or "", href) if href is not None else None


# Per-site rule sets: site tag -> rules and card extractor. BuiltIn and Dice share the
# card layout; both links are the anchor's resolved href.
SITE_EXTRACTORS = {
    "LinkedIn": (_LINKEDIN_RULES, _linkedin),
    "Indeed": (_INDEED_RULES, _indeed),
    "BuiltIn": (_BUILTIN_RULES, _builtin_like(_resolve_href)),
    "Dice": (_BUILTIN_RULES, _builtin_like(_resolve_href)),
}

#: Cards of about so many bytes of pages go out at a time; one page is parsed at a time, so a task holds its
#: input batch, one page's elements and these cards.
OUT_BYTES = 4 << 20


def _extract_batches(batches):
    """Parse each page with the rule set named in its ``_rules`` column; tag the
    cards with its ``source`` column."""
    for pdf in batches:
        out, size = [], 0
        for rule_set, source, page_id, url, html in zip(pdf["_rules"], pdf["source"], pdf["page_id"], pdf["url"],
                                                         pdf["html"]):
            if rule_set not in SITE_EXTRACTORS:  # never skipped unseen
                raise ValueError(f"page {page_id}: no card rules for site {rule_set!r}")
            page_rules, extractor = SITE_EXTRACTORS[rule_set]
            for i, (lid, title, company, link, location, pay) in enumerate(extractor(H.Page(html, page_rules), url)):
                out.append((page_id, i, lid, source, title, company, link, location, pay))
            size += len(html or "")
            if size >= OUT_BYTES:
                yield pd.DataFrame(out, columns=CARD_SCHEMA.fieldNames())
                out, size = [], 0
        yield pd.DataFrame(out, columns=CARD_SCHEMA.fieldNames())


def _extract(pages: DataFrame, rule_set: Column, source: Column) -> DataFrame:
    return (pages.select(rule_set.alias("_rules"), source.alias("source"), F.col("page_id").cast("bigint"),
                         "url", "html")
            .mapInPandas(_extract_batches, CARD_SCHEMA))


def extract_listing_cards(pages: DataFrame) -> DataFrame:
    """X1-X4 in one pass: pages of every site ``(source, page_id, url, html)``,
    each parsed with its site's rules (chosen per row by ``source``)."""
    return _extract(pages, F.col("source"), F.col("source"))


def extract_cards(pages: DataFrame, site: str, source_tag: str | None = None) -> DataFrame:
    """Cards of ``site``'s result pages ``(page_id, url, html)`` as listing rows.

    Output: ``page_id, card_no`` (position on the page) and the 7 card columns.
    """
    return _extract(pages, F.lit(site), F.lit(source_tag or site))


def extract_linkedin_cards(pages: DataFrame) -> DataFrame:
    """Cards ``[data-job-id]``; a card missing any field is skipped."""
    return extract_cards(pages, "LinkedIn")


def extract_indeed_cards(pages: DataFrame) -> DataFrame:
    """Cards ``a[data-jk]``; pay optional; other missing fields become NULL (then fail C1)."""
    return extract_cards(pages, "Indeed")


def extract_builtin_cards(pages: DataFrame) -> DataFrame:
    """Cards ``div[data-id=job-card]``; link = the title anchor's resolved href;
    pay kept only when annual."""
    return extract_cards(pages, "BuiltIn")


def extract_dice_cards(pages: DataFrame, source_tag: str = "Dice") -> DataFrame:
    """As X3 (same card layout), tagged with ``source_tag``."""
    return extract_cards(pages, "Dice", source_tag)


# --- X5-X7 as Column expressions ---------------------------------------------

# What a browser does not show as elements: comments, scripts, styles.
_NOT_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def _attr(name: str, value: str) -> str:
    """An attribute in either kind of quotes (a pattern without capturing groups)."""
    return rf"""{name}\s*=\s*(?:"{value}"|'{value}')"""


def _tag(html: Column, tag: str, attribute: str) -> Column:
    """The first opening tag with the attribute; empty when there is none."""
    return F.regexp_extract(html, rf"<{tag}\s(?:[^>]*\s)?{attribute}[^>]*>", 0)


def _next_anchor(source: Column, html: Column) -> Column:
    """The opening tag of the next-page link (Indeed: ``Next Page``; BuiltIn / Dice:
    ``Go to Next Page``); empty when there is none."""
    return F.when(source == "Indeed", _tag(html, "a", _attr("aria-label", "Next Page"))) \
        .otherwise(_tag(html, "a", _attr("aria-label", "Go to Next Page")))


def _page_number(digits: Column) -> Column:
    """Digits -> int; NULL when absent or out of range (never fails the job)."""
    return F.nullif(digits, F.lit("")).try_cast("int")


def _unescape_amp(href: Column) -> Column:
    for ent in ("&amp;", "&#38;", "&#x26;", "&#X26;"):
        href = F.replace(href, F.lit(ent), F.lit("&"))
    return href


def pager(source: Column, html: Column) -> Column:
    """X7 as one struct ``(has_next, next_page, next_link)``; each tag of the pager
    is found once per page.

    LinkedIn: the current page button (``aria-current="true"``) is labelled
    ``Page N``; a next page exists when a ``Page N+1`` button does, and is
    N + 1. Indeed (``Next Page``) and BuiltIn / Dice (``Go to Next Page``): the
    next-page link exists; its href (``&`` entities decoded) is the link and
    its ``page`` parameter the number (NULL when the site pages by offset).
    """
    html = F.regexp_replace(html, _NOT_MARKUP, "")
    current = _tag(html, "button", _attr("aria-current", "true"))
    n = _page_number(F.regexp_extract(current, r"""aria-label\s*=\s*["']Page (\d+)["']""", 1))
    n_next = F.try_add(n, F.lit(1))
    button = F.concat(F.lit(r"""<button\s(?:[^>]*\s)?aria-label\s*=\s*["']Page """), n_next.cast("string"), F.lit(r"""["']"""))
    li_has = F.coalesce(F.regexp_like(html, button), F.lit(False))
    anchor = _next_anchor(source, html)
    quoted = F.regexp_extract(anchor, r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    href = F.when(F.length(quoted) > 0, quoted).otherwise(F.regexp_extract(anchor, r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)')""", 2))
    link = F.when(F.length(href) > 0, _unescape_amp(href))
    other_n = _page_number(F.regexp_extract(link, r"[?&]page=(\d+)", 1))
    is_li = source == "LinkedIn"
    return F.struct(
        F.when(is_li, li_has).otherwise(F.length(anchor) > 0).alias("has_next"),
        F.when(is_li, F.when(li_has, n_next)).otherwise(other_n).alias("next_page"),
        F.when(~is_li, link).alias("next_link"))


def with_pager(df: DataFrame, source: str = "source", html: str = "html") -> DataFrame:
    """Add ``has_next``, ``next_page``, ``next_link`` (X7) to a pages frame."""
    return (df.withColumn("_pager", pager(F.col(source), F.col(html)))
            .select("*", "_pager.has_next", "_pager.next_page", "_pager.next_link").drop("_pager"))


def has_next_page(source: Column, html: Column) -> Column:
    """Whether a next result page exists."""
    return pager(source, html)["has_next"]


def next_page_link(source: Column, html: Column) -> Column:
    """The next-page link's href; NULL on the last page and for LinkedIn (buttons)."""
    return pager(source, html)["next_link"]


def next_page(source: Column, html: Column) -> Column:
    """Number of the next result page, NULL on the last page."""
    return pager(source, html)["next_page"]


# --- generic rules on any web page ---------------------------------------------

PAGE_FIELDS_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("h1", T.StringType()),
    T.StructField("n_nav_links", T.LongType()),
])


def _page_fields(batches):
    for pdf in batches:
        out = []
        for page_id, html in zip(pdf["page_id"], pdf["html"]):
            doc = H.parse(html)
            title = _text(H.find(doc, tag="title"))
            art = H.find(doc, tag="article")
            h1 = _text(H.find(art, tag="h1")) if art is not None else None
            n_nav = sum(1 for a in H.find_all(doc, tag="a", has=("href",)) if H.has_ancestor(a, "nav"))
            out.append((page_id, title, h1, n_nav))
        yield pd.DataFrame(out, columns=PAGE_FIELDS_SCHEMA.fieldNames())


def extract_page_fields(pages: DataFrame) -> DataFrame:
    """Generic rule set on arbitrary pages: ``title``, ``article h1``, count of ``nav a[href]``."""
    return pages.select(F.col("page_id").cast("bigint"), "html").mapInPandas(_page_fields, PAGE_FIELDS_SCHEMA)
