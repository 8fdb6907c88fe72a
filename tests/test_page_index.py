"""The page index against selector walks, its work and its memory."""

import random
import tracemalloc

import pandas as pd
import pytest

from jobsift.functions import html as H
from jobsift.operators import cards as X


def random_page(seed, n=300):
    rng = random.Random(seed)
    out, stack = [], []
    for _ in range(n):
        if stack and rng.random() < 0.45:
            out.append(f"</{stack.pop()}>")
            continue
        tag = rng.choice(["div", "div", "span", "a", "h2", "p"])
        attrs = rng.choice(["", ' class="bounded-attribute-section x"', ' data-id="job-card"', ' data-id="company-title" data-builtin-track-job-id="7"',
                            f' data-jk="{rng.randint(0, 30)}"', f' class="c job_{rng.randint(0, 30)} job_3"', f' id="jobTitle-{rng.randint(0, 30)}" title="t"',
                            ' data-testid="company-name"', ' data-testid="text-location"', ' class="zsalary-snippet-containerz"', ' href="/x"',
                            ' data-job-id="5"', ' class="job-card-container__link" aria-label="L" tabindex="0"', ' class="artdeco-entity-lockup__caption"'])
        out.append(f"<{tag}{attrs}>t{rng.randint(0, 9)}")
        stack.append(tag)
    return "".join(out)


@pytest.mark.parametrize("seed", range(15))
def test_index_finds_what_a_walk_finds(seed):
    text = random_page(seed)
    for rules, _ in X.SITE_EXTRACTORS.values():
        page = H.Page(text, rules)
        nodes = list(page.root.iter())
        assert [n.number for n in nodes] == list(range(1, len(nodes) + 1))
        for name, steps in rules.items():
            assert page.found[name] == [n for n in nodes if H._chain_ok(n, steps)]
            for inside in random.Random(seed).sample(nodes, min(40, len(nodes))):
                assert page.first(name, inside) is H.find_chain(inside, steps)
        for n in nodes:
            below = [m.number for m in n.iter()]
            assert n.last == max(below, default=n.number)
            assert n.nth == n.parent.element_children().index(n) + 1


@pytest.mark.parametrize("seed", range(15))
def test_indeed_boxes_are_the_first_that_hold_the_id(seed):
    text = random_page(seed)
    page = H.Page(text, X._INDEED_RULES)
    boxes = X._boxes(page)
    for card in page.found["card"]:
        lid = card.get("data-jk")
        assert boxes.get(lid) is next((b for b in page.found["box"] if f"job_{lid}" in b.get("class")), None)


def _indeed_page(n):
    return "".join(f'<div class="cardOutline job_{i}"><h2><a data-jk="{i}"><span id="jobTitle-{i}" title="T{i}">T</span></a></h2>'
                   f'<span data-testid="company-name">C{i}</span><div data-testid="text-location">Remote</div></div>' for i in range(n))


def test_element_tests_grow_with_the_page(monkeypatch):
    calls = [0]
    real = H.match
    monkeypatch.setattr(H, "match", lambda *a, **k: calls.__setitem__(0, calls[0] + 1) or real(*a, **k))
    seen = []
    for n in (200, 400, 800):
        calls[0] = 0
        out, = X._extract_batches([pd.DataFrame({"_rules": ["Indeed"], "source": ["Indeed"], "page_id": [1], "url": ["u"], "html": [_indeed_page(n)]})])
        assert len(out) == n and list(out["company"]) == [f"C{i}" for i in range(n)]
        seen.append(calls[0])
    assert seen[1] <= 2.05 * seen[0] and seen[2] <= 2.05 * seen[1]


def test_a_batch_of_50_mb_of_pages_stays_bounded(monkeypatch):
    """Beyond the batch itself a task holds one page's elements and a few MB of cards: under 40 MB here."""
    page = _indeed_page(250)
    n = 50
    filler = "<p>" + "x" * (1_000_000 - len(page)) + "</p>"
    pdf = pd.DataFrame({"_rules": ["Indeed"] * n, "source": ["Indeed"] * n, "page_id": range(n), "url": ["u"] * n, "html": [page + filler + str(i) for i in range(n)]})
    monkeypatch.setattr(X, "OUT_BYTES", 1 << 20)
    tracemalloc.start()
    total = sum(len(part) for part in X._extract_batches([pdf]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 250 * len(pdf)
    assert peak < 40 << 20
