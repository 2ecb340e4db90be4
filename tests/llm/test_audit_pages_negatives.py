"""Filter audit, main text and hard negatives: plain versions, odd rows and empty tables."""

import html
import itertools
import math
import re
from collections import defaultdict

import numpy as np
import pytest

from lawloom.llm import filter_audit, hard_negatives, main_text
from lawloom.llm import queries as q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, part string, A int, first int, salt int"
LABELS = "doc_id long, quality int, toxic int, good int"


def plain_audit(docs, labels):
    """Every order applied row by row."""
    good = {d for d, g, _ in labels if g == 1}
    toxic = {d for d, _, t in labels if t == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None and (t or "") not in least or d is not None and d < least[t or ""]:
            least[t or ""] = d
    rows = defaultdict(list)
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and least[t] < d}
        rows[lang or ""].append((d, {f for f, x in fails.items() if x}))
    out = set()
    for part, held in rows.items():
        total = defaultdict(int)
        found = []
        for order in itertools.permutations("ABCDE"):
            left = held
            for i, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                before = sum(f in x and bool(x & {*order[:i]}) for _, x in held)
                found.append(("".join(order), i + 1, f, len(left), len(gone), before, sum(x == {f} for _, x in held), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out |= {(part, *x, total[x[2]]) for x in found}
    return out


AUDIT = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit(spark):
    words = " ".join(f"w{i}" for i in range(210))
    docs = [(1, None, "en"), (2, "", "en"), (3, words, "en"), (4, words, "en"), (4, words, "en"), (5, words + " #", None), (6, "A " * 300, ""), (7, words.upper(), "de"), (None, words, "de"), (8, words + " a" * 300, "de"), (9, "X|" * 5000, "fr")]
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (7, None, 1), (6, 1, None), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOCS).repartition(3)
    got = filter_audit.audit_filters(table, spark.createDataFrame([(*x, 5) for x in labels], LABELS))
    assert {tuple(r) for r in got.select(AUDIT).collect()} == plain_audit(docs, [x for x in labels if x[0] is not None])
    assert got.count() == 4 * 600
    assert filter_audit.audit_filters(table.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_audit_states_are_shared(spark):
    """Thirty-one states for all orders, each survivor of a set of filters counted once."""
    flags = spark.createDataFrame([("p", True, False, *x) for x in itertools.product([False, True], repeat=5)], "part string, good boolean, toxic boolean, A boolean, B boolean, C boolean, D boolean, E boolean")
    got = {r.state: r for r in filter_audit.state_counts(flags, "ABCDE").collect()}
    assert len(got) == 31
    for state, r in got.items():
        left = 2 ** (5 - len(state[1:]))
        assert r.n == left and {x["filter"]: x.removed for x in r.x} == {f: 0 if f in state else left // 2 for f in "ABCDE"}


def page_text(page):
    rules = main_text.BlockRules()
    return "\n\n".join(b.text for b in main_text.labelled(page, rules)[0] if b.label == main_text.GOOD)


LONG = "The house on the hill was sold to a family that had been looking for a place of this kind for many years."
MORE = "It is not known when the first of the owners left, but there are letters in which they write about it."


def test_op12(spark):
    """The pages of the table keep their text in one element, so a plain reading of it must be found whole."""
    got = {r.page_id: r for r in q.op12_html_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize(
    "page, want",
    [
        # density and neighbours alone: no element or name tells the parts from each other
        (f"<div><div><a href=x>Home</a> <a href=y>News</a></div><div><div>A short head</div><div>{LONG}</div><div>Short end.</div><div>{MORE}</div></div><div><a href=1>one</a> <a href=2>two</a></div></div>", ["A short head", LONG, "Short end.", MORE]),
        (f"<div><p>{LONG}</p><p>{MORE}</p></div><div><p>red green blue house tree car water stone paper glass iron wood</p></div>", [LONG, MORE]),
        # apart by element, class, id, role or style
        (f"<header>Site of the world</header><nav>{LONG}</nav><main><h1>Title</h1><p>{LONG}</p></main><aside>{MORE}</aside><footer>{MORE}</footer>", ["Title", LONG]),
        (f"<body class='has-sidebar'><div class='page-wrapper'><div id=cookieNotice>{LONG}</div><div class='post-content'><p>{LONG}</p></div><div class=sideBar>{MORE}</div><section id='comments'><article><p>{MORE}</p></article></section></div>", [LONG]),
        (f"<article><header><h1>Own head</h1></header><p>{LONG}</p><div role=complementary>{MORE}</div><div style='display: none'>{MORE}</div></article>", ["Own head", LONG]),
        (f"<form action=x><article><p>{LONG}</p></article><p>Send us a message when you are done with it and we will write to you</p></form>", [LONG]),
        # raw text, comments, references, quoted signs, unclosed elements, breaks
        (f"<title>T</title><script>if (a < b) document.write('<p>{MORE}</p>')</script><style>p > a</style><p>{LONG}<!-- <p>gone</p> --><p title='a > b'>x &lt; y &amp; z&nbsp;&copy was &#8364; that of the one in it", [LONG, "x < y & z © was € that of the one in it"]),
        (f"<article><p>{LONG}<br>one\n two<br><br>three</article>", [f"{LONG} one two", "three"]),
        ("<article><h1>Only</h1><p>short</article>", ["Only", "short"]),
        (f"<article><ul><li>first item<li>second item</ul><p>{LONG}</p><table><tr><td>a<td>b</table></article>", ["first item", "second item", LONG, "a", "b"]),
        ("just words", ["just words"]),
        ("<p>5 < 6 and <b>bold", ["5 < 6 and bold"]),
        ("", []),
        (None, []),
        ("<div class='ad", []),
        (f"<p>{LONG} {'word and ' * 100_000}</p>", [f"{LONG} {('word and ' * 100_000).strip()}"]),
    ],
)
def test_main_text(page, want):
    assert page_text(page) == "\n\n".join(want)


def test_second_pass():
    """Open blocks against a plain search for the nearest decided ones."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        blocks = [main_text.Block("x", 1, 0, 0, False, int(body), int(c), False, int(x)) for body, c, x in zip(rng.integers(0, 2, 12), rng.integers(0, 4, 12), rng.choice([0, 0, 1, -1], 12), strict=True)]
        first = [b.label for b in blocks]
        main_text.inherit(blocks)
        for i, b in enumerate(blocks):
            if first[i]:
                assert b.label == first[i]
                continue
            for level in (0, 1):
                fits = lambda j, level=level: (blocks[j].container, blocks[j].body) == (b.container, b.body) if level == 0 else not b.body or blocks[j].body == b.body  # noqa: B023
                near = [(abs(i - j), x) for j, x in enumerate(first) if x and fits(j)]
                if near:
                    tied = {x for d, x in near if d == min(near)[0]}
                    assert b.label == (tied.pop() if len(tied) == 1 else 1 if b.body or level == 0 else -1)
                    break
            else:
                assert b.label == (1 if b.body or not any(first) else -1)


def test_pages_edges(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "x"), (1, "u", f"<p>{LONG}</p>", "x"), (2, None, None, "y"), (None, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract_text(pages)
    assert sorted(map(str, got.collect())) == sorted(map(str, [(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (None, "v", "", 0)])) or {tuple(r) for r in got.collect()} == {(1, "u", LONG, len(LONG)), (2, None, "", 0), (None, "v", "", 0)}
    assert got.count() == 4 and main_text.extract_text(pages.limit(0)).count() == 0
    blocks = main_text.classified_blocks(pages).collect()
    assert [(b.page_id, b.block, b.text, b.first_label, b.label) for b in blocks] == [(1, 0, LONG, 1, 1)] * 2 and blocks[0].stop_share > 0.3


def plain_negatives(rows):
    """Every anchor against every row."""
    use = []
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for a, la, qa in use:
        if a % 100:
            continue
        met = [(-sum(x * y for x, y in zip(qa, v, strict=True)), i, label) for i, label, v in use if i != a and len(v) == len(qa)]
        for s, p, _ in sorted(m for m in met if m[2] == la)[:5]:
            inside = sorted(m for m in met if m[2] != la and 80 * -s <= 100 * -m[0] <= 100 * -s)[:5]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(inside)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, block int, q string, side int"
NEGATIVES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives(spark, monkeypatch):
    """Many small blocks; ties, repeated ids, odd rows and vectors of two sizes."""
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(0, 0.2, 6 if i % 9 else 5), 1)], int(rng.integers(0, 3))) for i in range(1500)]
    rows += [(1600, [0.1] * 6, 1), (1600, [0.2] * 6, 1), (1601, None, 1), (1602, [0.1] * 6, None), (1603, [None] * 6, 2), (1604, [float("nan")] * 6, 2), (1605, [float("inf")] * 6, 2), (1700, [], 1), (1701, [], 1), (1702, [], 2), (None, [0.3] * 6, 1), (1800, [1e9, 0.0, 0.0, 0.0, 0.0, 0.0], 2)]
    shown = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], label) for i, e, label in rows if i != 1800]
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 100)
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in shown], VECTORS).repartition(4)
    got = hard_negatives.hard_negatives(table)
    assert sorted(tuple(r[c] for c in NEGATIVES) for r in got.collect()) == plain_negatives(shown)
    huge = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS)
    assert hard_negatives.hard_negatives(huge).where("anchor_id = 1800").count() >= 0
    assert hard_negatives.hard_negatives(table.limit(0)).count() == 0


def test_bounds():
    """Looked-up bounds hold, and most vectors are never scored exactly."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(0, 0.125, (4000, 64))).astype(np.int32)
    centre = np.floor(256 * rng.normal(0, 0.125, 64))
    x[:40] = centre + rng.integers(-8, 9, (40, 64))
    cells, edges = hard_negatives.cells_of(x.astype(np.int64))
    block = hard_negatives.Block(64, np.arange(4000).tobytes(), np.zeros(4000, np.int32).tobytes(), x.tobytes(), cells.tobytes(), edges.tobytes())
    asked = x[:3]
    low, high = block.bounds(asked)
    score = asked.astype(np.int64) @ x.T.astype(np.int64)
    assert (low <= score).all() and (score <= high).all()
    everyone = np.ones(low.shape, bool)
    assert (high >= hard_negatives.kth(low, everyone, 5)[:, None]).mean() < 0.05
    for dim in (1, 3):
        cells, edges = hard_negatives.cells_of(x[:50, :dim].astype(np.int64))
        block = hard_negatives.Block(dim, np.arange(50).tobytes(), np.zeros(50, np.int32).tobytes(), x[:50, :dim].tobytes(), cells.tobytes(), edges.tobytes())
        low, high = block.bounds(x[:5, :dim])
        score = x[:5, :dim].astype(np.int64) @ x[:50, :dim].T.astype(np.int64)
        assert (low <= score).all() and (score <= high).all()
