"""Vector codes, hard negatives and page text against brute-force forms on small frames."""

import hashlib
import html as htmllib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives, html_text, registry, vector_codes
from ledgerlake.llm.common import discard, documents, stage_at
from ledgerlake.sources.layers import path_exists

SMALL = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(n, dims, seed, labels=4, grid=None):
    """Random rows with null labels, ties (a coarse grid), repeats and bad vectors."""
    rng = random.Random(seed)
    cell = lambda: rng.choice(grid) if grid else float(np.float32(rng.gauss(0, 0.3)))
    rows = [(i, [cell() for _ in range(dims)], rng.randrange(labels) if rng.random() < 0.9 else None) for i in range(n)]
    for i in rng.sample(range(n), n // 8):  # equal vectors under other ids
        rows[i] = (i, rows[rng.randrange(n)][1], rows[i][2])
    bad = [(n, None, 1), (n + 1, [NAN] * dims, 1), (n + 2, [None] + [0.5] * (dims - 1), 2), (n + 3, [INF] + [0.0] * (dims - 1), 0),
           (n + 4, [-INF] * dims, None)]
    rows += bad
    rng.shuffle(rows)
    return rows


def able(row):
    return row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])


# --------------------------------------------------------------- vector codes

def brute_codes(rows, scale, parts, entries, rounds):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if able((i, v, label))]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0], r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((dist(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [near(cut(v, p), books[p])[1] for _, v, _ in kept]
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), a in zip(kept, at) if a == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    out, per_label = [], {}
    for i, v, label in kept:
        got = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in got)
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in got), error))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, code, error, per_label[label], digest) for i, label, code, error in out)


@pytest.mark.parametrize("grid", [None, [-0.5, -0.25, 0.0, 0.25]])
def test_codes_equal_full_scans(spark, grid):
    rows = vectors(150, 16, 5, grid=grid)
    rows += [rows[0], rows[0]]  # a repeated row is a row of its own
    df = spark.createDataFrame(rows, VECTORS).repartition(5).withColumns({
        "x": F.lit("clash"), "at": F.lit(1), "dist": F.lit(2), "code": F.lit(3), "error": F.lit(4), "__label": F.lit(5)})
    got = vector_codes.code_table(*vector_codes.encode(df))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == brute_codes(rows, 4096, 8, 16, 6)


def test_codes_of_few_rows_odd_lengths_and_nothing(spark):
    rows = [(4, [0.1, -0.2], 1), (2, [0.3, 0.7], None), (None, [9.0, 9.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, [], 1),
            (9, [1e30, 0.0], 1), (1, [0.5] * 4, 1)]
    got, books = vector_codes.encode(spark.createDataFrame(rows, VECTORS), parts=2, entries=16)
    assert books.shape == (2, 1, 2) and [r.vec_id for r in got.collect()] == [1]  # the smallest id sets the length
    rest = [r for r in rows if r[0] != 1]
    table = vector_codes.code_table(*vector_codes.encode(spark.createDataFrame(rest, VECTORS), parts=2))
    assert sorted([(r.vec_id, r.code, r.error) for r in table.collect()], key=repr) == [
        (2, "0000", 0), (4, "0101", 0), (None, "0202", 0)]
    for none in ([], [(1, None, 1)]):
        rows_of, books = vector_codes.encode(spark.createDataFrame(none, VECTORS))
        assert vector_codes.code_table(rows_of, books).count() == 0 and books.shape[1] == 0


def test_following_active_entries_equals_a_full_scan():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x = rng.integers(-4, 5, (60, 3))
        old = rng.integers(-4, 5, (7, 3))
        new = old.copy()
        for k in rng.choice(7, rng.integers(0, 5), replace=False):
            new[k] += rng.integers(-2, 3, 3)
        at, dist = vector_codes.nearest(x, old)
        vector_codes.follow(x, at, dist, new, (old != new).any(axis=1))
        want, far = vector_codes.nearest(x, new)
        assert (at == want).all() and (dist == far).all()


def test_discarded_stage_is_gone(spark):
    df, path = stage_at(spark.range(3).toDF("n"), "test-discard")
    assert df.count() == 3 and path_exists(spark, path)
    discard(spark, path)
    assert not path_exists(spark, path)


# ------------------------------------------------------------- hard negatives

def brute_negatives(rows, every, positives=5, negatives=5, low=80, high=100, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if able((i, v, label)) and label is not None]
    out = []
    for k, (a, x, label) in enumerate(kept):
        if a is None or a % every:
            continue
        score = [sum(p * q for p, q in zip(x, y)) for _, y, _ in kept]
        order = lambda j: (-score[j], kept[j][0] if kept[j][0] is not None else INF)
        same = sorted((j for j in range(len(kept)) if j != k and kept[j][2] == label), key=order)[:positives]
        for j in same:
            fit = [m for m in range(len(kept)) if kept[m][2] != label and low * score[j] <= 100 * score[m] <= high * score[j]]
            for r, m in enumerate(sorted(fit, key=order)[:negatives], 1):
                out.append((a, kept[j][0], r, kept[m][0], score[j], score[m]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("grid,group", [(None, 8192), ([-0.5, 0.0, 0.25], 3)])
def test_negatives_equal_brute_force(spark, grid, group):
    rows = vectors(260, 6, 9, grid=grid)
    rows += [(300, [0.0] * 6, 1), (301, [0.0] * 6, 2), (None, [0.25] * 6, 2)]  # an anchor without components, a row without id
    df = spark.createDataFrame(rows, VECTORS).repartition(4).withColumns({
        "row": F.lit("clash"), "score": F.lit(1), "v": F.lit(2), "id": F.lit(3), "window": F.lit(4)})
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, group=group)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, 10)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 100


def test_negatives_of_repeated_rows_short_vectors_and_nothing(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [1.0, 0.0], 2), (3, [1.0, 0.0], 2), (4, [2.0, 0.0], 2)]
    df = spark.createDataFrame(rows, VECTORS)
    got = sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") == 0, scale=10).collect()))
    one = [(0, 1, 1, 2, 100, 100), (0, 1, 2, 3, 100, 100)]  # 4 scores above the positive
    assert got == sorted(one * 2)
    for none in (df.limit(0), df.withColumn("label", F.lit(None).cast("int"))):
        assert hard_negatives.mine(none, F.col("vec_id") == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0
    assert hard_negatives.mine(df.filter("label = 1 and vec_id = 0"), F.lit(True)).count() == 0


def test_threshold_stops_early_and_keeps_ties():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n = 4000
    x = rng.integers(-3, 4, (n, 8)).astype(float)
    x[:40, 0] += 100  # a few rows that lead the list of a heavy component
    x[7] = x[21]
    batch = pa.RecordBatch.from_pydict({"v": pa.array(x.tolist(), pa.list_(pa.float64())), "label": [0] * n,
                                        "id": list(range(n, 0, -1)), "row": list(range(n))})
    block = hard_negatives.Block(batch, 8, 1)
    q = np.array([50.0, 1, -1, 2, 0, 0, 1, -2])
    best = hard_negatives.Best(5)
    met = block.search(q, lambda at, score: best.add(score, block.id[at], block.row[at]), lambda t: t < best.kth)
    score = x @ q
    want = sorted(range(n), key=lambda r: (-score[r], n - r))[:5]
    assert best.row.tolist() == want and met < n / 2


# ------------------------------------------------------------------ page text

def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>All about</a></li></ul></nav>"
ARTICLE = ("<h1>The  title</h1><p><b>First &amp; foremost.<br>Then <a href='#'>a link</a>,\n more.<p>Second\tparagraph is a "
           "little longer than the first one.</p><ul><li>one<li>two &lt;b&gt;</ul>")
TEXT = ("The title\n\nFirst & foremost. Then a link, more.\n\nSecond paragraph is a little longer than the first one.\n\n"
        "one\n\ntwo <b>")
FORMS = [
    page(f"{NAV}<div class='ad'>Buy this wonderful thing now, it is cheap and good and everybody has one.</div>"
         f"<article>{ARTICLE}</article><footer>&copy; somebody</footer>"),
    page(f"<header><h1>Site</h1>{NAV}</header><div id='page'><div class='post-content'>{ARTICLE}</div>"
         "<aside><p>Other things to read</p></aside></div><div id='footer'><p>Imprint and more words here</p></div>"),
    page(f"<script>var t='</p><p>no text</p>';</script><style>p{{}}</style><main>{ARTICLE}"
         "<section class='comments'><article><p>I do not like this article at all, said a reader at length.</p></article>"
         "</section></main><form><p>Your name <input> and <button>Send</button></p></form>"),
    page(f"<div class='cookie-notice'>We use cookies on this page to show adverts that fit you.</div><form id='whole'><article>"
         f"<header>{ARTICLE}</header><footer>Posted by X</footer></article></form><div hidden>Not shown</div>"
         "<p style='display: none'>Nor this</p><!-- <p>nor this</p> -->"),
    f"<article>{ARTICLE}</article>",  # no html, head or body
    f"<html><head><title>T</title><body class='no-sidebar'>{NAV}<table><tr><td>{ARTICLE}</td><td class='sidebar'>Side<tr></table>",
]


@pytest.mark.parametrize("html", FORMS)
def test_main_text_of_page_forms(html):
    assert html_text.main_text(html) == TEXT


def test_main_text_of_odd_pages():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text(page(NAV)) == ""
    assert html_text.main_text("x") == "x"  # no density at all: the whole page
    assert html_text.main_text("no markup\n but words &eacute; &#8364;") == "no markup but words é €"
    assert html_text.main_text(page("<article><p>&ampersand &quot;quoted\"</article>")) == '&ersand "quoted"'
    long = " ".join(f"word{i}" for i in range(200_000))
    assert html_text.main_text(page(f"{NAV}<article><p>{long}</p></article>")) == long
    deep = "<div>" * 20_000 + "deep words of a page" + "</div>" * 20_000
    assert html_text.main_text(page(deep)) == "deep words of a page"


def test_blocks_beside_the_densest_one_need_the_threshold():
    """Without an article element: what is as dense as the path to the densest subtree is kept, a list of links is not."""
    many = "".join(f"<p>Paragraph {i} of the main text, long enough to count as text of the page.</p>" for i in range(6))
    links = "".join(f"<li><a href='/{i}'>Some other page {i}</a></li>" for i in range(12))
    html = page(f"<div><h2>Heading</h2><div><div>{many}</div></div></div><ul>{links}</ul>"
                f"<section><p>{'Another dense part of the text. ' * 4}</p></section><div><span>.</span></div>")
    got = html_text.main_text(html).split("\n\n")
    assert got[0] == "Heading" and got[-1].startswith("Another dense part") and len(got) == 8


def under(tree, gone, i):
    return [i] + [x for c in tree.items[i] if isinstance(c, int) and not gone[c] for x in under(tree, gone, c)]


def naive_chars(tree, gone, i, only_links=False):
    def linked(j):
        return j > 0 and (tree.tag[j] == "a" or linked(tree.parent[j]))

    return sum(len(re.sub(r"\s", "", t)) for j in under(tree, gone, i) for t in tree.items[j]
               if isinstance(t, str) and (linked(j) or not only_links))


def naive_share(tree, gone, body):
    return naive_chars(tree, gone, body, True) / naive_chars(tree, gone, body)


def naive_density(tree, k, gone, body):
    """The formula from its definition: every count taken anew from the subtree."""
    c, lc = naive_chars(tree, gone, k), naive_chars(tree, gone, k, True)
    if not c:
        return 0.0
    below = under(tree, gone, k)[1:]
    t, lt = len(below), sum(tree.tag[j] == "a" for j in below)
    rest, share = c - lc, naive_share(tree, gone, body)
    base = math.log(c / max(rest, 1) * max(lc, 1) + share * c + math.e)
    return c / max(t, 1) * math.log(max(1, c / max(lc, 1) * max(t, 1) / max(lt, 1))) / math.log(base)


def test_selected_subtree_equals_the_naive_search():
    """On pages without article elements, the subtree with the largest naive sum is main text."""
    rng = random.Random(4)

    def part(depth):
        if depth == 0 or rng.random() < 0.3:
            words = " ".join(rng.choice(["alpha", "be", "gamma", "delta"]) for _ in range(rng.randrange(1, 25)))
            return rng.choice([f"<p>{words}</p>", f"<p><a href='#'>{words}</a> and</p>", f"{words}<br>", f"<a>{words}</a>"])
        return "<div>" + "".join(part(depth - 1) for _ in range(rng.randrange(1, 4))) + "</div>"

    for _ in range(60):
        tree = html_text.Tree(page(part(3) + part(3)))
        _, kept, gone = html_text.select(tree)
        body = tree.tag.index("body")
        nodes = [k for k in range(body, len(tree.tag)) if not gone[k]]
        dense = {k: naive_density(tree, k, gone, body) for k in nodes}

        def total(k):
            kids = [x for x in tree.items[k] if isinstance(x, int)]
            if not kids:
                return dense[k]
            bare = [len(re.sub(r"\s", "", x)) for x in tree.items[k] if isinstance(x, str)]
            link = int(tree.tag[k] == "a")
            share = naive_share(tree, gone, body)
            return sum(dense[x] for x in kids) + sum(html_text.density(c, c * link, 1, link, share) for c in bare)

        sums = {k: total(k) for k in nodes}
        most = max(sums.values())
        assert any(k in kept for k in nodes if sums[k] >= most * (1 - 1e-9))


def test_pages_keep_their_columns(spark):
    rows = [(1, "u", FORMS[0], "old", 7), (1, "u", FORMS[0], "old", 7), (None, None, None, None, None), (2, "v", "", "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, N_CHARS int").withColumn("tag", F.lit(1))
    got = html_text.extract_pages(df)
    assert got.columns == ["page_id", "url", "html", "tag", "text", "n_chars"]
    assert [(r.page_id, r.text, r.n_chars) for r in got.orderBy(F.desc_nulls_last("page_id")).collect()] == [
        (2, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (None, "", 0)]
    clash = html_text.extract_pages(df.select(F.col("html").alias("text")), "text")  # the page in a column of that name
    assert sorted(r.text for r in clash.collect()) == ["", "", TEXT, TEXT]
    assert html_text.extract_pages(df.limit(0)).count() == 0


def test_whole_pages_table_equals_its_articles(spark):
    def want(html):
        inner = re.search(r"<article>(.*)</article>", html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        plain = [" ".join(htmllib.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts]
        return "\n\n".join(x for x in plain if x)

    pages = {r.page_id: want(r.html) for r in documents(spark, SMALL, "pages").collect()}
    got = registry.op11_html_text(spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == pages[r.page_id] and r.n_chars == len(r.text)
