"""Decontamination, quality rules, HTML, toxicity: brute force, hand cases, held-out accuracy."""

import hashlib
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np

from tidemark.llm import decontamination, quality_rules, toxicity
from tidemark.llm.html_extraction import extract_text, main_text

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


def plain_words(text):
    return PLAIN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected_leaks(rows, items, window):
    patterns = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            patterns.setdefault(tuple(words[i : i + window]), set()).add(str(item))
    out = {}
    for doc_id, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(words) - n + 1):
                if names := patterns.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit))
    return out


def test_leaks_as_brute_force_in_one_block_and_many(spark, docs, corpus, monkeypatch):
    rng = random.Random(3)
    items = [(i, " - ".join(rng.choice(corpus)[1].upper().split()[:14])) for i in range(12)]
    items += [(100, "w1 W2"), (101, "the"), (102, None), (103, "..."), (7, "of of and")]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = expected_leaks(corpus, items, 10)
    for block in (10**6, 40):
        monkeypatch.setattr(decontamination, "BLOCK", block)
        rows = decontamination.find_leaks(docs, table, COLUMNS).collect()
        assert {r.doc_id: tuple(r[1:6]) for r in rows} == expected
        kept = {r.doc_id for r in decontamination.drop_leaks(docs, table).collect()}
        assert kept == {i for i, x in expected.items() if not x[4]}


def test_spans_point_into_the_original(spark):
    text = "Ünrelated… é: What IS - the capital\nof Peru? (answer) Lima!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, "is the CAPITAL of peru")], "item_id long, text string")
    (row,) = decontamination.find_leaks(docs, items, ("spans",)).collect()
    assert [text[a:b] for a, b in zip(row.spans[::2], row.spans[1::2])] == ["IS - the capital\nof Peru"]


def test_leaks_of_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b")], "item_id long, text string")
    rows = decontamination.find_leaks(awkward, items).collect()
    assert len(rows) == 16
    assert [(r.items, r.n_hit) for r in rows if r.doc_id == 6] == [(["", "3"], 2)]
    kept = decontamination.drop_leaks(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == 15
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.find_leaks(awkward, none).collect())
    assert decontamination.drop_leaks(awkward, none).count() == 16
    assert decontamination.find_leaks(empty, items).collect() == []


def expected_facts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    counts = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if counts[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_quality_facts_as_brute_force(docs, corpus, awkward, empty):
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: tuple(r[c] for c in base) for r in quality_rules.judge(docs).collect()}
    assert got == {i: expected_facts(t) for i, t in corpus}
    rows = quality_rules.judge(awkward).select("doc_id", *base).collect()
    texts = {(i, expected_facts(t)) for i, t in [(r.doc_id, r.text) for r in awkward.collect()]}
    assert len(rows) == 16 and {(r[0], tuple(r[1:])) for r in rows} == texts
    assert quality_rules.judge(empty).collect() == []


def test_quality_rules_name_what_fails(spark):
    good = "The report of the year is short and it was read by all in the house."
    rows = [(1, good), (2, "%%% ### $$$ &&& *** ||| <<< >>> ### %%% ### $$$"), (3, "\n".join(["- point of the day it is"] * 3 + [good]))]
    got = {r.doc_id: (r.kept, set(r.failed_rules)) for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (True, set())
    assert {"symbols_per_word", "stop_word_share", "letter_share"} <= got[2][1]
    assert got[3][0] is False and "duplicate_line_share" in got[3][1]


def test_quality_is_one_projection(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|hashpartitioning|SinglePartition|Join", plan)


PAGE = """<html><head><title>x</title></head><body class="post"><header><h1>Site</h1><a href=/>home</a></header>
<div id=menu><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div><div class="cookie-notice">We use cookies, ok, fine</div>
<div id="page"><div class="content"><h2>Title &amp; more</h2><p>First para, with <a href=x>a link</a>, and <b>bold</b>text.
<p>Second&nbsp;para<br>here.<ul><li>item one, two<li>item 3</ul><table><tr><td>cell a<td>cell b</table>
<form><input><p>Sign up now, please, do</form></div><div class="sidebar"><p>Side, with, commas, many, more</p></div></div>
<section id="comments"><p>Great post, thanks, a lot, really, yes, good</p></section><footer>&copy;</footer>"""


def test_main_text_of_pages():
    expected = "Title & more First para, with a link, and boldtext. Second para here. item one, two item 3 cell a cell b"
    assert main_text(PAGE) == expected
    article = '<nav><a href=/>x</a></nav><div class="ad">Buy, buy</div><article><h1>Head</h1><p><b>Open.<br><p>Next &lt;b&gt; &am.</article><footer>f</footer>'
    assert main_text(article) == "Head Open. Next <b> &am."
    assert main_text('<p>x</p><script>if(a<b){"</p>"}</script><p>y</p>') == "x y"
    assert main_text("<article><p>5 < 6 & 7</p><!-- <p>no</p> --></article>") == "5 < 6 & 7"
    assert main_text("text only") == "text only"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("</p></div><p>stray") == "stray"


def test_state_in_a_name_cuts_no_article():
    body = "<p>First, of the article, as it is.<p>Second, with more, and more.</p>"
    for attributes in (
        'class="content with-sidebar"',
        'id="content" class="comments-open"',
        'class="post type-post tag-politics"',
        'class="entry has-header"',
    ):
        page = f'<div {attributes}>{body}</div><div class="sidebar">Side, too</div>'
        assert main_text(page) == "First, of the article, as it is. Second, with more, and more.", attributes


    long = " ".join(["a word, and more"] * 60)  # nothing else is left: the outermost stays
    assert main_text(f'<div class="left-sidebar"><p>{long}</p><div class="sidebar">Side</div></div>') == long
    assert main_text('<p>Short.</p><div class="ad">An advert, longer than the text.</div>') == "Short."


def test_cut_elements_end_as_others_do():
    assert main_text('<article><p class="ad">Buy<p>First<p>Second</article>') == "First Second"
    assert main_text("<article><div><form>Sign</div><p>Rest</article>") == "Rest"
    assert main_text("<article><div><aside>Side</div><p>Rest</article>") == "Rest"
    assert main_text("<article><div><ul><li class=share>Share<li>Kept</ul></div><p>Rest</article>") == "Kept Rest"
    assert main_text("<head><title>T</title><body><p>Text</p>") == "Text"
    links = "".join(f"<li><a href={i}>Source {i}</a>" for i in range(4))
    assert main_text(f"<article><p>As shown.</p><ul>{links}</ul></article>") == "As shown. Source 0 Source 1 Source 2 Source 3"


RUNNING = "Running text, of the article, with commas, as it goes on, and on, and on."


def test_parts_beside_the_best_container_stay():
    big = "".join(f"<p>{RUNNING}</p>" for _ in range(5))
    whole = " ".join([RUNNING] * 5)
    for part, text in (
        ("<ul><li>One<li>Two</ul>", "One Two"),
        ("<table><tr><td>A<td>B</table>", "A B"),
        ("<figure><figcaption>Shown</figcaption></figure>", "Shown"),
        ("<dl><dt>Term<dd>Meaning</dl>", "Term Meaning"),
        ("Loose <b>text</b> here.", "Loose text here."),
        ("<math><mi>x</mi></math>", "x"),
    ):
        assert main_text(f"<body><div><div>{big}</div>{part}</div></body>") == f"{whole} {text}", part
        assert main_text(f"<body><div><div>{big}</div>{part}<div>{big}</div></div></body>") == f"{whole} {text} {whole}", part
    small = "<div><p>Short.</p></div>"
    assert main_text(f"<div><div>{big}</div>{small}<div>{big}</div></div>") == f"{whole} Short. {whole}"
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a></ul>"
    assert main_text(f"<div><div>{big}</div>{links}<div>{big}</div></div>") == f"{whole} {whole}"


def test_names_inside_an_article_cut_what_is_nothing_else():
    names = "legal related-work social-contract search-algorithm tag table-header notice toc reply alert-level"
    for name in names.split():
        for times in (1, 40):  # whatever its size
            text = " ".join([RUNNING] * times)
            for shell in ("<main>{}</main>", "<article>{}</article>", '<div class="content">{}</div>'):
                page = shell.format(f'<p>{RUNNING}</p><section class="{name}"><p>{text}</p></section>')
                assert main_text(f"<body>{page}</body>") == f"{RUNNING} {text}", (name, times, shell)
    for name in ("ad", "comments", "comment-list", "share-buttons", "social-share", "sidebar", "newsletter", "cookie-bar"):
        page = f'<article><p>{RUNNING}</p><div class="{name}"><p>{RUNNING} {RUNNING}</p></div></article>'
        assert main_text(page) == RUNNING, name
    for name in ("related-posts", "site-footer", "nav-links", "ad-slot-3", "search-form", "social-links", "cookie-notice"):
        page = f'<div><div class="{name}"><p>{RUNNING} {RUNNING}</p></div><div><p>{RUNNING}</p></div></div>'
        assert main_text(page) == RUNNING, name


class Plain(HTMLParser):
    """What the given pages say their article is, by a parser of its own: the text of <article>."""

    def __init__(self, page):
        super().__init__()
        self.blocks, self.run, self.depth, self.off = [], [], 0, 0
        self.feed(page)
        self.end()

    def end(self):
        block = " ".join("".join(self.run).split())
        self.blocks += [block] if block else []
        self.run = []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.off += tag in ("script", "style", "form", "nav", "footer", "aside")
        if tag not in ("b", "a", "i", "em", "span", "strong"):
            self.end()

    def handle_endtag(self, tag):
        if tag not in ("b", "a", "i", "em", "span", "strong"):
            self.end()
        self.depth -= tag == "article"
        self.off -= tag in ("script", "style", "form", "nav", "footer", "aside")

    def handle_data(self, data):
        if self.depth and not self.off:
            self.run.append(data)


def test_pages_as_a_parser_of_its_own(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    expected = {r.page_id: " ".join(Plain(r.html or "").blocks) for r in pages.collect()}
    found = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert found == expected and all(found.values())


def test_html_of_awkward_rows(spark):
    rows = [(1, "u", None, 5), (1, "u", None, 5), (None, None, "<p>t", 5), (3, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in extract_text(pages).collect())
    assert got == [("1", "", 0), ("1", "", 0), ("3", "", 0), ("None", "t", 1)]
    assert extract_text(pages.where("false")).collect() == []


def marked(n, seed):
    """Texts in which a toxic one holds a word of a bad kind, by word or by its beginning."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(["an", "er", "in", "th", "ou"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 90))]
        if bad := i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["scum", "zqarg" + words[0]])
        texts.append(" ".join(words))
        labels.append(float(bad))
    return texts, np.array(labels, np.float32)


def test_network_learns_words_and_beginnings():
    net = toxicity.fit(*marked(400, 1), share=1 / 3)
    texts, labels = marked(200, 2)
    assert np.mean((toxicity.Scorer(net).scores(texts) >= 0.5) == labels) > 0.95


def test_training_reads_whole_texts():
    texts, labels = marked(120, 1)
    filler, _ = marked(40, 3)
    long = []
    for i, text in enumerate(texts):
        words = " ".join(filler[(i + k) % 40] for k in range(30)).replace("scum", "er").replace("zqarg", "an").split()
        at = len(words) * (i % 7) // 7
        long.append(" ".join([*words[:at], text, *words[at:], f"ending{i % 8}"]))
    net = toxicity.fit(long, labels, share=1 / 3)
    # Each of the last words stands in 15 texts: all count, in whatever window.
    assert {f"ending{i}" for i in range(8)} <= set(net.index)
    # Scale and shift are fitted to what scoring sees, so scores average to the share.
    assert abs(np.mean(toxicity.Scorer(net).scores(long)) - 1 / 3) < 0.03


def test_gradients_are_right():
    net = toxicity.Network(["a"], seed=1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    gates = rng.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    present = np.arange(5)[:, None] < np.array([5, 3, 1])
    keep: dict = {}
    net.forward(gates, present, keep)
    slope = np.array([0.3, -1.0, 0.5])
    grads, d_gates = net.backward(keep, present, slope)

    def loss():
        return float(net.forward(gates, present) @ slope)

    def numeric(array, at, step=1e-2):
        array[at] += step
        up = loss()
        array[at] -= 2 * step
        down = loss()
        array[at] += step
        return (up - down) / (2 * step)

    for name in ("out", "look", "attend", "back_f", "back_b"):
        at = tuple(0 for _ in net.weights[name].shape)
        assert abs(numeric(net.weights[name], at) - grads[name][at]) < 1e-3, name
    assert abs(numeric(gates, (1, 0, 3)) - d_gates[1, 0, 3]) < 1e-3
    assert abs(numeric(gates, (0, 1, 40)) - d_gates[0, 1, 40]) < 1e-3


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 31, 32, 33, 52, 100, 1001):
        starts = toxicity.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a <= toxicity.STEP for a, b in zip(starts, starts[1:]))


def test_toxicity_on_spark(spark, awkward, empty):
    texts, labels = marked(150, 4)
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    marks = [(i, 1, int(y)) for i, y in enumerate(labels)] + [(None, 1, 1), (5, 1, 1), (5, 1, 0), (900, None, None)]
    table = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    net = toxicity.train(docs, table, most=60)
    got = toxicity.score(docs, net).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    kept = toxicity.drop_toxic(docs, net)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.score(awkward, net).count() == 16
    assert toxicity.score(empty, net).collect() == []
    none = toxicity.train(empty, table.where("false"))
    assert {r.predicted for r in toxicity.score(awkward, none).collect()} == {0}
