"""Text scans, quality rules, licenses, urls and pages."""

import re

import pyarrow as pa
import pytest

from termtide.llm import html_extract, licenses, quality, textscan, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n\t", "One", "a b\x0bc\x1dd \x85e", "Éa éa ÉA", "x\n\ny\nx\n x\nx", "#*$ %a& | <>",
    "a b c d e f g h i a b c d e f g h", "w " * 30, "1 2 3 ! ?",
]


def plain_counts(text):
    words = WORD.findall(text or "")
    seen, same = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    windows = [tuple(w.translate(url_filter._LOWER) for w in words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), same, len(hit)]


def test_words_and_lines():
    texts = textscan.texts_of(pa.array(TEXTS))
    words = textscan.words_of(texts)
    data = texts.data.tobytes()
    assert [data[a:b].decode() for a, b in zip(words.first, words.end)] == [
        w for t in TEXTS for w in WORD.findall(t or "")
    ]
    _, row, first, end = textscan.lines_of(texts)
    assert [(r, data[a:b].decode()) for r, a, b in zip(row, first, end)] == [
        (i, line) for i, t in enumerate(TEXTS) for line in (t or "").split("\n")
    ]


def test_hash_is_by_word_with_ascii_case(monkeypatch):
    hashes = lambda t: textscan.words_of(textscan.texts_of(pa.array([t]))).hash.tolist()
    a = hashes("Abc abc ABC abd É é " + "q" * 300 + " abc")
    assert a[0] == a[1] == a[2] == a[7] and len(set(a)) == 5
    monkeypatch.setattr(textscan, "WINDOW", 4)
    assert hashes("Abc abc ABC abd É é " + "q" * 300 + " abc") == a


def test_counts_by_brute_force(documents):
    texts = TEXTS + [r.text for r in documents.collect()]
    counts, _ = quality.text_counts(pa.array(texts))
    for i, text in enumerate(texts):
        assert [int(counts[c][i]) for c in quality.COUNTS] == plain_counts(text), text


def test_quality(docs, prose):
    good = [(i, " ".join(prose(80 + i % 40, i))) for i in range(250)]
    rows = docs(
        *good, (900, None), (901, ""), (902, "w " * 30), (None, " ".join(prose(90, 1))), (None, "x"),
        (903, " ".join(f"{w.upper()}###" for w in prose(90, 2))), (903, "few"),
    )
    got = {}
    for r in quality.judge_quality(rows).collect():
        got.setdefault(r.doc, []).append((r.n_words, r.base_failed, r.kept))
    assert sum(k[0][2] for i, k in got.items() if i is not None and i < 900) >= 249
    assert got[900] == got[901] == [(0, True, False)] and got[902] == [(30, True, False)]
    assert sorted(got[903]) == [(1, True, False), (90, False, False)] and len(got[None]) == 2
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and not {900, 901, 902, 903} & set(ids)
    assert quality.judge_quality(docs()).count() == quality.keep_good(docs()).count() == 0


def test_verdicts_by_brute_force(docs, prose):
    import numpy as np

    rows = [(i, " ".join(prose(60 + i % 50, i))) for i in range(170)]
    rows += [(200 + i, " ".join(w.upper() + "#!" * (i % 4) for w in prose(70, i))) for i in range(12)]
    got = [r for r in quality.judge_quality(docs(*rows)).collect() if not r.base_failed]
    values = np.array([[r[c] for c in quality.STATISTICS] for r in got])
    floor = np.array(list(quality.STATISTICS.values()))
    least = lambda x, share: np.sort(x, axis=0)[int(np.ceil(share * len(x))) - 1]
    bucket = lambda d: np.floor(np.log2(np.maximum(d, 1e-6)) * 64)
    centre = least(values, 0.5)
    shape = np.diag(1 / np.hypot(1.4826 * least(np.abs(values - centre), 0.5), floor))
    for _ in range(3):
        far = bucket((((values - centre) @ shape.T) ** 2).sum(axis=1))
        near = values[far <= least(far, 0.75)]
        centre = near.mean(axis=0)
        shape = np.linalg.inv(np.linalg.cholesky(np.cov(near.T, bias=True) + np.diag(floor**2)))
    d2 = (((values - centre) @ shape.T) ** 2).sum(axis=1)
    d2 /= max(2 ** ((least(bucket(d2), 0.5) + 1) / 64) / quality.chi_square(0.5, quality.P), 1)
    assert [r.d2 for r in got] == pytest.approx(d2.tolist(), rel=1e-6)
    assert [r.kept for r in got] == (d2 <= quality.chi_square(0.9998, quality.P)).tolist()
    assert 0 < sum(r.kept for r in got) < len(got)


def test_junk_goes_and_clean_stays(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.judge_quality(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.where("not base_failed").join(labels, judged["doc"] == labels["doc_id"]).collect()
    junk, clean = ([r.kept for r in rows if r.quality == q] for q in (0, 1))
    assert sum(junk) <= 0.1 * len(junk) and sum(clean) >= 0.99 * len(clean)


def test_licenses(docs):
    rows = docs(
        (1, "x\nLicensed under the Apache License, Version 2.0.\ny"), (2, None), (3, ""),
        (4, "This work is licensed under the GNU General Public License, version 2."),
        (5, "this WORK is licenced under the GNU General Public License, version 3."),
        (6, "A new licence to walk about the town was given to the old man."), (None, "All rights reserved."),
        (1, "x\nLicensed under the Apache License, Version 2.0.\ny"),
    )
    got = [(r.doc_id, r.line_no, r.license, r.exact, r.missing) for r in licenses.scan_licenses(rows).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 1, "Apache-2.0", True, []), (1, 1, "Apache-2.0", True, []), (4, 0, "GPL-2.0", True, []),
        (5, 0, "GPL-3.0", False, ["licensed"]), (None, 0, "proprietary", True, []),
    ], key=repr)
    assert licenses.scan_licenses(docs()).count() == 0


def test_licenses_wherever_lines_end(docs, prose):
    mit = licenses.TEMPLATES["MIT (notice)"].split()
    wrapped = "x\n" + "\n".join(" * " + " ".join(mit[i : i + 6]) for i in range(0, len(mit), 6)) + "\ny"
    words = prose(3000, 3)
    for name, text in licenses.TEMPLATES.items():
        assert [n[2] for n in licenses.Scanner({name: text}, 0.2).notices(text, 0.1)] == [name]
    long = [*words[:1500], "Released under the MIT License.", *words[1500:], "all rights RESERVED,", "w"]
    bsd = licenses.TEMPLATES["BSD"].replace(" forms,", "\nshapes,").replace("source and", "source\n# and")
    rows = docs((1, wrapped), (2, " ".join(long)), (3, bsd), (4, licenses.TEMPLATES["MIT (notice)"]))
    got = [(r.doc_id, r.line_no, r.license, r.missing, r.inside, r.line) for r in licenses.scan_licenses(rows).collect()]
    assert sorted(got) == [
        (1, 1, "MIT (notice)", [], [], wrapped[2:-2]), (2, 0, "MIT", [], [], " ".join(long)),
        (2, 0, "proprietary", [], [], " ".join(long)), (3, 0, "BSD", ["forms"], ["shapes"], bsd),
        (4, 0, "MIT (notice)", [], [], licenses.TEMPLATES["MIT (notice)"]),
    ]


def test_licenses_by_brute_force():
    import itertools
    import random

    def differences(stretch, template):
        best = len(template)
        for n in range(1, len(template) + 1):
            for places in itertools.combinations(range(len(template)), n):
                for at in itertools.combinations(range(len(stretch)), n):
                    if all(template[p] == stretch[a] for p, a in zip(places, at)):
                        best = min(best, len(template) - n + at[-1] - at[0] + 1 - n)
        return best

    for seed in range(150):
        pick = random.Random(seed)
        template = "a b c d e".split() if seed % 2 else "a b a c d".split()
        line = [pick.choice("abcdexyz") for _ in range(3)]
        line += [w for w in template if pick.random() < 0.9 for w in [w, *"q" * (pick.random() < 0.15)]]
        least = differences(line, template)
        found = licenses.Scanner({"t": " ".join(template)}, 0.4).notices(" ".join(line), -9.0)
        assert bool(found) == (least <= 2), (line, template)
        if found:
            assert min(len(m) + len(i) for *_, m, i in found) == least


def test_urls(spark):
    urls = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/casino": ("", "", None, "allow"),
        "http://A.Example.ORG/es/1?x=/": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12#a": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org": ("example.org", "", None, "allow"), "x://notorg/fr/": ("notorg", "/fr/", None, "allow"),
        "http://my-casino.net/": ("my-casino.net", "/", None, "block"),
        "http://casinos.net/essex": ("casinos.net", "/essex", None, "allow"),
        "http://free.net/free": ("free.net", "/free", None, "allow"),
        "http://free.net/Bets?porn": ("free.net", "/Bets", None, "block"),
        "http://casino.com/fr/x": ("casino.com", "/fr/x", "com/fr/", "allow"),
    }
    rows = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = [tuple(r)[1:5] for r in url_filter.judge_urls(rows).orderBy("page_id").collect()]
    assert got == list(urls.values())
    assert url_filter.judge_urls(rows.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><h2>The Site</h2><a href="/">Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site to give you a better experience of it, accept them.</p></div>
<main><article><h1>Title&nbsp;here</h1><p>First &lt;long&gt; paragraph of the article,
 which <b>says</b> a few things &amp so on.<br>Second line.<p>Short.</p><script>var t="</p>";</script>
<div class="ad">Buy this now. It is the best thing that money can buy, truly.</div>
<p>Last paragraph of the article that also has some <a href="x">linked words</a> in it.</article></main>
<aside><p>Other stories that you may like to read today, and there are many.</p></aside>
<section id="comments"><p>I think that this is a very good article indeed, thank you for it.</p></section>
<form><p>Subscribe to our letter and get all the news by mail every day.</p></form><footer>&copy; me</footer>"""


def test_page():
    assert html_extract.main_text(PAGE).split("\n\n") == [
        "Title here", "First <long> paragraph of the article, which says a few things & so on. Second line.",
        "Short.", "Last paragraph of the article that also has some linked words in it.",
    ]


@pytest.mark.parametrize("page", [None, "", "<", "<!-- x", "<p", "<script>x", "</p></p>", "<nav><a>x</a></nav>"])
def test_pages_without_text(page):
    assert html_extract.main_text(page) == ""


STORY = "<p>" + "A sentence of the story that is told here. " * 40 + "</p>"


@pytest.mark.parametrize("opening", [
    '<body class="single-post right-sidebar">', '<html class="has-header"><body id="search-results">',
    '<body class="hidden">', '<body><div class="has-sidebar search">', '<head><title>T</title><meta charset="x">',
    '<head><title>a <b> title</title><script>"<p>"</script>',
])
@pytest.mark.parametrize("story", [STORY, f"<article>{STORY}</article>"])
def test_names_of_the_page_and_open_heads(opening, story):
    assert html_extract.main_text(opening + story) == html_extract.main_text(STORY) != ""


def test_heads_and_comments_stay_out():
    assert html_extract.main_text("<head><title>T</title>" + STORY[3:-4]) == html_extract.main_text(STORY)
    assert html_extract.main_text("<head><title>T<meta></head><body>" + STORY) == html_extract.main_text(STORY)
    comments = f'<div id="comments">{STORY * 9}</div>'
    page = f"<body><article><h1>One</h1>{STORY}</article>{comments}"
    assert html_extract.main_text(page).count("story") == 40
    assert html_extract.main_text(f'<div style="display:none">{STORY}</div>') == ""


def test_long_page_is_whole():
    page = "<article>" + "".join(f"<p>Paragraph number {i} of many in this page.</p>" for i in range(3000)) + "</article>"
    assert html_extract.main_text(page).count("\n\n") == 2999


def test_cut_by_brute_force():
    import itertools
    import random

    for seed in range(60):
        pick = random.Random(seed)
        n = pick.randrange(1, 8)
        scores = [pick.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, pick.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if pick.random() < 0.5]

        def cost(side):
            own = sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, side))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(map(cost, itertools.product([True, False], repeat=n)))
        assert cost(html_extract.source_side(scores, edges)) == pytest.approx(best)


def test_extract(spark):
    rows = spark.createDataFrame(
        [(1, "u", PAGE, "c"), (1, None, None, "c"), (None, "u", "", "c")], "page_id bigint, url string, html string, text string"
    )
    got = [(r.page_id, r.url, r.n_chars, len(r.text)) for r in html_extract.extract_text(rows).collect()]
    assert got[0][2] == got[0][3] > 100 and got[1:] == [(1, None, 0, 0), (None, "u", 0, 0)]
    assert html_extract.extract_text(rows.limit(0)).count() == 0


def test_the_saving_ranks_templates():
    """Two templates both within the wording limit where they share a cue: the larger saving is confirmed first."""
    templates = {
        "a red": "the owner of these words lets anyone print them in red ink only",
        "b blue": "the owner of these words lets anyone print them in blue ink only",
    }
    scanner = licenses.Scanner(templates, 0.2)
    for name, text in templates.items():
        words = licenses.wording(f"so it says {text} and no more")
        both = [i for i, w in enumerate(words) if len(scanner.cues.get(w, ())) == 2]
        for i in both:
            fits = [
                scanner.aligned(n, p, *scanner.around(words, i, n, p)) for n, places in scanner.cues[words[i]].items() for p in places
            ]
            assert all(f and f[0] <= 2 for f in fits)
            ranked = scanner.ranked(words, i, 0.1)
            assert [n for _, n in ranked] == sorted(templates, key=lambda n: n != name) and ranked[0][0] > ranked[1][0]
        assert both and [n[2] for n in scanner.notices(" ".join(words), 0.1)] == [name]
    # Without what is saved, the first by name would have been taken where only the shared cue is left.
    scanner.cues = {w: names for w, names in scanner.cues.items() if len(names) == 2}
    text = templates["b blue"]
    assert [n[2] for n in scanner.notices(text, 0.1)] == ["b blue"]
    scanner.saved = lambda name, block: 1.0
    assert [n[2] for n in scanner.notices(text, 0.1)] == ["a red"]
    scanner.saved = lambda name, block: 0.05
    assert scanner.notices(text, 0.1) == []


def test_whole_notices(docs, prose):
    for name, text in licenses.TEMPLATES.items():
        words = f"{' '.join(prose(40, 1))}\n{text}\n{' '.join(prose(40, 2))}"
        assert [(n[2], n[4], n[5]) for n in licenses.Scanner(licenses.TEMPLATES, 0.2).notices(words, 0.1)] == [(name, [], [])]
    changed = licenses.TEMPLATES["MIT (text)"].replace("sublicense,", "").replace("Software", "Work", 3)
    found = licenses.Scanner({"MIT (text)": licenses.TEMPLATES["MIT (text)"]}, 0.2).notices(changed, 0.1)
    assert [(n[2], sorted(n[4]), n[5]) for n in found] == [("MIT (text)", ["software"] * 3 + ["sublicense"], ["work"] * 3)]
    # The opening sentence as it is differs less.
    assert licenses.Scanner(licenses.TEMPLATES, 0.2).notices(changed, 0.1)[0][2] == "MIT (notice)"
