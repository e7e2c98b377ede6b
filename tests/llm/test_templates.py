"""The template decides: hosts without articles, repeated lines, copies, and classes by brute force."""

import random
from collections import defaultdict

import pytest

from coppice.llm import templates
from coppice.llm.html_tokens import tokens
from coppice.llm.templates import TemplateSettings

SCHEMA = "page_id long, url string, html string, host string, large string, text int"


def extract(spark, htmls, host="h.example"):
    rows = [(i, f"https://{host}/{i}", html, "mine", "mine", 1) for i, html in enumerate(htmls)]
    got = templates.extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def words(n, seed):
    rng = random.Random(str(seed))
    return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))


def test_a_long_repeated_block_is_no_article(spark):
    block = words(400, "block")
    pages = [f"<body><div class=pitch>{block}</div><div class=text>{words(20, i)}</div></body>" for i in range(10)]
    assert extract(spark, pages) == {i: words(20, i) for i in range(10)}


def test_a_title_beside_the_story_stays(spark):
    inner = "<div id=content><h1>Title {0}</h1><div class=story><p>{1}</p><p>{2}</p></div></div><div class=foot>All rights</div>"
    outer = "<h1>Title {0}</h1><div class=story><p>{1}</p><p>{2}</p></div><div class=foot>All rights</div>"
    for shape in (inner, outer):
        pages = [f"<body>{shape.format(i, words(60, i), words(50, -i))}</body>" for i in range(9)]
        expected = {i: f"Title {i}\n{words(60, i)}\n{words(50, -i)}" for i in range(9)}
        assert extract(spark, pages) == expected


def test_a_line_repeated_in_every_article_goes(spark):
    page = "<body><article><h1>T{0}</h1><p>{1}</p><div class=x>Our partner offers more</div><p>{2}</p></article></body>"
    pages = [page.format(i, words(30, i), words(30, -1 - i)) for i in range(8)]
    got = extract(spark, pages)
    assert got == {i: f"T{i}\n{words(30, i)}\n{words(30, -1 - i)}" for i in range(8)}
    alone = extract(spark, pages[:3], "few.example")
    assert all("Our partner offers more" in text for text in alone.values())


def test_the_template_changes_the_result(spark):
    page = "<body><div class=x>Same on all</div><div class=c><p>{0}</p></div></body>"
    rows = [(i, "https://h.example/", page.format(words(40, i))) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = templates.host_templates(templates.with_host(df), TemplateSettings()).first()
    main, texts = templates.main_slot(found["large"]), set(found["template_texts"])
    assert main == "/body/div.c" and len(texts) == 1
    assert templates.main_text(rows[3][2], main, texts, 0.8) == words(40, 3)
    pitch = rows[3][2].replace("Same on all", words(400, "pitch"))
    assert words(40, 3) not in templates.main_text(pitch, "", set(), 0.8)
    known = {templates._key("text", "/body/div.x", words(400, "pitch"))}
    assert templates.main_text(pitch, main, known, 0.8) == words(40, 3)


def test_copies_of_a_page_are_judged_once(spark):
    article = f"<body><div class=c><h1>One</h1><p>{words(40, 'copy')}</p></div><div class=x>Same on all</div></body>"
    others = [f"<body><div class=c><h1>N{i}</h1><p>{words(40, i)}</p></div><div class=x>Same on all</div></body>" for i in range(6)]
    got = extract(spark, [article] * 90 + others)
    assert all(got[i] == f"One\n{words(40, 'copy')}" for i in range(90))
    assert all(got[90 + i] == f"N{i}\n{words(40, i)}" for i in range(6))
    only = extract(spark, [article] * 12, "copies.example")
    assert all(text.startswith("One\n") and words(40, "copy") in text for text in only.values())


def test_ids_that_count_pages_and_menus_of_links(spark):
    page = (
        "<body><div class=wrap><div id=post-{0}><p id=p{0}>{1}</p><p>{2}</p></div>"
        "<div class=rail><a href='/'>Read {0} next</a></div></div></body>"
    )
    pages = [page.format(i * 37, words(40, i), words(40, -1 - i)) for i in range(8)]
    assert extract(spark, pages) == {i: f"{words(40, i)}\n{words(40, -1 - i)}" for i in range(8)}


def test_very_long_and_empty_pages(spark):
    long = f"<body><div class=c><p>{words(60_000, 'long')}</p></div><div class=x>Same on all</div></body>"
    pages = [long, "", "<body></body>", "<p>" * 5000 + "deep"]
    pages += [f"<body><div class=c><p>{words(30, i)}</p></div><div class=x>Same on all</div></body>" for i in range(60)]
    got = extract(spark, pages)
    assert got[0] == words(60_000, "long") and got[1] == got[2] == "" and got[3] == "deep"
    assert all(got[4 + i] == words(30, i) for i in range(60))


def slow_templates(pages, settings):
    """Template texts and slot characters by path of one host, page by page."""
    pages = list(dict.fromkeys(pages))
    counts, first, chars = defaultdict(dict), defaultdict(list), defaultdict(int)
    for i, html in enumerate(pages):
        at, seen = 0, set()
        for t in tokens(html):
            text = templates.squeezed(t.text)
            if t.kind == "text" and not text:
                continue
            token = (t.kind, t.path, text)
            counts[token][i] = counts[token].get(i, 0) + 1
            if token not in seen:
                seen.add(token)
                first[token].append(at)
            if t.kind == "text" and not t.boilerplate and not t.linked:
                chars[token] += len(text)
            at += 1
    usual = [t for t, c in counts.items() if len(c) >= settings.min_share * len(pages)]
    classes = defaultdict(list)
    for token in usual if len(pages) >= settings.min_pages else []:
        classes[frozenset(counts[token].items())].append(token)
    kept = templates._nested(
        [(len(v), [(sum(first[t]) / len(first[t]), t) for t in ts]) for v, ts in classes.items()]
    )
    texts = {templates._key(*t) for t in kept if t[0] == "text"}
    inside, total = defaultdict(int), 0
    for token, n in chars.items():
        if token not in kept:
            total += n
            parts = token[1].split("/")
            for depth in range(2, len(parts) + 1):
                inside["/".join(parts[:depth])] += n
    return texts, {p for p, n in inside.items() if n and n >= settings.main_share * total}


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_and_slots_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts = {}
    for h in range(4):
        pages = []
        for i in range(rng.choice([3, 7, 20])):
            note = "<div class=n>Now and then</div>" if rng.random() < 0.93 else ""
            body = "".join(f"<p>{words(rng.randrange(3, 30), (h, i, k))}</p>" for k in range(rng.randrange(1, 5)))
            pages.append(f"<body><nav>Menu</nav>{note}<div class=c{h}><h2>Sub</h2>{body}</div><p>End of page</p></body>")
            if rng.random() < 0.2:
                pages.append(pages[-1])
        hosts[f"h{h}.example"] = pages
    rows = [(i, f"https://{h}/{i}", p) for h, ps in hosts.items() for i, p in enumerate(ps)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    settings = TemplateSettings()
    found = templates.host_templates(templates.with_host(df), settings).collect()
    got = {r["host"]: (set(r["template_texts"] or []), set(r["large"] or [])) for r in found}
    assert got == {h: slow_templates(ps, settings) for h, ps in hosts.items()}
