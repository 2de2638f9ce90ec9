import itertools
import random
import time

from linemend.llm.html_text import best_run, extract, learn, main_text, tokenise

W = learn()
BODY = "<h1>A title here</h1><p>First part of it, with <b>some</b> <a href=x>link</a> text.</p><p>Second part &amp; more &lt;p&gt; of\n the   story.</p>"
TEXT = "A title here\nFirst part of it, with some link text.\nSecond part & more <p> of the story."


def page(body, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>Other title words</title><style>p{{}}</style></head><body>{before}{body}{after}</body></html>"


def test_boilerplate_goes():
    parts = [
        "<nav><ul><li><a href=1>Home of all things</a></li></ul></nav>", "<header><p>Site name and many words of it stand here</p></header>", "<div class='cookie-notice'><p>We use cookies to make all of this work for you</p></div>",
        "<aside><p>Read also this other long story about things</p></aside>", '<div class="ad">Buy this now and save a lot of money today</div>', "<form><label>Your mail address</label><input><button>Send</button></form>",
        "<script>var t = '</p>';</script>", "<section id=comments><article class=comment><p>I liked this story so very much indeed</p></article></section>", "<footer>&copy; all rights of this site</footer>", "<!-- a <p>hidden</p> note -->",
    ]
    for p in parts:
        for wrap in ("article", "main", "div"):
            whole = f"<{wrap}>{BODY}</{wrap}>"
            assert extract(page(whole, before=p), W) == TEXT, p
            assert extract(page(whole, after=p), W) == TEXT, p
        inside = f"<article>{BODY.replace('<p>Second', p + '<p>Second')}</article>"
        assert extract(page(inside), W) == TEXT, p


def test_malformed():
    assert extract("<article><h1>A b c</h1><p>One two three<br>four<p>Five six seven</article><footer>x", W) == "A b c\nOne two three four\nFive six seven"
    assert extract("<body><div class=ad>Unclosed advert words<article><p>Real words stand in here.</p></article>", W) == "Real words stand in here."
    assert extract("<article><p>Cut off &am", W) == "Cut off &am"
    assert extract("<article><p>Cut off <a hre", W) == "Cut off"
    assert extract("a < b and c > d, no tags here", W) == "a < b and c > d, no tags here"
    assert extract('<article><p title="a > b">Inner words</p></article>', W) == "Inner words"


def test_empty():
    for x in (None, "", "   ", "<p></p>", "<script>only</script>", "<!-- open"):
        assert extract(x, W) == ""


def test_long_parts_inside_do_not_cut():
    long = "<aside><p>" + "side words " * 400 + "</p></aside>"
    assert extract(page(f"<article>{BODY.replace('<p>Second', long + '<p>Second')}</article>"), W) == TEXT


def test_best_run_against_all_runs():
    for scores in itertools.product((-2.0, -0.5, 1.0), repeat=6):
        a, b = best_run(list(scores))
        best = max((sum(scores[i:j]) for i in range(6) for j in range(i + 1, 7)), default=0)
        assert (a, b) == (0, 0) if best <= 0 else abs(sum(scores[a:b]) - best) < 1e-9


def test_weights():
    assert W["w"] > 0 and all(v < 0 for k, v in W.items() if k != "w")


def test_operator(spark):
    rows = [(1, "u", page(f"<article>{BODY}</article>"), "t"), (2, None, None, "t"), (3, "u", "", "t"), (None, "u", "<p>words", "t"), (1, "u", page(f"<article>{BODY}</article>"), "t")]
    out = main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r.page_id, r.text, r.n_chars) for r in out), key=str) == sorted([(1, TEXT, len(TEXT))] * 2 + [(2, "", 0), (3, "", 0), (None, "words", 5)], key=str)
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_around_the_story_do_not_drop_it():
    for wrap in ("article class='post no-comments'", "article class='hentry has-sidebar'", "div class='content with-sidebar'", "article class='promo'", "div class='content sidebar'", "div id=modal", "section class='search content'"):
        whole = f"<{wrap}>{BODY}</{wrap.split()[0]}>"
        for other in ("", "<footer>&copy; all rights of this site</footer>", "<div class='site-footer'>Some few words</div>"):
            assert extract(page(whole, after=other), W) == TEXT, (wrap, other)
    assert extract(page(f"<article><div class='entry-header'>{BODY.replace('</h1>', '</h1></div>', 1)}</article>"), W) == TEXT


def test_compound_names_of_boilerplate_still_go():
    for name in ("site-header", "sidebar-left", "comment-list", "footer_widgets", "comments-area"):
        part = f"<div class='{name}'><p>Words that are no part of it</p></div>"
        for wrap in ("article", "main", "div"):
            assert extract(page(f"<{wrap}>{BODY}{part}</{wrap}>"), W) == TEXT, name
    thread = "<div id=comments>" + "<p>I liked this story so very much indeed and say so</p>" * 40 + "</div>"
    assert extract(page(f"<div>{BODY}</div>", after=thread), W) == TEXT


def test_names_around_the_story_do_not_empty_it():
    story = "".join(f"<p>This is sentence number {i} of the story, which goes on for quite a while longer.</p>" for i in range(10))
    want = extract(page(f"<article>{story}</article>"), W)
    assert want.count("\n") == 9
    for name in ("layout has-sidebar", "content no-sidebar", "story legal", "search-results", "main-banner", "widget", "content with-sidebar"):
        assert extract(page(f'<div class="{name}">{story}</div>', before="<nav><a href=1>Home page</a></nav>", after="<footer>All rights</footer>"), W) == want, name
    assert extract(page(f'<article class="post comments-open">{story}</article>'), W) == want


def test_region_against_all_runs():
    """On random pages, the words of the best of all contiguous runs are in the text, and
    whatever else is in it stands in the same element as they do."""
    rng, pieces = random.Random(11), ["<div>", "</div>", "<p>", "</p>", "<a href=x>", "</a>", "<b>", "</b>", "<nav>", "</nav>", "<br>"]
    for _ in range(150):
        parts = [rng.choice(pieces) if rng.random() < 0.5 else f" word{k} " for k in range(rng.randrange(4, 28))]
        source = "".join(parts)
        p = tokenise(source)
        scores = [W.get(k, -1.0) * n for k, n in zip(p.kind, p.size)]
        runs = [(sum(scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        best = max(runs, key=lambda r: r[0], default=(0, 0, 0))
        text = extract(source, W).split()
        if best[0] > 0:
            inside = [w for i in range(best[1], best[2]) if p.text[i] and not p.apart[i] for w in p.text[i].split()]
            assert set(inside) <= set(text), source
        assert set(text) <= {w for i, t in enumerate(p.text) if t and not p.apart[i] for w in t.split()}


def test_time_grows_with_the_page_only():
    """Unclosed and stray tags by the thousand, and a page of 5 MB."""
    n = 60_000
    bad = ["<p>x</p>" + "<b>" * n + "</i>" * n + "text", "<div class=ad>" * n + "word " * n, "<p><div>" + "<b>" * n + "<p></p>" * n + "text", "<h1>" * n + "<p>" * n, "<article><p>" + "many words " * 400_000]
    for source in bad:
        began = time.perf_counter()
        extract(source, W)
        assert time.perf_counter() - began < 20, source[:20]
    assert len(extract(bad[-1], W).split()) == 800_000
