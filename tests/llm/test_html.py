import random

import pytest

from chartmill.llm import html

LONG = "The committee met on a rainy morning and spoke for hours about the new bridge, its cost and its use to the town. " * 3
PIECES = [
    "<![", "<![CDATA[x]]>", "<![foo]>", "<![%x[b", "<!", "<!-", "<!--", "-->", "<!doctype", "<!x>", "<?", "?>", "</", "<", ">", "&", "&#", "&#x", "&amp", ";", "]]>",
    "<p", "<p>", "</p>", "<div class='ad", "<article>", "</article>", "<script>", "</script", "<style>", "<textarea>", "<title>", "<a href=", "'", '"', "=", "\x00", "é", " text ", "\n",
    "<svg>", "<plaintext>", "<li>", "</ul>", "<td>", "<br/>", "<p/>",
]


def test_broken_markup_never_fails():
    rnd = random.Random(11)
    for _ in range(4000):
        html.main_text("".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 25))))


@pytest.mark.parametrize("fault", ["<![ >", "<![foo]>", "<![if !IE]>", "<![%x[b>", "<![endif]-->", "<!oops>"])
def test_text_after_a_strange_declaration_stays(fault):
    assert html.main_text(f"<p>{LONG}{fault}</p><p>{LONG}after</p>") == f"{LONG.strip()}\n{LONG}after"


PAGES = {
    "no article": f"<body><div><a href=a>One</a><a href=b>Two</a></div><div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><p>Tiny</p><p><a>x</a></p></div></body>",
    "links in the article": f"<article><h1>Title</h1><p>{LONG}</p><ul><li><a href=a>First story</a></li><li><a href=b>Second</a></li><li><a href=c>Third</a></li></ul><p>{LONG}</p></article>",
    "unnamed box": f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><div><span>Buy</span> <b>now</b> <i>at</i> <u>our</u> <a>shop</a> <b>!</b></div></article>",
}
EXPECTED = {
    "no article": ["Title", LONG, "Short.", LONG],
    "links in the article": ["Title", LONG, LONG],
    "unnamed box": ["Title", LONG, LONG, LONG],
}


@pytest.mark.parametrize("name", PAGES)
def test_clusters_decide(name, monkeypatch):
    wanted = "\n".join(x.strip() for x in EXPECTED[name])
    assert html.main_text(PAGES[name]) == wanted
    monkeypatch.setattr(html, "threshold", lambda values: 0.0)  # everything is one cluster
    assert html.main_text(PAGES[name]) != wanted


def test_smoothing_decides(monkeypatch):
    """A short heading between long paragraphs is content; the same words between links are not."""
    page = PAGES["no article"]
    scores = []
    monkeypatch.setattr(html, "smoothed", lambda ratios: scores.append(ratios) or html_smoothed(ratios))
    html.main_text(page)
    (ratios,) = scores
    assert html_smoothed(ratios) == pytest.approx([
        sum(r * html.KERNEL[j - i + html.RADIUS] for j, r in enumerate(ratios) if abs(j - i) <= html.RADIUS)
        / sum(html.KERNEL[j - i + html.RADIUS] for j in range(len(ratios)) if abs(j - i) <= html.RADIUS) for i in range(len(ratios))
    ])


html_smoothed = html.smoothed


@pytest.mark.parametrize("alone, lists", [([1, 1, 1, 0, 1], [1, 1, 1, 0, 0]), ([], []), ([1, 1], [0, 0]), ([0, 1, 1, 1, 1], [0, 1, 1, 1, 1])])
def test_link_lists(alone, lists):
    assert html.link_lists([bool(x) for x in alone]) == [bool(x) for x in lists]
