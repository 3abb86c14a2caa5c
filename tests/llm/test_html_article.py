"""Parts of the article that look like something else stay, and pages of any depth are read in linear time."""

import random
import time

import pytest

from shapekit.llm.html_extract import main_text

TEXT = [f"Paragraph number {k} of the text, long enough to be read, with commas." for k in range(8)]
P = [f"<p>{t}</p>" for t in TEXT]

PROBES = [
    (f"<article><h1>T</h1>{P[0]}<h2 id='related-work'>Related work</h2>{P[1]}<h2 id='notification-api'>Notification API</h2>{P[2]}</article>",
     f"T\n{TEXT[0]}\nRelated work\n{TEXT[1]}\nNotification API\n{TEXT[2]}"),
    (f"<article>{P[0]}<section id='social-history'><h2>Social history</h2>{P[1]}</section><section class='legal'><h2>Law</h2>{P[2]}</section></article>",
     f"{TEXT[0]}\nSocial history\n{TEXT[1]}\nLaw\n{TEXT[2]}"),
    (f"<article>{P[0]}<p class='comment'>{TEXT[1]}</p>{P[2]}</article>", f"{TEXT[0]}\n{TEXT[1]}\n{TEXT[2]}"),
    ("<article><p>The formula is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> as stated, and so on.</p></article>", "The formula is x=2 as stated, and so on."),
    ("<article><p>See <object data=x>the plan, drawn</object> or <video>the film</video> or <canvas>the chart</canvas>, please.</p></article>",
     "See the plan, drawn or the film or the chart, please."),
    (f"<body><a name=top><nav>n</nav><div><h1>Head</h1>{''.join(P[:3])}</div><div><a href=x>one</a> <a href=y>two</a></div></body>",
     f"Head\n{TEXT[0]}\n{TEXT[1]}\n{TEXT[2]}"),
    ("<article><p>Less than is &<b>lt;</b> in pages, and &lt; is it.</p></article>", "Less than is &lt; in pages, and < is it."),
    (f"<article>{P[0]}<div class='social'><a href=f>Share</a> <a href=t>Tell</a></div><div class='ad'>Buy this, now.</div>{P[1]}</article>", f"{TEXT[0]}\n{TEXT[1]}"),
    (f"<article>{P[0]}{P[1]}<div class='related'><a href=1>Other text</a></div><div class='newsletter'><p>Sign up, please.</p></div></article>", f"{TEXT[0]}\n{TEXT[1]}"),
]


@pytest.mark.parametrize("html,want", PROBES, ids=range(len(PROBES)))
def test_article_is_kept(html, want):
    assert main_text(html) == want


SLUGS = ["related-work", "notification-api", "social-history", "legal-status", "comment-by-the-author", "login-flow", "banner-years", "share-prices", "ads"]
BOILER = ["<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>", "<header><a href=/>Site</a></header>",
          "<div class='cookie-notice'><p>We use cookies, as all do.</p></div>", "<div class='ad'>Buy now, and save!</div>",
          "<aside><h3>More</h3><p>Something else, aside.</p></aside>", "<div id='sidebar'><ul><li><a href=x>Old</a></ul></div>",
          "<form><input name=q><button>Go</button></form>", "<footer>All rights, reserved.</footer>", "<script>var x='<p>no</p>';</script>"]


def page(rnd):
    """A page of known article and boilerplate."""
    parts, want = [f"<h1 id='{rnd.choice(SLUGS)}'>Title</h1>"], ["Title"]
    for k in range(rnd.randrange(3, 9)):
        text = " ".join(rnd.choice(["and", "so", "it", "went,", "on,", "long", "after."]) for _ in range(rnd.randrange(12, 60))) + f" {k}."
        match rnd.randrange(5):
            case 0:
                parts.append(f"<h2 id='{rnd.choice(SLUGS)}'>Part {k}</h2><p>{text}</p>")
                want += [f"Part {k}", text]
            case 1:
                parts.append(f"<section id='{rnd.choice(SLUGS[:7])}'><p>{text}</p></section>")
                want.append(text)
            case 2:
                parts.append(f"<p>{text} <math><mi>y</mi></math> &amp; <a name=n>so")
                want.append(text + " y & so")
            case 3:
                parts.append(f"<p class='{rnd.choice(SLUGS)}'>{text}</p>")
                want.append(text)
            case _:
                parts.append(f"<p>{text}</p>")
                want.append(text)
    box = rnd.choice(["article", "main"])
    before, after = (rnd.sample(BOILER, 3) for _ in range(2))
    return f"<html><body>{''.join(before)}<{box}>{''.join(parts)}</{box}>{''.join(after)}</body></html>", "\n".join(want)


def test_known_articles():
    rnd = random.Random(11)
    for _ in range(150):
        html, want = page(rnd)
        assert main_text(html) == want, html


@pytest.mark.parametrize("html", ["<div>" * 10_000 + "text, here" + "<div>x" * 20_000, "<x-y>t " * 30_000, "<div class=ad>t " * 13_000, "<span>t " * 30_000,
                                  "<li>t" * 40_000, "</p>" * 50_000, "<a href=x>t" * 20_000])
def test_depth_costs_no_more(html):
    start = time.time()
    main_text(html)
    assert time.time() - start < 6  # 200 KB take well under a second on a free machine
