"""Wrappers with classes of themes, forms around a page, and texts in several elements keep their text."""

import pytest

from shapekit.llm.html_extract import main_text

TEXT = [f"Paragraph number {k} of the text, long enough to be read, with commas." for k in range(6)]
P = "".join(f"<p>{t}</p>" for t in TEXT)
WANT = "\n".join(TEXT)

MARKED = [
    f"<html class='sidebar'><body class='post has-sidebar comments-open widget'><nav>x</nav><article>{P}</article><footer>f</footer></body></html>",
    f"<body><article class='post sponsored'>{P}</article></body>",
    f"<body><main id='comments' class='social'>{P}</main></body>",
    f"<body><div class='ad'>Buy!</div><div class='widget-content'>{P}</div></body>",
    f"<body><form action='x.aspx' id='form1'><div class='cookie'>We use cookies.</div><div>{P}</div><div class='sidebar'><p>Side, bar.</p></div></form></body>",
    f"<body><form><article>{P}</article><section id='comments'><p>Nice, really nice!</p></section></form></body>",
    f"<body><div class='hentry comments-closed'>{P}</div></body>",
    f"<article>{P}<article class='comment'><p>{'A long comment, really. ' * 40}</p></article></article>",
    f"<body><div>{P}</div><ol class='commentlist'>{'<li><p>Me too, and for long, as said above.</p>' * 40}</ol></body>",
]
SEVERAL = [
    ("<main><h1>Title</h1><p>A lead of a line or two, as usual, before.</p><article><p>{0}</p><p>{1}</p><p>{2}</p></article></main>",
     "Title\nA lead of a line or two, as usual, before.\n{0}\n{1}\n{2}"),
    ("<nav>n</nav><main><h1>Title</h1><article><p>{0}</p><p>{1}</p></article></main>", "Title\n{0}\n{1}"),
    ("<body><nav>n</nav><article><p>{0}</p><p>{1}</p><p>{2}</p></article><article><p>{3}</p><p>{4}</p></article><footer>f</footer></body>",
     "{0}\n{1}\n{2}\n{3}\n{4}"),
    ("<body><div><a href=x>Home</a></div><div><h1>Head</h1></div><div><p>{0}</p><p>{1}</p><p>{2}</p></div></body>", "Head\n{0}\n{1}\n{2}"),
    ("<body><article><h2>One</h2><p>{0}</p></article><h2>Between</h2><article><p>{1}</p></article></body>", "One\n{0}\nBetween\n{1}"),
]


@pytest.mark.parametrize("page", MARKED, ids=range(len(MARKED)))
def test_marked_wrappers(page):
    assert main_text(page) == WANT


@pytest.mark.parametrize("page,want", SEVERAL, ids=range(len(SEVERAL)))
def test_text_in_several_elements(page, want):
    assert main_text(page.format(*TEXT)) == want.format(*TEXT)
