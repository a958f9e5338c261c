"""Words in a wrapper's class do not lose the article inside; what stands beside it is still left out."""

import pytest

from tidegrid.llm.main_text import main_text

LINE = "This is a long paragraph of the article, with commas, and words that go on and on. "
PROSE = f"<p>{LINE * 4}</p>" * 3
TEXT = "\n\n".join([(LINE * 4).strip()] * 3)
REMARKS = "<div class='comments'><p>Nice one, thanks a lot for this, dear author, I read it with joy.</p></div>"


@pytest.mark.parametrize(
    "body, title",
    [
        (f"<div class='site no-sidebar'><article><h1>T</h1>{PROSE}</article></div>", True),
        (f"<div class='wrap header-fixed'><h1>T</h1>{PROSE}</div>", True),
        (f"<div class='post has-comments'><h1>T</h1>{PROSE}{REMARKS}</div>", True),
        (f"<div class='post has-comments'>{PROSE}{REMARKS}</div>", False),
        (f"<form action=x><article><h1>T</h1>{PROSE}</article><input name=q><button>Go</button></form>", True),
        (f"<div class='search-open'><main>{PROSE}</main></div>", False),
    ],
)
def test_a_wrapper_is_no_boilerplate(body, title):
    page = f"<html><body><nav><a href=x>Home</a></nav>{body}<div class='sidebar'><p>{LINE}</p></div><footer>c</footer></body></html>"
    assert main_text(page) == ("T\n\n" if title else "") + TEXT


def test_what_is_beside_the_article_stays_out():
    remarks = f"<div class='post-comments'>{f'<article><p>{LINE * 3}</p></article>' * 9}</div>"
    assert main_text(f"<body><div class='post'><p>{LINE * 2}</p></div>{remarks}</body>") == (LINE * 2).strip()
    assert main_text(f"<body><div class='comments'><p>{LINE * 9}</p></div></body>") == ""
    assert main_text(f"<body><p>{LINE * 2}</p><form><p>{LINE}</p></form><div hidden>{PROSE}</div></body>") == (LINE * 2).strip()
    assert main_text("<body><div class='banner'>") == "" and main_text(None) == ""
