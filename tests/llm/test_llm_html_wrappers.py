import pytest

from leaguelake.llm import html_density as h

ARTICLE = "<h1>Head line</h1><p>A first paragraph that is long enough to count as text.</p><p>A second one, also long enough.</p>"
TEXT = "Head line\nA first paragraph that is long enough to count as text.\nA second one, also long enough."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "menu-open", "with-banner", "ad-free", "no-comments"])
def test_wrappers_named_after_what_lies_beside_keep_the_article(name):
    page = f'<body><div class="{name}"><div>{ARTICLE}</div><div class="sidebar"><p>Side text</p></div></div><footer>end</footer></body>'
    assert h.main_text(page) == TEXT


def test_long_comments_under_a_short_article_still_go():
    page = f'<body><div class="post">{ARTICLE}</div><div id="comments">{"<p>Somebody says something rather long here.</p>" * 30}</div></body>'
    assert h.main_text(page) == TEXT
