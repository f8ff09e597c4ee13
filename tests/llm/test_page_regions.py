"""Page regions: text beside the main container, quotations, depth, class words."""

import pytest

from cartwheel.llm.html_extract import main_text

MANY = "<p>" + "some real words of the article text go here and on. " * 6 + "</p>"
FEW = "<p>" + "another long paragraph with real content in it too. " * 4 + "</p>"


def found(page):
    text = main_text(page)
    return text.count("some real words") // 6, text.count("another long") // 4


@pytest.mark.parametrize("page", [
    f"<body><div>{MANY * 3}</div><div>{FEW}</div></body>",
    f"<body><section>{MANY * 3}</section><section>{FEW}</section></body>",
    f"<body><article>{MANY * 3}</article><article>{FEW}</article></body>",
    f"<body><main><article>{MANY * 3}</article></main><div>{FEW}</div></body>",
    f"<body><table><tr><td>{MANY * 3}</td><td>{FEW}</td></tr></table></body>",
    f"<body><article>{MANY}<section class='social-history'>{FEW}</section>{MANY * 2}</article></body>"])
def test_no_container_hides_another(page):
    assert found(page) == (3, 1)


def test_paragraphs_around_a_long_quotation():
    text = main_text(f"<body><p>Lead paragraph with enough words to count.</p><blockquote>{MANY * 6}</blockquote><p>Short end.</p></body>")
    assert text.startswith("Lead paragraph") and text.endswith("Short end.")


def test_boilerplate_below_any_depth():
    inner = f"<script>var x = 1;</script><style>p {{}}</style><nav>menu items</nav>{MANY}"
    text = main_text("<body>" + "<div>" * 1000 + inner + "</div>" * 1000 + "</body>")
    assert found("<body>" + "<div>" * 1000 + inner + "</div>" * 1000 + "</body>") == (1, 0)
    assert "var x" not in text and "menu" not in text


def test_boilerplate_inside_an_article_still_goes():
    page = f"<body><article>{MANY}<section class='comments-area'>{FEW}</section><div id='relatedPosts'>{FEW}</div></article></body>"
    assert found(page) == (1, 0)
    assert main_text(f"<body><article><header><h1>Title</h1></header>{MANY}</article><div class='cookie-wall'>{FEW}</div></body>") \
        .startswith("Title\nsome real words") and found(f"<body>{MANY}<div class='cookie-wall'>{FEW}</div></body>") == (1, 0)
