"""Pages whose article a listed name, a form or an empty region might hide."""

import pytest

from fareflow.llm.html_text import main_text, report

ARTICLE = ("The valley is where the people of the town go for a walk in the summer, and it is said that the river was once as wide as the sea. " * 4).strip()
MENU = '<nav><a href="/">Home</a></nav><footer>© 2024 Site</footer>'

KEPT = {
    "form around the page": f'{MENU}<form id="f"><div>{ARTICLE}</div><label>Name</label><input><button>Go</button></form>',
    "form around an article": f"<form><article><p>{ARTICLE}</p></article></form>{MENU}",
    "hidden in a title": f'<article data-title="The hidden valley"><p title="see hidden things">{ARTICLE}</p></article>',
    "hidden in a class": f'<div class="flex hidden md:block"><p>{ARTICLE}</p></div>',
    "teaser article": f'<div id="content"><p>{ARTICLE}</p></div><div><article class="card">Other story of the day and more</article></div>',
    "main with a menu": f"<main><p>Menu</p></main><div><p>{ARTICLE}</p></div>",
    "widget": f'{MENU}<div class="widget elementor-widget"><p>{ARTICLE}</p></div>',
    "notice": f'<div class="notice"><p>{ARTICLE}</p></div>',
    "alert": f'<section class="alert alert-story"><p>{ARTICLE}</p></section>',
    "search form beside it": f"<article><p>{ARTICLE}</p></article><form><p>Search the site for all of the things that you want to find in it, and more</p></form>",
    "notice beside it": f'<div><p>{ARTICLE}</p></div><div class="notice"><p>{"It is the law that we ask you for this and that on the site. " * 5}</p></div>',
}
LOST = {
    "hidden": f"<div hidden><p>{ARTICLE}</p></div>",
    "aria": f"<div aria-hidden='true'><p>{ARTICLE}</p></div>",
    "style": f'<div style="color: red; Display : none"><p>{ARTICLE}</p></div>',
    "cookies only": f'<div class="cookie-consent"><p>{ARTICLE}</p></div>',
    "footer only": f"<footer><p>{ARTICLE}</p></footer>",
    "hidden notice": f'<div class="notice" hidden><p>{ARTICLE}</p></div>',
}


@pytest.mark.parametrize("name", KEPT)
def test_article_is_kept(name):
    assert main_text(f"<html lang=en><body>{KEPT[name]}</body></html>") == ARTICLE


@pytest.mark.parametrize("name", LOST)
def test_what_is_no_article(name):
    assert main_text(f"<html lang=en><body>{LOST[name]}</body></html>") == ""


def test_empty_table_repeated_rows_and_other_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", f"<p>{ARTICLE}</p>", "x", "y")] * 2 + [(None, None, None, None, None), (2, "v", "", "t", "")]
    assert report(spark.createDataFrame([], schema)).collect() == []
    out = report(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "u", ARTICLE, len(ARTICLE))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
