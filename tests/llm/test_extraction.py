"""Main text of pages with known parts: what must stay, and what must go."""

import pytest

from gleanery.llm.extraction import extract

STORY = "Some words of a story, told at length and with commas, so that it counts as text number"
NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>Blog</a></li></ul></nav>"
LINKS = "<ul>" + "".join(f"<li><a href=/r{i}>Reference item {i}</a></li>" for i in range(6)) + "</ul>"
CLOSING = "closing words without any marks " * 7
LEAD = "A lead paragraph that says what this is all about. " * 3


def story(n, text=STORY):
    return "".join(f"<p>{text} {i}.</p>" for i in range(n))


def texts(n, text=STORY):
    return [f"{text} {i}." for i in range(n)]


WHOLE = ["<article class='legal'>|</article>", "<div class='legal-text'>|</div>", "<section class='search-guide'>|</section>", "<div class='responses'>|</div>", "<div>|</div>", "<main>|</main>"]

PAGES = {
    "long and short part": (f"{NAV}<article><h1>T</h1><div>{story(60)}</div><div><h2>Second</h2>{story(4, 'Other part')}</div></article><footer>foot</footer>", [*texts(60), "Second", *texts(4, "Other part")], ["Home", "foot"]),
    "many small sections": (f"<article>{''.join(f'<section><h2>S{i}</h2>{story(1, f'Part {i}')}</section>' for i in range(30))}</article>", [f"Part {i} 0." for i in range(30)], []),
    "closing div": (f"{NAV}<div class=x>{story(20)}</div><div><p>{CLOSING}</p></div>", [*texts(20), CLOSING.strip()], ["Home"]),
    "references": (f"<article><h1>T</h1>{story(8)}<h2>References</h2>{LINKS}</article>", [*texts(8), "Reference item 5"], []),
    "references without an article": (f"{NAV}<div id=c>{story(8)}<h2>References</h2>{LINKS}</div>", [*texts(8), "Reference item 5"], ["Home"]),
    "related work": (f"<article>{story(5)}<section id='related-work'><h2>Related work</h2>{story(3, 'We know of others who did something like it before, and say how')}</section></article>", [*texts(5), "before, and say how 2."], []),
    "related posts": (f"<article>{story(5)}<div class='related-posts'><h3>More</h3>{LINKS}</div></article>", texts(5), ["Reference item 1"]),
    "comments": (f"{NAV}<article>{story(3)}</article><div class='comments'>{story(20, 'I disagree')}</div>", texts(3), ["I disagree", "Home"]),
    "comments in the article": (f"<article>{story(3)}<section id=comments>{story(20, 'I disagree')}</section></article>", texts(3), ["I disagree"]),
    "a comment as an article": (f"<main><article>{story(4)}</article><article class='comment'><p>{'I think so too, really. ' * 8}</p></article></main>", texts(4), ["I think so"]),
    "reader responses": (f"<article>{story(6)}</article><div class='responses'>{story(3, 'Reader says')}</div>", texts(6), ["Reader says"]),
    "advert": (f"<article>{story(3)}<div class='ad'><p>Buy now and save a lot of money, today only.</p></div>{story(2, 'More')}</article>", [*texts(3), *texts(2, "More")], ["Buy now"]),
    "wrapper named after its sidebar": (f"<div class='content-sidebar-wrap'><main class='content'>{story(6)}</main><div class='sidebar'><p>Side text of some length</p></div></div>", texts(6), ["Side text"]),
    "a form round the page": (f"<form id=aspnetForm><div>{NAV}<div id=main>{story(6)}</div></div></form>", texts(6), ["Home"]),
    "a form in the article": (f"<article>{story(4)}<form><p>Sign up here for letters</p><input></form></article>", texts(4), ["Sign up"]),
    "tag list": (f"<article>{story(4)}<div class='tags'><a href=/t>one</a> <a href=/u>two</a></div></article>", texts(4), ["one\n", "two"]),
    "no article, all named": (f"<div id=header><p>Site name</p></div><div id=content>{story(6)}</div><div id=sidebar><p>About me and my life in the far north</p></div><div>&copy; 2020 All rights reserved</div>", texts(6), ["Site name", "About me", "2020"]),
    "article header": (f"<article><header><h1>Head</h1><p class=byline>By A</p><p>{LEAD}</p></header>{story(3)}</article>", ["Head", LEAD.strip(), *texts(3)], ["By A"]),
    "hidden": (f"<article>{story(3)}<p hidden>secret one</p><div style='display: none'>secret two</div></article>", texts(3), ["secret"]),
    **{w: (f"{NAV}{w.replace('|', story(8))}<footer>foot</footer>", texts(8), ["Home", "foot"]) for w in WHOLE},
}


@pytest.mark.parametrize("name", list(PAGES))
def test_keeps_the_article_and_nothing_else(name):
    page, stay, go = PAGES[name]
    found = extract(f"<html><head><title>x</title></head><body>{page}</body></html>")
    assert [t for t in stay if t not in found] == []
    assert [t for t in go if t in found] == []
    at = [found.index(t) for t in stay]
    assert at == sorted(at)


def test_pages_without_an_article():
    assert extract("") == "" and extract(NAV) == "" and extract("just text") == "just text"
    assert extract("<div class='ads'>only this</div>") == "only this"  # names alone never empty a page
    assert extract("<p>a &amp; b\n\t c</p><p></p><p> d</p>") == "a & b c\n\nd"


def test_very_long_and_very_deep_pages():
    page = f"<article>{'<div>' * 3000}{story(2000)}{'</div>' * 3000}</article>"
    assert extract(page).count("\n\n") == 1999
