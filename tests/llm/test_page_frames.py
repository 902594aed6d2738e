"""Pages inside forms and named frames, heads without an end, unclosed tags in number."""

import time

import pytest

from loadtide.llm.html_main import main_text

PARTS = [f"Paragraph number {i} tells a long and quiet story about the sea, the wind and the people that live by both of them." for i in range(6)]
BODY = "<h1>A title of the page</h1>" + "".join(f"<p>{p}</p>" for p in PARTS)
MENU = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(9)) + "</ul></nav>"
COMMENTS = "<div class='comments'>" + "".join(f"<div class='comment'><p>I, reader {i}, have something rather long to say about what was written above here.</p></div>" for i in range(4)) + "</div>"
FOOT = "<footer><p>All rights reserved by the publisher of this page, now and in all years that follow.</p></footer>"
TEXT = "\n".join(["A title of the page", *PARTS])


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("around", [
    "<body><form id='aspnetForm' method='post'>{}</form></body>", "<body><div class='page comments-open'>{}</div></body>", "<body><div id='x' class='comments-closed'>{}</div></body>",
    "<body><div role='form'>{}</div></body>", "<head><title>t</title><meta charset=utf-8><body>{}</body>", "<head><title>t</title><div>{}</div>", "<body>{}</body>"])
def test_frames_are_no_asides(around, marked):
    inner = MENU + (f"<article>{BODY}</article>" if marked else f"<div>{BODY}</div>") + COMMENTS + FOOT
    got = main_text("<html>" + around.format(inner) + "</html>")
    assert got == TEXT if marked else set(got.split("\n")) >= set(PARTS) and "reader" not in got and "Menu" not in got and "rights" not in got


def test_asides_stay_asides():
    short = "<article><h1>Title</h1><p>" + PARTS[0] + "</p></article>"
    assert main_text(f"<body>{short}{COMMENTS}</body>") == "Title\n" + PARTS[0]
    form = "<form><p>" + " ".join(PARTS) + "</p><p>" + " ".join(PARTS) + "</p></form>"
    assert main_text(f"<body><article>{BODY}</article>{form}</body>") == TEXT
    assert main_text(f"<body>{COMMENTS}</body>") == ""


@pytest.mark.parametrize("page", ["<b>x</i>" * 100_000, "<b>" * 50_000 + "<p>y</p>" * 50_000, "<p>" * 100_000, "<li><b>z" * 50_000, "</div>" * 100_000 + "<span>" * 50_000 + "</u>" * 50_000])
def test_unclosed_tags_cost_their_number(page):
    started = time.time()
    main_text(page)
    assert time.time() - started < 20
