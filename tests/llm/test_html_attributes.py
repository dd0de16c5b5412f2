"""op1: attribute values of any length, tags that are never closed."""

from __future__ import annotations

import subprocess
import sys

from stratalake.llm import html_extract


def texts(markup: str) -> str:
    return "".join(piece for _, _, piece, _ in html_extract.read(markup).pieces)


def test_long_values_stay_within_their_tag():
    for size in (3_000, 5_000, 300_000):
        for quote in ("'", '"'):
            value = "x" * size + " > b <i>c</i>"
            assert texts(f"<div class=a data-x={quote}{value}{quote} id={quote}q{quote}>text</div>") == "text"


def test_quotes_without_an_end():
    assert texts('<p title="open>text</p> more') == "text more"
    assert texts("<p title=it's>text</p> it's") == "text it's"
    assert texts('<p a="x" b="y>one</p> and "more') == 'one and "more'


def test_an_unclosed_tag_ends_soon():
    code = "from stratalake.llm import html_extract as h; h.read('<div ' + 'a=\"b\" ' * 5000); h.read('<div ' + 'a=\"b\" ' * 5000 + '<p>x')"
    subprocess.run([sys.executable, "-c", code], timeout=40, check=True)


def test_the_trainers_mark_means_nothing_on_other_pages():
    page = '<body><div class="article"><p{0}>' + "Some main text of the page, long enough. " * 9 + "</p></div><div class=footer>foot</div></body>"
    plain = html_extract.read(page.format(""))
    for mark in (' data-gold=""', " data-gold=x", ' data-gold="1"', ' data-gold="0"', " data-gold", " data-gold='-7.5'"):
        marked = html_extract.read(page.format(mark))
        assert (marked.pieces, marked.hints, marked.gold) == (plain.pieces, plain.hints, [-1] * len(plain.gold))
        inline = html_extract.read(f"<p>a <b{mark}>word</b> c</p>")
        assert [p[2] for p in inline.pieces] == ["a ", "word", " c"] and len(inline.parent) == 2


def test_reading_takes_time_in_proportion_to_the_page():
    """2 MB of what used to be read again and again: declarations without an end, end tags of
    elements that are not open, behind many open ones."""
    forms = [
        "'<!' * 1_000_000", "'<?x ' * 500_000", "'<div>' * 200_000 + '</p>' * 250_000",
        "'<span class=a>' * 80_000 + '</b>' * 250_000", "'<b id=x><div>' + '<i class=a>' * 90_000 + '</b>' * 250_000",
        "'<p>' * 300_000 + '<li>' * 250_000", "'<!--' * 500_000", "'<a b=\"' * 300_000", "'<!' * 900_000 + '>'",
    ]
    for form in forms:
        code = f"from stratalake.llm import html_extract as h; h.read({form})"
        subprocess.run([sys.executable, "-c", code], timeout=25, check=True)


def test_what_follows_the_last_tag():
    assert texts("<p>a</p>b <! c") == "ab <! c"
    assert texts("<p>a</p>b <!-- c") == "ab "
    assert texts("<p>a</p>b <!-- c > d") == "ab "
    assert texts("<p>a</p>b <!-- c > d --> e") == "ab  e"
    assert texts("<p>a <i class=x>b</p> c</i> d") == "a b c d"
    assert texts("no tags at all <!") == "no tags at all <!"
