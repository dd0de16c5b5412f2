"""op3: spelled-out addresses open a region by themselves."""

from __future__ import annotations

import pytest

from stratalake.llm import semicrf


@pytest.mark.parametrize(
    "address",
    [
        "anna at example dot com",
        "anna AT example DOT com",
        "anna ( at ) example dot com",
        "anna (At) example.org",
        "anna [ AT ] example dot net",
        "anna {at} example.org",
    ],
)
def test_spelled_addresses_are_found_without_digits_nearby(address):
    finder = semicrf.Finder(semicrf.trained())
    text = f"please reach {address} today"
    found = finder.added(text, [])
    assert [(text[a:b], k) for a, b, k in found] == [(address, "email")]


def test_at_without_an_address_stays_out():
    finder = semicrf.Finder(semicrf.trained())
    assert semicrf.open_regions("we met at noon and looked at the sea", []) == []
    assert finder.added("we met at noon. then we left (at last) for home", []) == []
