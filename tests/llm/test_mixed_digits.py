"""Identifiers of digits and single spelled digits."""

import pytest

from daybook.llm import pii


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("call +1 555 five 12 three 4567 now", "phone", "+1 555 5 12 3 4567"),
        ("4111 1111 1111 one111", "card", "4111 1111 1111 1111"),
        ("ip 10.two.3.4", "ip", "10.2.3.4"),
    ],
)
def test_single_digit_words_between_digits(text, kind, value):
    assert [(s[0], s[4]) for s in pii.find_spans(text) if not s[3]] == [(kind, value)]


@pytest.mark.parametrize("text", ["1 one", "in 2024 one of 3 won", "4111 1111 1111 one112", "12 tone 5"])
def test_digit_words_alone_identify_nothing(text):
    assert pii.find_spans(text) == []
