"""Valid values next to or inside of what a check refuses."""

import pytest

from linewarden.llm import pseudonym

CASES = [
    ("4111 1111 1111 1111 123", "card", "4111 1111 1111 1111"),
    ("4111111111111111 12", "card", "4111111111111111"),
    ("5 4111111111111111", "card", "4111111111111111"),
    ("1234 4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
    ("AB12CD34EF56AB12CD34EF56AB12CD34", "secret", "AB12CD34EF56AB12CD34EF56AB12CD34"),
    ("25/12/1999", "date", "25/12/1999"),
    ("12/31/1999", "date", "12/31/1999"),
]


@pytest.mark.parametrize("text, kind, value", CASES)
def test_values_behind_refusals(text, kind, value):
    for n in range(40):
        there, back = (pseudonym.Permutation(b"key%d" % n, undo) for undo in (False, True))
        for whole in (text, f"before {text}, after"):
            fresh, spans = pseudonym.replaced(whole, there)
            assert [(s["kind"], s["length"]) for s in spans] == [(kind, len(value))]
            assert spans[0]["start"] == whole.index(value) and value not in fresh
            assert pseudonym.replaced(fresh, back)[0] == whole
