"""The gate before the wide e-mail pattern lets every text through that the pattern matches."""

import itertools

from strata.llm import pii


def test_plain_at_is_a_candidate():
    for t in ("write to name at example.com please", "name AT example dot org", "name at  mail . example.com", "name at mail(dot)example.com"):
        assert any(c.kind == 0 for c in pii.candidates(t, [])), t


def test_gate_is_necessary():
    signs = ["@", " @ ", " at ", " AT ", "  at ", " at  ", "(at)", " [ at ] ", "{@}", "\tat\n", "at", " "]
    dots = [".", " . ", " dot ", " DOT ", "[dot]", "( . )", "  dot ", "dot"]
    matched = 0
    for a, b in itertools.product(signs, dots):
        t = f"see name{a}mail{b}example{b}com now"
        found = [m for m in pii._AT.finditer(t)]
        matched += bool(found)
        assert not found or pii._AT_SIGN.search(t), t
        assert sum(c.kind == 0 for c in pii.candidates(t, [])) == len(found), t
    assert matched > 30
