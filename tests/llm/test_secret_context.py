import pytest

from sitespark.llm import secret_scan

KEY = "Zk3vQ9xT7bLr2WmH8sYpD4nC"
PLAIN = "the plain lines of a setup file go on "


@pytest.mark.parametrize(("text", "found"), [(f"{KEY} # api token", True), (f"api token\n{PLAIN * 4}\nvalue {KEY} end", True), (f"value {KEY} {PLAIN * 4} is the password", True), (f"api token {PLAIN * 8} {KEY} end", False), (f"{KEY} {PLAIN * 8} password", False), (f"{PLAIN} {KEY}", False), (f"auth={KEY}", True), (f"{KEY}=auth", True), (f"token {KEY} and {KEY[::-1]}", True)])
def test_novelty_is_sought_on_both_sides_as_far_as_it_is_measured(text, found):
    spans = secret_scan.novel_spans(text, [], secret_scan.Novelty())
    want = [k for k in (KEY, KEY[::-1]) if k in text] if found else []
    assert [text[s:e].strip("=") for _, s, e in spans] == want
