import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

import brute
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import privacy as P

PIECES = st.sampled_from(["a", "b.c", "@", "x@y", ".com", "..", "-", "_", "+", "1.2.3.4", "255", ".", " ", "\n",
                          "4111 1111 1111 1111", "4111-1111", "0", "+1 (555) 010-9999", "(", ")", "é😀", "999",
                          "%", "12345678901234567890"])


@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=30, max_size=60))
@settings(deadline=None, max_examples=8, suppress_health_check=list(HealthCheck))
def test_base_spans_equal_the_plain_patterns(spark, documents, texts):
    rows = list(enumerate(texts))
    for r in P.privacy_table(documents(*rows)).collect():
        want = brute.base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in want.values()], texts[r.doc_id]
        assert r.base_sha256 == brute.digest(brute.span_text(want))


def corpus():
    """Lines in which a nickname never stands without its address, among many others."""
    rows = [(i, f"Line {i} speaks of {w}.\nNothing else in {i}") for i, w in enumerate(
        ["rivers", "stones", "birds", "winds"] * 30)]
    rows += [(200, "Ask Zorro (zorro@mask.example.org) about rivers"),
             (201, "It was zorro, zorro@mask.example.org I think"),
             (202, "The birds and ZORRO zorro@mask.example.org again"),
             (203, "No address, but Zorro. And zorro")]
    # A copied line: every word of it always meets the address, and tells nothing.
    copies = ["write to info@copy.example.org for our very special yellow offers today number " + str(i)
              for i in range(5)]
    return rows + [(300 + i, t) for i, t in enumerate(copies)]


def test_terms_that_disclose_an_entity_are_spans(spark, documents):
    rows = corpus()
    got = {r.doc_id: r for r in P.privacy_table(documents(*rows)).collect()}
    assert {d for d, r in got.items() if r.n_term} == {200, 201, 202, 203}
    assert got[203].spans == "term:16:21,term:27:32"
    assert got[200].spans == "email:11:33,term:4:9"
    clean = {r.doc_id: r.text for r in P.sanitised(documents(*rows)).collect()}
    # One line of four has the name without the address: 93 % of what the address carries.
    assert clean[200] == "Ask [TERM] ([EMAIL]) about rivers"
    assert clean[203] == "No address, but [TERM]. And [TERM]"
    always = {r.doc_id: r.text for r in P.sanitised(documents(*rows[:-6], *rows[-5:])).collect()}
    assert always[200] == "Ask  ([EMAIL]) about rivers"
    assert clean[300].startswith("write to [EMAIL] for our very")
    assert clean[5] == rows[5][1]


def test_an_entity_may_have_any_number_of_terms(spark, documents):
    """Name, street, employer and badge that always stand with an address, in six different lines."""
    rows = [(i, f"Filler {i} about {w} and more of it") for i, w in enumerate(["rivers", "stones", "birds"] * 100)]
    person = "Quentin Vandermeer Kestrelway Brockholt Zenithworks Limitade badge room deputy"
    tales = ["came early to see the old garden wall again", "lost two keys near that long narrow bridge",
             "never eats soup after nine on any Monday", "paints blue horses for the village summer fair",
             "sold his boat when prices fell last winter", "plays chess with three cousins every other week"]
    rows += [(900 + i, f"{person} q.v@mask.example.org {t}") for i, t in enumerate(tales)]
    rows.append((950, "Somebody saw Vandermeer at noon"))
    got = {r.doc_id: r.n_term for r in P.privacy_table(documents(*rows)).collect()}
    assert all(got[900 + i] >= 9 for i in range(6)) and got[950] == 1 and got[5] == 0


def test_two_different_lines_tell_and_copies_do_not(spark, documents):
    rows = [(i, f"Filler {i} about {w} and more of it") for i, w in enumerate(["rivers", "stones", "birds"] * 40)]
    rows += [(500, "Yesterday Zorro wrote from z@mask.example.org about rivers"),
             (501, "z@mask.example.org is what Zorro gave me after stones fell")]
    rows += [(600 + i, f"Our special yellow offers end soon so write today to c@copy.example.org number {i}")
             for i in range(4)]
    got = {r.doc_id: r.spans for r in P.privacy_table(documents(*rows)).collect()}
    assert "term:10:15" in got[500] and "term:27:32" in got[501]
    assert all("term" not in got[600 + i] for i in range(4))


def test_time_stays_near_proportional_to_the_spans(spark, documents):
    import time

    def seconds(n):
        frame = documents((1, " ".join(f"u{i}@x.example.org" for i in range(n))))
        started = time.perf_counter()
        assert P.privacy_table(frame).first().n_email == n
        return time.perf_counter() - started

    seconds(2000)
    few, many = seconds(8000), seconds(16000)
    assert many <= 2.5 * few + 1


def test_edges(spark, documents, edges):
    frame = documents(*edges, (1, "+" + "1" * 30_000), (2, "9" * 30_000), (3, "a." * 20_000 + "@"),
                      (4, "a@b" + ".c" * 20_000), (4, "1.2.3.4"))
    got = P.privacy_table(frame)
    assert got.count() == len(edges) + 5
    by = {r.doc_id: r for r in got.where("doc_id in (1, 2, 3, 900, 901)").collect()}
    assert all(r.spans == "" for r in by.values())
    assert sorted(r.spans for r in got.where("doc_id = 4").collect()) == ["email:0:40003", "ip:0:7"]
    assert P.privacy_table(documents()).count() == 0
    assert P.sanitised(frame).columns == documents().columns
    assert P.sanitised(frame).where("doc_id = 900").first().text is None


@pytest.mark.parametrize("kind", P.KINDS)
def test_patterns_need_no_way_back(kind):
    """Possessive or not, the patterns find the same: they are plain apart from speed."""
    plain = re.sub(r"(?<=[+*])\+", "", P.PATTERNS[kind].replace(r"(?:\G|", "(?:(?!)|"))
    assert plain.count("(") >= 0 and "++" not in plain
