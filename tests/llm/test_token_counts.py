import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeledger.llm import queries
from tradeledger.llm.token_counts import Automaton, byte_vocabulary, token_counts


def greedy(word, opening, inside):
    """Longest match from the left, piece by piece."""
    at, n, pieces = 0, 0, set(opening)
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return -1
        at, n, pieces = at + size, n + 1, set(inside)
    return n


PIECE = st.text("abc", min_size=1, max_size=5).map(str.encode)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECE, max_size=12), st.lists(PIECE, max_size=12), st.lists(st.text("abc", min_size=1, max_size=14).map(str.encode), max_size=8))
def test_counts_equal_greedy_matching(opening, inside, words):
    automaton = Automaton(opening, inside)
    for word in words:
        assert automaton.count(word) == greedy(word, opening, inside)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_vocabulary(queries.VOCABULARY)


def test_public_vocabulary(vocabulary):
    opening, inside = (set(v) for v in vocabulary)
    automaton = Automaton(*vocabulary)
    for word in ("the", "unbelievable", "Èleouêen", "漢字", "x" * 300, "4191085147143418", "a\x00b"):
        w = b" " + word.encode()
        assert automaton.count(w) == greedy(w, opening, inside) > 0


def test_awkward_rows(spark, vocabulary):
    opening, inside = (set(v) for v in vocabulary)
    df = documents(spark, clashing=True)
    got = token_counts(df, Automaton(*vocabulary))
    assert got.columns.count("n_words") == 1
    for r in got.collect():
        words = (r["text"] or "").encode().split()
        if len(words) < 100:
            assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(words), sum(greedy(b" " + w, opening, inside) for w in words), 0)
    assert token_counts(documents(spark, []), Automaton(*vocabulary)).count() == 0


def test_unknown_words_count_once(spark):
    df = documents(spark, [(1, "ab abz zz ab " + "ab" * 5000, "", "", 0)])
    r = token_counts(df, Automaton([b"a"], [b"b", b"ab"]), prefix=b"").first()
    assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (5, 2 + 1 + 1 + 2 + 2 + 4999, 2)
