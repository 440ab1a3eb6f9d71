import random

from eventstar.llm import tokencount as T
from eventstar.llm.packing import default_tokenizer
from tests.llm.helpers import awkward, docs_frame, prose


def greedy(pieces, word):
    n, at = 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in pieces), 0)
        if not size:
            return T.NONE
        at += size
        n += 1
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(5)
    for _ in range(300):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5)))
                  for _ in range(rng.randint(1, 9))}
        automaton = T.LongestMatch(sorted(pieces))
        for _ in range(30):
            word = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == greedy(pieces, word), (pieces, word)


def test_counts_of_documents(spark):
    pieces = set(T.pieces_of(default_tokenizer()))
    docs = awkward(spark, clash="n_tokens")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = T.token_counts(docs, default_tokenizer()).collect()
    assert len(rows) == 14
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        assert (r.n_words, r.n_tokens, r.n_unknown) == (
            len(words), sum(greedy(pieces, b" " + w) for w in words), 0)
    assert T.token_counts(docs_frame(spark, []), default_tokenizer()).count() == 0


def test_unknown_words_and_forgetting():
    automaton = T.LongestMatch([b" a", b"b", b" "], keep=1)
    assert automaton.counts([b"ab", b"ac", b"ab"]) == [2, T.NONE, 2]
    assert automaton.counts([b"b"]) == [2]
    assert automaton.counts(prose(1, 3).encode().split())[0] == T.NONE
