"""The automaton against greedy longest match by slices."""

import random

import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from ingot.llm import token_counts as C
from ingot.llm.bpe import ranks_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def greedy(word, pieces, longest):
    n = 0
    while word:
        size = next((k for k in range(min(longest, len(word)), 0, -1) if word[:k] in pieces), 0)
        if not size:
            return 1
        word, n = word[size:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 for x in b)), max_size=12), st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=20))
def test_equals_greedy_matching(pieces, words):
    a = C.Automaton(pieces)
    for w in words:
        assert a.count(w) == greedy(w, pieces, 5)


def test_table(spark):
    r = random.Random(1)
    texts = ["", None, "a" * 40_000, "Hello  wörld 🙂 123", "x y " * 9000] + ["".join(r.choice("abcdeé 1.\n") for _ in range(200)) for _ in range(50)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, "a", 2)], "doc_id long, text string, n_tokens int")
    pieces = ranks_of(RANKS)
    longest = max(map(len, pieces))
    split = regex.compile(public_tokenizers.PATTERN).findall
    got = C.token_counts(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        words = split((texts[row["doc_id"]] if row["doc_id"] is not None else "a") or "")
        assert (row["n_words"], row["n_tokens"]) == (len(words), sum(greedy(w.encode(), pieces, longest) for w in words))
    assert C.token_counts(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
