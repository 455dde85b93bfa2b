"""Words that the byte-pair encoder folds itself."""

from __future__ import annotations

import random

import public_tokenizers
import tiktoken

from tradecast.llm import bpe


def test_bpe_words_beyond_the_table():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    parts = ["a", "e", "th", " ", "é", "\U0001f600", "x", "in", "ng", "\n", "1", "23", "#", "  ", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(500)]
    coder = bpe._Encoder(ranks, public_tokenizers.PATTERN, [" the"], [[ranks[b" the"]]])
    words = coder.of.__self__
    words.most = 1 + 50  # forgets what it has learnt now and then, never what was given
    bpe_memo, bpe.MEMO = bpe.MEMO, 50
    try:
        assert [coder.ids(t) for t in texts] == [known.encode_ordinary(t) for t in texts]
    finally:
        bpe.MEMO = bpe_memo
    assert len(words) <= words.most and dict.get(words, " the") == (ranks[b" the"],)
