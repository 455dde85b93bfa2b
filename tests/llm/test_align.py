"""Cross-tokenizer alignment against a byte-by-byte version."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tradecast.llm import align
from tradecast.llm.common import table

JSON_A = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
MODEL_B = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
TOKENIZER = Tokenizer.from_str(JSON_A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_proto=MODEL_B)


ALPHABET = align.byte_alphabet()


@cache
def _bytes_a(i: int) -> bytes:
    return bytes(ALPHABET[c] for c in TOKENIZER.id_to_token(i))


@cache
def _bytes_b(i: int) -> bytes:
    p = PIECES.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()


def _spans(ids, piece):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(piece(i)), i))
        at += len(piece(i))
    return out


def brute(docs: list[tuple]) -> list[tuple]:
    rows, held = [], Counter()
    for doc_id, text in docs:
        a = TOKENIZER.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = PIECES.encode(text) if text else []
        whole = b" " + (text or "").encode()
        if b"".join(map(_bytes_a, a)) != whole or b"".join(map(_bytes_b, b)) != whole:
            a, b = [], []
        sa, sb = _spans(a, _bytes_a), _spans(b, _bytes_b)
        links, lo = [], 0
        for s, e, x in sa:
            while lo < len(sb) and sb[lo][1] <= s:
                lo += 1
            k = lo
            while k < len(sb) and sb[k][0] < e:
                links.append((x, sb[k][2]))
                k += 1
        ends = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        ga, gb = ([[] for _ in ends] for _ in range(2))
        for spans, groups in ((sa, ga), (sb, gb)):
            for _, e, x in spans:
                groups[bisect_left(ends, e)].append(str(x))
        said = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(ga, gb, strict=True))
        rows.append((doc_id, len(a), len(b), len(ends), links, hashlib.sha256(said.encode()).hexdigest() if a else ""))
        held.update(set(links))
    most: dict[int, int] = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return [(i, a, b, g, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), h)
            for i, a, b, g, links, h in rows]


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


ODD = [(0, "the cat and the dog"), (1, None), (2, ""), (3, "  two  spaces\n\n\tand tabs "), (4, "café 中文字 \U0001f600\U0001f600 ok"),
       (5, "a▁b"), (6, "<|endoftext|></s><s>[INST] plain"), (7, "x" * 20_000), (8, "<0x41> A"), (9, "the cat and the dog"),
       (9, "the cat and the dog"), (None, "the cat"), (None, None), (10, " "), (11, "\x00nul"), (12, "é combining ﬁ ligature"),
       (13, " ".join(f"w{i % 211}" for i in range(5_000)))]


def test_odd_rows_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in ODD], "doc_id long, text string, chunk int, pair long, lines string").repartition(3)
    assert _sorted(align.alignments(docs, JSON_A, MODEL_B).collect()) == _sorted(brute(ODD))


def test_documents_equal_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert _sorted(align.alignments(docs, JSON_A, MODEL_B).collect()) == _sorted(want)


def test_many_chunks_give_the_same(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where("doc_id < 60")
    whole = _sorted(align.alignments(docs, JSON_A, MODEL_B).collect())
    a = align.Aligner(JSON_A, MODEL_B)
    texts = [r["text"] for r in docs.collect()]
    together = a.align(texts)[0]
    assert [a.align([t])[0][0] for t in texts] == together  # batches do not matter, remembered windows neither
    assert _sorted(align.alignments(docs.repartition(5), JSON_A, MODEL_B, chunk_bytes=1).collect()) == whole


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.alignments(docs, JSON_A, MODEL_B).count() == 0


@pytest.mark.parametrize("size", [1, 7])
def test_windows_cover_their_bytes(size):
    a = align.Aligner(JSON_A, MODEL_B)
    ids_a, ids_b = a.tokens(["word " * size + "unsplittable" * size])[0]
    ends, links, both, end_a, end_b = align.align_windows(np.array(ids_a), np.array(ids_b), a.size_a, a.size_b)
    assert both[-1] and ends[-1] == end_a[-1] == end_b[-1] and len(end_a) == len(ids_a) and len(end_b) == len(ids_b)
    assert len(links) == len(ids_a) + len(ids_b) - both.sum()  # a staircase in each group


def test_fast_encoder_gives_the_same_ids():
    fast = align.fast_encoder(JSON_A)
    # every code point beside letters, digits, blanks and itself
    texts = [" " + " ".join(f"a{chr(c)}b{chr(c)}1 {chr(c)}{chr(c)}  {chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
             for start in range(0, 0x110000, 64)]
    texts = [t for t in texts if t.strip()]
    slow = [x.ids for x in TOKENIZER.encode_batch_fast(texts, add_special_tokens=False)]
    different = [i for i, (t, x) in enumerate(zip(texts, slow, strict=True)) if fast.encode_ordinary(t) != x]
    assert not different, (len(different), texts[different[0]][:40].encode("unicode_escape"))


def test_another_file_goes_without_the_fast_encoder():
    assert align.fast_encoder(JSON_A.replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false')) is None
