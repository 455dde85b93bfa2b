"""Alignment of the tokens of two tokenizers over the same texts.

Every text is tokenised whole by both.  Offsets at which a token of each ends
and the next token of each is marked with a space are anchors: they cut a text
into windows of token ids, and the alignment of a window depends on its ids
alone, so each distinct window is aligned once and remembered by its id tuples.

Counts of linked id pairs cover the corpus.  A task sums them over a chunk of
texts, chunks exchange only their distinct pairs with the corpus counts, and
the packed links of a chunk's texts wait in the shared folder meanwhile.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradecast.llm.common import saved

#: How a byte-level pre-tokenizer splits texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CHUNK_BYTES = 8 << 20   # text whose distinct pairs are exchanged together; one longer text is a chunk of its own
BATCH_BYTES = 1 << 19   # text tokenised at a time
MEMO_TOKENS = 4_000_000  # tokens in remembered windows before a process starts anew
OTHER = 1 << 28         # marks the ids of the second tokenizer in a window's key
BYTE_PIECE = 6          # length of a piece written <0xHH>

LINES = ("array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>")
SENT = f"chunk long, lines {LINES}, body binary, pairs array<long>, docs array<long>"
_LINE = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string())])


def byte_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if
    it is printable Latin-1, else the next free code point from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_pieces(t: Tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    alphabet = byte_alphabet()
    out = [b""] * t.get_vocab_size(with_added_tokens=True)
    for entry, i in t.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(map(alphabet.__getitem__, entry)) if all(c in alphabet for c in entry) else entry.encode()
    return out


def marked_pieces(s: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each id of a vocabulary that marks spaces by U+2581."""
    out = []
    for i in range(s.get_piece_size()):
        piece = s.id_to_piece(i)
        if s.is_byte(i) and len(piece) == BYTE_PIECE:
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def align_windows(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Aligns the tokens of windows, one after another; both sides hold the same
    bytes.  Between two neighbouring ends, of whichever side, lies a piece of one
    token of each: a link.  Gives where the links end, their codes (a's id << 32
    | b's), whether both tokens end there, and where the tokens end."""
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    ends = np.unique(np.concatenate((end_a, end_b)))
    i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    return ends, a[i].astype(np.int64) << 32 | b[j], (end_a[i] == ends) & (end_b[j] == ends), end_a, end_b


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``size`` of them."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def fast_encoder(json_a: str) -> tiktoken.Encoding | None:
    """The same byte-level vocabulary for tiktoken, which is several times faster;
    None unless the file says that it splits by the common pattern, changes no
    text and numbers its merges in their order, so that both give the same ids."""
    said = json.loads(json_a)
    model, split = said["model"], said["pre_tokenizer"] or {}
    plain = (said["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
             and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space"))
    if not plain:
        return None
    alphabet, entries = byte_alphabet(), model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    special = {t["content"] for t in said["added_tokens"]}
    merged = [entries[x + y] for x, y in merges]
    if merged != list(range(256, 256 + len(merges))) or sorted(entries[c] for c in alphabet) != list(range(256)):
        return None
    ranks = {bytes(map(alphabet.__getitem__, e)): i for e, i in entries.items() if e not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Tokenises and aligns texts in a task."""

    def __init__(self, json_a: str, model_b: bytes):
        self.a = Tokenizer.from_str(json_a)
        self.a.encode_special_tokens = True
        self.fast = fast_encoder(json_a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.bytes_a, self.bytes_b = byte_level_pieces(self.a), marked_pieces(self.b)
        self.size_a, self.size_b = np.array([len(p) for p in self.bytes_a]), np.array([len(p) for p in self.bytes_b])
        self.said = np.array([f"{i}{sign}" for n, signs in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for sign in signs for i in range(n)], object)
        self.space_a = np.array([p[:1] == b" " for p in self.bytes_a])
        self.space_b = np.array([p[:1] == b" " for p in self.bytes_b])
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.remembered = 0
        self.text: list[str] = []
        self.n_groups = array("q")
        self.pairs = array("q")          # pair codes of all windows, one after another
        self.first = array("q", [0])

    def learn(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Aligns new windows, of ``n_a`` and ``n_b`` tokens each, in a row."""
        ends, codes, both, end_a, end_b = align_windows(a, b, self.size_a, self.size_b)
        done = np.searchsorted(ends, end_a[np.cumsum(n_a) - 1], "right")  # links up to the end of each window
        groups = np.cumsum(both)[done - 1]
        # tokens in the order in which the groups name them, each with the sign after it
        group = [np.searchsorted(ends[both], e) for e in (end_a, end_b)]
        last = [np.append(g[1:] != g[:-1], True) for g in group]
        said = np.concatenate((a + last[0] * len(self.size_a), b + last[1] * len(self.size_b) + 2 * len(self.size_a)))
        order = np.argsort(np.concatenate((2 * group[0], 2 * group[1] + 1)), kind="stable")
        parts = self.said[said[order]].tolist()
        at = 0
        for to in np.cumsum(n_a + n_b).tolist():
            self.text.append("".join(parts[at:to]))
            at = to
        self.n_groups.frombytes(np.diff(groups, prepend=0).astype(np.int64).tobytes())
        self.first.frombytes((len(self.pairs) + done).astype(np.int64).tobytes())
        self.pairs.frombytes(codes.tobytes())
        self.remembered += len(a) + len(b)

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides, or none where their bytes are not those of the text."""
        given = [t or "" for t in texts]
        out = []
        if self.fast:
            coded = [self.fast.encode_ordinary(" " + t) for t in given]
        else:
            coded = [x.ids for x in self.a.encode_batch_fast([" " + t for t in given], add_special_tokens=False)]
        for t, a, b in zip(given, coded, self.b.encode(given, num_threads=1), strict=True):
            whole = b" " + t.encode()
            bytes_a = self.fast.decode_bytes(a) if self.fast else b"".join(map(self.bytes_a.__getitem__, a))
            same = t and bytes_a == whole and b"".join(map(self.bytes_b.__getitem__, b)) == whole
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """A line (n_a, n_b, n_groups, n_links, digest) for each text, and its
        distinct linked pairs: number of the text, pair code, how often."""
        coded = self.tokens(texts)
        lines: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        have = [i for i, (a, _) in enumerate(coded) if a]
        if not have:
            return lines, *(np.zeros(0, np.int64) for _ in range(3))
        flat_a = np.fromiter(chain.from_iterable(coded[i][0] for i in have), np.int32)
        flat_b = np.fromiter(chain.from_iterable(coded[i][1] for i in have), np.int32)
        n_a, n_b = np.array([len(coded[i][0]) for i in have]), np.array([len(coded[i][1]) for i in have])
        cut_a, cut_b = self._anchors(flat_a, flat_b, np.cumsum(n_a), np.cumsum(n_b))
        # the id tuples of a window as one string of 32-bit ids, those of b marked
        ids_a, ids_b = flat_a.tobytes(), (flat_b + OTHER).astype(np.int32).tobytes()
        found, new, memo = [], [], self.memo
        n = len(memo)
        i = j = 0
        for x, (k, m) in enumerate(zip((4 * cut_a).tolist(), (4 * cut_b).tolist(), strict=True)):
            at = memo.setdefault(ids_a[i:k] + ids_b[j:m], n)
            if at == n:
                new.append(x)
                n += 1
            found.append(at)
            i, j = k, m
        if new:
            size_a, size_b = np.diff(cut_a, prepend=0)[new], np.diff(cut_b, prepend=0)[new]
            self.learn(flat_a[_ranges(cut_a[new] - size_a, size_a)], size_a, flat_b[_ranges(cut_b[new] - size_b, size_b)], size_b)
        # windows of each text: those up to the one that ends with its last token
        last = np.searchsorted(cut_a, np.cumsum(n_a)) + 1
        w = np.array(found)
        first = np.array(self.first)
        starts = np.concatenate([[0], last[:-1]])
        links = first[w + 1] - first[w]
        groups = np.add.reduceat(np.array(self.n_groups)[w], starts)
        total = np.add.reduceat(links, starts)
        for x, i in enumerate(have):
            said = "".join(map(self.text.__getitem__, found[starts[x]:last[x]]))[:-1]
            lines[i] = (int(n_a[x]), int(n_b[x]), int(groups[x]), int(total[x]), hashlib.sha256(said.encode()).hexdigest())
        at = np.repeat(first[w] - np.concatenate([[0], np.cumsum(links)[:-1]]), links) + np.arange(links.sum())
        codes, number = np.unique(np.array(self.pairs)[at], return_inverse=True)
        text = np.repeat(np.array(have), total)
        key, often = np.unique(text * len(codes) + number, return_counts=True)
        if self.remembered > MEMO_TOKENS:
            self.forget()
        return lines, key // len(codes), codes[key % len(codes)], often

    def _anchors(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens of each side before each anchor.  A text ends at one."""
        cut = []
        for ids, size, space, last in ((a, self.size_a, self.space_a, last_a), (b, self.size_b, self.space_b, last_b)):
            before = np.append(space[ids[1:]], True)
            before[last - 1] = True
            at = np.flatnonzero(before)
            cut.append((at + 1, np.cumsum(size[ids])[at]))
        (at_a, end_a), (at_b, end_b) = cut
        # verified: the same offset ends a token before a marked one on both sides
        place = np.searchsorted(end_b, end_a)
        place[place == len(end_b)] = 0
        shared = end_b[place] == end_a
        return at_a[shared], at_b[place[shared]]


@lru_cache(maxsize=1)
def _aligner(json_a: str, model_b: bytes) -> Aligner:
    """One for the tasks that a process runs in turn, with the windows it knows."""
    return Aligner(json_a, model_b)


def _pack(*arrays: np.ndarray) -> bytes:
    raw = struct.pack(f"<{len(arrays)}q", *[x.nbytes for x in arrays]) + b"".join(x.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(body: bytes, kinds: list[type]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in runs of some ``BATCH_BYTES`` of text."""
    for whole in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at, before = 0, 0
        while at < whole.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
            yield whole.slice(at, to - at)
            at, before = to, int(ends[to - 1])


class _Chunk:
    """Lines and links of consecutive texts of a task."""

    def __init__(self):
        self.bytes, self.lines, self.text, self.pair, self.often = 0, [], [], [], []

    def add(self, ids: list, lines: list, text: np.ndarray, pair: np.ndarray, often: np.ndarray, size: int) -> None:
        self.text.append(text + len(self.lines))
        self.lines += [(i, *x) for i, x in zip(ids, lines, strict=True)]
        self.pair.append(pair)
        self.often.append(often)
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        """The chunk's one row: its distinct pairs, in how many texts each is, and
        the packed links (text runs, steps between pair numbers, how often)."""
        pairs, at, docs = np.unique(np.concatenate(self.pair), return_inverse=True, return_counts=True)
        runs = np.bincount(np.concatenate(self.text), minlength=len(self.lines)).astype(np.int32)
        body = _pack(runs, np.diff(at, prepend=0).astype(np.int32), np.concatenate(self.often).astype(np.int32))
        names = _LINE.names
        line = [dict(zip(names, x, strict=True)) for x in self.lines]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([line], pa.list_(_LINE)), pa.array([body], pa.binary()),
             pa.array([pairs], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))],
            names=["chunk", "lines", "body", "pairs", "docs"])


def link_chunks(docs: DataFrame, json_a: str, model_b: bytes, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each chunk of texts, as ``SENT``."""
    shared = docs.sparkSession.sparkContext.broadcast((json_a, model_b))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core
        aligner, chunk = _aligner(*shared.value), _Chunk()
        number = TaskContext.get().partitionId() << 32
        for b in _slices(batches):
            size = b.column("text").nbytes
            if chunk.lines and chunk.bytes + size > chunk_bytes:
                yield chunk.row(number)
                chunk, number = _Chunk(), number + 1
            chunk.add(b.column("doc_id").to_pylist(), *aligner.align(b.column("text").to_pylist()), size)
        if chunk.lines:
            yield chunk.row(number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SENT)


def pair_counts(sent: DataFrame) -> DataFrame:
    """(``pair``, ``n``, ``best``): in how many texts each linked id pair is, and
    whether that is the most of its id of the first tokenizer, ties included."""
    each = sent.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counted = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
    counted = saved(counted.withColumn("a", F.shiftright("pair", 32)), "align-pairs")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of a vocabulary
    return counted.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_FINISHED = pa.schema([*[(n, _LINE.field(n).type) for n in _LINE.names[:5]], ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
FINISHED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(key: tuple, chunks: pa.Table, counts: pa.Table) -> pa.Table:
    """Lines of a chunk with the corpus counts of its links."""
    if not chunks.num_rows:
        return _FINISHED.empty_table()
    lines = pc.list_flatten(chunks.column("lines")).combine_chunks()
    runs, steps, often = _unpack(chunks.column("body")[0].as_py(), [np.int32] * 3)
    order = np.argsort(counts.column("pair").to_numpy())
    n = counts.column("n").to_numpy()[order]
    best = counts.column("best").to_numpy()[order]
    at = np.cumsum(steps)  # a chunk's pairs are numbered in ascending order
    text = np.repeat(np.arange(len(runs)), runs)
    often = often.astype(np.int64)
    sums = [np.zeros(len(runs), np.int64) for _ in range(2)]
    for total, each in zip(sums, (best[at] * often, n[at] * often), strict=True):
        np.add.at(total, text, each)
    field = {n: lines.field(n) for n in _LINE.names}
    return pa.table([*[field[n] for n in _LINE.names[:5]], pa.array(sums[0]), pa.array(sums[1]), field["groups_sha256"]], schema=_FINISHED)


def alignments(docs: DataFrame, json_a: str, model_b: bytes, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for
    every row of ``docs`` (``doc_id``, ``text``; other columns are not read).

    ``json_a`` is a byte-level tokenizer, given the text after a space,
    ``model_b`` a piece model that adds that space itself.  Null and empty texts
    and those whose bytes either side does not keep (U+2581, say) have no tokens:
    zeros and ''.  Repeated rows are documents of their own, in the counts too,
    and so are rows with a null id.  An empty table gives no rows.
    """
    sent = saved(link_chunks(docs, json_a, model_b, chunk_bytes), "align-chunks")
    counts = saved(pair_counts(sent), "align-counts")
    asked = sent.select(F.col("chunk").alias("to"), F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select("to", "pair", "n", "best")
    return (sent.select("chunk", "lines", "body").groupBy("chunk").cogroup(answers.groupBy("to"))
            .applyInArrow(_finish, FINISHED))
