"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A document's sketch holds every hash of its five-word shingles below a fixed
fraction of the hash range (and the smallest hash, if none is).  The sketch of
a union is the union of sketches cut the same way, so sketches merge, and the
shares of common hashes estimate Jaccard similarity and containment even
between texts of very unequal length.  With one hash in two kept, the standard
error of a likeness J of two texts is about sqrt(J (1 - J) / n), n the number of
their distinct shingles: 0.05 at most for 100, 0.025 for 400.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradecast.llm.common import ordered

SHINGLE = 5
BITS = 48          # of a hash
FRACTION = 2       # one hash in so many is kept
DIGITS = BITS // 4
BUCKET_ROWS = 2048 # neighbouring documents of a bucket, about


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column) -> Column:
    """48-bit hashes of the word 5-grams of a text; of a shorter text the hash
    of all its words; of a text without words none.  Repeats are kept."""
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\r\x0b\x0c"))
    words = F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(h) - (SHINGLE - 1), F.lit(1)))
        return F.transform(first, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(h, i, F.lit(SHINGLE))), 64 - BITS))

    none = F.array().cast("array<bigint>")
    return F.when(F.length(trimmed) == 0, none).otherwise(let(words, grams))


def cut(hashes: Column) -> Column:
    """The sorted distinct hashes below the threshold, or else the smallest."""
    below = F.lit((1 << BITS) // FRACTION)

    def kept(h: Column) -> Column:
        return let(F.filter(h, lambda x: x < below), lambda k: F.when(
            (F.size(k) == 0) & (F.size(h) > 0), F.array(F.array_min(h))).otherwise(F.sort_array(F.array_distinct(k))))

    return let(hashes, kept)


def sketch(text: Column) -> Column:
    return cut(shingle_hashes(text))


def merge(a: Column, b: Column) -> Column:
    """The sketch of the shingles of both."""
    return cut(F.concat(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two texts without words."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        n / F.greatest(F.size(a) + F.size(b) - n, F.lit(1))))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that are in ``b``; 1 if ``a`` has none."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_string(sk: Column) -> Column:
    """Twelve hex digits for each hash, in ascending order."""
    return F.array_join(F.transform(sk, lambda x: F.lpad(F.hex(x), DIGITS, "0")), "")


def _bounds(slim: DataFrame) -> list[tuple[int, int]]:
    """First (``_key``, ``_crc``) of each bucket of neighbours, in order: two
    numbers for some ``BUCKET_ROWS`` documents.  A bucket begins with a new key."""
    placed = ordered(slim, [F.desc("_key"), F.asc("_crc")], "sketch-order")
    starts = placed.where(F.col("_idx") % BUCKET_ROWS == 0).select("_key").distinct()
    first = placed.join(F.broadcast(starts), "_key").groupBy("_key").agg(F.min("_crc").alias("_crc"))
    return sorted(((r["_key"], r["_crc"]) for r in first.collect()), key=lambda k: -k[0])


def _bucket(key: Column, bounds: list[int]) -> Column:
    """Number of the last bound that isn't below ``key`` (bounds descend), found
    in two steps of about the square root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    array = F.array(*[F.lit(b) for b in bounds]) if len(bounds) <= 64 else F.from_json(
        F.lit("[" + ",".join(map(str, bounds)) + "]"), "array<bigint>")
    coarse = F.array(*[F.lit(b) for b in bounds[::step]]) if len(bounds) <= 64 else F.from_json(
        F.lit("[" + ",".join(map(str, bounds[::step])) + "]"), "array<bigint>")
    block = F.greatest(F.size(F.filter(coarse, lambda b: b >= key)) - 1, F.lit(0))
    return let(block, lambda k: k * step + F.size(F.filter(F.slice(array, k * step + 1, step), lambda b: b >= key)) - 1)


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: its value in the next row by
    descending ``_key`` (ties by ``_crc``), and after the last row the first's.

    Rows are dealt to buckets of neighbours, each of which also gets a copy of
    the row after its last; no window spans more than a bucket."""
    bounds = _bounds(docs.select("_key", "_crc"))
    if not bounds:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    n = len(bounds)
    own = docs.withColumn("_b", _bucket(F.col("_key"), [k for k, _ in bounds]).cast("int"))
    leads = F.from_json(F.lit("[" + ",".join(str(c) for _, c in bounds) + "]"), "array<bigint>")
    # the first row of a bucket is also the one after the last of the bucket before
    opens = F.col("_crc") == F.element_at(leads, F.col("_b") + 1)
    opens = opens & F.array_contains(F.from_json(F.lit("[" + ",".join(str(k) for k, _ in bounds) + "]"), "array<bigint>"), F.col("_key"))
    dealt = own.withColumn("_to", F.explode(F.when(opens, F.array(
        F.struct(F.col("_b").alias("b"), F.lit(0).alias("guest")),
        F.struct(F.pmod(F.col("_b") - 1, F.lit(n)).alias("b"), F.lit(1).alias("guest")),
    )).otherwise(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("guest"))))))
    dealt = dealt.withColumns({"_b": F.col("_to.b"), "_guest": F.col("_to.guest")}).drop("_to")
    w = Window.partitionBy("_b").orderBy("_guest", F.desc("_key"), "_crc")
    return dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried]).where("_guest = 0").drop("_guest", "_b")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (Jaccard estimates) and containment_next for every
    row of ``docs`` (``doc_id``, ``text``).

    A null text counts as empty and has the empty fingerprint, as have texts
    of blanks alone; rows of one doc_id are neighbours, in an order that
    depends on their texts alone; a null doc_id comes last.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_key"),
        F.xxhash64(text).alias("_crc"), text.alias("text"))
    rows = rows.select("*", F.length("text").cast("long").alias("n_chars"))
    rows = with_next(rows, ["text"])  # texts alone are dealt: their sketches would take more room
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "text", "next_text", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "edited", sketch(F.col("text")).alias("sk"),
                       sketch(F.col("next_text")).alias("next_sk"), sketch(F.col("edited")).alias("esk"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sk")).alias("fingerprint"), as_string(F.col("esk")).alias("edited_fingerprint"),
        likeness(F.col("sk"), F.col("esk")).alias("near_edited"), likeness(F.col("sk"), F.col("next_sk")).alias("near_next"),
        containment(F.col("sk"), F.col("next_sk")).alias("containment_next"))
