"""Near-duplicate records by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit universe generate every signature coordinate: the first scatters the
hashed words, the second is applied after a circular shift by k and gives coordinate k as the minimum
over the record's words. Coordinates are banded; records that agree in a band become candidates if the
sizes and parity sketches of their word sets allow the threshold, and the exact Jaccard similarity of the
word sets decides.

The parity sketch has 80 bits; a word flips one of them. Two sketches differ in at most as many bits as
the sets differ in words, so the sketch never drops a pair at or above the threshold. What a band row
carries is a key, the representative's key and 12 bytes of sketch and size; texts are shuffled once.

With the default 4 coordinates a band, 57 bands let a pair at similarity 0.6 meet with probability 0.9996,
at 0.65 with 0.99998 (``bands_for``). More coordinates a band need more rows, but let fewer unlike pairs
meet: 5 pay from some millions of classes on, 6 from a hundred times as many.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kstate.llm.components import connected_components
from kstate.runtime import cut

#: Bits of the parity sketch, and the largest set size a band row states (larger sets pass unchecked).
SKETCH, MOST = 80, (1 << 16) - 1
#: Bits of a band's hash: with the number of the band 4 bytes. Unlike classes meet by chance once in 2^KEY_BITS pairs a band, at
#: a hundred million classes about once a class and band; beyond that, more bits cost less than these meetings.
KEY_BITS = 26
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Distinct words: maximal runs of letters and digits, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def shingles(text: Column, n: int) -> Column:
    """Distinct runs of n words (the words themselves for n = 1); fewer words than n give one shingle."""
    if n == 1:
        return words(text)
    w = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def bands_for(threshold: float, rows: int, recall: float = 0.9996) -> int:
    """How many bands of ``rows`` coordinates let a pair at the threshold meet with probability ``recall``."""
    return max(1, math.ceil(round(math.log1p(-recall) / math.log1p(-(threshold**rows)), 1)))


def _mix(x: np.ndarray, c1: int, c2: int) -> np.ndarray:
    """A bijection of 32-bit integers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(c1)
    x ^= x >> np.uint32(13)
    x *= np.uint32(c2)
    x ^= x >> np.uint32(16)
    return x


def circulant_minhash(hashes: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures (records x coordinates); record i owns hashes[starts[i]:starts[i+1]], never empty."""
    h = hashes.view(np.uint64)
    scattered = _mix((h ^ (h >> np.uint64(32))).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    out = np.empty((coordinates, len(starts)), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(coordinates):
            out[k] = np.minimum.reduceat(_mix(scattered + np.uint32(k), 0x7FEB352D, 0x846CA68B), starts)
    return out.T


def parity_sketch(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 parities a record; 16 parities above the size of its set."""
    bit = (hashes.view(np.uint64) >> np.uint64(24)) % np.uint64(SKETCH)
    low = bit < 64
    first = np.where(low, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
    second = np.where(low, 0, np.uint64(1) << (bit & np.uint64(31))).astype(np.uint32) << np.uint32(16)
    second = np.bitwise_xor.reduceat(second, starts) | np.minimum(sizes, MOST).astype(np.uint32)
    return np.bitwise_xor.reduceat(first, starts).view(np.int64), second.view(np.int32)


def _bands(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                lists = b.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                sig = circulant_minhash(flat, starts, bands * rows)
                # the kind is part of every key, so kinds never meet
                key = np.repeat(b.column(2).to_numpy().astype(np.int64).view(np.uint64)[:, None], bands, axis=1)
                for r in range(rows):
                    key ^= sig[:, r::rows].astype(np.uint64)
                    key *= np.uint64(0xFF51AFD7ED558CCD)
                    key ^= key >> np.uint64(29)
                key = (key >> np.uint64(64 - KEY_BITS)) | (np.arange(bands, dtype=np.uint64) << np.uint64(KEY_BITS))
                first, second = parity_sketch(flat, starts, sizes)
                each = lambda x: pa.array(np.repeat(x, bands))
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), each(b.column(0).to_numpy()), each(first), each(second)], names=["band", "rep", "s1", "s2"])

    return run


def _may_be_similar(threshold: float) -> Column:
    """Whether the sizes and sketches of two band rows allow the threshold: sets that reach it differ in few words."""
    na, nb = (F.col(c).bitwiseAND(F.lit(MOST)) for c in ("a2", "b2"))
    apart = (na + nb) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6)
    bits = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.shiftrightunsigned(F.col("a2").bitwiseXOR(F.col("b2")), 16))
    return (na == MOST) | (nb == MOST) | ((bits <= apart) & (F.abs(na - nb) <= apart))


def near_duplicates(
    records: DataFrame, key: str = "key", kind: str = "kind", text: str = "text",
    threshold: float = 0.6, shingle_words: int = 1, bands: int | None = None, rows: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Classes of equal word sets and the similar pairs between them.

    Returns (members, pairs): members (kind, rep, <key>) places every record in its class, whose
    representative is its smallest key; pairs (kind, rep_a, rep_b, similarity) has each pair of
    classes of one kind with Jaccard >= threshold once, rep_a < rep_b. Copies never meet pairwise.
    Rows with null key, kind or text, and texts without any word, take no part; a row delivered
    twice counts once, and of several texts of one key and kind one counts (that of the least hash of its words); other
    columns are ignored; texts are used whole. ``key`` is an integer. ``bands`` is by default what ``rows`` needs.
    """
    bands = bands or bands_for(threshold, rows)
    said = records.select(F.col(kind).alias("kind"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    said = said.filter("kind is not null and key is not null and text is not null").filter(F.col("text").rlike(r"[\p{L}\p{N}]"))
    w = shingles(F.col("text"), shingle_words)
    said = said.withColumn("same", F.unhex(F.md5(F.array_join(F.sort_array(w), "\u0001"))))
    one = said.groupBy("kind", "key").agg(F.min("same").alias("same"))
    classes = one.groupBy("kind", "same").agg(F.min("key").alias("rep"))
    members = cut(one.join(classes.hint("merge"), ["kind", "same"]).select("kind", "rep", "key", "same"))
    # the only shuffle of texts: by key, where they stay for the bands and for the verification. Kind and word set are compared by
    # range: as further join keys they would have all texts shuffled once more
    reps = members.filter("rep = key").select("rep", F.col("kind").alias("of"), F.col("same").alias("set"))
    found = (F.col("key") == F.col("rep")) & F.col("kind").between(F.col("of"), F.col("of")) & F.col("same").between(F.col("set"), F.col("set"))
    own = said.repartition("key").join(reps.hint("merge"), found, "left_semi").groupBy("key", "kind").agg(F.min("text").alias("text"))
    flat = own.select(F.col("key").alias("rep"), F.transform(w, lambda x: F.xxhash64(x)).alias("h"), F.xxhash64("kind").alias("k"))
    banded = flat.mapInArrow(_bands(bands, rows), "band long, rep long, s1 long, s2 int")
    a, b = banded.toDF("band", "rep_a", "a1", "a2"), banded.toDF("band", "rep_b", "b1", "b2")
    meet = (a["band"] == b["band"]) & (F.col("rep_a") < F.col("rep_b"))
    maybe = a.join(b.hint("merge"), meet & _may_be_similar(threshold)).select("rep_a", "rep_b").distinct()
    maybe = maybe.join(own.toDF("rep_a", "kind", "ta").hint("merge"), "rep_a").join(own.toDF("rep_b", "kind_b", "tb").hint("merge"), "rep_b")
    maybe = maybe.filter(F.col("kind").between(F.col("kind_b"), F.col("kind_b")))
    # inline keeps each word set from being worked out again for every use of it
    sets = F.array(F.struct(shingles(F.col("ta"), shingle_words).alias("a"), shingles(F.col("tb"), shingle_words).alias("b")))
    counts = F.transform(sets, lambda x: F.struct(F.size(F.array_intersect(x["a"], x["b"])).alias("both"), (F.size(x["a"]) + F.size(x["b"])).alias("sizes")))
    pairs = maybe.select("kind", "rep_a", "rep_b", F.inline(counts)).withColumn("all", F.col("sizes") - F.col("both"))
    pairs = pairs.filter(F.col("both") >= threshold * F.col("all") - 1e-9)
    pairs = pairs.select("kind", "rep_a", "rep_b", (F.col("both") / F.col("all")).alias("similarity"))
    return members.select("kind", "rep", F.col("key").alias(key)), pairs


def expand_pairs(members: DataFrame, pairs: DataFrame, key: str = "key") -> DataFrame:
    """(<key>_a, <key>_b), a < b: every pair of records whose classes are equal or linked."""
    m = members.select("kind", "rep", key)
    many = m.groupBy("kind", "rep").agg(F.count("*").alias("n")).filter("n > 1").select("kind", "rep")
    own = many.select("kind", F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"))
    links = pairs.select("kind", "rep_a", "rep_b").unionByName(own)
    out = links.join(m.toDF("kind", "rep_a", "x").hint("merge"), ["kind", "rep_a"]).join(m.toDF("kind", "rep_b", "y").hint("merge"), ["kind", "rep_b"])
    out = out.filter("rep_a <> rep_b or x < y")
    return out.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def near_duplicate_groups(members: DataFrame, pairs: DataFrame, key: str = "key") -> DataFrame:
    """(kind, <key>, class_id, group_id, links): one row a record.

    class_id is the smallest key with the same word set, group_id the smallest key reached through
    links, links the number of other classes its class is linked with.
    """
    pairs = cut(pairs.select("kind", "rep_a", "rep_b"))
    end = lambda c: F.struct(F.col("kind").alias("kind"), F.col(c).alias("rep"))
    comp = connected_components(pairs.select(end("rep_a").alias("src"), end("rep_b").alias("dst")))
    comp = comp.select("node.kind", "node.rep", F.col("component.rep").alias("g"))
    links = pairs.select("kind", F.col("rep_a").alias("rep")).union(pairs.select("kind", "rep_b")).groupBy("kind", "rep").agg(F.count("*").alias("links"))
    out = members.join(comp.hint("merge"), ["kind", "rep"], "left").join(links.hint("merge"), ["kind", "rep"], "left")
    return out.select("kind", key, F.col("rep").alias("class_id"), F.coalesce("g", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
