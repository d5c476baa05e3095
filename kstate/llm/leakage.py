"""Evaluation passages inside training documents.

Two searches over one kind of index. The exact one cuts every item into windows of the size that counts as a
leak (12 words; 20 letters and digits for Chinese and Japanese) and finds the documents that hold one of them
token by token. The near one takes windows of the items' own sizes and finds the documents that hold an item with
small edits. In both, each window of items and documents has a 64-bit SimHash of its tokens; fingerprints are cut into
radius + 1 blocks: two within the radius agree in a block, so a table a block finds all of them. Candidates within the
radius are verified by the exact weighted similarity of their five-token shingles; a token weighs by how rare it is
among all items.

Items are indexed in blocks of bounded size, each a broadcast of its own; the documents are read, tokenised and
fingerprinted once, whatever the number of items.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = regex.compile(r"[\p{L}\p{N}]+")
SIGN = regex.compile(r"[\p{L}\p{N}]")
SPACELESS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
SHINGLE = 5
#: Tokens hashed at a time, and items held by one index; larger inputs go in further blocks.
CHUNK = 20_000
ITEM_BLOCK = 5_000
#: Blocks whose indexes a worker keeps; with more of them, indexes are built anew for each batch of documents.
KEPT = 4


def tokens(text: str, by_sign: bool) -> list[str]:
    """Lower-cased words, or single letters and digits; all other signs are ignored."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return (SIGN if by_sign else WORD).findall(text.lower())


def is_spaceless(lang: str | None, text: str) -> bool:
    """Chinese and Japanese items count signs: by their language, or by their script where it isn't given."""
    if lang:
        return lang.strip().lower()[:2] in ("zh", "ja")
    signs = SIGN.findall(text)
    return 2 * len(SPACELESS.findall(text)) > len(signs)


KNOWN = np.uint64((1 << 22) - 1)


class Blocks:
    """Fingerprints with a table for each of radius + 1 blocks of their bits."""

    def __init__(self, prints: np.ndarray, radius: int) -> None:
        self.print, self.radius = prints, radius
        self.edges = np.linspace(0, 64, radius + 2).astype(int)
        self.tables = []
        for lo, hi in zip(self.edges, self.edges[1:]):
            v = self.block(prints, lo, hi)
            order = np.argsort(v, kind="stable")
            self.tables.append((order, np.searchsorted(v[order], np.arange((1 << (hi - lo)) + 1))))

    @staticmethod
    def block(f: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return ((f >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)

    def near(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index in f, index here) of all pairs of fingerprints within the radius, each once."""
        found = [np.zeros(0, np.int64)]
        total = len(self.print)
        for (order, starts), lo, hi in zip(self.tables, self.edges, self.edges[1:]):
            v = self.block(f, lo, hi)
            n = starts[v + 1] - starts[v]
            hit = np.flatnonzero(n)
            if not len(hit):
                continue
            n = n[hit]
            left = np.repeat(hit, n)
            offset = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            right = order[np.repeat(starts[v[hit]], n) + offset]
            ok = np.bitwise_count(f[left] ^ self.print[right]) <= self.radius
            found.append(left[ok] * total + right[ok])
        pairs = np.unique(np.concatenate(found))
        return pairs // max(total, 1), pairs % max(total, 1)


class Weights:
    """What tokens weigh, by their numbers among all items of a mode, and their 64 signs times a weight."""

    def __init__(self, df: dict[str, int], items: int, flat: bool) -> None:
        self.of = {w: max(1, round(4 * (math.log2((items + 1) / n) + 1))) for w, n in df.items()}
        self.top, self.flat = round(4 * (math.log2(items + 1) + 1)), flat
        self.rows: dict[str, int] = {}
        self.matrix, self.hash, self.weight = np.zeros((1024, 64), np.int16), np.zeros(1024, np.uint64), np.zeros(1024, np.int64)

    def ids(self, t: list[str]) -> np.ndarray:
        """Rows of the tokens in matrix, hash and weight."""
        if len(self.rows) > 200_000:
            self.rows.clear()
        rows = self.rows
        for w in set(t).difference(rows):
            r = rows[w] = len(rows)
            if r == len(self.matrix):
                self.matrix, self.hash, self.weight = (np.concatenate([x, np.zeros_like(x)]) for x in (self.matrix, self.hash, self.weight))
            digest = xxhash.xxh3_64_digest(w)
            bits = np.unpackbits(np.frombuffer(digest, np.uint8))
            self.weight[r] = self.of.get(w, self.top)
            self.hash[r] = int.from_bytes(digest)
            self.matrix[r] = (bits.astype(np.int16) * 2 - 1) * (1 if self.flat else self.weight[r])
        return np.fromiter(map(rows.__getitem__, t), np.int64, len(t))

    def sums(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ids) + 1, 64), np.int32)
        np.cumsum(self.matrix[ids], axis=0, dtype=np.int32, out=out[1:])
        return out

    def shingles(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and weight of the shingle that starts at each token."""
        n = max(len(ids) - SHINGLE + 1, 0)
        hashes, weights, own, w = np.zeros(n, np.uint64), np.zeros(n, np.int64), self.hash[ids], self.weight[ids]
        for k in range(SHINGLE if n else 0):
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n]
            weights += w[k : k + n]
        return hashes, weights

    def similarity(self, a: tuple[str, ...], b: tuple[str, ...]) -> float:
        """Weighted Jaccard of the shingles; a shingle weighs what its tokens weigh."""
        if a == b:
            return 1.0
        x = Counter(a[i : i + SHINGLE] for i in range(len(a) - SHINGLE + 1))
        y = Counter(b[i : i + SHINGLE] for i in range(len(b) - SHINGLE + 1))
        w = lambda s: sum(self.of.get(t, self.top) for t in s)
        both = sum(w(s) * n for s, n in (x & y).items())
        return both / (sum(w(s) * n for s, n in x.items()) + sum(w(s) * n for s, n in y.items()) - both)


def prints(sums: np.ndarray, window: int) -> np.ndarray:
    """SimHash of every window of the tokens, from their running sums."""
    if len(sums) <= window:
        return np.zeros(0, np.uint64)
    return np.packbits(sums[window:] - sums[:-window] > 0, axis=1).view(np.uint64).reshape(-1)


def sizes(least: int, most: int) -> list[int]:
    """Window sizes from ``least`` on, each a third longer than the one before."""
    out = [least]
    while out[-1] < most:
        out.append(out[-1] * 4 // 3)
    return out


class ItemIndex:
    """Windows of one mode (words or signs) of a bounded block of items, by size.

    With ``sized``, an item has two windows, its first and its last tokens, as many as the largest size it reaches;
    otherwise it has every window of the least size.
    """

    def __init__(self, items: list[tuple[int, str]], by_sign: bool, window: int, radius: int, weights: Weights, sized: bool = False) -> None:
        lists = [(i, t) for i, text in items if len(t := tokens(text, by_sign)) >= window]
        grid = sizes(window, max((len(t) for _, t in lists), default=window)) if sized else [window]
        held: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        #: which low bits of a hash some shingle of the items has
        self.known = np.zeros(int(KNOWN) + 1, bool)
        for i, t in lists:
            n = max(g for g in grid if g <= len(t))
            starts = sorted({0, len(t) - n}) if sized else list(range(len(t) - n + 1))
            ids = weights.ids(t)
            held[n][0].append(prints(weights.sums(ids), n)[starts])
            held[n][1].extend((i, tuple(t[k : k + n])) for k in starts)
            self.known[weights.shingles(ids)[0] & KNOWN] = True
        self.by_size = {n: (Blocks(np.concatenate(f), radius), own) for n, (f, own) in sorted(held.items())}


def search(docs: list[tuple[int, str]], indexes: Iterable[ItemIndex], by_sign: bool, window: int, weights: Weights, least: float, plain: bool) -> dict[tuple[int, int], list]:
    """Per document and item: verified windows, windows equal token by token, best similarity.

    The documents' tokens form one stream, taken in chunks that overlap by the longest window less one token;
    windows across two documents do not count.
    """
    found: dict[tuple[int, int], list] = defaultdict(lambda: [0, 0, 0.0])
    stream: list[str] = []
    owner: list[np.ndarray] = []
    for n, (_, text) in enumerate(docs):
        if by_sign and not plain and not SPACELESS.search(text):
            continue
        t = tokens(text, by_sign)
        if len(t) >= window:
            stream += t
            owner.append(np.full(len(t), n))
    of = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    kept: dict[int, tuple] = {}
    for index in indexes:
        over = max(index.by_size, default=0)
        for at in range(0, len(stream) - window + 1, CHUNK):
            part = stream[at : at + CHUNK + over - 1]
            # the running sums of a chunk serve every size and, while the chunks are as long, every block of items
            own = kept.get(at)
            if own is None or len(own[0]) < len(part) + 1:
                ids = weights.ids(part)
                own = (weights.sums(ids), *weights.shingles(ids))
                if len(stream) <= 4 * CHUNK:
                    kept[at] = own
            sums, hashes, weight = own
            # weight up to each token of all shingles, and of those some item has: a window can be no more alike than the latter's part
            every = np.concatenate([[0], np.cumsum(weight)])
            some = np.concatenate([[0], np.cumsum(np.where(index.known[hashes & KNOWN], weight, 0))])
            for size, (blocks, windows) in index.by_size.items():
                end = min(len(part), CHUNK + size - 1)
                if end < size:
                    continue
                whole = of[at : at + end - size + 1] == of[at + size - 1 : at + end]
                place = np.flatnonzero(whole)
                left, right = blocks.near(prints(sums[: end + 1], size)[place])
                left = place[left]
                stop = left + size - SHINGLE + 1
                able = some[stop] - some[left] >= (every[stop] - every[left]) * least - 1e-6
                hits: dict[tuple[int, int], tuple[float, bool]] = {}
                for x, y in zip(left[able].tolist(), right[able].tolist()):
                    mine, (item, theirs) = tuple(part[x : x + size]), windows[y]
                    s = weights.similarity(mine, theirs)
                    if s >= least:
                        before = hits.get((x, item), (0.0, False))
                        hits[x, item] = (max(before[0], s), before[1] or mine == theirs)
                for (x, item), (s, same) in hits.items():
                    r = found[docs[of[at + x]][0], item]
                    r[0] += 1
                    r[1] += same
                    r[2] = max(r[2], s)
    return found


def leaked_items(
    documents: DataFrame, items: DataFrame, window: int = 12, sign_window: int = 20, radius: int = 3, min_similarity: float = 0.8,
) -> DataFrame:
    """(doc_id, item_id, windows, exact_windows, similarity) for each document and item it leaks.

    exact_windows counts the document's windows equal token by token to one of the item's; these are all
    found. windows counts them and, of the windows of at least min_similarity that differ in some token,
    those whose fingerprints differ by at most radius bits: it misses others (near_items looks for edited items).
    Null or empty texts, items shorter than the window and rows with null ids give nothing; repeated rows count once;
    further columns are ignored; documents of any length are searched whole. Of an item_id with several texts all count.
    """
    return _search_all(documents, items, (window, sign_window), radius, min_similarity, sized=False)


def near_items(documents: DataFrame, items: DataFrame, window: int = 12, sign_window: int = 20, radius: int = 7, min_similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, windows, exact_windows, similarity) for documents that hold the first or last tokens of an item with small edits.

    A window has as many tokens as the largest window size the item reaches (three quarters of it at least); similarity is the
    weighted one of five-token shingles. Fingerprints weigh all tokens alike, so that one rare word replaced does not
    move them beyond the radius: in the tests at least 0.9 of what brute force finds is found. Odd rows count as in leaked_items.
    """
    return _search_all(documents, items, (window, sign_window), radius, min_similarity, sized=True)


def _search_all(documents: DataFrame, items: DataFrame, windows: tuple[int, int], radius: int, least: float, sized: bool) -> DataFrame:
    sc = documents.sparkSession.sparkContext
    it = items.select("item_id", "lang", "text").filter("item_id is not null and text is not null").distinct()
    docs = documents.select("doc_id", "text").filter("doc_id is not null and length(text) > 0")
    blocks = max(1, math.ceil(it.count() / ITEM_BLOCK))
    held, df, number, plain = [], (Counter(), Counter()), [0, 0], False
    for k in range(blocks):
        rows = it.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        split: tuple[list, list] = ([], [])
        for r in sorted(rows, key=lambda r: (r.item_id, r.text)):
            split[is_spaceless(r.lang, r.text)].append((r.item_id, r.text))
        for m in (0, 1):
            for _, text in split[m]:
                if len(t := tokens(text, bool(m))) >= windows[m]:
                    df[m].update(set(t))
                    number[m] += 1
                    # an item counted by signs may hold a window without any sign of those scripts: then no text can be passed over
                    plain |= m == 1 and any(sum(1 for _ in g) >= windows[1] for k, g in groupby(t, key=lambda c: SPACELESS.match(c) is None) if k)
        # one broadcast a block of at most about ITEM_BLOCK items; the weights are those of all items
        held.append(sc.broadcast(split))
    run = _searcher(held, df, number, windows, radius, least, sized, plain)
    out = docs.mapInArrow(run, "doc_id long, item_id long, windows long, exact_windows long, similarity double")
    return out.groupBy("doc_id", "item_id").agg(F.max("windows").alias("windows"), F.max("exact_windows").alias("exact_windows"), F.max("similarity").alias("similarity"))


def _searcher(held: list, df: tuple[Counter, Counter], number: list[int], windows: tuple[int, int], radius: int, least: float, sized: bool, plain: bool):
    names = ["doc_id", "item_id", "windows", "exact_windows", "similarity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [Weights(df[m], number[m], sized) for m in (0, 1)]
        index = lru_cache(2 * KEPT)(lambda m, k: ItemIndex(held[k].value[m], bool(m), windows[m], radius, weights[m], sized))
        for whole in batches:
            step = 500 if len(held) <= KEPT else whole.num_rows
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                docs = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
                rows = []
                for m in (0, 1):
                    if number[m]:
                        every = (index(m, k) for k in range(len(held)))
                        rows += [(*k, *r) for k, r in search(docs, every, bool(m), windows[m], weights[m], least, plain).items()]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i == 4 else pa.int64()) for i, c in enumerate(cols)], names=names)

    return run
