"""Freely typed names mapped to the entries of a reference list.

The reference list is small and broadcast in blocks of bounded size: its words and its whole keys stand
in symmetric-delete dictionaries (every deletion of up to two letters of a prefix points to the word), so a
typed word finds all words within the bound by looking up its own deletions, and the words it may be cut
short from in the sorted list. Finds are verified and ranked by a weighted Damerau-Levenshtein distance; a name that is
a key of the list means that key, whatever else is near; equal distances go to the entry named most often in the data.
Names that mean no entry are reported as unmatched.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kstate.runtime import cut

#: Words that say nothing about which entry is meant: articles and remarks; a parameter.
FILLERS = frozenset("a an the our my this that new draft see note notes service copy final wip todo tbd n na untitled unknown unnamed none null misc test".split())
UNMATCHED = "unmatched"
TOKEN = regex.compile(r"([\p{L}\p{N}]+)(\.?)")
HUMP = regex.compile(r"(?<=\p{Ll})(?=\p{Lu})|(?<=\.)(?=\p{Lu})")
PREFIX = 8
#: Entries held by one index; a longer list is taken in blocks.
ENTRY_BLOCK = 50_000
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEAR = {frozenset((r[i], r[i + 1])) for r in _ROWS for i in range(len(r) - 1)} | {
    frozenset((a, b)) for up, low in zip(_ROWS, _ROWS[1:]) for i, b in enumerate(low) for a in up[i : i + 2]
}


def fold(text: str) -> str:
    """Case, accents, widths and apostrophes removed."""
    t = unicodedata.normalize("NFKD", text)
    t = "".join(c for c in t if not unicodedata.combining(c)).casefold()
    return regex.sub(r"['’ʼ`\p{Cf}]", "", t)


def distance(a: str, b: str, most: int) -> tuple[int, float] | None:
    """(edits, weighted edits) of the optimal-alignment Damerau-Levenshtein distance, None beyond ``most``.

    A swap of neighbours weighs 0.7, a letter doubled or halved 0.6, a neighbouring key 0.8, all else 1.
    """
    if abs(len(a) - len(b)) > most:
        return None
    far = (most + 1, most + 1.0)
    before = 0
    two: list = []
    one = [(j, j * 1.0) if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [far] * (len(b) + 1)
        if i <= most:
            row[0] = (i, i * 1.0)
        low = row[0][0]
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            if x == y:
                best = one[j - 1]
            else:
                e, w = one[j - 1]
                best = (e + 1, w + (0.8 if frozenset((x, y)) in _NEAR else 1.0))
            e, w = one[j]
            best = min(best, (e + 1, w + (0.6 if i > 1 and a[i - 2] == x else 1.0)))
            e, w = row[j - 1]
            best = min(best, (e + 1, w + (0.6 if j > 1 and b[j - 2] == y else 1.0)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                e, w = two[j - 2]
                best = min(best, (e + 1, w + 0.7))
            row[j] = best
            low = min(low, best[0])
        # a swap reaches back two rows, so both must be out of reach
        if low > most and before > most:
            return None
        before = low
        two, one = one, row
    return one[-1] if one[-1][0] <= most else None


def edits_allowed(n: int) -> int:
    """How many slips a word of n letters may have."""
    return 0 if n < 4 else 1 if n < 8 else 2


def deletions(word: str, most: int) -> set[str]:
    p = word[:PREFIX]
    return {"".join(c for i, c in enumerate(p) if i not in gone) for k in range(min(most, len(p)) + 1) for gone in combinations(range(len(p)), k)}


class SymmetricDelete:
    """All words of a list within an edit distance, by shared deletions of their prefixes."""

    def __init__(self, words: set[str], most: int = 2) -> None:
        self.most = most
        table: dict[str, list[str]] = defaultdict(list)
        for w in sorted(words):
            for d in deletions(w, most):
                table[d].append(w)
        self.table = dict(table)

    def near(self, word: str, most: int, only: set[str] | None = None) -> list[tuple[str, float]]:
        found = []
        for w in {w for d in deletions(word, self.most) for w in self.table.get(d, ())}:
            if (only is None or w in only) and (d := distance(word, w, most)) is not None:
                found.append((w, d[1]))
        return found


def tokens(name: str) -> list[tuple[str, bool]]:
    """(word, whether a dot cuts it short)."""
    return [(m[1], bool(m[2])) for m in TOKEN.finditer(fold(name))]


class NameIndex:
    """A bounded block of reference entries: (id, title, aliases, former titles)."""

    def __init__(self, entries: list[tuple[str, str | None, list, list]], vocabulary: set[str], fillers: frozenset[str] = FILLERS) -> None:
        self.fillers = fillers
        #: key -> ids; keys are the words of a title, alias or former title, the last of least rank
        self.keys: dict[tuple[str, ...], dict[str, float]] = defaultdict(dict)
        for ident, title, aliases, former in entries:
            for rank, forms in ((0.0, [title]), (0.001, aliases or []), (0.002, former or [])):
                for form in forms:
                    if form and (k := tuple(w for w, _ in tokens(form))):
                        self.keys[k][ident] = min(rank, self.keys[k].get(ident, 9.0))
        self.vocabulary = vocabulary
        own = {w for k in self.keys for w in k}
        self.words = SymmetricDelete({w for w in own if not any(c.isdigit() for c in w)})
        self.own = own
        self.sorted = sorted(own)
        self.by_word: dict[str, list[tuple[str, ...]]] = defaultdict(list)
        self.joined: dict[str, list[tuple[str, ...]]] = defaultdict(list)
        for k in self.keys:
            for w in set(k):
                self.by_word[w].append(k)
            self.joined["".join(k)].append(k)
        self.whole = SymmetricDelete({j for j in self.joined if not any(c.isdigit() for c in j)})
        self.options = lru_cache(200_000)(self._options)

    def filler(self, word: str, cut: bool) -> float | None:
        """Cost of leaving a word out, None if it says something; only the listed words, their plurals and, before a dot, their beginnings."""
        if word in self.fillers or word == "s":
            return 0.02
        if word.endswith("s") and word[:-1] in self.fillers:
            return 0.05
        if cut and len(word) >= 3 and any(f.startswith(word) for f in self.fillers):
            return 0.1
        return None

    @staticmethod
    def singular(word: str) -> Iterator[str]:
        for end, new in (("ies", "y"), ("es", ""), ("s", "")):
            if word.endswith(end) and len(word) > len(end) + 2:
                yield word[: -len(end)] + new

    def _options(self, word: str, cut: bool) -> tuple[tuple[str, float], ...]:
        """Words of the list that a typed word may mean, with costs; a known word means itself."""
        if word in self.vocabulary:
            return ((word, 0.0),) if word in self.own else ()
        if any(c.isdigit() for c in word):
            return ()
        best: dict[str, float] = {}

        def offer(w: str, cost: float) -> None:
            if cost < best.get(w, 9.0):
                best[w] = cost

        for s in self.singular(word):
            if s in self.vocabulary:
                return ((s, 0.1),) if s in self.own else ()
        for base, extra in [(word, 0.0), *((s, 0.1) for s in self.singular(word))]:
            for w, d in self.words.near(base, edits_allowed(len(base))):
                offer(w, d + extra)
        if cut and len(word) >= 2 or len(word) >= 4:
            for w in self.starting(word):
                if len(w) > len(word):
                    offer(w, 0.3 if cut else 0.5)
        if cut and len(word) >= 4:
            for w in self.starting(word[0]):
                if len(w) > len(word) and not w.startswith(word):
                    for n in (len(word) - 1, len(word), len(word) + 1):
                        if d := distance(word, w[:n], 1):
                            offer(w, 0.3 + d[1])
        return tuple(sorted(best.items(), key=lambda x: (x[1], x[0])))

    def starting(self, beginning: str) -> Iterator[str]:
        """Words of the list with this beginning."""
        k = bisect_left(self.sorted, beginning)
        while k < len(self.sorted) and self.sorted[k].startswith(beginning):
            yield self.sorted[k]
            k += 1

    def match(self, name: str | None) -> tuple[list[str], float]:
        """Ids of the entries meant, all of equal cost, and that cost; none if the name means no entry."""
        found = self.match_words(tokens(name or ""))
        if not found[0] and name and (parted := HUMP.sub(" ", name)) != name:
            found = self.match_words(tokens(parted))
        return found

    def match_words(self, typed: list[tuple[str, bool]]) -> tuple[list[str], float]:
        key = tuple(w for w, _ in typed)
        if key in self.keys:
            return self.best({key: 0.0})
        skip = [self.filler(w, c) for w, c in typed]
        if all(x is not None for x in skip):
            joined = "".join(w for w, _ in typed)
            return (self.best({k: 0.0 for k in self.joined.get(joined, ())}) if joined else ([], 0.0))
        found: dict[tuple[str, ...], float] = {}
        options = [self.options(w, c) for w, c in typed]
        for k in {k for o in options for w, _ in o for k in self.by_word[w]}:
            cost = self.assign(k, typed, options, skip)
            if cost is not None:
                found[k] = cost
        if not found or min(found.values()) > 0.1:
            kept = [w for (w, _), s in zip(typed, skip) if s is None]
            for words in (kept, [w for w, _ in typed]):
                self.blanks_moved(words, found)
        return self.best(found)

    def assign(self, key: tuple[str, ...], typed: list, options: list, skip: list) -> float | None:
        """Least cost of giving each word of the key its own typed word; what is left over must be filler."""
        n = len(key)
        if len(typed) < n or sum(s is None for s in skip) > n:
            return None
        best = [math.inf]

        def place(i: int, used: int, cost: float, order: list[int]) -> None:
            if cost >= best[0]:
                return
            if i == n:
                for t, s in enumerate(skip):
                    if not used >> t & 1:
                        if s is None:
                            return
                        cost += s
                if order != sorted(order):
                    cost += 0.02
                best[0] = min(best[0], cost)
                return
            for t, o in enumerate(options):
                if not used >> t & 1:
                    for w, c in o:
                        if w == key[i]:
                            place(i + 1, used | 1 << t, cost + c, [*order, t])

        place(0, 0, 0.0, [])
        return best[0] if best[0] < math.inf else None

    def blanks_moved(self, words: list[str], found: dict[tuple[str, ...], float]) -> None:
        """Keys equal to the typed words once blanks are left out, up to slips and a plural."""
        joined = "".join(words)
        if not joined:
            return
        known = {w for w in words if w in self.vocabulary}
        only = None
        if known:
            only = {"".join(k) for k in set.intersection(*(set(self.by_word.get(w, ())) for w in known))}

        def offer(j: str, cost: float) -> None:
            for k in self.joined.get(j, ()):
                if known <= set(k) and cost < found.get(k, 9.0):
                    found[k] = cost

        if joined in self.joined:
            for k in self.joined[joined]:
                found[k] = min(found.get(k, 9.0), 0.01)
            return
        for f in self.fillers:
            if len(f) > 2 and len(joined) > len(f) + 3:
                if joined.endswith(f):
                    offer(joined[: -len(f)], 0.02)
                if joined.startswith(f):
                    offer(joined[len(f) :], 0.02)
        if len(known) == len(words) or any(c.isdigit() for c in joined):
            return
        for s in self.singular(joined):
            offer(s, 0.15)
        for base, extra in [(joined, 0.05), *((s, 0.15) for s in self.singular(joined))]:
            for j, d in self.whole.near(base, edits_allowed(len(base)), only):
                offer(j, d + extra)

    def best(self, found: dict[tuple[str, ...], float]) -> tuple[list[str], float]:
        ids: dict[str, float] = {}
        for k, cost in found.items():
            for ident, rank in self.keys[k].items():
                ids[ident] = min(ids.get(ident, 9.0), cost + rank)
        if not ids:
            return [], 0.0
        least = min(ids.values())
        return sorted(i for i, c in ids.items() if c <= least + 1e-9), least


def map_to_canonical(names: DataFrame, reference: DataFrame, key: str = "candidate_no", name: str = "candidate_name", fillers: frozenset[str] = FILLERS) -> DataFrame:
    """(key, name, internal_id, cost): one row for each key; internal_id is the entry meant or 'unmatched'.

    ``reference`` has internal_id, title, aliases, title_history. A name is matched by whole words, each
    exact, in the plural, cut short or within one slip (two from eight letters on), in any order, the words of ``fillers``
    aside, or with its blanks left out or put in; a name that is a key of the list means that key. Null, blank and filler names and names with a further word
    are unmatched (cost null). Of several entries at the same cost the one most often named exactly in these rows
    wins, then the smallest id. Keys delivered twice count once, null keys are left out, further columns
    are ignored; an empty reference list leaves every name unmatched.
    """
    rows = names.select(F.col(key).alias("key"), F.col(name).alias("name")).filter("key is not null").distinct()
    typed = rows.filter("name is not null").groupBy("name").agg(F.count("*").alias("n"))
    ref = reference.select("internal_id", "title", "aliases", "title_history").filter("internal_id is not null").distinct()
    blocks = max(1, math.ceil(ref.count() / ENTRY_BLOCK))
    parts = [[tuple(r) for r in ref.filter(F.pmod(F.xxhash64("internal_id"), F.lit(blocks)) == b).collect()] for b in range(blocks)]
    vocabulary = {w for part in parts for _, t, a, h in part for f in (t, *(a or []), *(h or [])) if f for w, _ in tokens(f)}
    # a name takes a millisecond, so few bytes are much work: as many parts as there are for a shuffle, not coalesced
    # (by a hash of the name: a repartition by the name itself would fold into that of the aggregation)
    typed = typed.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("name"))
    out = None
    for part in parts:
        found = typed.mapInArrow(_matcher(sorted(part, key=lambda r: r[0]), vocabulary, fillers), "name string, n long, ids array<string>, cost double")
        out = found if out is None else out.unionByName(found)
    # cut, or the names would be matched once for their entries and once for the ranks of these
    out = cut(out)
    # blocks meet: the least cost of a name, with all its entries
    one = out.select("name", "n", "cost", F.explode("ids").alias("internal_id"))
    if blocks > 1:
        least = one.groupBy("name").agg(F.min("cost").alias("least"))
        one = one.join(least, "name").filter("cost <= least + 1e-9").drop("least")
    said = one.filter("cost < 0.003").groupBy("internal_id").agg(F.sum("n").alias("said"))
    ranked = one.join(said, "internal_id", "left").groupBy("name").agg(F.min(F.struct((-F.coalesce("said", F.lit(0))).alias("s"), "internal_id", "cost")).alias("b"))
    best = ranked.select("name", "b.internal_id", "b.cost")
    return rows.join(best, "name", "left").select(F.col("key").alias(key), F.col("name").alias(name), F.coalesce("internal_id", F.lit(UNMATCHED)).alias("internal_id"), "cost")


def _matcher(entries: list, vocabulary: set[str], fillers: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for b in batches:
            index = index or NameIndex(entries, vocabulary, fillers)
            got = [index.match(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got], pa.float64())], names=["name", "n", "ids", "cost"]
            )

    return run
