"""Sources mixed to target shares of all tokens.

Equal texts count as one document that belongs to every source holding it. Documents are aggregated by
membership pattern; a min-cost flow routes the tokens of each pattern to the quotas of its sources, every
further use of a pattern costing more than the one before. Documents are then drawn in a seeded order:
their tokens, laid end to end once a use, are divided among the sources at the points the flow gives.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kstate.runtime import cut

#: Public byte-level BPE vocabulary as ranks; a parameter wherever tokens are counted.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that vocabulary splits text by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Membership patterns the flow takes at most; k sources allow 2^k - 1 of them, so their number is checked before they are collected.
MOST_PATTERNS = 20_000
#: Parts of a pattern whose token sums are taken apart, so that no pattern meets in one task.
PARTS = 256


def count_tokens(df: DataFrame, text: str, keep: list[str], out: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """The columns ``keep`` and the number of tokens of the whole text; null counts as 0. The vocabulary is read on the driver."""
    d = df.select(*keep, text)
    with open(tokenizer, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(bpe.encode_ordinary(x)) if x else 0 for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[: len(keep)])
    return d.mapInArrow(run, f"{schema}, `{out}` long")


def min_cost_flow(arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of the cheapest largest flow, by successive shortest paths."""
    n = max(max(a, b) for a, b, _, _ in arcs) + 1
    to, cap, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, c, w in arcs:
        for x, y, k, v in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            cap.append(k)
            cost.append(v)
    height = [0] * n
    while True:
        dist: list[float] = [float("inf")] * n
        via = [-1] * n
        dist[source] = 0
        heap = [(0.0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in out[u]:
                if cap[e] and (nd := d + cost[e] + height[u] - height[to[e]]) < dist[to[e]]:
                    dist[to[e]], via[to[e]] = nd, e
                    heapq.heappush(heap, (nd, to[e]))
        if via[sink] < 0:
            return [cap[2 * i + 1] for i in range(len(arcs))]
        height = [h + (d if d < float("inf") else 0) for h, d in zip(height, dist)]
        push, v = float("inf"), sink
        while v != source:
            push, v = min(push, cap[via[v]]), to[via[v] ^ 1]
        v = sink
        while v != source:
            cap[via[v]] -= push
            cap[via[v] ^ 1] += push
            v = to[via[v] ^ 1]


def route(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: dict[str, int]) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens each pattern gives to each of its sources."""
    names, keys = sorted(quotas), sorted(patterns)
    node = {k: 1 + i for i, k in enumerate([*keys, *names])}
    sink = len(node) + 1
    arcs: list[tuple[int, int, int, int]] = []
    where: dict[tuple[tuple[str, ...], str], int] = {}
    for k in keys:
        for use in range(1, sum(repeats[s] for s in k) + 1):
            arcs.append((0, node[k], patterns[k], use * use))
        for s in k:
            where[k, s] = len(arcs)
            arcs.append((node[k], node[s], patterns[k] * repeats[s], 0))
    for s in names:
        arcs.append((node[s], sink, quotas[s], 0))
    flow = min_cost_flow(arcs, 0, sink)
    return {w: flow[i] for w, i in where.items() if flow[i]}


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, doc_id, uses, tokens): how often each chosen document is used for each source.

    ``targets`` has source, target_share, max_repeat; two different rows for one source are an error. The flow runs on the
    driver over the membership patterns: there can be 2^k - 1 of k sources and no more than documents, in practice far
    fewer; above MOST_PATTERNS it is an error, raised before they are collected. The mix aims at ``total_tokens``, by default the tokens of all distinct texts of the sources; each source gets its share of
    that, less what its documents cannot give when each is used max_repeat times. Shares are met to within a
    document for each pattern. Null or empty texts, other and null sources take no part; of equal texts the
    smallest doc_id stands for all; sources without documents get nothing; further columns are ignored.
    """
    rows = targets.filter("source is not null").select("source", "target_share", "max_repeat").distinct().limit(MOST_PATTERNS + 1).collect()
    want = {r.source: (float(r.target_share or 0), int(r.max_repeat or 0)) for r in rows}
    if len(want) < len(rows) or len(rows) > MOST_PATTERNS:
        raise ValueError("mix: two target rows for one source, or too many sources")
    docs = documents.filter(F.col("source").isin(sorted(want))).select("doc_id", "source", "text").filter("length(text) > 0")
    docs = count_tokens(docs.withColumn("same", F.unhex(F.md5("text"))), "text", ["doc_id", "source", "same"], tokenizer=tokenizer)
    whole = docs.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"), F.sort_array(F.collect_set("source")).alias("pattern"))
    whole = cut(whole.filter("tokens > 0").withColumn("at", F.xxhash64("same", F.lit(seed))).withColumn("part", F.pmod(F.shiftright("at", 40), F.lit(PARTS)).cast("int")))
    parts = whole.groupBy("pattern", "part").agg(F.sum("tokens").alias("sum"))
    known = parts.groupBy("pattern").agg(F.sum("sum").alias("t")).limit(MOST_PATTERNS + 1).collect()
    if len(known) > MOST_PATTERNS:
        raise ValueError(f"mix: more than {MOST_PATTERNS} membership patterns")
    sums = {tuple(r.pattern): r.t for r in known}
    total = sum(sums.values()) if total_tokens is None else total_tokens
    quotas = {s: int(share * total) for s, (share, _) in want.items()}
    flow = route(sums, quotas, {s: n for s, (_, n) in want.items()}) if sums else {}
    stretches, at = [], {}
    for (k, s), f in sorted(flow.items()):
        stretches.append((list(k), s, at.get(k, 0), at.get(k, 0) + f, sums[k]))
        at[k] = at.get(k, 0) + f
    how = documents.sparkSession.createDataFrame(stretches, "pattern array<string>, source string, lo long, hi long, all long")
    before = parts.withColumn("off", F.sum("sum").over(Window.partitionBy("pattern").orderBy("part")) - F.col("sum")).drop("sum")
    own = Window.partitionBy("pattern", "part").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = whole.withColumn("upto", F.sum("tokens").over(own)).join(before, ["pattern", "part"])
    placed = placed.withColumn("place", F.col("off") + F.col("upto") - F.col("tokens"))
    # uses of a document whose place, counted on through all uses of the pattern, falls into the source's stretch
    hits = lambda x: F.ceil((x - F.col("place")) / F.col("all"))
    # one row a pattern and source: MOST_PATTERNS bounds what is broadcast
    chosen = placed.join(F.broadcast(how), "pattern").withColumn("uses", F.greatest(hits(F.col("hi")), F.lit(0)) - F.greatest(hits(F.col("lo")), F.lit(0)))
    return chosen.filter("uses > 0").select("source", "doc_id", F.col("uses").cast("long").alias("uses"), "tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeat, documents, most_uses, tokens, share, gap): what each source really reached; gap is share - target_share."""
    got = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.max("uses").alias("most_uses"), F.sum(F.col("uses") * F.col("tokens")).alias("tokens"))
    out = targets.select("source", "target_share", "max_repeat").distinct().join(got, "source", "left").na.fill(0, ["documents", "most_uses", "tokens"])
    # one row a source: the sum over all is one task of a few rows
    out = out.withColumn("share", F.coalesce(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), F.lit(0.0)))
    return out.withColumn("gap", F.col("share") - F.col("target_share"))
