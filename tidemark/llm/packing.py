"""Texts of varying length in containers of fixed capacity, with little room unused.

The pattern of a container is how many texts of each length it holds. How often to use
which pattern is the configuration linear program over the histogram of lengths, which
is solved by multiplicative weights: lengths that are covered already weigh less, and
a knapsack by dynamic programming prices the best pattern for the current weights. The
same prices are a solution of the dual program, so every round also gives a number of
containers that no packing can go below. The multiplicities are rounded down; patterns
may be used once more in the order of what that cut off, as long as their texts are there;
what is left is filled up largest first. Of these roundings, and filling alone, the one with
the fewest containers is taken.

The histogram has at most as many entries as the capacity, so the program doesn't grow
with the corpus. Documents get their container without meeting in one task: they are
ranked within their length and a salt, and a rank names a place in a pattern.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.session import cut_lineage, shuffle_width

CAPACITY = 2048
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    import base64

    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def lengths(df: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, tokens`` of every text, whole; null and empty texts have 0."""
    kind = df.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("tokens", T.LongType())])

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "tokens"])

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, schema)


class Plan:
    """How often each pattern is used. ``patterns``: (lengths, counts, uses) in the order of their containers."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, epsilon: float = 0.1, rounds: int = 60):
        if any(not 0 < n <= capacity for n in histogram):
            raise ValueError("every length must be within the capacity")
        self.capacity = capacity
        self.patterns: list[tuple[np.ndarray, np.ndarray, int]] = []
        demand = np.zeros(capacity + 1, dtype=np.int64)
        for n, many in histogram.items():
            demand[n] = many
        if demand[capacity]:
            self._use(np.array([capacity]), np.array([1]), int(demand[capacity]))
            demand[capacity] = 0
        self.tokens = int(sum(n * many for n, many in histogram.items()))
        whole = int(sum(uses for _, _, uses in self.patterns))
        found = self._fractional(demand, epsilon, rounds)
        #: No packing has fewer containers.
        self.bound = whole + math.ceil(max(self._dual, self._step_prices(demand)) - 1e-6)
        roundings = [self._rounded(demand, found, cut_off) for cut_off in (True, False)] + [self._rounded(demand, [], False)]
        #: ``by_program``: the texts that are in patterns of the program; the others are filled in.
        patterns, self.by_program = min(roundings, key=lambda r: sum(uses for _, _, uses in r[0]))
        self.patterns += patterns
        self.containers = sum(uses for _, _, uses in self.patterns)

    def _rounded(self, demand: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, float]], cut_off: bool) -> tuple[list[tuple[np.ndarray, np.ndarray, int]], int]:
        """Whole uses of the patterns, with ``cut_off`` also once more of those that rounding down cut most off, and containers filled with what is left."""
        left, out, texts = demand.copy(), [], 0
        for once_more in (False, True)[: 1 + cut_off]:
            for sizes, counts, uses in sorted(found, key=lambda p: p[2] - math.floor(p[2]), reverse=True):
                times = int(min(math.ceil(uses - math.floor(uses)) if once_more else math.floor(uses), *(left[sizes] // counts)))
                if times:
                    out.append((sizes.astype(np.int64), counts.astype(np.int64), times))
                    left[sizes] -= counts * times
                    texts += times * int(counts.sum())
        return out + self._filled(left), texts

    def _step_prices(self, demand: np.ndarray) -> float:
        """The most of the dual program by prices in steps of 1/k, which are known to let no pattern be worth more than a container; of 1/1, those of the volume and of texts over half a container."""
        sizes = np.flatnonzero(demand)
        best = float(sizes @ demand[sizes]) / self.capacity
        for k in range(1, 65):
            steps = (k + 1) * sizes
            prices = np.where(steps % self.capacity == 0, sizes / self.capacity, (steps // self.capacity) / k)
            best = max(best, float(prices @ demand[sizes]))
        return best

    def _use(self, sizes: np.ndarray, counts: np.ndarray, uses: int) -> None:
        self.patterns.append((sizes.astype(np.int64), counts.astype(np.int64), uses))

    def _price(self, sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The knapsack for several weights at once: the most value within each room, and the index of an item to take for it, or -1.

        values: one row an item, one column a set of weights; so are the results, one row a room.
        """
        tables = values.shape[1]
        best, take = np.zeros((self.capacity + 1, tables)), np.full((self.capacity + 1, tables), -1)
        upto, every = np.searchsorted(sizes, np.arange(self.capacity + 1), side="right"), np.arange(tables)
        for room in range(1, self.capacity + 1):
            k = upto[room]
            best[room] = best[room - 1]
            if k:
                worth = best[room - sizes[:k]] + values[:k]
                i = worth.argmax(axis=0)
                top = worth[i, every]
                more = top > best[room]
                best[room, more], take[room, more] = top[more], i[more]
        return best, take

    def _pattern(self, first: int, names: np.ndarray, sizes: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The length ``first`` and the best of the room beside it; item i of ``take`` is the length ``names[i]``."""
        items, room = [first], self.capacity - int(sizes[first])
        while room > 0:
            i = int(take[room])
            if i < 0:
                room -= 1
            else:
                items.append(int(names[i]))
                room -= int(sizes[names[i]])
        return np.unique(np.array(items), return_counts=True)

    def _fractional(self, demand: np.ndarray, epsilon: float, rounds: int, tables: int = 8, around: int = 192) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Patterns and their uses, covering each length at most once over.

        The weight of a length falls with the share of it that is covered. A
        round prices ``tables`` slightly perturbed copies of the weights at once,
        so that equally good patterns take turns, and completes each into the best
        patterns around ``around`` lengths still to be covered, the least covered and
        longest first. Patterns within 1 - epsilon of the best under the weights
        as they are by then are used, each so far that it covers no length by
        more than epsilon of its demand, or one text. Lengths too rare to be
        repeated in a container come in as the length a pattern is built around.
        """
        sizes, self._dual = np.flatnonzero(demand), 0.0
        if not len(sizes):
            return []
        random = np.random.default_rng(1)  # ties only; the plan is the same in every run
        wanted = demand[sizes].astype(float)
        left, uses = wanted.copy(), {}
        volume = float(sizes @ wanted)
        weigh = lambda i: sizes[i] * np.exp(left[i] / wanted[i] - 1)
        for _ in range(rounds):
            open_ = np.flatnonzero(left > 1e-9)
            before = float(sizes @ left)
            if before < 0.01 * volume:
                break
            names = open_[left[open_] >= np.minimum(self.capacity // sizes[open_], 8)]
            if not len(names):
                break
            noise = 1 + 0.02 * random.random((len(names), tables))
            values = weigh(names)[:, None] * noise
            best, take = self._price(sizes[names], values)
            # Prices divided by the worth of the best pattern let no pattern be worth more than one container.
            self._dual = max(self._dual, float((wanted[names] @ values / best[self.capacity]).max()))
            rank = np.lexsort((-sizes[open_], -np.round(left[open_] / wanted[open_], 1)))
            firsts = open_[rank[: tables * around]]
            for n, first in enumerate(firsts):
                table = n % tables
                items, counts = self._pattern(int(first), names, sizes, take[:, table])
                if float(counts @ weigh(items)) < (1 - epsilon) * best[self.capacity, table] / 1.02:
                    continue
                step = float(min((left[items] / counts).min(), (np.maximum(1, epsilon * wanted[items]) / counts).min()))
                if step <= 1e-9:
                    continue
                left[items] = np.maximum(0, left[items] - step * counts)
                known = (tuple(items), tuple(counts))
                uses[known] = uses.get(known, 0.0) + step
            if before - float(sizes @ left) < 0.001 * volume:
                break
        return [(sizes[list(items)], np.array(counts), many) for (items, counts), many in uses.items()]

    def _filled(self, demand: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Containers for what is left, largest first; equal containers are made at once."""
        left, out = demand.copy(), []
        while True:
            present = np.flatnonzero(left)
            if not len(present):
                return out
            room, chosen = self.capacity, {}
            while room > 0 and len(fit := present[: np.searchsorted(present, room, side="right")]):
                # Of the largest that fits, as many as there are and go in.
                size = int(fit[-1])
                many = min(int(left[size]), room // size)
                chosen[size] = many
                room -= size * many
                present = present[present < size]
            sizes, counts = np.array(list(chosen)), np.array(list(chosen.values()))
            uses = int((left[sizes] // counts).min())
            out.append((sizes.astype(np.int64), counts.astype(np.int64), uses))
            left[sizes] -= counts * uses

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted arrays of runs: length and first rank, how many ranks share a container, the run's first container."""
        runs, used, container = [], {}, 0
        for sizes, counts, uses in self.patterns:
            for size, many in zip(sizes.tolist(), counts.tolist(), strict=True):
                runs.append((size, used.get(size, 0), many, container))
                used[size] = used.get(size, 0) + many * uses
            container += uses
        runs.sort()
        return tuple(np.array(x, dtype=np.int64) for x in zip(*runs, strict=True)) if runs else tuple(np.zeros(0, np.int64) for _ in range(4))


def pieces(sized: DataFrame, capacity: int) -> DataFrame:
    """``doc_id, part, token_start, n_tokens``: texts beyond the capacity in full parts and a rest, all others whole."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity))).cast("int")
    split = sized.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    start = F.col("part").cast("bigint") * F.lit(capacity)
    return split.select("doc_id", "part", start.alias("token_start"), F.least(F.lit(capacity).cast("bigint"), F.col("tokens") - start).alias("n_tokens"))


def containers(df: DataFrame, doc_id: str, text: str, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, part, token_start, n_tokens, container_id``: every text's place.

    Container ids run from 0 without gaps. A text is split only if it alone
    exceeds the capacity, at multiples of it. Null and empty texts take no room
    and are in container 0. A repeated row is an item of its own. An empty table
    has no containers.
    """
    item = cut_lineage(pieces(lengths(df, doc_id, text, vocabulary), capacity))
    counted = item.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n"))
    plan = Plan({r.n_tokens: r.n for r in counted.collect()}, capacity)  # at most `capacity` rows
    salts = max(8, shuffle_width(df.sparkSession))
    salted = item.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.lit(salts).cast("bigint")).cast("int"))
    inside = Window.partitionBy("n_tokens", "salt").orderBy("doc_id", "part")
    ranked = salted.withColumn("rank", F.row_number().over(inside).cast("bigint") - 1)
    sizes = salted.groupBy("n_tokens", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("n_tokens", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = ranked.join(offsets, ["n_tokens", "salt"]).select("doc_id", "part", "token_start", "n_tokens", (F.col("rank") + F.col("offset")).alias("rank"))
    runs = df.sparkSession.sparkContext.broadcast(plan.places())  # the patterns, whose number the rounds bound
    schema = T.StructType([*placed.schema.fields[:4], T.StructField("container_id", T.LongType())])

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        size, first, many, container = runs.value
        order = size * (1 << 48) + first
        for batch in batches:
            n, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            at = np.searchsorted(order, n * (1 << 48) + rank, side="right") - 1
            ids = np.zeros(len(n), np.int64)
            some = n > 0
            at = at[some]
            ids[some] = container[at] + (rank[some] - first[at]) // many[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids)], names=schema.names)

    return placed.mapInArrow(assign, schema)


def fill(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, the ``least`` containers any packing needs, by the dual program, the ``gap`` to it in per cent, and the share of room unused."""
    histogram = placed.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    least = Plan({r.n_tokens: r.n for r in histogram}, capacity).bound
    one = placed.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"))
    gap = F.round(100 * (F.col("containers") - F.lit(least)) / F.nullif(F.lit(least), F.lit(0)), 3)
    return one.withColumns({"least": F.lit(least), "gap": gap, "unused": F.round(1 - F.col("tokens") / F.nullif(F.col("containers") * F.lit(capacity), F.lit(0)), 6)})


def holds(placed: DataFrame, sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row on a packing of texts with distinct ids: ``documents`` placed, and how many containers are over full, ids are missing, texts lost or gained tokens, were split without need, or have parts apart from each other's ends; all but the first should be 0.

    sized: ``doc_id, tokens`` of every text, see :func:`lengths`.
    """
    room = placed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    rooms = room.agg(F.count_if(F.col("n") > capacity).alias("over_full"), (F.coalesce(F.max("container_id") + 1, F.lit(0)) - F.count(F.lit(1))).alias("ids_missing"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity)))
    of_each = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"))
    both = sized.join(of_each, "doc_id", "full_outer")
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    texts = both.agg(
        F.count("parts").alias("documents"), F.count_if(~same(F.col("n"), F.col("tokens"))).alias("tokens_changed"),
        F.count_if(~same(F.col("parts"), parts)).alias("split_needlessly"), F.count_if(~same(F.col("end"), F.col("tokens"))).alias("apart"),
    )
    of_rooms = [rooms.select(c).scalar().alias(c) for c in ("over_full", "ids_missing")]
    return texts.select("documents", *of_rooms, "tokens_changed", "split_needlessly", "apart")
