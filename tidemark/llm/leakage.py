"""Passages of test items in a corpus, by greedy string tiling.

Texts are brought to their consistent form, lower-cased and cut into words; words
become 64-bit hashes and runs of words Karp-Rabin fingerprints. Items and documents
meet where they share a fingerprint (the seeds). Then tiles are laid: again and again
the longest run that both share and that no tile covers yet is marked, until none of at
least ``min_words`` is left. Tiles may stand in any order, so an item is covered
also by a document that has its passages reordered; the covered share decides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm import canonical
from tidemark.operators.skew import join_by_key
from tidemark.session import cut_lineage

#: The items' seeds are broadcast up to so many (8 bytes each, and 8 for each word); more are joined by shuffle.
MOST_BROADCAST = 2_000_000
#: Fixed value: an odd 64-bit base for the fingerprints.
BASE = np.uint64(0x9E3779B97F4A7C15)
TILES = "n_tiles int, longest int, covered_words int, item_words int"


#: Letters that a letter drawn like one case of theirs and another drawn like the other make one: Greek nu is
#: drawn like a small v and a capital N, palochka like a small l and a capital I.
JOINED, JOINED_AS = "vl", "ni"


def words_sql(table: str, column: str) -> str:
    """DuckDB SQL for the word hashes of ``column`` of ``table``, as a list ``w``; a word is an unbroken run of letters, their marks, and digits.

    Neither case nor look counts, so words are compared by the look of their capitals: a letter
    may be drawn like a Latin one in one case only (Cyrillic ve, ka, em, en, te), so the
    consistent form is taken before and after raising it.
    """
    shown = f"SELECT upper({canonical.sql(column)}) AS raised FROM {table}"
    key = f"translate(lower({canonical.look_sql('raised')}), '{JOINED}', '{JOINED_AS}')"
    return f"SELECT list_transform(regexp_extract_all({key}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: hash(w)) AS w FROM ({shown})"


def hashed_words(connection, batch) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of the column ``text`` of a table, and the offsets of its rows among them."""
    import pyarrow as pa

    connection.register("batch", batch)
    lists = connection.sql(f"SELECT coalesce(w, []) AS w FROM ({words_sql('batch', 'text')})").to_arrow_table().column(0).combine_chunks()
    connection.unregister("batch")
    lists = lists.cast(pa.large_list(pa.uint64()))
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def fingerprints(words: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of the run of ``size`` words from each word on; runs may cross rows, see :func:`inside`."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * BASE + words[i : i + n]
    return out


def inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """The row of each run of ``size`` words, -1 where it crosses into another row."""
    total = int(offsets[-1])
    n = max(0, total - size + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return np.where(row[:n] == row[size - 1 : size - 1 + n], row[:n], -1) if n else np.zeros(0, np.int64)


def _stretches(true: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], true.view(np.int8), [0]))))
    return zip(edges[::2], edges[1::2], strict=True)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shared_runs(a: np.ndarray, b: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in a, start in b and length of every longest run that both share, of at least ``min_words`` words.

    Only where runs begin is looked at: seeds, that is equal fingerprints, whose words before
    differ. So a text of one word repeated has as many candidates as it has runs, not
    as pairs of places. Lengths are found by bisection over sums that hold the
    fingerprint of any stretch.
    """
    fa, fb = fingerprints(a, min_words), fingerprints(b, min_words)
    none = np.zeros(0, np.int64)
    if not len(fa) or not len(fb):
        return none, none, none
    # Places by (seed, word before), both as ranks; the start of a text has a word before of its own.
    seeds, words = np.unique(fb), np.unique(b)
    seed_b, before_b = np.searchsorted(seeds, fb), np.concatenate(([len(words)], np.searchsorted(words, b[: len(fb) - 1])))
    seed_a = np.minimum(np.searchsorted(seeds, fa), len(seeds) - 1)
    known = seeds[seed_a] == fa
    before_a = np.minimum(np.searchsorted(words, a[: len(fa) - 1]), len(words) - 1)
    before_a = np.concatenate(([len(words) + 1], np.where(words[before_a] == a[: len(fa) - 1], before_a, len(words) + 1)))
    at = np.flatnonzero(known)
    if not len(at):
        return none, none, none
    many = len(words) + 2
    place = seed_b * many + before_b
    order = np.argsort(place, kind="stable")
    place = place[order]
    low, high = np.searchsorted(place, seed_a[at] * many), np.searchsorted(place, (seed_a[at] + 1) * many)
    same = seed_a[at] * many + before_a[at]
    low_same, high_same = np.searchsorted(place, same, "left"), np.searchsorted(place, same, "right")
    pairs = []
    for first, last in ((low, low_same), (high_same, high)):
        count = last - first
        i = np.repeat(at, count)
        j = order[np.repeat(first, count) + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)]
        pairs.append((i, j))
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    with np.errstate(over="ignore"):
        longest = max(len(a), len(b)) + 1
        up, down = _powers(int(BASE), longest), _powers(pow(int(BASE), -1, 1 << 64), longest)
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * down[: len(x)]))) for x in (a, b)]
        least, most = np.full(len(i), min_words, np.int64), np.minimum(len(a) - i, len(b) - j)
        while len(open_ := np.flatnonzero(least < most)):
            x, y = i[open_], j[open_]
            middle = (least[open_] + most[open_] + 1) // 2
            equal = (sums[0][x + middle] - sums[0][x]) * up[x] == (sums[1][y + middle] - sums[1][y]) * up[y]
            least[open_] = np.where(equal, middle, least[open_])
            most[open_] = np.where(equal, most[open_], middle - 1)
    return i, j, least


def tiles(a: np.ndarray, b: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (start in a, start in b, length), longest first.

    Equal lengths are taken in order of their starts. A run that a tile has
    cut into is split into what is left of it and waits its turn again.
    """
    heap: list[tuple[int, int, int]] = []
    for i, j, length in zip(*(x.tolist() for x in shared_runs(a, b, min_words)), strict=True):
        equal = a[i : i + length] == b[j : j + length]
        if equal.all():
            heap.append((-length, i, j))
        else:  # fingerprints that are equal by chance
            heap.extend((-int(y - x), i + int(x), j + int(x)) for x, y in _stretches(equal) if y - x >= min_words)
    heapq.heapify(heap)
    in_a, in_b, out = np.zeros(len(a), bool), np.zeros(len(b), bool), []
    room = min(len(a), len(b))
    while heap and room >= min_words:
        length, i, j = heapq.heappop(heap)
        free = ~(in_a[i : i - length] | in_b[j : j - length])
        if free.all():
            in_a[i : i - length] = in_b[j : j - length] = True
            room = min(room, len(a) - int(in_a.sum()), len(b) - int(in_b.sum()))
            out.append((i, j, -length))
            continue
        for s, e in _stretches(free):
            if e - s >= min_words:
                heapq.heappush(heap, (-int(e - s), i + int(s), j + int(s)))
    return out


class Items:
    """The test items as word hashes, with the fingerprints of all their runs in order."""

    def __init__(self, ids: list, words: np.ndarray, offsets: np.ndarray, min_words: int):
        self.ids, self.words, self.offsets, self.min_words = ids, words, offsets, min_words
        prints, rows = fingerprints(words, min_words), inside(offsets, min_words)
        real = rows >= 0
        at = np.flatnonzero(real)
        order = np.argsort(prints[at], kind="stable")
        self.prints, self.rows, self.starts = prints[at][order], rows[at][order], (at - offsets[rows[at]])[order]

    def __len__(self) -> int:
        return len(self.prints)

    def of(self, row: int) -> np.ndarray:
        return self.words[self.offsets[row] : self.offsets[row + 1]]

    def tiled(self, words: np.ndarray, found: np.ndarray, min_coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(item row, tiles, longest, covered, item's words) for each item that shares a seed; found: the document's seeds.

        The words that an item's shared seeds span are the most that tiles can
        cover, so items short of the share by that count are not tiled.
        """
        spans: dict[int, set[int]] = {}
        for f in np.unique(found):
            lo, hi = np.searchsorted(self.prints, f, "left"), np.searchsorted(self.prints, f, "right")
            for k in range(lo, hi):
                spans.setdefault(int(self.rows[k]), set()).add(int(self.starts[k]))
        for row, starts in sorted(spans.items()):
            item = self.of(row)
            if min_coverage > 0:
                reach = np.zeros(len(item), bool)
                for s in starts:
                    reach[s : s + self.min_words] = True
                if reach.sum() < min_coverage * len(item):
                    continue
            laid = tiles(words, item, self.min_words)
            covered = sum(t[2] for t in laid)
            if laid and covered >= min_coverage * len(item):
                yield row, len(laid), laid[0][2], covered, len(item)


def _connection():
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})


def _narrow(df: DataFrame, id_: str, text: str, name: str) -> DataFrame:
    return df.select(F.col(id_).alias(name), F.col(text).alias("text")).filter(F.col(name).isNotNull() & (F.length("text") > 0))


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, min_words: int = 12, min_coverage: float = 0.0, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``doc_id, item_id, n_tiles, longest, covered_words, item_words`` of every document and item that share tiles.

    A pair is reported if a run of at least ``min_words`` words is shared and the
    tiles cover ``min_coverage`` of the item. Items with fewer words than that
    can't be found. Null ids and null or empty texts have no part in it;
    repeated rows count once. Documents are read once, in place, against the
    broadcast items; if the items have more than ``most_broadcast`` runs, runs
    are joined by shuffle and only candidate pairs are tiled.
    """
    questions = _narrow(items, item_id, item_text, "item_id").distinct()
    corpus = _narrow(docs, doc_id, text, "doc_id")
    runs = questions.select(F.sum(F.greatest(F.lit(0), F.length("text"))).alias("n")).first().n or 0
    if runs <= 2 * most_broadcast:  # a word and what follows it are two characters at least
        found = _broadcast(corpus, questions, min_words, min_coverage)
    else:
        found = _shuffled(corpus, questions, min_words, min_coverage)
    return found.dropDuplicates(["doc_id", "item_id"])


def _schema(docs: DataFrame, items: DataFrame) -> T.StructType:
    counts = [T.StructField(n, T.IntegerType()) for n in ("n_tiles", "longest", "covered_words", "item_words")]
    return T.StructType([docs.schema["doc_id"], items.schema["item_id"], *counts])


def _broadcast(corpus: DataFrame, questions: DataFrame, min_words: int, min_coverage: float) -> DataFrame:
    import pyarrow as pa

    table = questions.orderBy("item_id", "text").toArrow()  # of bounded size, see leaks()
    words, offsets = hashed_words(_connection(), table)
    known = corpus.sparkSession.sparkContext.broadcast(Items(table.column("item_id").to_pylist(), words, offsets, min_words))
    schema = _schema(corpus, questions)

    def work(batches: Iterator) -> Iterator:
        from pyspark.sql.pandas.types import to_arrow_schema

        items, con, wanted = known.value, _connection(), to_arrow_schema(schema)
        for batch in batches:
            words, offsets = hashed_words(con, pa.Table.from_batches([batch]))
            prints, rows = fingerprints(words, min_words), inside(offsets, min_words)
            at = np.searchsorted(items.prints, prints)
            at[at == len(items)] = 0
            hits = np.flatnonzero((items.prints[at] == prints) & (rows >= 0)) if len(items) else np.zeros(0, np.int64)
            ids, out = batch.column(0), []
            for row in np.unique(rows[hits]):
                document = words[offsets[row] : offsets[row + 1]]
                for item, *counts in items.tiled(document, prints[hits[rows[hits] == row]], min_coverage):
                    out.append((ids[int(row)].as_py(), items.ids[item], *counts))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), wanted, strict=True)], schema=wanted)

    return corpus.mapInArrow(work, schema)


#: The filter over the items' runs has so many bits, a power of two, and is broadcast as 16 MB whatever their number.
FILTER_BITS = 1 << 27


def _bits(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each fingerprint in the filter."""
    u, mask = runs.view(np.uint64), np.uint64(FILTER_BITS - 1)
    return (u & mask).astype(np.int64), ((u >> np.uint64(32)) & mask).astype(np.int64)


def run_filter(runs: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``run`` in 64-bit words, put together by partial aggregation. With ever more runs it lets more pass, which costs time but no result."""
    mask = FILTER_BITS - 1
    bits = runs.select(F.explode(F.array(F.col("run").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("run", 32).bitwiseAND(F.lit(mask)))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _runs(df: DataFrame, name: str, min_words: int, known: np.ndarray | None = None) -> DataFrame:
    """``name, run``: the distinct fingerprints of each row, as signed numbers; with a filter, only those it lets pass."""
    schema = T.StructType([df.schema[name], T.StructField("run", T.LongType())])
    shared = None if known is None else df.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        con = _connection()
        for batch in batches:
            words, offsets = hashed_words(con, pa.Table.from_batches([batch]))
            prints, rows = fingerprints(words, min_words), inside(offsets, min_words)
            at = np.flatnonzero(rows >= 0)
            if shared is not None:
                first, second = (shared.value[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) for bit in _bits(prints[at]))
                at = at[(first & second) == 1]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[at])), pa.array(prints[at].view(np.int64))], names=[name, "run"])

    return df.select(name, "text").mapInArrow(work, schema).distinct()


def _shuffled(corpus: DataFrame, questions: DataFrame, min_words: int, min_coverage: float) -> DataFrame:
    """The same result without the items in memory: runs that a filter of the items' runs lets pass are joined, hot runs apart, and candidates tiled pair by pair."""
    asked = cut_lineage(_runs(questions, "item_id", min_words))
    pairs = join_by_key(_runs(corpus, "doc_id", min_words, run_filter(asked)), asked, "run", 0.001).select("doc_id", "item_id").distinct()
    both = pairs.join(corpus, "doc_id").join(questions.withColumnRenamed("text", "item_text"), "item_id").select("doc_id", "item_id", "text", "item_text")
    schema = _schema(corpus, questions)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        con, wanted = _connection(), to_arrow_schema(schema)
        for batch in batches:
            a, at_a = hashed_words(con, pa.table({"text": batch.column(2)}))
            b, at_b = hashed_words(con, pa.table({"text": batch.column(3)}))
            out = []
            for k in range(batch.num_rows):
                item = b[at_b[k] : at_b[k + 1]]
                laid = tiles(a[at_a[k] : at_a[k + 1]], item, min_words)
                covered = sum(t[2] for t in laid)
                if laid and covered >= min_coverage * len(item):
                    out.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), len(laid), laid[0][2], covered, len(item)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), wanted, strict=True)], schema=wanted)

    return both.mapInArrow(work, schema)
