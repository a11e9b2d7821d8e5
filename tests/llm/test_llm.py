"""The text operators against plain Python and by their guarantees."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from verify import compare

from tidemark.llm import canonical, leakage, packing, queries


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


LOOK = str.maketrans("аеорсухіАВЕКМНОРСТΑΒΟο", "aeopcyxiABEKMHOPCTABOo")


def form(text):
    """A second way to the consistent form, for texts of the characters the tests use."""
    if text is None:
        return None
    shown = "".join(c for c in text if unicodedata.category(c) != "Cf")
    shown = "".join(" " if c == "\t" or unicodedata.category(c) == "Zs" else c for c in shown).replace("\r\n", "\n")
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", unicodedata.normalize("NFKC", shown)).translate(LOOK))


# Consistent forms.

SAME = [
    ("full width", "ｆｕｌｌ　ｗｉｄｔｈ"),
    ("café", "café"),
    ("zero", "ze​ro"),
    ("soft", "so­ft"),
    ("a b", "a b"),
    ("a b", "a b"),
    ("a b", "a\tb"),
    ("cope", "соре"),
    ("BETA", "ΒΕΤΑ"),
    ("file", "ﬁle"),
    ("Kelvin", "Kelvin"),
    ("ё", "ë"),
    ("áb", "а‍́b"),
    ("x\ny", "x\r\ny"),
    ("ế", "ế"),
    ("ệ", "ệ"),
]
DIFFERENT = [("Case", "case"), ("café", "cafe"), ("a.", "a,"), ("a b", "ab"), ("a  b", "a b"), ("a\nb", "a b"), ("x2", "x²"), ("O0", "0O"), ("l1", "1l"), ("ä", "a")]


def canon(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.canonical for r in canonical.canonical(df, "text").orderBy("i").collect()]


def test_forms(spark):
    pairs = SAME + DIFFERENT
    got = canon(spark, [t for p in pairs for t in p])
    for k, (a, b) in enumerate(pairs):
        assert (got[2 * k] == got[2 * k + 1]) == (k < len(SAME)), (a, b, got[2 * k], got[2 * k + 1])
    assert canon(spark, got) == got


def test_forms_of_canonically_equivalent_spellings(spark):
    singles = sorted([*canonical.tables()["several"], "\u1fcb", "\u1fdb"])  # the last two become accented capitals by NFC
    spelled = [(c, unicodedata.normalize("NFD", c), unicodedata.normalize("NFD", c)[:1] + "\u200d" + unicodedata.normalize("NFD", c)[1:]) for c in singles]
    texts = [f"a{x}b" for three in spelled for x in three]
    got = canon(spark, texts)
    assert [t for i, t in enumerate(texts) if got[i] != got[i - i % 3]] == []
    assert canon(spark, got) == got
    assert got[texts.index("a\u0443\u0306b")] == "ay\u0306b"


def test_look_alikes_in_both_cases(spark):
    pairs = [("\u051b\u051d\u04af", "qwy"), ("\u051a\u051c\u04ae", "QWY"), ("\u04c0", "I"), ("\u04cf", "l"), ("\u03f2\u03f3", "cj"), ("\u03f9\u037f", "CJ")]
    assert canon(spark, [a for a, _ in pairs]) == [b for _, b in pairs]


def test_null_empty_long_and_clashing_columns(spark):
    assert canon(spark, [None, "", "​", "ａ" * 300_000]) == [None, "", "", "a" * 300_000]
    df = spark.createDataFrame([(1, "ｘ", "old", 2)], "`a b` int, text string, canonical string, batch int")
    assert rows(canonical.canonical(df, "text")) == [(1, "ｘ", 2, "x")]
    assert canonical.canonical(df.limit(0), "text").count() == 0


def test_forms_of_the_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.canonical for r in canonical.canonical(docs, "text").collect()}
    groups, expected = defaultdict(set), defaultdict(set)
    full = str.maketrans(canonical.CYRILLIC + canonical.GREEK, canonical.CYRILLIC_AS + canonical.GREEK_AS)
    for r in docs.collect():
        groups[got[r.doc_id]].add(r.doc_id)
        shown = "".join(c for c in r.text if unicodedata.category(c) != "Cf")
        shown = "".join(" " if c == "\t" or unicodedata.category(c) == "Zs" else c for c in shown).replace("\r\n", "\n")
        nfkd = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", shown)).translate(full)
        expected[unicodedata.normalize("NFC", nfkd)].add(r.doc_id)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_look_alikes_pair_texts_not_copies(spark):
    texts = ["cope", "соре", "cope", "cоpe", "other", "other", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    want = sorted((a, b) for a in range(4) for b in range(a + 1, 4) if texts[a] != texts[b])
    assert rows(canonical.look_alikes(df, "id", "t")) == want
    got = {r.doc_id: (r.class_id, r.n_texts) for r in canonical.classes(df, "id", "t").collect()}
    assert got == {0: (0, 3), 1: (0, 3), 2: (0, 3), 3: (0, 3), 4: (4, 1), 5: (4, 1), 7: (7, 1)}


@pytest.mark.parametrize("capital, small", [(a, b) for a, b in zip("ꓮꓐᎪՕՍ‐", "abаoսh", strict=True)])
def test_smaller_scripts(spark, capital, small):
    """Letters of scripts that share the shape of a Latin capital, and the hyphen of its own."""
    shown = {"ꓮ": "A", "ꓐ": "B", "Ꭺ": "A", "Օ": "O", "Ս": "U", "‐": "-"}
    assert canon(spark, [f"x{capital}y"]) == [f"x{shown[capital]}y"]


def test_many_copies_of_one_text_and_one_variant(spark):
    df = spark.range(10_000).select("id", F.lit("cope").alias("t")).unionByName(spark.createDataFrame([(10_000, "соре"), (10_001, "сope")], "id long, t string"))
    found = canonical.look_alikes(df, "id", "t")
    assert found.count() == 20_001
    assert found.filter("doc_id_b < 10000").count() == 0 and found.filter("doc_id_a = 10000 and doc_id_b = 10001").count() == 1
    # Texts are paired before documents are joined: no join makes more rows than come out.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "text_a" in plan and "exact_a" not in plan


# Leakage.


@pytest.mark.parametrize("low, high", [("но в начале было слово", "НО В НАЧАЛЕ БЫЛО СЛОВО"), ("Вот так", "ВОТ ТАК"), ("νέα ήλιος και ώρα", "ΝΈΑ ΉΛΙΟΣ ΚΑΙ ΏΡΑ"), ("ӏ ўк ќ", "Ӏ ЎК Ќ"), ("straße", "STRAßE"), ("vіew", "VIEW"), ("ｗｉｄｅ", "Wide"), ("đợng", "ĐỢNG")])
def test_words_of_either_case_and_look_are_one(low, high):
    import pyarrow as pa

    words, offsets = leakage.hashed_words(leakage._connection(), pa.table({"text": [low, high, low.capitalize()]}))
    of = lambda k: words[offsets[k] : offsets[k + 1]].tolist()
    if "ς" in low or "σ" in high.lower():
        assert of(0)[0] == of(1)[0] and of(0)[2:] == of(1)[2:]  # a final sigma has a form of its own
    else:
        assert of(0) == of(1) == of(2)
    assert len(of(0)) == len(low.split())


def test_accents_and_letters_still_tell_words_apart():
    import pyarrow as pa

    words, _ = leakage.hashed_words(leakage._connection(), pa.table({"text": ["cafe café cafè сад сат нос nos x2 x3 12 l2 ё е"]}))
    assert len(set(words.tolist())) == 13


def test_upper_case_russian_passages_are_found(spark):
    text = "Река жинты цитрак фимфюн, ребёнок для монреть брётр вот так и был после в саду"
    d = spark.createDataFrame([(1, f"before {text.upper()} after"), (2, f"и {text}"), (3, text.replace("монреть", "монрёть"))], "d long, t string")
    got = leakage.leaks(d, "d", "t", spark.createDataFrame([(7, text)], "id long, t string"), "id", "t")
    assert rows(got.select("doc_id", "item_id")) == [(1, 7), (2, 7)]


def test_a_text_of_one_word_repeated():
    """As many candidates as runs, not as pairs of places: 100,000 words against 1,000."""
    a, b = np.full(100_000, 7, np.uint64), np.full(1_000, 7, np.uint64)
    i, j, length = leakage.shared_runs(a, b, 12)
    assert len(i) == len(fa := leakage.fingerprints(a, 12)) + len(leakage.fingerprints(b, 12)) - 1 and len(fa) == 99_989
    assert length.max() == 1_000 and length.min() == 12
    assert leakage.tiles(a, b, 12) == [(0, 0, 1_000)]
    twice = np.tile(np.array([3, 9, 4], np.uint64), 20_000)
    assert len(leakage.shared_runs(twice, twice[:3_000], 12)[0]) < 25_000
    assert leakage.tiles(twice, twice[:3_000], 12)[0] == (0, 0, 3_000)


def test_the_filter_of_runs_passes_all_it_holds(spark):
    rng = np.random.default_rng(3)
    runs = rng.integers(-(2**63), 2**63 - 1, 5_000)
    bits = leakage.run_filter(spark.createDataFrame([(int(r),) for r in runs], "run long"))
    passes = lambda x: np.logical_and(*((bits[b >> 6] >> (b & 63).astype(np.uint64) & np.uint64(1) == 1) for b in leakage._bits(x)))
    assert passes(runs.view(np.uint64)).all()
    assert passes(rng.integers(-(2**63), 2**63 - 1, 50_000).view(np.uint64)).mean() < 0.001


def brute_tiles(a, b, least):
    """Tiling by its definition: over and over the longest common unmarked run, first in a and then in b."""
    in_a, in_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not in_a[i + k] and not in_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        k, i, j = best
        in_a[i : i + k] = in_b[j : j + k] = [True] * k
        out.append((i, j, k))


@pytest.mark.parametrize("seed", range(30))
def test_tiles_against_brute_force(seed):
    rng = random.Random(seed)
    a = [rng.randrange(4) for _ in range(rng.randrange(60))]
    b = [rng.randrange(4) for _ in range(rng.randrange(40))] + a[5:25] + a[:9]
    least = rng.choice([2, 3, 5])
    got = leakage.tiles(np.array(a, np.uint64), np.array(b, np.uint64), least)
    want = brute_tiles(a, b, least)
    assert [t[2] for t in got] == [t[2] for t in want]
    assert got == want


def words(text):
    return re.findall(r"[^\W_]+", form(text).lower())


def test_leaks_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"wörd{i}" for i in range(40)] + ["соре", "ｗｉｄｅ"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.randrange(4, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "short one")]
    docs = [(i, " ".join(some(30))) for i in range(20)] + [(90, None), (91, "")]
    for i in range(30):
        item = items[i % 12][1].split()
        part = item[: rng.randrange(4, 40)]
        text = " - ".join([*some(9), ", ".join(part).upper(), *some(6)]).replace("COPE", "cоpе")
        docs.append((100 + i, text))
    docs += docs[20:40]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    runs = lambda t: {tuple(w[i : i + 12]) for w in [words(t)] for i in range(len(w) - 11)}
    want = sorted({(a, i) for a, t in docs if t for i, u in items if u and runs(t) & runs(u)})
    assert want
    for most in (10**6, 0):
        got = leakage.leaks(d, "doc_id", "text", q, "item_id", "text", min_words=12, most_broadcast=most)
        assert rows(got.select("doc_id", "item_id")) == want
    least = 5
    covered = []
    for a, t in {x for x in docs if x[1]}:
        for i, u in items:
            if u:
                total = sum(x[2] for x in brute_tiles(words(t), words(u), least))
                if total and total >= 0.8 * len(words(u)):
                    covered.append((a, i, total))
    for most in (10**6, 0):
        got = leakage.leaks(d, "doc_id", "text", q, "item_id", "text", least, 0.8, most)
        assert rows(got.select("doc_id", "item_id", "covered_words")) == sorted(covered)
    assert leakage.leaks(d.limit(0), "doc_id", "text", q, "item_id", "text").count() == 0
    assert leakage.leaks(d, "doc_id", "text", q.limit(0), "item_id", "text").count() == 0


def test_reordered_passages_are_covered(spark):
    parts = [" ".join(f"p{k}w{i}" for i in range(6)) for k in range(4)]
    d = spark.createDataFrame([(1, f"x {parts[2]} y {parts[0]} z {parts[3]} {parts[1]}"), (2, parts[0])], "id long, t string")
    q = spark.createDataFrame([(7, " ".join(parts))], "id long, t string")
    got = leakage.leaks(d.withColumnRenamed("id", "d"), "d", "t", q, "id", "t", min_words=5, min_coverage=0.8)
    assert [(r[0], r.n_tiles, r.covered_words) for r in got.collect()] == [(1, 4, 24)]


# Containers.


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 200])
    histogram = Counter(rng.randrange(1, capacity + 1) if rng.random() < 0.5 else rng.randrange(1, 1 + capacity // 4) for _ in range(rng.choice([1, 30, 3000])))
    plan = packing.Plan(dict(histogram), capacity)
    used = Counter()
    for sizes, counts, uses in plan.patterns:
        assert (sizes * counts).sum() <= capacity and uses > 0
        for s, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            used[s] += c * uses
    assert used == histogram
    least = -(-plan.tokens // capacity)
    big = sum(n for s, n in histogram.items() if s > capacity / 2)
    assert max(least, big) <= plan.containers <= 1.25 * max(least, big) + 2


def test_plan_by_the_program_where_the_greedy_way_wastes_room():
    """Largest first puts 51 with 27 and wastes 22 of 100; 51 + 26 + 23 and 27 + 27 + 23 + 23 waste nothing."""
    histogram = {51: 6000, 26: 6000, 27: 6000, 23: 12000}
    plan = packing.Plan(histogram, 100)
    assert packing.Plan(histogram, 100, rounds=0).containers == 11000
    assert plan.containers <= 1.02 * 9000
    assert packing.Plan({}, 100).containers == 0
    with pytest.raises(ValueError):
        packing.Plan({0: 1}, 100)


def knapsack(prices, capacity):
    """The most that texts in one container can be worth."""
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in prices.items() if s <= room])
    return best[capacity]


@pytest.mark.parametrize("seed", range(4))
def test_no_packing_goes_below_the_bound(seed):
    """The least number of containers of small sets, by trying all ways, is never below the bound, nor the plan below it."""
    rng = random.Random(seed)
    for _ in range(15):
        capacity = rng.choice([7, 10, 13])
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True)

        def least(rest, rooms):
            if not rest:
                return len(rooms)
            tries = {tuple(sorted([*rooms[:i], rooms[i] - rest[0], *rooms[i + 1 :]])) for i in range(len(rooms)) if rooms[i] >= rest[0]} | {tuple(sorted([*rooms, capacity - rest[0]]))}
            return min(least(rest[1:], list(t)) for t in tries)

        plan = packing.Plan(dict(Counter(items)), capacity)
        assert plan.bound <= least(items, []) <= plan.containers


def test_gap_to_the_dual_program():
    """Where filling isn't optimal the program is within a per cent of what the dual proves, and where lengths are rare no worse than filling."""
    cases = [({51: 6000, 26: 6000, 27: 6000, 23: 12000}, 100, 0.0), (dict(Counter(random.Random(1).randrange(683, 1024) for _ in range(9000))), 2048, 0.01), ({n: 1 for n in range(300, 1500)}, 2048, 0.01)]
    for histogram, capacity, gap in cases:
        plan = packing.Plan(histogram, capacity)
        assert plan.containers <= (1 + gap) * plan.bound
        assert plan.containers <= packing.Plan(histogram, capacity, rounds=0).containers
    assert packing.Plan(cases[0][0], 100).by_program == 30_000 and packing.Plan(cases[0][0], 100, rounds=0).containers == 11_000


def test_prices_of_the_dual_let_no_container_be_worth_more_than_one():
    histogram, capacity = {51: 60, 26: 60, 27: 60, 23: 120, 34: 10}, 100
    for k in range(1, 65):
        prices = {s: s / capacity if (k + 1) * s % capacity == 0 else ((k + 1) * s // capacity) / k for s in histogram}
        assert knapsack(prices, capacity) <= 1 + 1e-9


def test_holds_notices_what_is_wrong(spark):
    sized = spark.createDataFrame([(1, 5), (2, 12), (3, 0)], "doc_id long, tokens long")
    placed = lambda *r: spark.createDataFrame(list(r), "doc_id long, part int, token_start long, n_tokens long, container_id long")
    right = [(1, 0, 0, 5, 0), (2, 0, 0, 10, 1), (2, 1, 10, 2, 0), (3, 0, 0, 0, 0)]
    check = lambda *r: tuple(packing.holds(placed(*r), sized, 10).first())
    assert check(*right) == (3, 0, 0, 0, 0, 0)
    assert check((1, 0, 0, 5, 1), *right[1:])[:2] == (3, 1)
    assert check((1, 0, 0, 5, 3), *right[1:])[2] == 1
    assert check((1, 0, 0, 4, 0), *right[1:])[3:] == (1, 0, 1)
    assert check((1, 0, 0, 2, 0), (1, 1, 2, 3, 0), *right[1:])[3:] == (0, 1, 0)
    assert check(*right[1:])[0] == 2 and check(*right[1:])[3] == 1
    assert packing.fill(placed(*right), 10).first().gap == 0 and packing.fill(placed(), 10).first().containers == 0


def test_containers(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "one two three " * 9000)], docs.schema))
    out = packing.containers(docs, "doc_id", "text").collect()
    tokens = Counter()
    encode = packing.encoder(packing.VOCABULARY).encode_ordinary
    for r in docs.collect():
        tokens[r.doc_id] += len(encode(r.text or ""))
    got, room, parts = Counter(), Counter(), Counter(r.doc_id for r in out)
    for r in out:
        got[r.doc_id] += r.n_tokens
        room[r.container_id] += r.n_tokens
        assert r.token_start == r.part * packing.CAPACITY
    copies = Counter(r.doc_id for r in docs.collect())
    assert got == tokens and max(room.values()) <= packing.CAPACITY
    assert set(room) == set(range(len(room)))
    assert all(parts[d] == copies[d] * max(1, -(-(tokens[d] // copies[d]) // packing.CAPACITY)) for d in parts)
    assert len(room) <= -(-sum(tokens.values()) // packing.CAPACITY) + 1
    again = packing.containers(docs.repartition(7), "doc_id", "text").groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    assert {r.container_id: r.n for r in again.collect()} == dict(room)
    assert packing.containers(docs.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_as_sql(name, spark, folder, oracle):
    columns, names, more, less = compare(queries.QUERIES[name](spark, folder), queries.SQL[name], oracle)
    assert columns == names
    assert not more and not less, (list(more)[:3], list(less)[:3])


def test_all_are_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
