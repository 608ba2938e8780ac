"""N-gram Jaccard classes, suffix-array dedup and decontamination against plain versions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from offerledger.llm import decontamination, ngram_jaccard, suffix_dedup
from offerledger.operators import graph
from tests.llm import cases


def shingles(text: str, k: int = 4) -> set:
    words = cases.WHITE.findall((text or "").translate(cases.LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def classes(texts: dict[int, str], percent: int = 85) -> dict[int, tuple[int, int]]:
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(ids[x]), find(ids[y])
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_classes_of_the_sample(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.op9_ngram_jaccard_join(spark, cases.SF).collect()}
    assert got == classes(cases.texts(spark))


def test_classes_of_near_copies(spark):
    """A family whose members are at and around the threshold, chained, with unrelated texts between."""
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in r.integers(0, 500, 120)]
    texts = {}
    for i in range(60):
        words = list(base)
        for at in r.integers(0, 120, r.integers(0, 9)):
            words[at] = f"n{r.integers(0, 50)}"
        texts[i] = " ".join(words[: 120 - i % 4])
    texts |= {100 + i: " ".join(f"w{j}" for j in r.integers(0, 9, 40)) for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_classes(df).collect()} == classes(texts)


def test_classes_of_odd_rows(spark):
    rows = [tuple(x) for x in ngram_jaccard.ngram_classes(cases.odd_documents(spark)).collect()]
    assert len(rows) == 12
    by = {(i, n): c for i, n, c in rows}
    assert by[3, 0] == 3 and by[4, 0] == 4 and by[5, 0] == 5 and by[6, 1] == 6
    assert {c for i, n, c in rows if i in (1, 2, None) or i == 10} <= {1, 10}
    assert ngram_jaccard.ngram_classes(cases.empty_documents(spark)).count() == 0
    kept = ngram_jaccard.one_of_each_class(cases.odd_documents(spark))
    assert kept.columns == cases.odd_documents(spark).columns
    assert 2 not in {r.doc_id for r in kept.collect()}


def test_a_row_without_id_links_near_copies(spark):
    """Its set has no other holder, and is fetched all the same."""
    words = [f"w{i}" for i in range(200)]
    near = lambda *at: " ".join("other" if i in at else w for i, w in enumerate(words))
    rows = [(1, near()), (None, near(100)), (None, near(100, 197)), (3, near(100, 102, 104, 106, 108, 110, 197)), (4, "quite another text of its own"), (None, "and one more that is alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(x) for x in ngram_jaccard.ngram_classes(df).collect()), key=repr)
    # Rows 1 and 3 are linked by the rows without an id alone.
    assert 3 == classes({1: rows[0][1], 3: rows[3][1]})[3][1]
    assert got == sorted([(1, 197, 1), (None, 197, 1), (None, 197, 1), (3, 197, 1), (4, 3, 4), (None, 4, None)], key=repr)


def test_near_duplicates_of_the_pipeline(spark):
    """The pipeline's classes: 5 words and 80 %, against all pairs."""
    r = np.random.default_rng(7)
    texts = {}
    for family in range(12):
        words = [f"w{i}" for i in r.integers(0, 900, 200)]
        for i in range(6):
            changed = list(words)
            for at in r.choice(40, int(r.integers(0, 8)), replace=False):
                changed[5 * int(at)] = f"n{r.integers(0, 900)}"
            texts[10 * family + i] = " ".join(changed)
    sets = {i: shingles(t, 5) for i, t in texts.items()}
    edges = [(i, j) for i in texts for j in texts if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = {i: i for i in texts}
    for _ in texts:
        for i, j in edges:
            root[i] = root[j] = min(root[i], root[j])
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {x.doc_id for x in stage(spark, docs, cases.SF).collect()} == set(root.values())
    assert {c for _, c in classes(texts).values()} > set(root.values())


def test_prefix_trees():
    """What the trees leave out can't link, whole trees miss no pair, and sets of one component are left out."""
    r = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        base = np.sort(r.choice(2**30, 200, replace=False).astype(np.uint32))
        sets += [np.unique(np.concatenate([np.delete(base, r.choice(200, 3 * i, replace=False)), r.choice(2**30, 2 * i).astype(np.uint32)])) for i in range(8)]
    sets = sets + [s[:160] for s in sets[::8]]
    comp = np.arange(len(sets)) // 3
    holders = Counter(t for s in sets for t in s[: len(s) - -(-85 * len(s) // 100) + 1].tolist())
    rows = []
    for i, s in enumerate(sets):
        size = len(s) - -(-85 * len(s) // 100) + 1
        held = [(p, t) for p, t in enumerate(s[:size].tolist()) if holders[t] > 1]
        for k, (p, t) in enumerate(held):
            rest = held[k + 1 : k + 6]
            whole = len(held) <= k + 6
            rows.append((t, [x for _, x in rest], i, p, [q for q, _ in rest], size - 1 if whole else rest[-1][0], int(s[size - 1]) if whole else rest[-1][1]))
    rows.sort(key=lambda x: x[:2])
    column = lambda k: np.array([x[k] for x in rows], np.int64)
    flat = lambda k: np.array([y for x in rows for y in x[k]], np.int64)
    who = column(2)
    n = np.array([len(s) for s in sets])[who]
    trees = ngram_jaccard.PrefixTrees(column(0), 0 * who, n, column(3), comp[who], column(5), column(6).astype(np.uint32), flat(1).astype(np.uint32), flat(4), np.array([len(x[1]) for x in rows]), 85)
    found = {tuple(sorted((int(who[x]), int(who[y])))) for x, y in zip(*trees.all_pairs(), strict=True)}
    overlap = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if comp[i] != comp[j] and 100 * overlap(i, j) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert len(want) > 50 and want <= found and len(found) < 4 * len(want)
    near = {tuple(sorted((int(who[x]), int(who[y])))) for x, y in zip(*trees.neighbours(), strict=True)}
    assert near <= found and len(near & want) > 20

    trees.bits = np.stack([ngram_jaccard.parity_bits(sets[i].astype(np.uint64), 1024) for i in who])
    x, y = trees.all_pairs()
    every = list(zip(x.tolist(), y.tolist(), trees.apart(x, y).tolist(), strict=True))
    closest = set(zip(*(z.tolist() for z in trees.closest(2)), strict=True))
    assert closest < {(p, q) for p, q, _ in every}
    for row in {z for p, q, _ in every for z in (p, q)}:
        of_row = sorted((far, q if p == row else p) for p, q, far in every if row in (p, q))
        assert {tuple(sorted((row, other), reverse=True)) for _, other in of_row[:2]} <= {tuple(sorted(z, reverse=True)) for z in closest}


def test_few_pairs_are_left_for_whole_trees(spark, monkeypatch):
    """A large family with few links to each: the rounds before have joined it."""
    r = np.random.default_rng(8)
    base = [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(300):
        words = list(base)
        for at in r.choice(60, 6, replace=False):
            words[5 * int(at)] = f"n{r.integers(0, 3)}"
        texts[i] = " ".join(words)
    made, written = [], ngram_jaccard.shared.written

    def counted(df, name):
        out = written(df, name)
        if name == "ngram-pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(ngram_jaccard.shared, "written", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_classes(df).collect()}
    assert got == classes(texts)
    assert len(made) == 3 and max(made) <= 4 * len(texts) and made[-1] < len(texts)


def test_nested_sets(spark):
    """Each document is the one before and a word more, so every set holds the smaller ones."""
    words = [f"w{i}" for i in range(1100)]
    texts = {i: " ".join(words[: 600 + i]) for i in range(0, 500, 4)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_classes(df).collect()} == classes(texts)


@pytest.mark.parametrize("block", [3, 20])
def test_blocks_of_a_frequent_shingle(spark, monkeypatch, block):
    """Shingles of more sets than a block: the same classes."""
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    monkeypatch.setattr(ngram_jaccard, "REST", 4)
    monkeypatch.setattr(ngram_jaccard, "CHECKED_AT_ONCE", 2000)
    r = np.random.default_rng(4)
    base = [f"w{i}" for i in range(80)]
    texts = {}
    for i in range(120):
        words = list(base)
        for at in r.choice(80, int(r.integers(0, 7)), replace=False):
            words[at] = f"n{r.integers(0, 9)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_classes(df).collect()} == classes(texts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5), (None, 3)]
    for one_task in (0, 1000):
        got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), one_task=one_task).collect()}
        assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats(texts: dict[int, str], match: int = 50) -> dict[int, tuple[int, int]]:
    words = {i: cases.WHITE.findall(t) for i, t in sorted(texts.items())}
    count, first = Counter(), {}
    for i, w in words.items():
        for k in range(len(w) - match + 1):
            run = tuple(w[k : k + match])
            count[run] += 1
            first.setdefault(run, (i, k))
    out = {}
    for i, w in words.items():
        repeated, removed = set(), set()
        for k in range(len(w) - match + 1):
            run = tuple(w[k : k + match])
            if count[run] > 1:
                repeated.update(range(k, k + match))
                if first[run] != (i, k):
                    removed.update(range(k, k + match))
        if repeated:
            out[i] = (len(repeated), len(removed))
    return out


@pytest.mark.parametrize("match,key", [(50, 25), (12, 5)])
def test_repeated_passages(spark, match, key):
    got = {r.doc_id: (r.n_repeated, r.n_removed) for r in suffix_dedup.repeated_passages(cases.documents(spark), match, key).collect()}
    assert got == repeats(cases.texts(spark), match)


@pytest.mark.parametrize("bucket", [1, 3])
def test_runs_counted_by_hash_are_those_of_sorted_suffixes(spark, monkeypatch, bucket):
    """First words with more contexts than a task sorts."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    texts = cases.texts(spark)
    texts |= {50_000 + i: f"{'q ' * (i % 3)}{texts[i % 40]}" for i in range(60)}
    rows = [*texts.items(), *list(texts.items())[::3]]  # and rows that repeat
    got = {r.doc_id: (r.n_repeated, r.n_removed) for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 12, 5).collect()}
    assert got == repeats(texts, 12)


def test_repeats_within_a_document(spark):
    texts = {1: "a " * 100, 2: "x " + "a " * 60, 3: "b c " * 40, 4: " ".join(map(str, range(120))) + " z " + " ".join(map(str, range(60, 120)))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_repeated, r.n_removed) for r in suffix_dedup.repeated_passages(df).collect()} == repeats(texts)


def test_cut_texts(spark):
    docs = cases.documents(spark)
    texts, found = cases.texts(spark), repeats(cases.texts(spark))
    cut = {r.doc_id: r for r in suffix_dedup.without_repeats(docs).collect()}
    assert suffix_dedup.without_repeats(docs).columns == docs.columns
    for i, text in texts.items():
        words = len(cases.WHITE.findall(text))
        left = words - found.get(i, (0, 0))[1]
        if not found.get(i, (0, 0))[1]:
            assert cut[i].text == text
        elif left:
            assert len(cases.WHITE.findall(cut[i].text)) == left and cut[i].n_chars == len(cut[i].text)
        else:
            assert i not in cut


def test_repeats_of_odd_rows(spark):
    found = {r.doc_id: (r.n_repeated, r.n_removed) for r in suffix_dedup.repeated_passages(cases.odd_documents(spark)).collect()}
    assert found[1] == (120, 0) and found[2] == (120, 120) and None not in found and found[7][0] == 90_000
    left = suffix_dedup.without_repeats(cases.odd_documents(spark)).collect()
    assert {r.doc_id for r in left} == {1, 3, 4, 5, 6, 7, 8, None, 9, 10}
    assert suffix_dedup.repeated_passages(cases.empty_documents(spark)).count() == 0
    same_id = spark.createDataFrame([(1, "p " + " ".join(map(str, range(60)))), (1, "q " + " ".join(map(str, range(60)))), (2, " ".join(map(str, range(60))))], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_repeated) for r in suffix_dedup.repeated_passages(same_id).collect()) == [(1, 60), (1, 60), (2, 60)]


def test_leaks(spark):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.op5_benchmark_decontamination(spark, cases.SF).collect()}
    want, low = set(), lambda t: cases.ALNUM.findall(t.translate(cases.LOWER))
    for i, text in cases.texts(spark).items():
        words = " " + " ".join(low(text)) + " "
        want |= {(i, k) for k, t in items.items() if len(low(t)) >= 5 and f" {' '.join(low(t))} " in words}
    assert want and want <= set(got)
    assert all(got[k] > 0.999 for k in want)
    assert all(s >= 0.8 for s in got.values())


def windows(item: list[str], words: list[str], weight: dict, k: int = 5) -> float:
    """The best weighted Jaccard similarity of an item's shingles and those of the windows of its length."""
    grams = lambda w: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    best, mine = 0.0, grams(item)
    for i in range(len(words) - len(item) + 1):
        other = grams(words[i : i + len(item)])
        both = sum(min(n, other[g]) * weight[g] for g, n in mine.items())
        every = sum(max(mine[g], other[g]) * weight[g] for g in mine | other)
        best = max(best, both / every)
    return best


def test_similarities_against_all_windows(spark):
    """Every pair found has the similarity of its best window within the radius; of all pairs of 0.8 or more 0.95 are found."""
    r = np.random.default_rng(12)
    word = lambda: f"k{r.integers(0, 60)}"
    items = {i: [word() for _ in range(int(n))] for i, n in enumerate(r.integers(20, 80, 30))}
    docs = {}
    for d in range(120):
        words = list(items[d % 30])
        for at in r.choice(len(words), int(r.integers(0, 3)), replace=False):
            words[int(at)] = word()
        docs[d] = [word() for _ in range(int(r.integers(0, 20)))] + words[int(r.integers(0, 3)) :] + [word() for _ in range(10)]
    holders = Counter(g for w in items.values() for g in {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    every = {tuple(w[i : i + 5]) for w in (*items.values(), *docs.values()) for i in range(len(w) - 4)}
    weight = {g: float(np.log(1 + len(items) / holders.get(g, 1))) for g in every}
    want = {(d, i): s for d, w in docs.items() for i, item in items.items() if (s := windows(item, w, weight)) >= 0.8}
    frame = lambda x, c: spark.createDataFrame([(i, " ".join(w)) for i, w in x.items()], f"{c} long, text string")
    got = {(x.doc_id, x.item_id): x.similarity for x in decontamination.contaminations(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert set(got) <= set(want) and len(want) > 50
    assert len(got) >= 0.95 * len(want)
    assert np.mean([abs(got[p] - want[p]) < 1e-9 for p in got]) > 0.95 and all(got[p] <= want[p] + 1e-9 for p in got)


def test_short_items_are_found_word_for_word(spark):
    items = spark.createDataFrame([(1, "To be, or not"), (2, "answer 42"), (3, "yes"), (4, "answer 42"), (5, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x to be or NOT to be"), (2, "to be and not or"), (3, "yes, the answer (42) yes"), (4, "x one two three four five six"), (5, None)], "doc_id long, text string")
    got = {(x.doc_id, x.item_id): (x.start_word, x.similarity) for x in decontamination.contaminations(docs, items).collect()}
    assert got == {(1, 1): (1, 1.0), (3, 2): (2, 1.0), (3, 4): (2, 1.0), (3, 3): (0, 1.0), (4, 5): (1, 1.0)}
    assert {r.doc_id for r in decontamination.decontaminated(docs, items).collect()} == {2, 5}


def test_near_leaks_and_clean_texts(spark):
    r = np.random.default_rng(2)
    word = lambda: f"k{r.integers(0, 10_000)}"
    items = {i: " ".join(word() for _ in range(60)) for i in range(50)}
    docs = {}
    for i, t in items.items():
        words = t.split()
        if i % 2:
            words[int(r.integers(0, 60))] = "other"  # 5 of 56 shingles change
        docs[i] = " ".join([word() for _ in range(80)] + words + [word() for _ in range(40)])
    docs |= {100 + i: " ".join(word() for _ in range(200)) for i in range(50)}
    docs[200] = " ".join(items[0].split()[:20])  # a third of an item is none
    found = decontamination.contaminations(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    pairs = {(x.doc_id, x.item_id) for x in found}
    assert pairs <= {(i, i) for i in items}
    assert {(i, i) for i in items if i % 2 == 0} <= pairs
    assert len(pairs) >= 48  # near copies: what the fingerprints' radius returns
    for x in found:
        assert x.start_word == 80 if x.item_id % 2 == 0 else abs(x.start_word - 80) <= 8


def test_parts_of_a_benchmark_give_the_rows_of_one(spark, monkeypatch):
    """Items share boilerplate across parts; weights are those of the whole benchmark in each part."""
    r = np.random.default_rng(6)
    word = lambda: f"k{r.integers(0, 10_000)}"
    same = " ".join(word() for _ in range(40))
    items = {i: f"{same} {' '.join(word() for _ in range(24))}" for i in range(40)}
    docs = {100 + i: " ".join(word() for _ in range(80)) for i in range(10)} | {200: same}
    for i, t in items.items():
        words = t.split()
        for at in r.choice(24, i % 4, replace=False):
            words[40 + int(at)] = "other"
        docs[i] = " ".join([word() for _ in range(30)] + words)
    docs = spark.createDataFrame([*docs.items(), (None, items[3]), (None, "nothing in it at all, that is known"), (None, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([*items.items(), (90, None), (91, "never here")], "item_id long, text string")
    rows = lambda: sorted((tuple(x) for x in decontamination.contaminations(docs, benchmark).collect()), key=repr)
    left = lambda: sorted((tuple(x) for x in decontamination.decontaminated(docs, benchmark).collect()), key=repr)
    found, kept = rows(), left()
    assert len(found) >= 10 and len(kept) < docs.count()
    monkeypatch.setattr(decontamination, "MAX_ITEMS", 9)
    assert decontamination.benchmark_parts(benchmark)[0] == 5
    assert rows() == found and left() == kept


def test_multi_index_returns_the_whole_radius():
    r = np.random.default_rng(4)
    b = decontamination.Benchmark(list(range(300)), [" ".join(f"v{x}" for x in r.integers(0, 900, 20)) for _ in range(300)])
    for _ in range(200):
        flips = r.choice(64, int(r.integers(0, 18)), replace=False)
        query = int(b.prints[int(r.integers(0, 300))]) ^ sum(1 << int(f) for f in flips)
        want = {i for i in range(300) if int(b.prints[i] ^ np.uint64(query)).bit_count() <= b.radius}
        assert set(b.within(query).tolist()) == want


def test_decontaminated_odd_rows(spark):
    items = spark.createDataFrame([(1, "wort0 ünd0 wort1 ünd1 wort2 ünd2"), (2, None), (3, "never here"), (4, "")], "item_id long, text string")
    docs = cases.odd_documents(spark)
    left = decontamination.decontaminated(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {3, 4, 5, 6, 7, 8, 9}
    assert decontamination.contaminations(docs, items.where("item_id > 4")).count() == 0
    assert decontamination.contaminations(cases.empty_documents(spark), items).count() == 0


def test_a_long_text_in_slices(monkeypatch):
    """Slices of window starts find what the whole text finds, across their bounds too."""
    r = np.random.default_rng(6)
    items = [" ".join(f"w{i}" for i in r.integers(0, 300, n)) for n in (12, 20, 33, 47)]
    words = [f"w{i}" for i in r.integers(0, 300, 3000)]
    for at in range(40, 2900, 97):
        item = items[at % 4].split()
        words[at : at + len(item)] = item
    part, column = decontamination.Benchmark([1, 2, 3, 4], items), pa.array([" ".join(words), None, items[2]])
    whole = list(part.leaks(column))
    for size in (7, 64, 1000):
        monkeypatch.setattr(decontamination, "SLICE", size)
        got = list(part.leaks(column))
        assert [(row, [f[:3] for f in found]) for row, found in got] == [(row, [f[:3] for f in found]) for row, found in whole] and len(whole) == 2
