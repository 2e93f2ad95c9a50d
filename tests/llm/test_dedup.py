"""Operators 1, 2 and 8 and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shockline.llm import common, decontaminate, simhash, substring

from ..conftest import SF

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", None, "  \n", "One", "one TWO", "a b c", "a a a a a a", "É é x y\x0bz \x1c", "w " * 70_000])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 120), st.integers(1, 8))
def test_tree_links_connect_what_distances_connect(seed, n, flips):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(3)]
    points = list({b ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, flips))) & (2**64 - 1) for b in base for _ in range(n // 3 + 1)})
    a = np.array(points, np.uint64)
    want = slow_components(points, lambda x, y: (x ^ y).bit_count() <= 3)
    simhash.VantageTree.__init__.__defaults__ = (8,)
    try:
        i, j = simhash.stars(a, 3)
    finally:
        simhash.VantageTree.__init__.__defaults__ = (simhash.LEAF,)
    pairs = set(zip(a[i].tolist(), a[j].tolist(), strict=True))
    got = slow_components(points, lambda x, y: (x, y) in pairs or (y, x) in pairs)
    assert len(set(got.values())) == len(set(want.values()))
    assert len({(got[p], want[p]) for p in points}) == len(set(want.values()))


def test_trees_prune_branches():
    r = random.Random(6)
    centres = [r.getrandbits(64) for _ in range(60)]
    points = np.array(sorted({c ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for c in centres for _ in range(60)}), np.uint64)
    tree = simhash.VantageTree(points)

    def size(node):
        return 1 + size(node[2]) + size(node[3]) if isinstance(node, tuple) else 1

    nodes, i = size(tree.root), 1234
    want = set(np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3).tolist())
    assert set(tree.near(points[i], 3).tolist()) == want and len(want) > 3
    assert nodes > 100 and tree.visited < 0.8 * nodes, (tree.visited, nodes)


def cluster(seed, n):
    r = random.Random(seed)
    base = r.getrandbits(64)
    return sorted({base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(n)} | {r.getrandbits(64) for _ in range(n)})


@pytest.mark.parametrize(("block", "refine"), [(4096, 65_536), (16, 10**9), (16, 20)])
def test_links_through_blocks_and_refined_shards(spark, block, refine):
    points = np.array(cluster(5, 150), np.uint64)
    want = slow_components(points.tolist(), lambda x, y: (x ^ y).bit_count() <= 3)
    frame = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    got = {np.int64(r.node).view(np.uint64).item(): r.component for r in common.connected_components(simhash.links(frame, 3, block, refine)).collect()}
    many = [p for p in want if sum(v == want[p] for v in want.values()) > 1]
    assert set(got) == set(many)
    assert len({(got[p], want[p]) for p in many}) == len({want[p] for p in many}) == len(set(got.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 200)] + [(500, 500)] + [(7, 8), (8, 7)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + k: 100 for k in range(200)}
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_query_2(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want_fp = {d.doc_id: slow_fingerprint(d.text) for d in docs}
    want = slow_components(sorted(want_fp), lambda a, b: (want_fp[a] ^ want_fp[b]).bit_count() <= 3)
    got = simhash.op2_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{want_fp[i]:016x}", want[i]) for i in want}


def test_simhash_edge_cases(spark):
    docs = spark.createDataFrame([(5, None, 1), (3, "", 1), (4, "same words here", 1), (9, "same words here", 1), (9, "same words here", 1), (None, "same words here", 1), (None, "alone in the world", 1)], "doc_id long, text string, fp int")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, -1), (-1, 4), (3, 3), (4, 4), (5, 3), (9, 4), (9, 4)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [3, 4]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_each_component_keeps_one_row(spark):
    rows = [(None, "same words here"), (None, "Same words here"), (4, "SAME words here"), (4, "same Words here"), (None, "alone in the world"), (None, "Alone in the world"), (4, "another text of that id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text.lower()) for r in simhash.keep_one(docs).collect()]
    assert sorted(got, key=str) == [(4, "another text of that id"), (4, "same words here"), (None, "alone in the world")]


# ---- operator 1 -------------------------------------------------------------------------------------


def prose(r, n):
    words = []
    for k in range(n):
        w = "".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 8)))
        words.append((w.capitalize() if k % 9 == 0 else w) + ("." if k % 9 == 8 else ""))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    passage, line = prose(r, 60), prose(r, 80)
    edited = line.split()
    edited[40] = "changed"
    docs = {1: f"{prose(r, 33)} {passage} {prose(r, 30)}", 2: f"{prose(r, 50)}\n{prose(r, 7)} {passage} {prose(r, 40)}", 3: prose(r, 200), 4: f"{prose(r, 20)}\n{line}", 5: f"{' '.join(edited)}\n{prose(r, 25)}", 6: f"{prose(r, 12)} {passage}"}
    return docs, passage


def test_repeated_passages_and_clean_documents(spark, corpus):
    docs, passage = corpus
    frame = spark.createDataFrame([*docs.items(), (7, None), (8, ""), (None, docs[1])], "doc_id long, text string").selectExpr("*", "0 as words", "'k' as uid")
    rows = substring.repeats(frame).collect()
    assert {r.doc_id for r in rows} == {1, 2, 4, 5, 6}
    first = {r.doc_id: r.first_doc_id for r in rows}
    assert (first[2], first[6], first[5]) == (1, 1, 4)
    for r in rows:
        if r.doc_id in (1, 2, 6):
            got = " ".join(docs[r.doc_id].split()[r.start_word : r.start_word + r.n_words])
            assert got in docs[r.doc_id].replace("\n", " ") and passage[40:300] in got
    cut = {r.doc_id: r.text for r in substring.drop_repeats(frame).collect() if r.doc_id}
    assert cut[1] == docs[1] and cut[3] == docs[3] and cut[4] == docs[4]
    assert passage[40:300] not in cut[2] and docs[2].startswith(cut[2][:100])
    assert len(cut[6].split()) < 20 and 7 in cut and 8 in cut
    assert substring.repeats(frame.where("false")).count() == 0


def test_shared_runs_with_borders_in_long_sentences(spark):
    r = random.Random(12)
    plain = lambda n: " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(3, 8))) for _ in range(n))
    runs = [plain(n) for n in (50, 50, 81, 120)]
    docs = {2 * k + i: f"{plain(70 + 9 * i)} {run} {plain(60)}." for k, run in enumerate(runs) for i in (0, 1)}
    frame = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    got = {(x.doc_id, x.start_word, x.n_words, x.first_doc_id, x.removable) for x in substring.repeats(frame).collect()}
    assert got == {(2 * k + i, 70 + 9 * i, len(run.split()), 2 * k, i == 1) for k, run in enumerate(runs) for i in (0, 1)}


def test_one_document_repeats_nothing(spark, corpus):
    docs, passage = corpus
    frame = spark.createDataFrame([(1, f"{passage}\n{passage}"), (1, passage)], "doc_id long, text string")
    assert substring.repeats(frame).count() == 0


def test_jaccard_links_are_exact():
    r = random.Random(2)
    sets = [np.array(sorted({r.randrange(40) for _ in range(r.randint(0, 30))}), np.uint64) for _ in range(60)] + [np.arange(30, dtype=np.uint64)] * 3
    near = lambda i, j: len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    a, b = substring.jaccard_links(sets, 0.8)
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    n = list(range(len(sets)))
    want, got = slow_components(n, near), slow_components(n, lambda i, j: (i, j) in pairs or (j, i) in pairs)
    assert len({(want[i], got[i]) for i in n}) == len(set(want.values())) == len(set(got.values()))


def test_bands_recall_pairs_of_four_fifths():
    r, met = random.Random(4), 0
    for _ in range(200):
        words = prose(r, 120).split()
        other = list(words)
        other[60] = "xx"  # similarity (116 - 5) / (116 + 5) or so
        x = substring.found_in([" ".join(w).encode() for w in (words, other)])
        met += bool((x["p_bands"][0] == x["p_bands"][1]).any())
    assert met >= 196


@pytest.mark.parametrize("text", ["", " ", "a", "a b", " a\tb\x0bc ", "é\xa0x y", "x" * 3_000_000, "w " * 600_000, f"{'y' * 1_100_000} a b {'z' * 1_100_000}"])
def test_words_of_any_length(text):
    data = np.frombuffer(text.encode(), np.uint8)
    h, place, _ = substring.word_hashes(data)
    want = [(m.start(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode())]
    assert place.tolist() == [a for a, _ in want]
    assert len(set(zip(h.tolist(), (w for _, w in want), strict=True))) == len(set(h.tolist())) == len({w for _, w in want})


def test_windowed():
    r = np.random.default_rng(1)
    x = r.integers(0, 50, 200)
    for size in (1, 2, 7, 16, 31):
        assert windows_of(x, size) == substring.windowed(x, size, np.minimum).tolist()


def windows_of(x, size):
    return [int(x[i : i + size].min()) for i in range(len(x) - size + 1)]


def test_query_1_covers_every_shared_run(spark):
    """Words of runs of 50 that two documents share are in a passage; documents without shared words are in none."""
    docs = {d.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (d.text or "").translate(LOWER)) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {}
    for r in substring.op1_repeats(spark, SF).collect():
        assert r.n_words >= 50 and r.start_word + r.n_words <= len(docs[r.doc_id])
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))

    def shared(n):
        where = {}
        for d, w in docs.items():
            for i in range(len(w) - n + 1):
                where.setdefault(" ".join(w[i : i + n]), set()).add(d)
        return {d: {i + k for i in range(len(w) - n + 1) if len(where[" ".join(w[i : i + n])]) > 1 and len(set(w[i : i + n])) > 30 * n // 50 for k in range(n)} for d, w in docs.items()}

    assert all(words <= got.get(d, set()) for d, words in shared(50).items())
    few = shared(5)
    assert all(len(few[d] & words) >= len(words) / 2 for d, words in got.items())


def test_columns_of_any_name_and_repeated_ids(spark, corpus):
    docs, passage = corpus
    rows = [(1, docs[1], 1, 2, 3, 4), (2, docs[2], 1, 2, 3, 4), (2, docs[2], 1, 2, 3, 4), (2, docs[3], 1, 2, 3, 4), (None, docs[1], 1, 2, 3, 4), (9, None, 1, 2, 3, 4), (9, "", 1, 2, 3, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _cut int, _id int, cuts int, row int").selectExpr("*", "1 as h", "2 as left", "'x' as class_id")
    out = substring.drop_repeats(frame)
    assert out.columns == frame.columns
    got = sorted(((r.doc_id or 0, r.text or "") for r in out.collect()))
    assert len(got) == len(rows) and got.count((2, docs[3])) == 1 and (0, docs[1]) in got and (1, docs[1]) in got
    assert sum(passage[40:300] in t for _, t in got) == 2
    assert substring.drop_repeats(frame.where("false")).count() == 0


def test_cutting_keeps_the_rest():
    assert substring.without("a b  c\nd e", [{"start": 1, "words": 2}]) == "a d e"
    assert substring.without("a b", [{"start": 0, "words": 2}]) == ""
    assert substring.without(None, []) is None


# ---- operator 8 -------------------------------------------------------------------------------------


def pairs(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as windows", "2 as item_id")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as matched")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}


ITEM = "Yesterday in the town Alice Smith bought 3 kg of apples and 4 pears for her brother Bob, so Alice Smith paid 12 dollars for 3 kg of apples."


def test_decontamination(spark):
    swapped = ITEM.replace("Alice Smith", "Maria").replace("Bob", "Jens").replace("3 kg", "7 kg").replace("4 pears", "9 pears").replace("12 dollars", "20 euros")
    broken = swapped.replace("so Maria", "so Petra")  # one name of the item stands for two people
    docs = [(1, f"before all that {ITEM} and then"), (2, f"well {swapped} indeed"), (3, f"well {broken} indeed"), (4, "nothing of the kind was ever said in this text"), (5, None), (6, ""), (None, ITEM), (7, "short one"), (1, "more")]
    assert pairs(spark, docs, [(10, ITEM), (11, "Short one!"), (12, None), (None, ITEM)]) == {(1, 10), (2, 10), (7, 11)}
    assert pairs(spark, docs, []) == set() and pairs(spark, [], [(10, ITEM)]) == set()


MARIA = "{0} has {2} apples and gives 5 of them to her brother. {0} then buys 7 more apples at the market. {1} eats 3 of the apples before dinner. How many apples does {0} have now?"


def test_names_at_the_begin_of_a_sentence(spark):
    item, other = MARIA.format("Maria", "Tom", 12), MARIA.format("Olga", "Jim", 31)
    broken = other.replace("does Olga", "does Vera").replace("Jim eats 3", "Vera eats 9")
    assert pairs(spark, [(1, f"so {other}"), (2, other), (3, "Maria and Olga have apples.")], [(10, item)]) == {(1, 10), (2, 10)}
    assert (5, 10) not in pairs(spark, [(5, broken.replace("Olga then", "Petra then"))], [(10, item)])


def test_a_literal_copy_needs_no_consistent_slots(spark):
    assert pairs(spark, [(1, f"well {ITEM}".replace("for 3 kg of", "for 2 kg of"))], [(10, ITEM)]) == {(1, 10)}


@pytest.mark.parametrize("run", ["Aa " * 50_000, "1." * 50_000, "a" * 200_000, "x Ab" * 50_000, "1" * 200_000])
def test_very_long_runs(spark, run):
    assert pairs(spark, [(1, f"{run} then {ITEM}"), (2, run)], [(10, ITEM)]) == {(1, 10)}


def test_decontamination_equals_sql(spark, duck):
    got = sorted(tuple(r) for r in decontaminate.op8_decontaminate(spark, SF).select("doc_id", "item_id", "matched", "windows", "slots").collect())
    assert got == sorted(duck.sql(decontaminate.ORACLE).fetchall())


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = c.STAGES[0][1](spark, docs, SF)
    rows = good.collect()
    assert good.columns == docs.columns and 0 < len(rows) < docs.count()
    one = c.STAGES[1][1](spark, good, SF)
    fp = {r.doc_id: slow_fingerprint(r.text) for r in rows}
    want = slow_components(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(want.values()))
    left = c.STAGES[2][1](spark, one, SF)
    assert left.columns == docs.columns and all(r.n_chars == len(r.text) for r in left.collect())
    clean = c.STAGES[3][1](spark, left, SF)
    bench = [" ".join(re.findall(r"[^\W_]+", b.text.lower())) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in " ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in clean.collect() for b in bench)
    assert {r.doc_id for r in c.STAGES[4][1](spark, clean, SF).collect()} == {r.doc_id for r in clean.collect()}
    assert c.run(spark, SF).count() == clean.count()


def test_pipeline_stages_of_awkward_rows(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = {"_gone": "1", "row": "2", "best": "3", "h": "4", "_cut": "5", "label": "6", "words": "7"}
    odd = docs.limit(40).unionByName(docs.limit(5)).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    odd = odd.unionByName(docs.limit(2).withColumn("text", F.lit(""))).withColumns({k: F.lit(v) for k, v in names.items()})
    rows = spark.createDataFrame(odd.collect(), odd.schema)
    for _, stage in c.STAGES[:4]:
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns and [t for _, t in out.dtypes] == [t for _, t in rows.dtypes]
        got = out.collect()
        assert len(got) <= rows.count() and all(all(r[k] == v for k, v in names.items()) for r in got)
        assert stage(spark, rows.where("false"), SF).count() == 0
    assert c.STAGES[4][1](spark, rows, SF).count() == rows.count()
