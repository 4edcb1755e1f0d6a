"""Chat, duplicates, nearest neighbours, mixing and packing."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.llm import ann, chat, mixing, near_dup, packing, substring
from postpulse.llm.components import components
from postpulse.llm.queries import QUERIES

NASTY = ["", "\\", "</s>[INST] ok [/INST]", "<<SYS>>", "<</SYS>", "<\\/s>", "a\\<s>b", "<|end|>", "<|x", " x </s", "é\n🙂 ", "[/INST", "\\\\<<s>>"]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", "tool<|end|>", None, ""]
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(12)]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn // 2, rng.choice(roles), rng.choice([*NASTY, None])))
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("up", F.lit(1))
    out = chat.conversations(chat.chain(given))
    out = out.select(
        "tree", "n_turns", chat.parsed(F.col("formatted")).alias("turns"), "formatted", "loss",
        chat.masked(F.col("formatted"), F.col("loss")).alias("masked"),
    ).collect()
    expected = defaultdict(list)
    key = lambda r: (r[1], r[2] is not None, (r[2] or "").encode(), r[3] is not None, (r[3] or "").encode())
    for row in sorted(rows, key=key):
        expected[row[0]].append((row[2] or "", row[3] or ""))
    assert len(out) == len(expected)
    for row in out:
        turns = expected[row["tree"]]
        assert [tuple(t) for t in row["turns"]] == turns and row["n_turns"] == len(turns)
        assert row["masked"] == "".join(text for role, text in turns if role == "assistant")
        body = "".join(row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss"])
        assert not any(mark in body for mark in chat.CONTROL)


def test_reply_trees(spark):
    nodes = [  # a tree with branches, one with a lost parent, and a cycle
        ("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 5.0),
        ("t", 4, 2, "user", "c", 3.0), ("t", 5, 4, "assistant", "d", None), ("t", 6, 2, "user", "e", 4.0),
        ("u", 1, 99, "user", "alone", 0.0), ("v", 1, 2, "user", "x", 0.0), ("v", 2, 1, "user", "y", 0.0),
        ("v", 3, 2, "user", "z", 0.0), (None, 7, None, "user", "null tree", 0.0),
    ]
    table = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    out = chat.conversations(table, best=2).select("tree", "leaf", chat.parsed(F.col("formatted")).alias("turns")).collect()
    found = {(r["tree"], r["leaf"]): [t["text"] for t in r["turns"]] for r in out}
    assert found == {  # leaves 3 and 6 score 5; leaf 5 scores 4
        ("t", 3): ["root", "b"], ("t", 6): ["root", "a", "e"], ("u", 1): ["alone"], (None, 7): ["null tree"],
    }
    assert chat.conversations(table.limit(0)).count() == 0


def test_deep_tree(spark):
    nodes = spark.range(1, 301).select(
        F.lit("t").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
        F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(1.0).alias("score"),
    )
    row = chat.conversations(nodes).select(chat.parsed(F.col("formatted")).alias("turns")).first()
    assert [t["text"] for t in row["turns"]] == [str(i) for i in range(1, 301)]


def multiset(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def brute_classes(texts):
    bags = {i: multiset(t) for i, t in texts.items()}
    shared = defaultdict(set)
    for i, bag in bags.items():
        for shingle in bag:
            shared[shingle].add(i)
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, bag in bags.items():
        for j in set().union(*(shared[s] for s in bag)) if bag else ():
            if j < i and similarity(bag, bags[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(5)
    n, m = 2, 96
    agree, trials = 0, 60
    a = {k: int(rng.integers(1, 12)) for k in range(60)}
    b = {k: max(0, v + int(rng.integers(-4, 5))) for k, v in a.items()}
    expected = sum(min(a[k], b[k]) for k in a) / sum(max(a[k], b[k]) for k in a)
    for _ in range(trials):
        names = rng.integers(1, 1 << 62, 60).astype(np.uint64)
        rows = [(d, names[k], bag[k]) for d, bag in enumerate((a, b)) for k in bag if bag[k]]
        docs, hashes, counts = (np.array(x) for x in zip(*rows))
        found = near_dup.bag_minhash(docs, hashes.astype(np.uint64), counts, n, m)
        agree += (found[0] == found[1]).mean()
    assert agree / trials == pytest.approx(expected, abs=0.03)


def _near_copies():
    rng = random.Random(11)
    vocabulary = ["w%d" % i for i in range(400)]
    texts, i = {}, 0
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([60, 200, 900]))] for _ in range(12)]
    for base in bases:
        for _ in range(rng.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rng.randrange(0, max(1, len(words) // 90) + 1)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts[i] = " ".join(words)
            i += 1
    for text in ["", "  ", "one", "one", "one two", "one  two", "two one", "x " * 40, "x " * 50, "x " * 44, None]:
        texts[i] = text
        i += 1
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = _near_copies()
    rows = [(i, t, 1.0) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key double").repartition(4)
    found = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert found == brute_classes(texts)
    kept = near_dup.keep_first(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(found.values()))


def test_near_duplicate_edge_rows(spark):
    text = " ".join(map(str, range(30)))
    rows = [(5, text), (5, text), (2, text + " "), (None, text), (None, None), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(str(r["doc_id"]), r["class_id"]) for r in near_dup.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [("2", 2), ("5", 2), ("5", 2), ("8", 8), ("9", 9), ("None", 2), ("None", None)], key=str
    )
    assert sorted(str(r["doc_id"]) for r in near_dup.keep_first(docs).collect()) == ["2", "8", "9", "None"]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
    assert near_dup.keep_first(docs.limit(0)).count() == 0


def test_repeated_and_missing_ids_lose_no_text(spark):
    """Rows that repeat an id, or have none, are kept by their texts' classes."""
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    near = b.replace("b59", "other")
    cases = [
        ([(5, a), (5, b), (7, b)], [(5, a), (5, b)]),
        ([(5, a), (5, b), (5, b), (7, a), (9, c)], [(5, a), (5, b), (9, c)]),
        ([(None, a), (None, a), (None, b)], [(None, a), (None, b)]),
        ([(None, b), (3, near), (None, c)], [(3, near), (None, c)]),
        ([(None, b), (None, near), (None, a)], None),
        ([(4, None), (4, None), (None, ""), (None, " ")], [(4, None), (4, None), (None, ""), (None, " ")]),
    ]
    for rows, kept in cases:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("_row", "_first", "_id", "_digest", "_seen", "_lost", "_hash", "_word", "_bits", "class", "digest", "n"):
            docs = docs.withColumn(name, F.lit(f"own {name}"))
        out = near_dup.keep_first(docs)
        assert out.columns == docs.columns
        found = out.collect()
        assert all(r["_first"] == "own _first" and r["class"] == "own class" and r["n"] == "own n" for r in found)
        found = sorted(((r["doc_id"], r["text"]) for r in found), key=str)
        if kept is None:  # either of the two near texts
            assert len(found) == 2 and found[0] == (None, a)
        else:
            assert found == sorted(kept, key=str), rows


def test_star_of_copies_without_mutual_similarity(spark):
    """Copies that are near to the base, but not to each other."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(300)]
    texts = {40: " ".join(base)}
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(0, 300, 6), 5):
            words[at] = f"n{i}-{at}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["class_id"] for r in near_dup.near_duplicates(docs).collect()} == {0}


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[j] == 100 for j in range(100, 160))
    assert all(found[a] == found[b] <= min(a, b) for a, b in edges)


def brute_repeats(rows, span=50):
    first = {}
    bags = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in bags:
        for at in range(len(words) - span + 1):
            if i is not None:
                gram = tuple(words[at : at + span])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, words in bags:
        gone = set()
        for at in range(len(words) - span + 1):
            if i is not None and first[tuple(words[at : at + span])] < i:
                gone.update(range(at, at + span))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_repeats_equal_brute_force(spark):
    rng = random.Random(9)
    fresh = iter(range(10**6))
    passage = [[f"p{k}-{i}" for i in range(n)] for k, n in enumerate((49, 50, 51, 120, 70))]
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"f{next(fresh)}" for _ in range(rng.choice([0, 3, 60]))] + rng.choice(passage)[rng.randrange(2) :]
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(words)))
    whole = passage[3] + passage[4]
    rows += [(41, " ".join(whole)), (42, " ".join(whole)), (42, " ".join(whole)), (43, "  ".join(whole[:100] + whole[60:]))]
    rows += [(44, " ".join(["same"] * 130)), (45, " ".join(["same"] * 60)), (46, ""), (47, None), (None, " ".join(whole))]
    rows += [(48, "a\xa0b \x85 c"), (49, " ".join(f"u{i % 60}" for i in range(400)))]
    # Different texts of one id, each with its own repeats.
    rows += [(50, " ".join(["v", *passage[2], "w"])), (50, " ".join(["v", "x", *passage[4]])), (50, "y " * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).repartition(3)
    found = substring.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute_repeats(rows)
    texts = {i: (t or "").encode().split() for i, t in rows if i != 50}
    for row in found:
        covered = set()
        for f in row["factors"]:
            span = range(f["start"], f["start"] + f["length"])
            assert f["length"] >= 50 and f["ref_doc"] < row["doc_id"] and not covered.issuperset(span)
            covered.update(span)
            ref = texts[f["ref_doc"]][f["ref_start"] :][: f["length"]]
            if row["doc_id"] != 50:
                assert ref == texts[row["doc_id"]][span.start : span.stop]
        # The factors are what is removed.
        assert len(covered) == row["n_removed"]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_factors_are_greedy_and_checked_at_their_ends(spark):
    """One place is followed for as long as it goes; a window across its end that
    the reference holds elsewhere starts a factor of its own, in the overlap."""
    a, b = [[f"{name}{i}" for i in range(120)] for name in "ab"]
    seam = a[-30:] + b[:60]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(seam)), (4, " ".join(["z", *a, *b])), (5, " ".join(a[:100] + b[40:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row["doc_id"]: row for row in substring.remove_repeats(docs).collect()}
    factors = {i: [tuple(f) for f in row["factors"]] for i, row in found.items()}
    assert factors[1] == factors[2] == []
    assert factors[3] == [(30, 60, 2, 0)]
    assert factors[4] == [(1, 120, 1, 0), (91, 79, 3, 0), (121, 120, 2, 0)]
    assert factors[5] == [(0, 100, 1, 0), (100, 80, 2, 40)]
    assert [found[i]["n_removed"] for i in range(1, 6)] == [0, 0, 60, 240, 180]


def brute_nearest(vectors, queries, k):
    ids = sorted(vectors)
    out = {}
    for q in queries:
        scored = sorted((-float(np.dot(vectors[q], vectors[i])), i) for i in ids if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_nearest_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows}
    expected = brute_nearest(vectors, [i for i in vectors if i % 20 == 0], 20)
    found = defaultdict(list)
    for r in sorted(QUERIES["op7_ann_search"](spark, sf_dir).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append(r["vec_id"])
        assert r["score"] == pytest.approx(float(np.dot(vectors[r["query_id"]], vectors[r["vec_id"]])), rel=1e-12)
    assert set(found) == set(expected) and all(len(v) == 20 for v in found.values())
    assert np.mean([len(set(found[q]) & set(expected[q])) / 20 for q in expected]) >= 0.9


def test_nearest_of_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 24))
    vectors = {i: centres[i % 30] * 3 + rng.normal(size=24) * 0.3 for i in range(3000)}
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in sorted(ann.nearest(rows, F.col("vec_id") % 100 == 0, k=10).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append(r["vec_id"])
    expected = brute_nearest(vectors, [i for i in vectors if i % 100 == 0], 10)
    assert np.mean([len(set(found[q]) & set(expected[q])) / 10 for q in expected]) >= 0.9


def test_probing_and_scanning_find_the_same():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 1 << 63, (3000, 2), dtype=np.uint64)
    queries = codes[:40] ^ (np.uint64(1) << rng.integers(0, 63, (40, 2), dtype=np.uint64))
    for radius in (0, 2, 9):
        pairs = {p for q, c in ann.within_radius(codes, queries, radius) for p in zip(q.tolist(), c.tolist())}
        apart = ann.hamming(queries[:, None], codes[None])
        assert pairs == {(int(q), int(c)) for q, c in zip(*np.nonzero(apart <= radius))}


@pytest.mark.parametrize("hot", [10_000, 20])
def test_index_of_all_codes_finds_each_pair_once(spark, monkeypatch, hot):
    """Also where values are shared by a third of all codes, and salted."""
    monkeypatch.setattr(ann, "HOT_CODES", hot)
    rng = np.random.default_rng(9)
    codes = rng.integers(0, 1 << 63, (900, 2), dtype=np.uint64)
    codes[:300] = codes[0] ^ (np.uint64(1) << rng.integers(0, 63, (300, 2), dtype=np.uint64))
    codes[300:330] = codes[0]
    queries = np.concatenate([codes[:3], codes[400:420] ^ np.uint64(5)])
    shape = "key long, hash long, code binary"
    index = spark.createDataFrame([(i, -i, bytearray(c.tobytes())) for i, c in enumerate(codes)], shape)
    asked = spark.createDataFrame([(i, 7, bytearray(c.tobytes())) for i, c in enumerate(queries)], shape)
    apart = ann.hamming(queries[:, None], codes[None])
    for width, radius in ((8, 0), (8, 17), (16, 3), (16, 9), (32, 1), (32, 6)):
        pairs = ann.within_radius_by_index(index, asked, radius, width, 128).collect()
        assert all(r["hash"] == -r["key"] and r["qhash"] == 7 for r in pairs)
        expected = sorted((int(q), int(c)) for q, c in zip(*np.nonzero(apart <= radius)))
        assert sorted((r["qkey"], r["key"]) for r in pairs) == expected


def test_radius_is_that_of_true_neighbours(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(700, 12))
    vectors[5] = vectors[4]
    coder = ann.learn(vectors[:50], float(np.linalg.norm(vectors, axis=1).max()))
    codes = coder.codes(vectors, False)
    rows = [(i, i + 1, bytearray(v.tobytes()), bytearray(c.tobytes())) for i, (v, c) in enumerate(zip(vectors, codes))]
    index = spark.createDataFrame(rows, "key long, hash long, vec binary, code binary").repartition(5)
    keys = np.array([(i, i + 1) for i in range(50)])
    apart = ann._neighbours_apart(index, vectors[:50], keys, coder, 7)
    near = brute_nearest(dict(enumerate(vectors)), range(50), 7)
    expected = [ann.hamming(coder.codes(vectors[q : q + 1], True), codes[near[q]]) for q in range(50)]
    assert sorted(apart) == sorted(np.concatenate(expected))
    assert not len(ann._neighbours_apart(index.filter("key = 0"), vectors[:1], keys[:1], coder, 7))


def test_shares_cover_the_radius():
    for bits in (8, 40, 128, 256):
        for width in ann.WIDTHS:
            for radius in range(bits + 1):
                # Codes further apart than each share are further apart than the radius.
                assert sum(share + 1 for share in ann.shares(bits, width, radius)) == radius + 1


def test_tight_clusters_are_probed_in_rounds(spark, monkeypatch):
    """Tight clusters on a sphere use the index; of few members, they need a
    larger radius. (Vectors of varying lengths have larger radii.)"""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(90, 32))
    vectors = {i: centres[i % 80] + rng.normal(size=32) * 0.02 for i in range(4000)}
    vectors |= {4000 + i: centres[80 + i % 10] + rng.normal(size=32) * 0.02 for i in range(41)}
    vectors = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    learned, calibrated = [], ann.calibrated
    # The cost of a scan, as if there were four times as many vectors.
    monkeypatch.setattr(ann, "SCAN_COST", 4 * ann.SCAN_COST)
    monkeypatch.setattr(ann, "calibrated", lambda *given: learned.append(calibrated(*given)) or learned[-1])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    wanted = [i for i in vectors if i % 100 == 0 or i > 4035]
    found = defaultdict(list)
    near = ann.nearest(rows, (F.col("vec_id") % 100 == 0) | (F.col("vec_id") > 4035), k=10)
    for r in sorted(near.collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append(r["vec_id"])
    radii, widths = zip(*learned[0].rounds)
    assert len(radii) > 2 and list(radii) == sorted(set(radii))
    assert set(widths[:-1]) <= set(ann.WIDTHS) and learned[0].rounds[-1] == (learned[0].bits, None)
    expected = brute_nearest(vectors, wanted, 10)
    assert all(len(found[q]) == 10 for q in wanted)
    assert np.mean([len(set(found[q]) & set(expected[q])) / 10 for q in expected]) >= 0.9


def test_nearest_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0])] * 2 + [(i, [1.0, 0.0]) for i in range(1, 60)]
    rows += [(60, [0.0, 0.0]), (61, [nan, 1.0]), (62, [inf, 1.0]), (63, None), (64, []), (65, [None, 1.0]), (66, [1.0]),
             (None, [1.0, 0.0]), (80, [-1.0, 0.5]), (100, [0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    found = defaultdict(list)
    for r in sorted(ann.nearest(table, F.col("vec_id") % 20 == 0, k=5).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append(r["vec_id"])
    assert found == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4], 80: [100, 0, 1, 2, 3], 100: [80, 0, 1, 2, 3]}
    few = ann.nearest(table.filter(F.col("vec_id").isin(0, 100)), F.col("vec_id") % 20 == 0)
    assert sorted((r["query_id"], r["vec_id"]) for r in few.collect()) == [(0, 100), (100, 0)]
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        level = rest / sum(weights[s] for s in free) if free else 0
        over = [s for s in free if level * weights[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weights[s]) for s in names}
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", [0, 1])
def test_mixing(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "z", "é", "", None, "tiny", "empty", "big"]
    rows = []
    for i in range(1500):
        source = rng.choice(sources + ["big"] * 9)
        size = 0 if source == "empty" else rng.randrange(0, 30 if source == "tiny" else 900)
        rows.append((i, source, size, "keep"))
    rows += [rows[0]] * 3 + [(None, "a", 40, "keep")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, target string").repartition(5)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, source, size, _ in rows:
        sizes[source] += size
    targets = brute_targets(sizes)
    taken = Counter()
    for r in found:
        assert 0 <= r["copies"] <= 3 and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.02 * target + 30, source
    again = mixing.mix(docs.repartition(2)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"], r["rate"])
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rates_are_tilted_and_splits_agree(spark, monkeypatch):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
        F.when(F.col("id") < 300, 100).otherwise(F.col("id") % 50 + 5).cast("long").alias("size"),
    )
    plain = mixing.mix(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")), F.max("target")).collect()
    monkeypatch.setattr(mixing, "CELL_ROWS", 7)
    mixed = mixing.mix(docs)
    split = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")), F.max("target")).collect()
    for row in plain + split:
        assert abs(row[1] - row[2]) <= 0.01 * row[2] + 5
    free = [r for r in mixed.collect() if 0 < r["rate"] < 3 and r["size"]]
    for source in {r["source"] for r in free}:
        slopes = [np.log(r["rate"]) / r["size"] for r in free if r["source"] == source]
        assert np.ptp(slopes) < 1e-6


def test_no_words_at_all(spark):
    docs = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [(r["target"], r["copies"] * r["size"]) for r in mixing.mix(docs).collect()] == [(0.0, 0), (0.0, 0)]


def check_bins(pieces, sizes, clusters, capacity, per_source):
    bins, words = defaultdict(list), Counter()
    for p in pieces:
        if p["bin"] is not None:
            bins[p["bin"]].append(p)
            words[p["doc_id"]] += p["n"]
    for own in bins.values():
        own.sort(key=lambda p: p["position"])
        at = 0
        for p in own:
            assert p["position"] == at
            at += p["n"]
        assert at <= capacity
        if len(own) > 1:
            known = [p["cluster"] for p in own if p["cluster"] is not None]
            assert len(known) == len(set(known))
            assert max(Counter(p["source"] for p in own).values()) <= per_source
    for doc, size in sizes.items():
        assert words[doc] == size
    return bins


def test_packing(spark):
    rng = random.Random(6)
    rows = []
    for i in range(900):
        cluster = rng.choice([None, 7, 7, rng.randrange(40), 1000 + i])
        rows.append((i, rng.choice(["hot", "hot", "a", "b", None]), cluster, rng.choice([0, 1, 10, 64, 99, 100, 250, 40])))
    docs = spark.createDataFrame(rows, "doc_id long, source string, cluster long, size long").withColumn("bin", F.lit(0))
    pieces = packing.pack(docs, capacity=100, per_source=3, shard_rows=200).collect()
    sizes = {r[0]: r[3] for r in rows}
    bins = check_bins(pieces, sizes, {r[0]: r[2] for r in rows}, 100, 3)
    assert {p["doc_id"] for p in pieces} == set(sizes)
    assert len(bins) < 2 * sum(sizes.values()) / 100 + 500
    assert packing.pack(docs.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(100, 1)
    assert bins.place(60, 1, 0) == (0, 0)
    assert bins.place(50, 2, 1) == (1, 0)
    assert bins.place(30, 4, 1) == (0, 60)  # 40 left fits tighter than 50
    assert bins.place(10, 4, 0) == (1, 50)  # bin 0 has the source
    assert bins.place(5, 8, 1) == (2, 0)  # both bins have the cluster


def brute_best_fit(items, capacity, per_source):
    bins = []
    for size, source, cluster in items:
        fits = [
            (capacity - b["n"] - size, i) for i, b in enumerate(bins)
            if b["n"] + size <= capacity and b["s"][source] < per_source and (not cluster or cluster not in b["c"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"n": 0, "s": Counter(), "c": set()})
            i = len(bins) - 1
        bins[i]["n"] += size
        bins[i]["s"][source] += 1
        bins[i]["c"].add(cluster)
    return sorted(b["n"] for b in bins)


def test_best_fit_fills_like_brute_force():
    rng = random.Random(1)
    items = sorted([(rng.randrange(1, 60), rng.randrange(4), 0) for _ in range(300)], reverse=True)
    bins = packing.Bins(100, 50)
    filled = Counter()
    for size, source, cluster in items:
        k, _ = bins.place(size, 1 << source, cluster)
        filled[k] += size
    assert sorted(filled.values()) == brute_best_fit(items, 100, 50)


def test_packing_query(spark, sf_dir):
    pieces = QUERIES["op10_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    sizes = {r["doc_id"]: len(r["text"].encode().split()) for r in docs}
    bins = check_bins(pieces, sizes, {}, packing.CAPACITY, packing.PER_SOURCE)
    assert len(bins) <= 1.3 * sum(sizes.values()) / packing.CAPACITY + 2


def test_repeated_rows_are_dealt_over_shards(spark):
    from collections import Counter

    repeated = spark.range(9000).selectExpr("cast(null as long) doc_id", "'s' source", "7L cluster", "5L size")
    others = spark.range(3000).selectExpr("id doc_id", "concat('s', id % 9) source", "id cluster", "id % 40 size")
    pieces = packing.pack(repeated.unionByName(others), shard_rows=200).collect()
    assert Counter((r["doc_id"], r["cluster"]) for r in pieces) == Counter({(None, 7): 9000} | {(i, i): 1 for i in range(3000)})
    shards = Counter(r["bin"] >> 32 for r in pieces if r["bin"] is not None)
    assert len(shards) == 60 and max(shards.values()) < 300
    bins = Counter(r["bin"] for r in pieces if r["doc_id"] is None)
    assert max(bins.values()) == 1


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["_size", "_source", "_fixed", "_extras", "_bucket", "_rank", "n", "weight", "_splits", "_copy", "_row", "row"]
    docs = spark.createDataFrame([(i, f"s{i % 3}", i % 7) for i in range(60)], "doc_id long, source string, size long")
    plain = mixing.mix(docs).select("doc_id", "copies").collect()
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), "doc_id"))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, *mixing.ADDED]
    found = mixed.collect()
    assert sorted((r["doc_id"], r["copies"]) for r in found) == sorted(map(tuple, plain))
    assert all(r[name] == f"{name} {r['doc_id']}" for r in found for name in names)
    assert set(names) <= set(mixing.repeat_copies(mixed).columns)
