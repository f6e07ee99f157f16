"""Prefix trie, hard negatives and SimHash against plain Python, on awkward tables."""

import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from viewtide.llm import hard_negatives, positions, prefix_trie, simhash

# -- running -------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_running_over_groups_that_span_tasks(spark, parts):
    rng = random.Random(5)
    keys = ["hot"] * 300 + [None] * 40 + [f"k{i}" for i in range(30)] * 2
    rows = [(k, rng.randrange(50) if i % 9 else None, rng.randrange(-99, 99)) for i, k in enumerate(keys)]
    frame = spark.createDataFrame(rows, "k string, o int, v long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        twice = frame.withColumn("w", F.col("v"))
        order = [F.col("o").asc_nulls_first(), "v"]
        got = positions.running(twice, ["k"], order, ["v"], ["w"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    groups, seen = defaultdict(list), defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    for r in got:
        seen[r["k"]].append(r)
    for key, members in groups.items():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        total, mixed = 0, 0
        for at, (want, r) in enumerate(zip(members, sorted(seen[key], key=lambda r: r["_at"]), strict=True)):
            assert (r["o"], r["v"], r["_at"], r["v_before"], r["w_before"]) == (*want[1:], at, total, mixed)
            total, mixed = total + want[2], mixed ^ want[2]


# -- prefix trie -----------------------------------------------------------------------------


def brute_trie(lists):
    """Nodes of conversations given as lists of (role, text)."""
    nodes = defaultdict(list)
    for conv, turns in lists.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(conv)
    children = defaultdict(int)
    for way in nodes:
        if way:
            children[way[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for way, members in nodes.items():
        gain = (len(members) - 1) * len(way[-1][1]) if way else 0
        for depth in range(len(way) + 1):
            leaves[way[:depth]] += not children[way]
            saved[way[:depth]] += gain
    return sorted(
        (min(m), len(w), -1 if not w else min(nodes[w[:-1]]), len(m), children[w], leaves[w], saved[w],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(lists[c]) == len(w)).encode()).hexdigest())
        for w, m in nodes.items()
    )


def trie_rows(frame):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in frame.collect())


def conversations(spark, lists, extra=()):
    rows = [(c, i, role, text) for c, turns in lists.items() for i, (role, text) in enumerate(turns)]
    frame = spark.createDataFrame([*rows, *extra], "conv_id long, turn long, role string, text string")
    return frame.withColumns({n: F.lit("x") for n in ("block", "node", "parent", "slot", "pos", "depth", "c0")})


def random_conversations(seed, count, longest):
    rng, out = random.Random(seed), {}
    pool = [("user", "a"), ("assistant", "a"), ("user", "été 😀"), ("", ""), ("u", "sera"), ("user", "a" * 50)]
    for c in range(count):
        start = list(out[rng.choice(list(out))]) if out and rng.random() < 0.8 else []
        start = start[: rng.randrange(len(start) + 1)] if rng.random() < 0.7 else start
        out[c * 3 - 40] = start + [rng.choice(pool) for _ in range(rng.randrange(longest) if rng.random() < 0.6 else 0)]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trie_of_long_conversations(spark, seed, monkeypatch):
    """Many blocks of columns, copies, conversations without turns, pieces of two ids."""
    monkeypatch.setattr(prefix_trie, "WIDTH", (3, 8, 2)[seed])
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    lists = random_conversations(seed, 60, 14)
    lists |= {1000 + i: [("user", "same")] * 29 for i in range(25)}
    frame = conversations(spark, lists)
    ids = spark.createDataFrame([(c,) for c in lists], "conv_id long")
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.ordered_turns(frame), ids)) == brute_trie(lists)


def test_trie_of_awkward_rows(spark):
    rows = [
        (1, None, None, "first"), (1, 2, "user", None), (1, 2, "user", None), (1, 1, "a", "b"),
        (2, 0, "", "first"), (2, 0, "a", "b"), (None, 0, "user", "nobody"), (None, None, None, None),
        (3, 5, "user", "long " * 200_000),
    ]
    frame = conversations(spark, {}, rows)
    turns = prefix_trie.ordered_turns(frame)
    ids = turns.select("conv_id").distinct()
    found = trie_rows(prefix_trie.prefix_trie(turns, ids))
    tie = sorted([("", "first"), ("a", "b")], key=lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest())
    lists = {1: [("", "first"), ("a", "b"), ("user", ""), ("user", "")], 2: tie, 3: [("user", "long " * 200_000)]}
    assert found == brute_trie(lists)
    texts = {bytes(r["turn_id"]): (r["role"], r["text"]) for r in prefix_trie.turn_texts(frame).collect()}
    assert {texts[bytes(r["turn_id"])] for r in turns.where("conv_id = 1").collect()} == set(lists[1])
    none = frame.where("conv_id IS NULL")
    empty = prefix_trie.ordered_turns(none)
    assert prefix_trie.prefix_trie(empty, empty.select("conv_id")).count() == 0


def test_rebuilt_conversations(spark):
    lists = {c: [("user", f"{c % 7}-{i}") for i in range(n)] for c, n in
             [(0, 3), (1, 8), (2, 1), (3, 4), (199, 7), (300, 9), (301, 2), (302, 2), (350, 6), (-205, 4), (-200, 9)]}
    turns = prefix_trie.ordered_turns(conversations(spark, lists))
    rows, ids = prefix_trie.rebuilt(turns)
    import zlib

    want = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        want[c] = lists.get(base, [])[:h] + own[h:]
    assert trie_rows(prefix_trie.prefix_trie(rows, ids)) == brute_trie(want)


# -- hard negatives ------------------------------------------------------------------------


def brute_negatives(rows, asks, n_positives, n_negatives):
    """rows: (vec_id, label, whole vector)."""
    out = []
    for i, (anchor, label, v) in enumerate(rows):
        if not asks(anchor):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), o, j, l) for j, (o, l, w) in enumerate(rows) if j != i]
        for ps, p, _, _ in sorted(s for s in scored if s[3] == label)[:n_positives]:
            fits = sorted(s for s in scored if s[3] != label and -30 * ps <= -100 * s[0] <= -90 * ps)
            out += [(anchor, p, rank, n[1], -ps, -n[0]) for rank, n in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("seed", range(3))
def test_negatives_against_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 5))
    rows = []
    for i in range(400):
        v = np.round(centres[i % 6] * 20 + rng.normal(size=5) * 6).astype(int).tolist()
        rows.append((i if i % 17 else i // 2, int(rng.integers(0, 4)), v[: 5 if i % 11 else 3]))
    rows += [rows[40]] * 5 + [(7, 2, []), (8, 2, [0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, label long, vector array<int>")
    got = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, 3, 4, shard_rows=(40, 90, 1000)[seed], block=(7, 20, 99)[seed])
    assert sorted(tuple(r[n] for n in NAMES) for r in got.collect()) == brute_negatives(rows, lambda i: i % 10 == 0, 3, 4)


def test_large_scores_stay_whole(spark):
    top = hard_negatives.LARGEST - 1
    rows = [(0, 1, [top] * 40), (1, 1, [top] * 40), (2, 2, [top // 2] * 40), (3, 2, [top // 2 + 1] * 40)]
    frame = spark.createDataFrame(rows, "vec_id long, label long, vector array<int>")
    got = hard_negatives.mine(frame, F.col("vec_id") == 0)
    assert sorted(tuple(r[n] for n in NAMES) for r in got.collect()) == brute_negatives(rows, lambda i: i == 0, 5, 10)


def test_pages_are_pruned():
    """Far fewer rows are read than there are, and the answer is the same."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(c, 1, (400, 8)) for c in rng.normal(0, 30, (20, 8))]).round()
    ids = np.arange(len(vectors))
    tree = hard_negatives.build(ids, ids, ids % 3, vectors)
    read = []

    class Counted(hard_negatives.Windows):
        def offer(self, scores, ids, rows):
            read.append(len(scores))
            super().offer(scores, ids, rows)

    best = Counted(5, [(hard_negatives.LEAST, hard_negatives.MOST)])
    hard_negatives.search(tree, 0, 0, vectors[0], best, True)
    scores = vectors @ vectors[0]
    want = sorted((-scores[i], i) for i in ids if i % 3 == 0 and i)[:5]
    assert [(s, i) for s, i, _ in best.found[0]] == want and sum(read) < len(ids) / 10


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0], 1), (10, [1.0, None], 1), (20, [1.0, float("nan")], 1), (30, [float("inf"), 0.0], 1),
        (40, None, 1), (50, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (60, [1e30, 0.0], 1), (70, [-0.001, 0.999], 2),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {n: F.lit("x") for n in ("row", "shard", "block", "score", "vector")})
    used = hard_negatives.usable(frame)
    assert sorted(map(tuple, used.collect())) == [(0, 1, [256, 512]), (70, 2, [-1, 255])]
    assert hard_negatives.mine(used, F.lit(True)).count() == 0
    nothing = hard_negatives.mine(used.limit(0), F.lit(True))
    assert nothing.count() == 0 and nothing.columns == list(NAMES)


# -- SimHash ---------------------------------------------------------------------------------


def brute_print(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    """Smallest position reachable from each."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints_of_awkward_texts(awkward, no_documents):
    got = simhash.find(awkward).collect()
    rows = awkward.collect()
    assert len(got) == len(rows)
    want = {r["text"]: brute_print(r["text"]) for r in rows}
    by_id = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    for r in got:
        value = r["fingerprint"] % 2**64
        assert value in want.values()
        if r["doc_id"] is not None:
            assert value == want[by_id[r["doc_id"]]]
    of = {r["doc_id"]: r["component_id"] for r in got}
    assert of[2] == of[3] == of[4] == 2 and of[5] == of[6] == 5 and of[7] == 7
    nobody = {r["component_id"] for r in got if r["doc_id"] is None}
    assert nobody == {None, 2}
    assert simhash.find(no_documents).count() == 0


def test_stretches_do_not_change_a_fingerprint(monkeypatch):
    text = ("Été der " * 40 + "x" * 500 + " \t\n ok" * 30).encode()
    want = brute_print(text.decode())
    for stretch in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "STRETCH", stretch)
        assert simhash.fingerprint(np.frombuffer(text, np.uint8)) % 2**64 == want
    assert simhash.fingerprint(np.frombuffer(b"a B", np.uint8)) % 2**64 == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("parts,tile,radius", [(4, 5, 2), (1, 3, 2), (8, 100, 3), (2, 16, 0)])
def test_links_against_all_pairs(spark, parts, tile, radius):
    rng = random.Random(parts)
    prints = {0, 2**64 - 1, 1, 3}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            prints.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                x ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    found = simhash.links(frame, radius, parts, tile).collect()
    at = {s: i for i, s in enumerate(signed)}
    assert all((prints[at[a]] ^ prints[at[b]]).bit_count() <= radius for a, b in found)
    label = list(range(len(prints)))
    for a, b in found:
        one, two = label[at[a]], label[at[b]]
        label = [min(one, two) if x in (one, two) else x for x in label]
    assert label == brute_groups(prints, radius)


def test_a_group_of_near_copies_is_no_square_of_links():
    prints = np.array([1 << i | 1 << j for i in range(40) for j in range(i)], np.uint64)
    assert len(simhash.joining_links(prints, prints, 2)) == len(prints) - 1


def test_simhash_query(spark, sf_dir, tables):
    from viewtide.llm import queries

    got = {r["doc_id"]: r for r in queries.QUERIES["op13_simhash"](spark, sf_dir).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in tables["documents"].select("doc_id", "text").collect())
    prints = [brute_print(t) for _, t in docs]
    assert len(got) == len(docs)
    for (doc, _), value, low in zip(docs, prints, brute_groups(prints, 2)):
        assert got[doc]["fingerprint"] == f"{value:016x}" and got[doc]["component_id"] == docs[low][0]


# -- hot groups in chat and mixing -----------------------------------------------------------


def test_chat_parts_are_bounded_by_rows(spark, monkeypatch):
    """Many rows without a turn and a conversation, and many of one turn, in parts of four."""
    from viewtide.llm import chat

    monkeypatch.setattr(chat, "PART", 4)
    rng = random.Random(1)
    rows = [(None, None, rng.choice(["user", "assistant"]), f"t{i % 23}") for i in range(60)]
    rows += [(5, 2, "user", f"same {i % 3}") for i in range(30)] + [(5, i, "assistant", "x") for i in (0, 1, 3, 9)]
    rows += [(6, i, "user", f"{i}") for i in range(11)] + [(None, 7, "user", "late")]
    rows += [(None, None, None, None)] * 9
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(frame)
    sizes = [len(r["turns"]) for r in chat.read_back(formatted).collect()]
    assert max(sizes) <= 4 and sum(sizes) == len(rows)
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    for conv in (None, 5, 6):
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("text", ["three words here", None])
def test_mixing_a_source_under_one_id(spark, text):
    """Nine tenths of a source have one id, or all rows are copies: its target is still met."""
    from viewtide.llm import mixing

    rng = random.Random(2)
    rows = [(None if i % 10 else i, text or " ".join("w" * rng.randrange(1, 30)), "a") for i in range(1000)]
    rows += [(7000 + i, "one two three four five", f"s{i % 4}") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in mixing.mix_sources(frame).collect():
        taken[r["source"]] += r["size"] * r["times"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(target) == 5
    for source, want in target.items():
        assert abs(taken[source] - want) <= largest[source]


# -- bounded samples and shards -----------------------------------------------------------------


def test_language_sample_is_bounded_under_one_id(spark):
    """Most rows have one id or none, a third are copies of one text."""
    from viewtide.llm import language

    rows = [(None if i % 3 else 5, f"text number {i} of many words", "en" if i % 2 else "fr") for i in range(6000)]
    rows += [(9, "the same again", "en")] * 3000 + [(i, f"seltener text {i}", "de") for i in range(40)]
    docs = spark.createDataFrame([*rows, (7, None, "en")], "doc_id long, text string, lang string")
    sample = language.training_sample(docs, F.lit(True), 300).collect()
    found = defaultdict(set)
    for r in sample:
        found[r["lang"]].add(r["text"])
    assert sum(map(len, found.values())) == len(sample) < 450
    assert len(found["de"]) == 40 and 50 < len(found["fr"]) < 150 and 20 < len(found["en"]) < 150


def test_toxicity_sample_is_bounded_under_one_id(spark, monkeypatch):
    from viewtide.llm import toxicity

    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 200)
    bad = "A start. You are a blurgh and a gnarfle."
    rows = [(i % 4 if i % 8 else 100 + i, f"{bad if i % 2 else 'A calm text here.'} Number {i}.") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(4)] * 50 + [(100 + i, i % 2) for i in range(0, 4000, 8)], "doc_id long, toxic int")
    kept, write = [], toxicity.written

    def counted(frame, label):
        table = write(frame, label)
        kept.append((label, table.count()))
        return table

    monkeypatch.setattr(toxicity, "written", counted)
    model = toxicity.train(docs, labels, F.lit(True))
    assert all(n < 300 for label, n in kept if label == "toxic-sample")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs.where("doc_id < 4"), model).collect()}
    assert got[1] > 0.5 > got[2]


def test_neighbours_do_not_depend_on_the_cluster(spark):
    """Shards come from the rows; rows of one id and copies do not crowd one of them."""
    from viewtide.llm import neighbours

    rng = np.random.default_rng(4)
    rows = [(i if i % 3 else 7, rng.normal(size=6).tolist()) for i in range(900)] + [(8, [1.0] * 6)] * 700
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ready = neighbours.usable(frame)
    held = neighbours.build_index(ready, 4, 5).collect()
    import pickle

    sizes = [len(pickle.loads(r["tree"]).units) for r in held]
    assert len(sizes) == 4 and max(sizes) < 300 and sum(sizes) == 901
    asks = F.col("vec_id") % 50 == 0
    answers = [sorted(map(tuple, neighbours.nearest(f, asks).collect())) for f in (frame, frame.repartition(7))]
    assert answers[0] == answers[1] and answers[0]


def test_a_tree_comes_once_for_many_queries(spark, monkeypatch):
    """Trees and queries meet in bounded groups; no join repeats a tree for each block."""
    from viewtide.llm import neighbours

    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6 if i % 9 else 4).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def answers():
        got = neighbours.nearest(frame, F.col("vec_id") % 2 == 0, factor=1.0, shards=3)
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got.collect())

    want = answers()
    assert len(want) == 200 * 5
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "BLOCKS", 3)
    assert answers() == want
