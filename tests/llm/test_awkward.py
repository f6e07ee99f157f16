"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from viewtide.llm import (
    chat,
    decontamination,
    language,
    licenses,
    mixing,
    near_duplicates,
    neighbours,
    repeats,
    toxicity,
    wavelet,
)


def by_id(df, *names):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[n] for n in names))
    return out


def test_mixing(awkward, no_documents):
    rows = mixing.mix_sources(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["times"] <= 2 and r["target"] <= 2 * r["source_size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    whole = {r["source"]: r["source_size"] for r in rows}
    assert whole[None] == 5 and whole[""] == 0
    again = mixing.mix_sources(awkward.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix_sources(no_documents).count() == 0


def test_mixing_budgets_nest(awkward):
    small = by_id(mixing.mix_sources(awkward, share=(1, 4)), "times")
    large = by_id(mixing.mix_sources(awkward, share=(3, 4)), "times")
    assert all(a <= b for d in small for a, b in zip(sorted(small[d]), sorted(large[d])))


def test_repeats(awkward, no_documents):
    got = by_id(repeats.remove_repeats(awkward), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[2] == [(0, 0, 0, nothing)] and got[13] == [(700, 700, 1, nothing)]
    assert got[7][0][0] == got[7][0][1] and got[8][0][1] == got[7][0][0]
    assert got[11][0] == got[11][1] and got[11][0][0] == got[11][0][1]
    assert got[12][0][2] == 1 and 0 < got[12][0][1] < got[12][0][0]
    assert got[5][0][1] == 0 and len(got[None]) == 2
    assert repeats.remove_repeats(no_documents).count() == 0


def test_crowded_anchors_give_the_same(awkward, monkeypatch):
    want = sorted(map(str, repeats.remove_repeats(awkward).collect()))
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", 1)
    assert sorted(map(str, repeats.remove_repeats(awkward).collect())) == want


def test_equal_rows_without_id_are_cut_once_a_task(spark, monkeypatch):
    rng = np.random.default_rng(2)
    shared, own = ("".join(map(chr, rng.integers(97, 123, 500))) for _ in range(2))
    rows = [(None, shared + own)] * 600 + [(1, "x" + shared[:300] + "y" * 50), (2, own[100:] + "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every = repeats._keyed(docs).select("text", "text_key", "id_key").mapInArrow(repeats._all_contexts, repeats._CONTEXT)
    spots = every.groupBy("anchor", "whole").agg(
        F.min(F.struct("text_key", "id_key", "begin", "strings", "place")).alias("spot"))
    assert repeats._bytes_of(docs, spots).count() <= 3 * spots.count()
    got = by_id(repeats.remove_repeats(docs), "n_bytes", "n_removed")
    assert got[None] == [(1000, 1000)] * 600 and got[1] == [(351, 300)] and got[2] == [(401, 400)]


def random_texts(seed):
    rng = np.random.default_rng(seed)
    pool = [bytes(rng.integers(97, 99 + seed % 3, 400, np.uint8)) for _ in range(3)]
    texts = []
    for _ in range(12):
        cut = [p[a : a + n] for p in pool for a, n in [(rng.integers(0, 200), rng.integers(0, 260))]]
        rng.shuffle(cut)
        texts.append(b"".join(cut).decode())
    return [*texts, "ab" * 300, "q" * 450, texts[0]]


@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_find_all_repeats(seed):
    """The merge alone, on every context of the texts, against plain counting."""
    import pyarrow as pa
    from viewtide.llm import kernels

    texts = random_texts(seed)
    data, at = next((d, a) for _, _, d, a in kernels.slices(pa.array(texts)))
    anchor, whole, begin, strings, copies, place = repeats.contexts(data, at)
    flat = [(b + i * s, s, p, x) for b, s, n, p, x in zip(begin, strings, copies, place, anchor) for i in range(n)]
    raw = bytes(data)
    rows = np.full((len(flat), repeats.COLUMNS), 255, np.uint8)
    first = np.array([repeats.REACH - p for _, _, p, _ in flat])
    width = np.array([s + 199 for _, s, _, _ in flat])
    for i, (b, s, _, _) in enumerate(flat):
        rows[i, first[i] : first[i] + width[i]] = np.frombuffer(raw[b : b + s + 199], np.uint8)
    shards = [repeats.transform(rows[i : i + 7]) for i in range(0, len(rows), 7)]
    low, high = repeats.merge(shards, first, first + width)
    covered = np.zeros(len(data), bool)
    for i, (b, _, _, _) in enumerate(flat):
        if low[i] >= 0:
            covered[b + low[i] - first[i] : b + high[i] - first[i]] = True
    from collections import Counter
    strings_at = [(a + i, raw[a + i : a + i + 200]) for a, z in zip(at, at[1:]) for i in range(z - 1 - a - 199)]
    seen, want = Counter(s for _, s in strings_at), np.zeros(len(data), bool)
    for i, s in strings_at:
        if seen[s] > 1:
            want[i : i + 200] = True
    assert (covered == want).all() and want.any()


def test_token_files(awkward, no_documents):
    got = by_id(wavelet.stage(None, awkward, ""), "start", "n_tokens", "ids_crc32")
    assert got[2][0][1] == got[3][0][1] == 1 and len(got[11]) == 2
    order = sorted((r for rows in got.values() for r in rows))
    ends = [s + n for s, n, _ in order]
    assert [s for s, _, _ in order] == [0, *ends[:-1]]
    assert got[None][0][0] in (0, 1) and got[11][0][2] == got[11][1][2]
    assert wavelet.stage(None, no_documents, "").count() == 0


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 700, 3000).astype(np.uint32)
    held = wavelet.WaveletMatrix(wavelet.pack(ids, [4, None, 9], np.array([1000, 0, 2000])))
    assert held.documents == [4, None, 9] and (held.ids() == ids).all()
    for at in rng.integers(0, 3000, 40).tolist():
        value = int(ids[at])
        assert held.access(at) == value
        assert held.count(value, at) == (ids[:at] == value).sum()
        assert held.occurrence(value, held.count(value, at)) == at
    assert held.count(5000) == 0 and held.count(699) == (ids == 699).sum()
    assert wavelet.WaveletMatrix(wavelet.pack(ids[:0], [], np.zeros(0, int))).ids().tolist() == []


def test_chat(spark):
    says = "</s>[INST] ok [/INST] <\\s> <\\\\s> [SEP] <s"
    rows = [(1, 1, "assistant", "b" + says), (1, 0, "user", says), (1, 2, "assistant", None),
            (1, 2, "assistant", None), (2, None, None, "no turn"), (2, 5, "user", "x"),
            (None, 0, "assistant", "z"), (3, 255, "user", "p"), (3, 256, "user", "q"),
            (3, 257, "assistant", "r"), (3, 600, "assistant", "s"), (4, 0, "[INST]<s>", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "part", F.lit("clash")).withColumn("turns", F.lit(1))
    formatted = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (r["conv_id"] or 0, r["part"] is not None, r["part"] or 0)):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["formatted"]
    assert whole[3] == ("<s>[INST]user[/INST]p[INST]user[/INST]q</s>"
                        "<s>[INST]assistant[/INST]r[INST]assistant[/INST]s</s>")
    assert whole[1].count("<s>") == 2 and whole[1].count("[SEP]") == 2
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_toxicity(spark, awkward, no_documents):
    bad = "A calm start. You are a blurgh and a gnarfle. The end."
    rows = [(i, bad if i % 2 else f"A calm text number {i}. Nothing to see.", "x", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, feature string, score int")
    labels = spark.createDataFrame(
        [(i, i % 2, 1) for i in range(200)] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels, F.col("doc_id") > 40)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 1) for i in range(200))
    found = toxicity.locate(docs, model).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 200, 2))
    assert {r["sentence"] for r in found} == {" You are a blurgh and a gnarfle."}
    assert {(r["begin"], r["stop"]) for r in found} == {(13, 45)}
    scored = toxicity.score(awkward, model).collect()
    assert len(scored) == awkward.count()
    assert all(r["score"] == 0 for r in scored if r["doc_id"] in (2, 3, 4))
    assert toxicity.score(no_documents, model).count() == 0
    assert toxicity.train(docs, labels.limit(0), F.lit(True)) is None
    assert {r["score"] for r in toxicity.score(awkward, None).collect()} == {0.0}


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], "q") for i in range(60)] + [
        (60, None, ""), (61, [0.0, 0.0, 0.0], ""), (62, [nan, 1.0, 1.0], ""), (63, [None, 1.0, 1.0], ""),
        (64, [inf, 1.0, 1.0], ""), (65, [], ""), (66, [1.0, 2.0], ""), (67, [2.0, 4.0], ""),
        (None, [1.0, 1.0, 1.0], ""), (5, [5.0, 1.0, 2.0], "again"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard string")
    for shards in (1, 3):
        got = neighbours.nearest(df, F.col("vec_id").isin(0, 10, 62, 66), factor=1.0, shards=shards)
        found = {}
        for r in got.orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
        assert set(found) == {0, 10, 66} and found[66] == [(67, 1.0)]
        for q in (0, 10):
            a = np.array(rows[q][1])
            cos = sorted((-round(float(a @ np.array(v) / np.linalg.norm(a) / np.linalg.norm(v)), 9), i)
                         for i, v, _ in rows[:60] if i != q)[:5]
            assert found[q] == [(i, -c) for c, i in cos]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_tree_factor_one_is_exact():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 8)).astype(np.float32)
    ids = np.arange(3000)
    tree = neighbours.build(ids, vectors, 5)
    asked, found, score = neighbours.search(tree, ids[:50], vectors[:50], 5, 1.0)
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    for q in range(50):
        cosine = units @ units[q]
        cosine[q] = -2
        assert found[asked == q].tolist() == np.argsort(-cosine)[:5].tolist()


def test_near_duplicates(spark, awkward, no_documents):
    got = by_id(near_duplicates.find(awkward, 2), "n_shingles", "component_id", "kept")
    assert got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)] and got[4] == [(0, 4, True)]
    assert got[5] == [(1, 5, True)] and got[6] == [(1, 5, False)]
    assert got[7][0][1] == got[8][0][1] == 7 and not got[8][0][2]
    assert got[11][0][1:] == (11, True) and len(got[11]) == 2
    assert {r[1:] for r in got[None]} == {(None, True)}
    assert near_duplicates.find(no_documents, 2).count() == 0
    left = near_duplicates.stage(spark, awkward, "")
    assert left.columns == awkward.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert kept.count(11) == 1 and 8 not in kept and 6 not in kept and kept.count(None) == 2


@pytest.mark.parametrize("width", [1, 2, 5])
def test_near_duplicates_against_all_pairs(spark, width):
    """Small sets, where one shingle decides, and a group that no single star covers."""
    from test_corpus_queries import brute_components

    rng = np.random.default_rng(width)
    docs = {i: " ".join(f"w{x}" for x in rng.integers(0, 9, rng.integers(0, 9))) for i in range(150)}
    base = [f"b{i}" for i in range(120)]
    for i in range(150, 230):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            words[at] = f"c{i}x{at}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = brute_components(docs, width)
    for exact in (False, True):
        found = near_duplicates.find(df, width, exact).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_blocks_of_a_component_do_not_meet(spark, monkeypatch):
    """Two components of several blocks and some documents beside them under one pivot."""
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 4)
    rows = [(0, i, 10, 1 if i < 20 else 20 if i < 30 else i) for i in range(1, 40)]
    rows += [(50, i, 10, 51) for i in range(51, 90)]  # done: one component
    members = spark.createDataFrame(rows, "pivot long, node long, n_shingles long, component long")
    got = {r["component"]: r for r in near_duplicates._blocks(members).collect()}
    assert set(got) == {1, 20, *range(30, 40)}
    assert got[1]["own"] and got[1]["parts"] == 5 and got[20]["own"] and got[20]["parts"] == 3
    assert {(r["own"], r["first"], r["parts"]) for c, r in got.items() if c >= 30} == {(False, 0, 3)}
    assert {r["blocks"] for r in got.values()} == {11}
    assert {got[1]["first"], got[20]["first"]} in ({3, 8}, {3, 6})


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    from test_corpus_queries import brute_components

    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    docs = {}
    for i in range(120):
        words = [f"b{j}" for j in range(60)]
        for at in rng.integers(0, 60, (2, 5, 9, 12)[i % 4]):
            words[at] = f"c{rng.integers(0, 4)}x{at}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.find(df, 2).collect()}
    assert got == brute_components(docs, 2)


def test_least_shared_values_reach_every_similar_set():
    for n in range(1, 400):
        kept = len(near_duplicates._least_shared(np.arange(n)))
        # The others are too few to hold an overlap of 80 %.
        assert 100 * (n - kept) < 80 * n <= 100 * (n - kept + 1)


def test_language(awkward, no_documents):
    model = language.train(awkward, F.lit(True))
    rows = language.identify(awkward, model, "doc_id", "run").collect()
    assert len(rows) == awkward.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 9)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows) and model.languages == ["en", "fr"]
    assert language.train(no_documents, F.lit(True)) is None
    assert {r["lang_pred"] for r in language.identify(awkward, None, "doc_id").collect()} == {"und"}
    left = language.stage(None, awkward, "")
    assert left.schema == awkward.schema and left.count() == awkward.count() - 5
    assert language.stage(None, no_documents, "").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 9, 40])
def test_codewords_lie_apart(n):
    code = language.codewords(n)
    assert len({tuple(c) for c in code}) == n
    if n > 2:
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= code.shape[1] / 5


def test_decontamination(spark, awkward, no_documents, benchmark):
    found = decontamination.contaminated(awkward, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(11, 1), (12, 1), (1, None)}
    assert all(r["similarity"] == 1.0 for r in found)
    assert {r["at_word"] for r in found if r["doc_id"] == 11} == {11}
    assert decontamination.contaminated(no_documents, benchmark).count() == 0
    assert decontamination.contaminated(awkward, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("every", [5, 6, 7, 9])
def test_decontamination_tolerates_replaced_words(spark, every):
    words = [f"w{i}" for i in range(30)]
    changed = [f"z{i}" if i % every == every - 1 else w for i, w in enumerate(words)]
    docs = spark.createDataFrame(
        [(1, "before it " + " ".join(changed) + " behind it"), (2, " ".join(f"u{i}" for i in range(90)))],
        "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    assert [r["doc_id"] for r in decontamination.contaminated(docs, items).collect()] == [1]


def patterns(n):
    """All ways to replace as many of n words as an overlap allows."""
    return list(itertools.combinations(range(n), n - -(-4 * n // 5)))


def test_decontamination_masks_fit_beside_all_replaced_words():
    assert sorted(decontamination.MASKS) == list(range(1, decontamination.WINDOW + 1))
    for n, masks in decontamination.MASKS.items():
        laid = [{s + o for o in m} for m in masks for s in range(n - m[-1])]
        assert all(any(not seen & set(p) for seen in laid) for p in patterns(n))


def test_decontamination_finds_all_overlaps_at_the_limit(spark):
    docs, items, want = [], [(0, " ".join(f"long{i}" for i in range(24)))], set()
    for n in range(5, 16):
        items.append((n, " ".join(f"n{n}w{i}" for i in range(n))))
        for whole, at in ((items[-1], 0), *([(items[0], 4)] if n == 15 else [])):
            for p in patterns(n):
                quote = [f"z{i}" if i in p else w for i, w in enumerate(whole[1].split()[at : at + n])]
                want.add((len(docs), whole[0]))
                docs.append((len(docs), " ".join(["before", "it", *quote, "behind", "it"])))
    # One word more replaced is no overlap.
    docs.append((len(docs), "n15w0 n15w1 n15w2 n15w3 n15w4 n15w5 n15w6 n15w7 n15w8 n15w9 n15w10 z z z z"))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want


def test_decontamination_against_all_alignments(spark):
    """Few different words, so that overlaps repeat, touch and hang over the ends."""
    rng = random.Random(3)
    items = [(n, [f"w{rng.randrange(6)}" for _ in range(n)]) for n in range(5, 22)]
    docs = []
    for d in range(80):
        said = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(25))]
        quote = rng.choice(items)[1][rng.randrange(4):]
        docs.append((d, said + [f"w{rng.randrange(6)}" if rng.random() < 0.2 else w for w in quote]))
    want = set()
    for (d, said), (i, item) in itertools.product(docs, items):
        size, best = min(len(item), 15), None
        for shift in range(1 - len(item), len(said)):
            equal = [0 <= shift + j < len(said) and said[shift + j] == w for j, w in enumerate(item)]
            for s in range(len(item) - size + 1):
                n = sum(equal[s : s + size])
                if 5 * n >= 4 * size:
                    best = max(best or (0, 0), (n, -(shift + s)))
        if best:
            want.add((d, i, -best[1], best[0]))
    found = decontamination.contaminated(
        spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["at_word"], r["equal_words"]) for r in found} == want
    assert len(want) > 40


def test_decontamination_short_and_long_items(spark):
    """Items of few words on demand, a long one whose words are not written with each seed,
    and items of the same words."""
    rng = random.Random(4)
    long_one = " ".join(f"v{rng.randrange(4000)}" for _ in range(3000))
    items = spark.createDataFrame(
        [(1, "one"), (2, "two words"), (3, "now three words"), (4, "and these are four"),
         (5, long_one), (6, long_one), (None, "one"), (8, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "One, not more"), (2, "here two words"), (3, "now three other words"), (4, "and these are four"),
         (5, " ".join(long_one.split()[1500:1520])), (6, None)], "doc_id long, text string")
    pairs = lambda n: {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items, n).collect()}
    assert pairs(5) == {(5, 5), (5, 6)}
    assert pairs(1) == {(1, 1), (1, None), (2, 2), (4, 4), (5, 5), (5, 6)}
    seeds, _ = decontamination.benchmark_seeds(decontamination.benchmark_words(items).dropDuplicates(["_item"]))
    assert seeds.columns == ["_item", "item_at", "seed"] and seeds.count() < 3000 * 3


def test_licenses(awkward, no_documents):
    got = by_id(licenses.scan(awkward), "n_words", "n_base", "first_word", "last_word",
                "base_labels", "labels", "score")
    assert got[2] == [(0, 0, None, None, "", "", 0.0)] and got[3] == got[4] == got[2]
    assert got[14][0][1:6] == (3, 3, 10, "cc-by,gpl,mit", "cc-by,cc-by-nc,gpl,mit")
    assert len(got[11]) == 2
    assert all(0 <= r[6] <= 1 for rows in got.values() for r in rows)
    assert licenses.scan(no_documents).count() == 0


def test_licenses_against_all_templates_at_all_phrases(spark):
    """Files that bundle many notices, beside every template laid at every beginning."""
    rng = np.random.default_rng(5)
    notices = [text for _, _, text in licenses.TEMPLATES]
    filler = sorted({w for text in notices for w in text.split()}) + ["usual", "words", "here"]
    texts = [" and then ".join(notices), " ".join(reversed(notices)), *notices]
    for n in range(1, 18):
        parts = []
        for i in rng.permutation(len(notices))[:n]:
            kept = [w if rng.random() < 0.9 else "other" for w in notices[i].split()]
            parts += [" ".join(kept), " ".join(rng.choice(filler, 12))]
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = by_id(licenses.scan(docs), "labels", "score")
    for d, said in enumerate(texts):
        words, labels, best = said.split(), set(), 0.0
        for phrase, label in licenses.BASE.items():
            if f" {phrase} " in f" {said} ":
                labels.add(label)
                best = max(best, 0.5)
        for label, key, notice in licenses.TEMPLATES:
            key, text = key.split(), notice.split()
            for k in range(len(words) - len(key) + 1):
                if words[k : k + len(key)] != key:
                    continue
                labels.add(label)
                for start in range(k - len(text) + 1, k + licenses.BEFORE + 1):
                    same = [w for j, w in enumerate(text) if 0 <= start + j < len(words) and words[start + j] == w]
                    if len(set(same)) >= licenses.AGREE:
                        best = max(best, len(same) / len(text))
        assert got[d] == [(",".join(sorted(labels)), pytest.approx(best))]


def test_pieces_do_not_need_the_library_twice():
    from viewtide.llm.tokens import Encoder
    from tokenizers import Tokenizer

    path = wavelet.tokenizer_path()
    plain, coder = Tokenizer.from_file(path), Encoder(path)
    texts = ["it's  we'll\n\n'tis ''s 'S", "", " ", "\n", "a b ̀x", "x\x1cy", "\U0001f600 中12½",
             "<|endoftext|> tail  ", "'re'm", "٣'t", "tabs\t\t end\t", "a <|endoftext|> b",
             " <|endoftext|>", "<|endoftext|><|endoftext|> a b", "<|endoftext| >", " lead <|endoftext|>"]
    ids, counts = coder.encode(texts)
    cut = np.split(ids, np.cumsum(counts)[:-1])
    assert [c.tolist() for c in cut] == [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert plain.token_to_id("<|endoftext|>") in ids


def test_more_pieces_in_one_text_than_the_table_has_slots(monkeypatch):
    from viewtide.llm import tokens
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "TABLE_BITS", 6)
    probes, slots = [], tokens.PieceTable._slots

    def counted(self, hashes, probe):
        probes.append(probe)
        assert probe <= 1000, "no free slot is left"
        return slots(self, hashes, probe)

    monkeypatch.setattr(tokens.PieceTable, "_slots", counted)
    path = wavelet.tokenizer_path()
    plain, coder = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = ["a b a", " ".join(f"{i * 7919:x}" for i in range(3000)), "", "a b a"]
    for said in (texts, texts[:1], texts[::-1]):
        ids, counts = coder.encode(said)
        cut = np.split(ids, np.cumsum(counts)[:-1])
        assert [c.tolist() for c in cut] == [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in said]
    assert probes


def test_stages_keep_the_columns(spark, awkward, no_documents, tmp_path):
    """Mixing and decontamination as stages: whole rows, whatever their columns are called."""
    passage = next(r["text"] for r in awkward.where("doc_id = 12").collect())
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = decontamination.stage(spark, awkward, str(tmp_path))
    assert left.schema == awkward.schema
    assert left.count() == awkward.count() - 3  # both rows of 11, which has the passage, and 12
    mixed = mixing.stage(spark, awkward, "")
    assert mixed.schema == awkward.schema
    times = by_id(mixing.mix_sources(awkward), "times")
    want = {d: sum(t for t, in rows) for d, rows in times.items()}
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in want.items() if n}
    assert mixing.stage(spark, no_documents, "").count() == 0
    assert decontamination.stage(spark, no_documents, str(tmp_path)).count() == 0
