"""The registered queries on the given tables: against SQL, or against plain Python."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import numpy as np
import pytest
from compare import connect, spark_rows, spark_types, sql_rows, sql_types
from viewtide.llm import licenses, queries, wavelet

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def frame(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).toPandas()


def texts(tables):
    return {r["doc_id"]: r["text"] or "" for r in tables["documents"].select("doc_id", "text").collect()}


def test_all_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    got, con = queries.QUERIES[name](spark, sf_dir), connect(sf_dir)
    assert spark_types(got) == sql_types(con, queries.ORACLES[name])
    assert spark_rows(got) == sql_rows(con, queries.ORACLES[name])


def test_repeats(spark, sf_dir, tables):
    got, docs = frame(spark, sf_dir, "op2_repeats"), {k: t.encode() for k, t in texts(tables).items()}
    seen = Counter(b[i : i + 200] for b in docs.values() for i in range(len(b) - 199))
    assert len(got) == len(docs)
    for r in got.itertuples():
        text, covered = docs[r.doc_id], bytearray(len(docs[r.doc_id]))
        for i in range(len(text) - 199):
            if seen[text[i : i + 200]] > 1:
                covered[i : i + 200] = b"\x01" * 200
        kept = bytes(b for b, c in zip(text, covered) if not c)
        runs = len(re.findall(b"\x01+", bytes(covered)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(text), sum(covered), runs, hashlib.sha256(kept).hexdigest()
        )


def test_token_files(spark, sf_dir, tables):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(wavelet.tokenizer_path())
    got, at = frame(spark, sf_dir, "op3_token_files").sort_values("doc_id"), 0
    docs = texts(tables)
    assert got.doc_id.tolist() == sorted(docs)
    for r in got.itertuples():
        ids = [*plain.encode(docs[r.doc_id], add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc)
        at += len(ids)


def test_toxicity(spark, sf_dir, tables):
    got = frame(spark, sf_dir, "op5_toxicity")
    assert len(got) == tables["documents"].count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == h for d, h in zip(got.doc_id, got.held_out))
    # Held-out labels: how often a toxic document scores higher than another one.
    both = got.merge(tables["labels"].select("doc_id", "toxic").toPandas(), on="doc_id")
    held = both[both.held_out & both.toxic.notna()]
    toxic, other = (held[held.toxic == x].score.to_numpy() for x in (1, 0))
    assert len(toxic) and len(other)
    higher = (toxic[:, None] > other).mean() + (toxic[:, None] == other).mean() / 2
    assert higher > 0.95, (higher, len(toxic), len(other))


def test_neighbours(spark, sf_dir, tables):
    got = frame(spark, sf_dir, "op6_neighbours")
    rows = tables["embeddings"].select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    units = np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    found, asked = 0, [i for i in ids if i % 50 == 0]
    for q in asked:
        cosine = units @ units[ids == q][0]
        order = [i for i in np.lexsort((ids, -cosine)) if ids[i] != q][:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(mine.score, [cosine[ids == v][0] for v in mine.vec_id])
        found += len(set(mine.vec_id) & set(ids[order]))
    assert found >= 0.9 * 5 * len(asked) and len(got) == 5 * len(asked)


def brute_components(docs, width):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)) for d, t in docs.items()}
    sets = {
        d: {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        for d, w in words.items()
    }
    holders, parent = defaultdict(list), {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d in sorted(sets):
        shared = Counter(o for s in sets[d] for o in holders[s])
        for o, n in shared.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), root(d)) for d in docs}


def test_near_duplicates(spark, sf_dir, tables):
    got, want = frame(spark, sf_dir, "op7_near_duplicates"), brute_components(texts(tables), 2)
    assert len(got) == len(want)
    for r in got.itertuples():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_language(spark, sf_dir, tables):
    got = frame(spark, sf_dir, "op8_language")
    both = got.merge(tables["documents"].select("doc_id", "lang").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert all((zlib.crc32(str(d).encode()) % 4 == 2) == h for d, h in zip(got.doc_id, got.held_out))
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_licenses(spark, sf_dir, tables):
    got, docs = frame(spark, sf_dir, "op10_licenses"), texts(tables)
    phrases = [(p.split(), label) for p, label in licenses.BASE.items()]
    assert len(got) == len(docs)
    for r in got.itertuples():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", docs[r.doc_id].translate(LOWER))
        hits = [(i, x) for p, x in phrases for i in range(len(w)) if w[i : i + len(p)] == p]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert r.base_labels == ",".join(sorted({x for _, x in hits}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        if hits:
            assert (r.first_word, r.last_word) == (min(hits)[0], max(hits)[0])


def test_pipeline(spark, sf_dir, tables):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "token_files"
    docs = tables["documents"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.schema == docs.schema
        assert after.select("doc_id").exceptAll(docs.select("doc_id")).distinct().count() <= docs.count()
        docs = corpus_pipeline.written(after, "test")
    got = entry.queries()["pipeline"](spark, sf_dir)
    assert got.count() == docs.count()
