"""Prefix trie, pivot search and filter audit against brute force: nulls, empty and long values, ties, repeats, empty tables, clashing names."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from massloom.llm import filter_audit, pivot_search, prefix_trie, queries

rng = random.Random(11)


# ---- prefix trie -----------------------------------------------------------------------------

def brute_trie(rows):
    """rows: conv_id, turn, role, text; the nodes of the contract."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = tuple(own.get(donor, [])[:h] + ts[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
        ends[ts].append(c)
    out = set()
    for p, ms in members.items():
        kids = [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p]
        under = [q for q in members if q[:len(p)] == p]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in members) for q in under)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        out.add((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return out, len(members)


def conversations():
    r = random.Random(3)
    rows = []
    for c in [*range(-7, 90), 1000, 1005, 1006, 7000]:
        for turn in range(r.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn, r.choice(["user", "assistant"]) if turn else "user", r.choice(["hi", "ÿes", "no " * turn, ""])))
    rows += [(200, t, "user", f"turn {t}") for t in range(150)] + [(205, t, "user", f"turn {t}") for t in range(140)]
    rows += [(300, 0, None, None), (301, 0, "", ""), (302, None, "user", "first"), (302, 1, "user", "second"), (302, 1, "user", "second"), (302, 1, "user", "other"), (None, 0, "user", "nobody")]
    return rows


@pytest.mark.parametrize("block", [8, 1 << 17])
def test_trie_nodes(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = conversations()
    schema = "conv_id long, turn long, role string, text string, turns string, node_id string, sizes long"
    spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_prefix_trie(spark, str(tmp_path)).collect()
    want, n = brute_trie(rows)
    assert len(got) == n and {tuple(r) for r in got} == want


def test_trie_without_turns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.with_donor_heads(prefix_trie.turn_ids(empty))).count() == 0
    bare = spark.createDataFrame([(4, []), (9, []), (4, [])], "conv_id long, turns array<struct<turn_id:string,bytes:long>>")
    (root,) = prefix_trie.prefix_trie(bare).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (4, 0, 3, 0, 1, 0) and root.ends_sha256 == hashlib.sha256(b"4,4,9").hexdigest()


def test_node_layouts_grow():
    root, keys = prefix_trie.Node(b""), [bytes([b]) + bytes(15) for b in rng.sample(range(256), 256)]
    layouts = set()
    for key in keys:
        prefix_trie.insert(root, key, (1, key[0], [1]))
        layouts.add(root.layout)
    assert layouts == {4, 16, 48, 256} and [b for b, _ in root.children()] == list(range(256))
    assert all(root.child(k[0]).path == k[1:] for k in keys)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.lists(st.integers(0, 2), max_size=5).map(tuple), min_size=1, max_size=25))
def test_tree_rows(seqs):
    width = prefix_trie.WIDTH
    keys = sorted((b"".join(hashlib.sha256(bytes([t])).digest()[:width] for t in s), s) for s in seqs)
    root = prefix_trie.Node(b"")
    for i, (key, s) in enumerate(keys):
        prefix_trie.insert(root, key, (1, i, [1] * len(s)))
    rows = prefix_trie.emit(root, keys[0][0], keys[-1][0])
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert len(rows) == len(prefixes) and sum(r[5] for r in rows) == sum(map(len, prefixes))
    assert sorted(r[7] for r in rows) == sorted(sum(s[:len(p)] == p for s in seqs) for p in prefixes)
    assert all(r[3] for r in rows if r[5] == 0)


# ---- pivot search ----------------------------------------------------------------------------

def brute_top(rows, k=5):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(256 * np.float64(x))) for x in v]))
    out = []
    for n, (i, v) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for m, (j, w) in enumerate(good) if m != n and len(v) == len(w))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def vectors(n, dims=8, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims)) * 4
    return [(i, [float(np.float32(x)) for x in centres[i % 5] + r.normal(size=dims) / 4]) for i in range(n)]


def test_top_k(spark, tmp_path):
    rows = vectors(420)
    rows += [(500 + i, rows[0][1]) for i in range(30)] + [(0, rows[0][1]), (0, rows[1][1]), (550, rows[0][1]), (550, rows[0][1]), (-50, rows[3][1])]
    rows += [(600, None), (650, []), (651, []), (700, [1.0, None]), (750, [float("nan")] * 8), (751, [float("inf")] * 8), (None, rows[0][1]), (800, [1.0, 2.0]), (801, [1.5, -2.0])]
    schema = "vec_id long, embedding array<float>, label int, h long, vector string, table int, near string"
    spark.createDataFrame([(i, v, 1, 2, "x", 3, "y") for i, v in rows], schema).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, queries.op12_top_k(spark, str(tmp_path)).collect())) == brute_top(rows)
    narrow = pivot_search.top_k(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 3, pivots=2, queries_a_pass=4)
    assert sorted(map(tuple, narrow.collect())) == brute_top(rows, 3)


def test_top_k_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert pivot_search.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<double>")
    assert pivot_search.top_k(one, F.col("vec_id") % 50 == 0).count() == 0


def test_products_are_exact():
    a = np.array([[1 << 30, 3], [(1 << 27) + 1, -7]], dtype=np.int64)
    want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in a] for r in a]
    assert pivot_search.products(a, a).tolist() == want
    assert pivot_search.products(a << 3, a << 3)[0, 0] == np.iinfo(np.int64).max


def test_bounds_leave_most_unevaluated(monkeypatch):
    """Where vectors lie in tight groups, the bounds rule out the other groups."""
    r = np.random.default_rng(0)
    centres = r.normal(size=(20, 8))
    x = np.floor(256 * (centres / np.linalg.norm(centres, axis=1)[:, None])[np.arange(2000) % 20] + r.normal(size=(2000, 8))).astype(np.int64)
    pivots = pivot_search.choose_pivots(list(x[:200]))
    counted, plain = [], pivot_search.products
    monkeypatch.setattr(pivot_search, "products", lambda a, b: counted.append(len(a) * len(b)) or plain(a, b))
    q = {"id": np.arange(5), "vector": x[:5], "table": pivot_search.distances(x[:5], pivots), "size": (x[:5] ** 2).sum(1).astype(float), "square": (x[:5] ** 2).sum(1)}
    best = pivot_search.Best(5, 5)
    pivot_search._evaluate(best, q, np.arange(2000), np.ones(2000, int), x, pivot_search.distances(x, pivots))
    scores = x[:5] @ x.T
    scores[np.arange(5), np.arange(5)] = -1 << 60
    assert (best.score == -np.sort(-scores, 1)[:, :5]).all() and sum(counted) < 5 * 2000 * 0.5


# ---- filter audit ----------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, part in docs:
        t = t or ""
        words = WORD.findall(t)
        fail = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts[part or ""].append(({k for k, v in fail.items() if v}, i in good, i in toxic))
    out, shapley = [], defaultdict(int)
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            alive = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if f in r[0]]
                alive = [r for r in alive if f not in r[0]]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), step, len(alive), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audit_tables():
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 40))) for _ in range(300)]
    prose = lambda n, few=300: " ".join(r.choice(vocabulary[:few]) for _ in range(n))
    texts = [prose(n, few) for n in (0, 1, 50, 99, 100, 101, 150) for few in (1, 80, 300)]
    texts += [prose(120).upper(), "A" * 3 + "b" * 27, "A" * 4 + "b" * 27, prose(110) + " 100%", "#", None, "", " \t\r\n\v\f", "\x1f\x1c\x85\xa0", "日本 語\U0001F600 " * 60, "x" * 5000, " ".join(f"w{i}" * 9 for i in range(130))]
    docs = [(i, t, r.choice(["en", "fr", None, ""])) for i, t in enumerate(texts)]
    docs += [(1000 + i, r.choice(texts), "de") for i in range(40)] + [docs[30], docs[30], (None, texts[20], "en"), (None, texts[20], "en")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 1040, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return docs, labels


def test_audit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", 700)
    docs, labels = audit_tables()
    spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, digest string, bits long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, quality int, toxic int, part string").write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(map(tuple, queries.op13_filter_audit(spark, str(tmp_path)).collect())) == brute_audit(docs, labels)


def test_audit_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(none, labels).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, lang string")
    rows = filter_audit.filter_audit(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.removed == (r.filter_order[r.step - 1] == "A") for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\né日#x", max_size=60) | st.text(max_size=40), min_size=1, max_size=6), st.sampled_from([5, 64, 1 << 20]), st.sampled_from([2, 1 << 18]))
def test_transducer(texts, block, words):
    old = filter_audit.BLOCK, filter_audit.WORDS
    filter_audit.BLOCK, filter_audit.WORDS = block, words
    try:
        texts = [t.encode("utf-8", "ignore").decode() for t in texts]
        got = filter_audit.measure(pa.array([t.encode() for t in texts], pa.binary()))
    finally:
        filter_audit.BLOCK, filter_audit.WORDS = old
    for t, row in zip(texts, got.tolist(), strict=True):
        w = WORD.findall(t)
        assert row == [len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(re.findall("[#$%&*|]", t)), len(t)]


def test_hash_table_verifies(monkeypatch):
    """With one hash for all spans, only the comparison of bytes tells words apart."""
    monkeypatch.setattr(filter_audit, "_hashes", lambda raw, doc, start, length: np.zeros(len(start), dtype=np.uint64))
    text = " ".join(f"word{i % 17}" for i in range(60)) + " " + "long" * 30 + " " + "long" * 29 + "lonG"
    assert filter_audit.measure(pa.array([text.encode(), text.encode()], pa.binary()))[:, 1].tolist() == [19, 19]


def test_near_dedup_takes_candidates_from_the_trie(spark):
    from massloom.llm import near_dedup

    rows = [(0, 0b0, [10, 20]), (1, 0b11, [11, 21]), (2, 0b1111, [12, 22]), (3, -1, [13, 23]), (4, -1, [14, 24]), (5, 1 << 40 | 0x7F0000, [10, 25])]
    nodes = spark.createDataFrame([(n, 9, fp, bands) for n, fp, bands in rows], "node long, n long, fp long, bands array<long>")
    shared = {}
    for r in near_dedup._buckets(nodes).collect():
        shared.setdefault(r.band, set()).add(r.node)
    # 0 and 1, 1 and 2 differ in two bits; 3 and 4 in none; 0 and 5 share a band
    assert sorted(map(sorted, (m for m in shared.values() if len(m) > 1))) == [[0, 1, 2], [0, 5], [3, 4]]
