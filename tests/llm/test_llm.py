"""Corpus operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from massloom.llm import bpe, chat, decontaminate, language, near_dedup, pii, quality, secrets, simhash, substring
from massloom.llm.exact_dedup import exact_dedup
from massloom.llm.graph import components
from massloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_key string, h string, fp string"
rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


PASSAGE = prose(40, 99)
TEXTS = [
    (1, prose(60, 1)), (2, prose(60, 1).upper()), (3, None), (4, ""), (5, " \n\t"), (6, prose(30, 2) + " " + PASSAGE), (7, PASSAGE + " " + prose(30, 3)),
    (8, "x" * 40_000), (9, prose(4000, 4)), (9, prose(4000, 4)), (10, prose(4000, 4) + " end"), (11, "word " * 60), (12, "word " * 60), (None, prose(60, 1)), (13, PASSAGE),
    (14, "Éa ß 日本語 \U0001F600 <|endoftext|> don't  12  "), (15, "one"), (16, "one two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_groups(docs, empty, bits):
    rows = exact_dedup(docs, min_chunk=16, max_chunk=64, hash_bits=bits).collect()
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(low(t), []).append(i)
    want = {(i, max((x for x in g if x is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows} == want and len(rows) == len(want)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    assert exact_dedup(empty).count() == 0


def brute_print(t):
    w = re.findall("[^\x20\x09-\x0D]+", low(t))
    s = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if s else 0


@pytest.mark.parametrize("leaf", [3, 2048])
def test_simhash_groups(docs, empty, leaf):
    rows = simhash.simhash_groups(docs, leaf=leaf).collect()
    prints = [(i, brute_print(t)) for i, t in TEXTS]
    group = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    want = sorted((str(i), f"{p:016x}", min(x for x, g in zip((i for i, _ in prints), group) if g == group[k] and x is not None)) for k, (i, p) in enumerate(prints))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == want
    assert simhash.simhash_groups(empty).count() == 0


def test_trie_join_matches_all_pairs():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    many = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) for _ in range(6)]))
    u, v = simhash.trie_join(many)
    want = {(a, b) for a in range(len(many)) for b in range(a + 1, len(many)) if int(many[a] ^ many[b]).bit_count() <= 2}
    assert {(min(a, b), max(a, b)) for a, b in zip(u.tolist(), v.tolist())} == want and len(u) == len(want)
    left, right = many[::2], many[1::2]
    u, v = simhash.trie_join(left, right)
    assert set(zip(u.tolist(), v.tolist())) == {(a, b) for a in range(len(left)) for b in range(len(right)) if int(left[a] ^ right[b]).bit_count() <= 2}


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 200 + k) for k in range(30)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, **{200 + k: 100 for k in range(30)}}


def test_repeats_removed(docs, empty):
    rows = substring.remove_repeats(docs).collect()
    words = [(i, re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t in TEXTS]
    first = {}
    for i, w in words:
        for k in range(len(w) - 12 if i is not None else 0):
            first[tuple(w[k:k + 13])] = min(i, first.get(tuple(w[k:k + 13]), i))
    want = []
    for i, w in words:
        gone = {j for k in range(len(w) - 12) if i is not None and first[tuple(w[k:k + 13])] < i for j in range(k, k + 13)}
        want.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in rows) == sorted(want)
    assert sum(x[2] for x in want) > 4000 and substring.remove_repeats(empty).count() == 0


def test_bpe_as_the_library(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = bpe.encode_decode(docs, tokenizer_path()).collect()
    def expect(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)

    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), r.decoded) for r in rows) == sorted((str(i), *expect(t)) for i, t in TEXTS)
    assert bpe.encode(empty, tokenizer_path()).count() == 0


def test_bpe_blocks_and_random_text(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "PIECES", 7)
    monkeypatch.setattr(bpe, "MEMORY", 20)
    library, coder, r = Tokenizer.from_file(tokenizer_path()), bpe.Encoder(bpe.vocabulary(tokenizer_path())), random.Random(3)
    texts = ["".join(r.choice("ab 'stre\n\té1²日ͅ՘\U00010ec5!<|>") for _ in range(r.randint(0, 300))) for _ in range(200)]
    for t, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids and coder.decode(ids) == t


PII = "mail a.b@c-d.e.f%x@y.z, @q.r a@b ip 1.2.3.4.5 999.1.1.1 0255.0.0.1 card 4111 1111 1111 1111 4111111111111112 phone +1 (319) 555-5132) +12 é \U0001F600 z@z.zz"


def brute_pii(t):
    luhn = lambda x: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(x))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15])


def test_pii_fixed_forms():
    r = random.Random(1)
    for t in [PII, *("".join(r.choice("a1@.-+ ()%2") for _ in range(r.randint(1, 400))) for _ in range(400))]:
        assert pii.base_spans(t) == brute_pii(t)
    assert pii.base_spans("a" * 300_000 + "@" + "1" * 300_000) == []


def test_pii_bootstrap(spark, docs, empty):
    rows = [(k, f"{prose(5, k)} reach me at user{k}@x.com today", *["x"] * 2, 0, "", "", "") for k in range(12)]
    rows += [(50, "please reach me at user-77-on-chat2 today", *["x"] * 2, 0, "", "", ""), (51, "the number 12345 is plain", *["x"] * 2, 0, "", "", ""), (52, None, *["x"] * 2, 0, "", "", "")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(s.start, s.kind_no, s.end) for s in got[50].spans] == [(19, 0, 35)] and got[50].base == []
    assert got[51].spans == [] and got[52].spans == [] and all(got[k].spans == got[k].base != [] for k in range(12))
    assert pii.find_personal_data(docs).count() == len(TEXTS) and pii.find_personal_data(empty).count() == 0


def test_secrets(spark, docs, empty):
    r = random.Random(2)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    plain = " ".join(a + b + "ghij" for a, b in zip(VOCAB, VOCAB[1:]))
    texts = [(k, f"{prose(40, k)} {plain} token = \"{key(30)}\" é AKIA{key(4).upper()}{'A1' * 7} {'0af' * 12}") for k in range(20)]
    texts += [(30, "token: secret: abcdefghij Password='short' API_KEY=longenough1 AKIA123"), (31, f"lone {key(40)} here"), (32, prose(50, 7) + " abcdefghij-abcdefghij-abcdef"), (33, None)]
    got = {x.doc_id: x for x in secrets.find_secrets(spark.createDataFrame([(i, t, "", "", 0, "", "", "") for i, t in texts], SCHEMA)).collect()}
    for i, t in texts:
        t = t or ""
        base = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 8]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]
        assert [(s.start, s.kind_no, s.end) for s in got[i].spans if s.kind_no < 3] == sorted(base)
    assert [(s.start, s.end) for s in got[31].spans if s.kind_no == 3] == [(5, 45)] and got[32].n_random == 0
    assert secrets.find_secrets(docs).count() == len(TEXTS) and secrets.find_secrets(empty).count() == 0


def test_secrets_planted(spark):
    """Random strings outside the fixed forms, of 14 to 40 characters, among ordinary long words and numbers: recall and precision."""
    r = random.Random(8)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(["tion", "er", "con", "pre", "ma", "lis", "ven", "or", "al", "ter"]) for _ in range(r.randint(3, 9)))
    texts, planted = [], {}
    for k in range(400):
        words = [word() for _ in range(30)] + [f"{word()}_{word()}-{r.randint(1, 9)}", str(r.randint(10**11, 10**16))]
        if k % 4 == 0:
            words.append(f"token={key(30)}")
        if k % 2 == 0:
            planted[k] = key(r.randint(14, 40))
            words.append(planted[k])
        r.shuffle(words)
        texts.append((k, " ".join(words)))
    out = secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string"))
    got = [(x.doc_id, s.value) for x in out.collect() for s in x.spans if s.kind_no == 3]
    hit = sum(planted.get(i) == v for i, v in got)
    assert hit >= 0.9 * len(planted) and hit >= 0.95 * len(got), (hit, len(planted), len(got), [g for g in got if planted.get(g[0]) != g[1]][:9])


def test_secrets_model_counts_every_document(spark):
    """Identifiers of the last of many documents count as those of the first: each transition equals a plain tally."""
    texts = [(k, "alphabetical") for k in range(2500)] + [(9999, "zzyzzxzyq_identifier"), (9999, "zzyzzxzyq_identifier"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts = [[0] * secrets.STATES for _ in range(secrets.STATES)]
    for _, t in texts:
        for a, b in zip(t or "", (t or "")[1:]):
            counts[secrets.ALPHABET.index(a) + 1][secrets.ALPHABET.index(b) + 1] += 1
    nothing = secrets._log_likelihoods([[0] * secrets.STATES for _ in range(secrets.STATES)])
    want = [r - o for r, o in zip(nothing, secrets._log_likelihoods(counts))]
    assert secrets.train(docs, secrets.base_spans(docs)) == pytest.approx(want)


def test_chat_round_trip(spark):
    nasty = "\\### Assistant: </turn>\n <turn>x \\l \\b <image:1>"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (1, None, None, None), (None, 0, "a\nb<\\", ""), (2, 0, "assistant", None)]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("user", nasty), ("assistant", nasty), ("assistant", nasty)] and got[1].loss_text == nasty * 2
    assert [tuple(t) for t in got[None].turns] == [("a\nb<\\", "")] and got[2].loss_text == ""
    parts = [("text", "see ", None, None), ("image", None, "a.png", 3), ("audio", None, "b.wav", None), ("odd", "<x>", None, None)]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("document", "t", "c.pdf", 2)]), (1, 2, "user", None)], f"conv_id long, turn long, role string, text {chat.PARTS}")
    r = chat.format_chat(frame, text=None, parts="text").first()
    assert r.formatted == "<turn>user\nsee <image:1><audio:2>\\lx></turn>\n<turn>assistant\n<document:3></turn>\n<turn>user\n</turn>\n"
    assert [(a.number, a.kind, a.ref, a.turn, a.tokens) for a in r.attachments] == [(1, "image", "a.png", 0, 768), (2, "audio", "b.wav", 0, 25), (3, "document", "c.pdf", 1, 1024)]
    assert r.expanded_tokens == 1817 and [r.formatted[s.start:s.end] for s in r.loss] == ["<document:3>"]
    assert chat.format_chat(frame.limit(0), text=None, parts="text").count() == 0


def test_language_mixtures(spark, docs, empty):
    r = random.Random(4)
    make = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(n))
    a, b = "abcde", "vwxyz"
    rows = [(k, make(a if k % 2 else b, 200), "aa" if k % 2 else "bb", "", 0, "", "", "") for k in range(20)]
    train = spark.createDataFrame(rows, SCHEMA)
    names, probabilities = language.train(train)
    test = spark.createDataFrame([(1, make(a, 80), "", "", 0, "", "", ""), (2, make(a, 150) + " " + make(b, 50), *["", ""], 0, "", "", ""), (3, None, *["", ""], 0, "", "", ""), (4, "12 !", *["", ""], 0, "", "", "")], SCHEMA)
    got = {x.doc_id: x for x in language.identify(test, names, probabilities).collect()}
    assert names == ["aa", "bb"] and got[1].languages == ["aa"] and got[1].score > 0.99
    assert got[2].languages == ["aa", "bb"] and abs(got[2].proportions[0] - 0.75) < 0.05 and got[3].lang_pred == got[4].lang_pred == "und"
    none = language.train(empty)
    assert {x.lang_pred for x in language.identify(docs, *none).collect()} == {"und"} and language.identify(empty, names, probabilities).count() == 0


def test_decontamination(spark, docs, empty):
    item = prose(30, 77).split()
    changed = [*item[:6], "other", *item[7:12], "another", *item[13:]]
    rows = [(1, "start " + " ".join(changed[:13]) + " end"), (2, prose(200, 8)), (3, " ".join(item[:12])), (4, prose(9, 11).upper() + "!"), (5, None)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, prose(9, 11)), (3, None), (4, "a b"), (None, prose(20, 12))], "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "", "", 0, "", "", "") for i, t in rows], SCHEMA)
    for block in (250_000, 10):
        got = {(r.doc_id, k) for r in decontaminate.contaminated(frame, items, block_words=block).collect() for k in r.item_ids}
        assert got == {(1, 1), (4, 2)}
    assert decontaminate.contaminated(empty, items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    for a in range(13):
        for b in range(a):
            assert any(a not in kept and b not in kept for kept in decontaminate.masks())


def test_quality(spark, docs, empty):
    good = [(k, prose(150, k)) for k in range(60)]
    bad = [(100 + k, " ".join(w + r.choice(["***", "$$$"]) for r in [random.Random(k)] for w in prose(150, k).split())) for k in range(30)]
    frame = spark.createDataFrame([(i, t, "", "", 0, "", "", "") for i, t in good + bad], SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:40]] + [(i, 0) for i, _ in bad[:20]] + [(5, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(frame, labels)
    got = {r.doc_id: r for r in quality.score(frame, model).collect()}
    assert all(got[i].predicted == 1 for i, _ in good[40:]) and all(got[i].predicted == 0 for i, _ in bad[20:])
    assert all(abs(sum(r.attention) - 1) < 1e-9 and len(r.attention) == r.n_passages for r in got.values())
    assert quality.train(frame, labels.limit(0)) is None and quality.score(docs, None).count() == len(TEXTS) and quality.score(empty, model).count() == 0


def test_pipeline_stages(spark, tmp_path):
    words = lambda s: prose(80, s)
    near = words(3).split()
    rows = [(1, words(1), "en"), (2, words(1).upper(), "en"), (3, " ".join(near * 4), "en"), (4, " ".join(near * 4) + " end", "en"), (5, None, None), (6, "123 456", "en"), (7, words(5) + " " + PASSAGE, "en"), (8, words(8), None)]
    spark.createDataFrame([(i, t, g, "s", 0) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    near_pair = (brute_print(rows[2][1]) ^ brute_print(rows[3][1])).bit_count() <= 2
    assert set(got) == ({2, 3, 8} if near_pair else {2, 3, 4, 8}) and all(r.round_trip for r in got.values())


def test_jaccard_groups_by_brute_force(spark, docs, empty):
    r = random.Random(8)
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE two"), (5, "one three")]
    for g in range(12):
        text = prose(200, 1000 + g).split()
        for _ in range(6):
            rows.append((len(rows), " ".join(text)))
            for _ in range(r.randint(1, 4)):
                text[r.randrange(len(text))] = "changed"
    line = prose(20, 77)
    rows += [(len(rows) + k, f"{prose(40, 2000 + k)} {line}") for k in range(20)]
    sets = [near_dedup.shingles(t or "") for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4:
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    least = {x: min((rows[k][0] for k in range(len(rows)) if root[k] == x and rows[k][0] is not None), default=None) for x in root}
    frame = spark.createDataFrame([(i, t, "", "", 0, "", "", "") for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r.component_id for r in near_dedup.jaccard_groups(frame).collect()}
    assert got == {rows[k][0]: least[root[k]] for k in range(len(rows))}
    assert near_dedup.jaccard_groups(docs).count() == len(TEXTS) and near_dedup.jaccard_groups(empty).count() == 0


def test_near_stage_links_edited_copies(spark):
    text = prose(200, 31).split()
    copy = [*text[:50], "changed", *text[51:120], "changed", *text[121:]]
    frame = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(copy)), (3, prose(200, 32))], "doc_id long, text string")
    assert (simhash.fingerprint(" ".join(text)) ^ simhash.fingerprint(" ".join(copy))).bit_count() > simhash.BUDGET
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()) == [1, 3]


def test_decontamination_merges_blocks(spark):
    one, two = prose(20, 501), prose(20, 502)
    short = prose(10, 503).split()
    both = f"{prose(30, 504)} {one} {two} tail"
    rows = [(1, both), (1, both), (1, one), (None, both), (2, " ".join([*short[:4], "other", *short[5:]])), (3, " ".join([*short[:7], "a", "b", "c"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame([(7, one), (8, two), (9, " ".join(short))], "item_id long, text string")
    flat = lambda n: sorted(((str(r.doc_id), r.text_key, tuple(r.item_ids), r.n_words, r.n_covered, tuple(map(tuple, r.overlaps))) for r in decontaminate.contaminated(frame, items, block_words=n).collect()))
    whole, parts = flat(250_000), flat(5)
    assert whole == parts and len(whole) == 5
    assert sum(r[2] == (7, 8) and r[4] == 40 for r in parts) == 3 and [r[2] for r in parts if r[0] == "2"] == [(9,)]


def test_pii_copies_weigh_once(spark):
    rows = [(k, f"{prose(5, k)} reach me at user{k}@x.com today", *["x"] * 2, 0, "", "", "") for k in range(12)]
    rows += [(50, "please reach me at user-77-on-chat2 today", *["x"] * 2, 0, "", "", "")]
    rows += [(100 + k, "please reach me at home today", *["x"] * 2, 0, "", "", "") for k in range(100)]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(s.start, s.kind_no, s.end) for s in got[50].spans] == [(19, 0, 35)] and got[100].spans == []


def test_quality_passages_of_long_texts():
    text = prose(64 * 100, 61)
    whole = quality.encode_passages(text)
    assert len(whole) == 100 and abs(whole[50, quality.SHAPES + 3] - len(set(text.split()[3200:3264])) / 64) < 1e-6
    assert len(quality._spaced(whole)) == quality.MOST
    r = np.random.default_rng(3)
    model = quality.fit([r.random((3, quality.WIDTH), dtype=np.float32) for _ in range(20)], np.arange(20) % 2)
    (value,), (weights,) = model.score([whole])
    for block in (1, 7, 100):
        v, w = model.stream(whole, block)
        assert abs(v - value) < 1e-12 and np.allclose(w, weights, atol=1e-12)
    values, parts = model.score([whole, whole[:1], np.tile(whole, (30, 1))])
    assert np.allclose(values[[0, 2]], value) and [len(p) for p in parts] == [100, 1, 3000]
