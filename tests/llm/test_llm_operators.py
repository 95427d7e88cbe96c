"""Every operator against a brute-force version on small fixtures: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm import bpe, chat, components, exact, langid, mixing, ngram_join, quality, queries, suffixes, toxicity, warc

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))

ROWS = [
    (0, BASE, "en", "b", 1),
    (1, BASE + " nineteen", "en", "a", 2),
    (2, None, "en", None, 3),
    (3, "", None, "a", 4),
    (4, " \t\n ", "fr", "b", 5),
    (5, BASE.upper(), "en", "b", 6),
    (6, BASE.replace(" ", "  "), "en", "é", 7),
    (7, "Étude à l'œuvre 123 -- !!  \n\n x y \U0001f600", "fr", "é", 8),
    (8, LONG, "en", "a", 9),
    (9, LONG + " end", "en", "b", 10),
    (10, "same line\nsame line\nother line\n\n", "en", "b", 11),
    (11, "a b c d e", "de", "a", 12),
    (12, "A B C D E", "de", "a", 12),
    (13, "a b", "de", "a", 12),
    (14, "1234 5678 !!", "de", "a", 12),
    (15, " ".join(["x y z"] * 40), "de", "c", 1),
    (15, " ".join(["x y z"] * 40), "de", "c", 1),
    (None, "no number here at all, none", "en", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns that operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["score", "row", "n", "node", "entry", "size", "copies", "body", "sha", "words", "value", "h", "start", "trusted"]
    return df.withColumns({name: F.lit(f"{name}!") for name in extra})


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language(spark, docs, none):
    words = {"en": "the and of that with", "de": "der die und nicht ein", "fr": "le la une est dans"}
    train = [(f"{v} {k} " * n, k) for k, v in words.items() for n in range(1, 12)]
    model = langid.train([t for t, _ in train], [g for _, g in train])
    frame = spark.createDataFrame([(1, "the that of and"), (2, "nicht die und"), (3, None), (4, "12 !"), (5, "une est la dans " * 5000)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r for r in langid.predict_languages(frame, model).collect()}
    assert [got[k]["lang_pred"] for k in range(1, 6)] == ["en", "de", "und", "und", "fr"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    rows = langid.predict_languages(docs, model).select("row.*", "lang_pred")
    assert rows.count() == len(ROWS) and rows.columns[:-1] == docs.columns
    assert langid.predict_languages(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict_languages(docs, langid.train([], [])).collect()} == {"und"}


def test_language_held_out(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").collect()
    known = {r["doc_id"]: r["lang"] for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_ngram_join_edges(docs, none):
    got = by_id(ngram_join.near_duplicates(docs))
    want = brute_components({r[0]: r[1] for r in ROWS if r[0] is not None})
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items() if i is not None} == want
    assert ngram_join.near_duplicates(docs).count() == len(ROWS)
    assert ngram_join.near_duplicates(none).count() == 0
    kept = ngram_join.keep_rows(docs)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()}) == sorted(i for i, (_, c) in want.items() if i == c)


def test_ngram_join_null_id_before_its_copy(spark):
    """A row without doc_id does not stand for the equal texts after it in its task."""
    rows = [(None, BASE), (5, BASE), (9, BASE + " nineteen")]
    got = by_id(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)))
    assert (got[5]["component_id"], got[9]["component_id"]) == (5, 5)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 2, 3), (3, 2, 1, 0)])
def test_ngram_join_one_id_with_two_texts(spark, order):
    """Both texts of doc_id 5 have a near copy; the rows' order changes nothing."""
    one, two = " ".join(f"p{k}" for k in range(60)), " ".join(f"q{k}" for k in range(60))
    rows = [(5, one), (5, two), (9, two + " z"), (3, one + " y")]
    frame = spark.createDataFrame([rows[k] for k in order], "doc_id long, text string").coalesce(1)
    assert {(r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(frame).collect()} == {(5, 3), (9, 3), (3, 3)}


def test_ngram_join_many_near_copies(spark):
    """Frequent shingles, chains whose ends do not link, and short texts; all links are found."""
    import random

    random.seed(5)
    texts = {}
    for g in range(4):
        base = [f"g{g}w{random.randrange(400)}" for _ in range(40 * (g + 1))]
        for k in range(45):
            words = list(base)
            for _ in range(random.randrange(4)):
                words[random.randrange(len(words))] = f"edit{random.randrange(9)}"
            texts[len(texts)] = " ".join(words[: len(words) - random.randrange(6)])
    chain = [f"c{k}" for k in range(120)]
    for k in range(12):
        texts[len(texts)] = " ".join(chain[3 * k : 3 * k + 60])
    for k in range(30):
        texts[len(texts)] = " ".join(random.choice("pqr") for _ in range(random.randrange(9)))
    frame = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    got = by_id(ngram_join.near_duplicates(frame))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(texts)


def test_entries_of_linked_sets_meet():
    """Any two linked sets share an index entry, whatever shingles count as frequent."""
    import numpy as np

    random = np.random.default_rng(3)
    full = np.full(64, ~np.uint64(0))
    for frequent in (np.zeros(64, np.uint64), full, random.integers(0, 2**63, 64).astype(np.uint64)):
        for n in [*range(4, 40), 60, 99, 250, 1000]:
            x = np.unique(random.integers(0, 2**64, n, dtype=np.uint64))
            lost = n // 5
            y = np.unique(np.concatenate([random.permutation(x)[lost:]]))
            z = np.unique(np.concatenate([x, random.integers(0, 2**64, n // 4, dtype=np.uint64)]))
            for other in (y, z):
                assert ngram_join.linked(x, other)
                assert np.intersect1d(ngram_join.entries(x, full, frequent), ngram_join.entries(other, full, frequent)).size


def test_differences_of_linked_sets_meet():
    """Linked sets of which one does not link with the hub share an entry of their differences, and the bound leaves them open."""
    import numpy as np

    random = np.random.default_rng(8)
    full, none, tried = np.full(64, ~np.uint64(0)), np.zeros(64, np.uint64), 0
    for often in (none, full, random.integers(0, 2**63, 64).astype(np.uint64)):
        for _ in range(1500):
            hub = np.unique(random.integers(0, 2**64, int(random.integers(5, 90)), dtype=np.uint64))
            edited = lambda s, most: np.union1d(
                random.permutation(s)[int(random.integers(0, len(s) // most + 1)) :],
                random.integers(0, 2**64, int(random.integers(0, len(s) // most + 1)), dtype=np.uint64),
            )
            x = edited(hub, 2)
            y = edited(x, 12)
            for p, q in ((x, y), (y, x)):
                if not ngram_join.linked(p, q) or ngram_join.linked(p, hub) or np.array_equal(p, q):
                    continue
                sides = []
                for s in (p, q):
                    gone, fresh = np.setdiff1d(hub, s), np.setdiff1d(s, hub)
                    sides.append((*ngram_join.difference_entries(gone, fresh, len(s), len(hub), not ngram_join.linked(s, hub), full, often), len(gone) + len(fresh)))
                (all_p, _, (gone_p, fresh_p), d), (all_q, prefix, (gone_q, fresh_q), e) = sides
                if e:
                    tried += 1
                    assert np.intersect1d(all_p, all_q[prefix]).size
                    assert 9 * (d + e) - len(p) - len(q) <= 18 * (min(gone_p, gone_q) + min(fresh_p, fresh_q))
    assert tried > 500


def test_differences_meet_once_within_both_prefixes():
    """Linked sets of which neither links with the hub: the first shingle that their differences share is in both prefixes and passes the bound."""
    import numpy as np

    random = np.random.default_rng(4)
    full, none, tried, later = np.full(64, ~np.uint64(0)), np.zeros(64, np.uint64), 0, [0, 0]
    for often in (none, full, random.integers(0, 2**63, 64).astype(np.uint64)):
        for _ in range(1500):
            hub = np.unique(random.integers(0, 2**64, int(random.integers(9, 90)), dtype=np.uint64))
            x = np.union1d(random.permutation(hub)[: int(random.integers(len(hub) // 2, len(hub)))], random.integers(0, 2**64, len(hub) // 4, dtype=np.uint64))
            y = np.union1d(random.permutation(x)[len(x) // 12 :], random.integers(0, 2**64, len(x) // 15, dtype=np.uint64))
            if not ngram_join.linked(x, y) or ngram_join.linked(x, hub) or ngram_join.linked(y, hub) or np.array_equal(x, y):
                continue
            sides = []
            for s in (x, y):
                gone, fresh = np.setdiff1d(hub, s), np.setdiff1d(s, hub)
                entry, prefix, left_gone, left_fresh = ngram_join.left_entries(gone, fresh, len(s), len(hub), True, full, often)
                sides.append({int(e): (p, int(a), int(b), len(gone) + len(fresh)) for e, p, a, b in zip(entry, prefix, left_gone, left_fresh, strict=True)})
            shared = sorted(set(sides[0]) & set(sides[1]), key=lambda e: -sum(sides[0][e][1:3]))
            open_ = [9 * (p[3] + q[3]) - len(x) - len(y) <= 18 * (min(p[1], q[1]) + min(p[2], q[2])) for p, q in ((sides[0][e], sides[1][e]) for e in shared)]
            tried += 1
            assert sides[0][shared[0]][0] and sides[1][shared[0]][0] and open_[0]
            later = [later[0] + sum(open_[1:]), later[1] + len(open_) - 1]
    assert tried > 500 and 2 * later[0] < later[1]


def test_ngram_join_deletes_what_is_read(spark, tmp_path, monkeypatch):
    """Of its written tables only those that the result is read from, and small ones, are left."""
    tags = []
    monkeypatch.setattr("tidemark.llm.common.scratch_path", lambda _, tag: tags.append(tag) or f"{tmp_path}/{tag}-{len(tags)}")
    frame = spark.createDataFrame([(k, BASE + " end" * (k % 3)) for k in range(9)], "doc_id long, text string")
    found = ngram_join.near_duplicates(frame)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    gone = {"ngram-sets", "ngram-index", "ngram-buckets", "ngram-open", "ngram-left", "ngram-texts"}
    assert gone <= set(tags) and not left & gone and "ngram-members" in left
    assert {r["component_id"] for r in found.collect()} == {0}


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (50, 49)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    found = collections.defaultdict(set)
    for r in components.components(frame).collect():
        found[r["component"]].add(r["node"])
    assert sorted(map(sorted, found.values())) == [list(range(41)), [49, 50], list(range(100, 130))]
    assert components.components(frame.limit(0)).count() == 0


def brute_quality(text):
    words = WORD.findall(text or "")
    grams = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(8, 1, 0), (9, 1, 0), (15, 0, 0), (8, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality.judge(docs, labels)
    got = by_id(judged)
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == {r[0]: brute_quality(r[1]) for r in ROWS}
    assert judged.count() == len(ROWS) and not any(r["kept"] and r["base_failed"] for r in got.values())
    assert got[8]["kept"]
    assert quality.judge(none, labels).count() == 0
    unlabelled = quality.judge(docs, labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in unlabelled)


def test_quality_trusts_all_labelled_rows(spark):
    """Labels of documents elsewhere, however many, change nothing: no trusted row is left out for their sake."""
    import random

    random.seed(7)
    rows = [(k, " ".join(f"{'ab'[k % 2]}{random.randrange(300)}" for _ in range(80))) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    more = labels.unionByName(spark.range(1_000, 61_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    want = by_id(quality.judge(frame, labels))
    assert len({r["value"] for r in want.values()}) > 30 and not all(r["kept"] for r in want.values())
    assert by_id(quality.judge(frame, more)) == want


def test_quality_is_native(spark):
    plan = queries.op3_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact(docs, none, monkeypatch):
    body = {r[0]: re.sub("[\x20\x09-\x0d]+", " ", r[1] or "") for r in ROWS}
    for limit in (exact.TRIE_BYTES, 50):  # the second one makes subtrees leave early
        monkeypatch.setattr(exact, "TRIE_BYTES", limit)
        rows = exact.exact_duplicates(docs).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            same = [q[0] for q in ROWS if re.sub("[\x20\x09-\x0d]+", " ", q[1] or "") == body[r["doc_id"]]]
            least = min((i for i in same if i is not None), default=None)
            assert (r["keep_id"], r["group_size"], r["kept"]) == (least, len(same), r["doc_id"] == least)
            assert r["text_sha256"] == hashlib.sha256(body[r["doc_id"]].encode()).hexdigest()
    kept = exact.keep_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(body.values()))
    assert exact.exact_duplicates(none).count() == 0


def test_trie_owners():
    import random

    random.seed(2)
    keys = ["".join(random.choice("ab") for _ in range(random.randrange(7))).encode() for _ in range(400)]
    trie, want = exact.Trie(), {}
    for k, key in enumerate(keys):
        trie.insert(key, k, 1)
        want.setdefault(key, [k, 0])[1] += 1
    assert {body: [node.owner, node.copies] for body, node in trie.drain()} == want


@pytest.fixture(scope="module")
def tokenizer():
    tiktoken = pytest.importorskip("tiktoken")
    vocabulary = pytest.importorskip("public_tokenizers")
    path = vocabulary.path("byte_bpe_multi_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    return path, vocabulary.PATTERN, encoding


def test_bpe(docs, none, tokenizer):
    path, pattern, encoding = tokenizer
    got = by_id(bpe.encode_documents(docs, path, pattern))
    for doc_id, text, *_ in ROWS:
        ids = encoding.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert tuple(got[doc_id][n] for n in ("n_tokens", "ids_sha256", "decoded_sha256")) == want
    assert bpe.encode_documents(none, path, pattern).count() == 0


def test_bpe_words(tokenizer):
    """Random text with odd white space, and words long enough for the repeated statements."""
    import random

    path, pattern, encoding = tokenizer
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    random.seed(1)
    letters = " \n\t\r\x1c\x85   a b c'sé12²-*.x 中\U0001f600"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(40))) for _ in range(1500)]
    texts += ["a" * n for n in (1, 399, 401, 20_000)] + ["".join(random.choice("abcdeé") for _ in range(n)) for n in (390, 900, 2500)]
    for text, (ids, raw) in zip(texts, codec.encode(texts), strict=True):
        assert ids == ",".join(map(str, encoding.encode_ordinary(text))) and raw == text.encode()


def brute_repeats(rows):
    first = {}
    texts = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: r[0])
    for i, b in texts:
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_of_one_id_with_several_texts(spark):
    """Rows of one doc_id are not compared with each other, and each is cut by its own text's repeats."""
    import random

    random.seed(6)
    text = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    early = text(300)
    rows = [(1, early), (2, text(20)), (2, early[:120] + text(280)), (2, text(200) + early[100:200] + text(200)), (2, text(20)), (None, early), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = sorted((r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffixes.remove_repeats(frame).filter("doc_id = 2").collect())
    want = []
    for i, t in rows:
        if i == 2:
            found = brute_repeats([(1, early), (2, t)])[2]
            want.append((found[0], found[1], found[3]))
    assert got == sorted(want) and sum(n for _, n, _ in got) >= 220


def test_repeats_edges(docs):
    """Nulls, repeated rows, long texts and clashing columns of the common fixture."""
    got = by_id(suffixes.remove_repeats(docs))
    want = brute_repeats([r[:2] for r in ROWS if r[0] is not None])
    assert {i: tuple(got[i][n] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for i in want} == want
    assert got[None]["n_removed"] == 0


def test_repeats(spark, docs, none):
    import random

    random.seed(4)
    text = lambda n: "".join(random.choice("abcd é") for _ in range(n))
    shared, other = text(130), text(60)
    rows = [
        (1, text(40) + shared + text(30)),
        (2, text(20) + shared[:100] + other + text(20)),
        (3, shared + other),
        (4, other[:49]),
        (5, None),
        (6, "z" * 200),
        (7, "z" * 300),
        (8, other[10:] + shared[40:] + shared[:70]),
        (9, text(300)),
    ]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = by_id(suffixes.remove_repeats(frame))
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == brute_repeats(rows)
    assert suffixes.remove_repeats(none).count() == 0


def test_window_order():
    """The classes of a difference cover, merged by counting, give the order of whole windows, equal ones included."""
    import random

    random.seed(16)
    raw = bytes(random.choice(b"ab") for _ in range(60)) * 6 + b"a" * 120 + bytes(random.randrange(256) for _ in range(200))
    n, data = len(raw) - suffixes.LENGTH + 1, np.frombuffer(raw, np.uint8)
    deep = [raw[k : k + suffixes.DEPTH] for k in range(len(raw) - suffixes.DEPTH + 1)]
    names = {b: k for k, b in enumerate(sorted(set(deep)))}
    kind = np.arange(n) % suffixes.PERIOD
    ranks = np.array([[names[deep[k + d]] for d in suffixes._AWAY[k % suffixes.PERIOD]] for k in range(n)])
    windows = [raw[k : k + suffixes.LENGTH] for k in range(n)]
    order = np.array(sorted(range(n), key=lambda k: windows[k][:16]))
    heads = {b: k for k, b in enumerate(sorted({w[:16] for w in windows}))}
    group = np.array([heads[windows[k][:16]] for k in order])
    tail = suffixes._eight(data, order + suffixes.LENGTH - 8).to_numpy()
    got = suffixes.merged_ranks(kind[order], group, ranks[order], tail)
    inside = sorted(windows)
    assert got.tolist() == [inside.index(windows[k]) for k in order]


def test_hits_in_parts(spark, monkeypatch):
    """Windows of one beginning stay together when a task orders its windows in parts, and no position is a row of a recursion."""
    import random

    random.seed(17)
    text = lambda n: "".join(random.choice("abcd ") for _ in range(n))
    shared = text(70)
    bodies = [(k, k, (text(20) + shared + text(15)).encode()) for k in range(40)]
    segs = spark.createDataFrame(bodies, "seg long, doc_id long, body binary")
    want = {(k, p) for k, _, b in bodies for p in range(len(b) - 49) if any(b[p : p + 50] in other for i, _, other in bodies if i < k)}
    assert {(r["seg"], r["pos"]) for r in suffixes.window_hits(segs).collect()} == want and len(want) >= 39 * 21
    placed = spark.createDataFrame([r for r in suffixes_rows(bodies)], suffixes._PLACED)
    monkeypatch.setattr(suffixes, "ORDERED", 50)
    parts = placed.sort("head", "neck").toArrow().to_batches(max_chunksize=7)
    found = [r for b in suffixes._hits(iter(parts)) for r in zip(b.column("seg").to_pylist(), b.column("pos").to_pylist(), strict=True)]
    assert set(found) == want and len(found) == len(want)


def test_bitmaps_grow(spark, monkeypatch):
    """A bitmap has room for all hashes that are met twice, and holds every one of them."""
    monkeypatch.setattr(suffixes, "BITS", 1 << 10)
    rng = np.random.default_rng(6)
    twice, once = (rng.integers(0, 1 << 64, n, np.uint64) for n in (5_000, 5_000))
    frame = spark.createDataFrame([(h,) for h in np.concatenate([twice, once, twice]).view(np.int64).tolist()], "h long").repartition(3)
    shared = suffixes.met_in(frame, lambda batches: (b.column("h").to_numpy().view(np.uint64) for b in batches))
    assert suffixes.has_met(shared.value, twice).all()
    assert suffixes.has_met(shared.value, once).mean() < 0.1


def test_packed_columns(spark):
    rng = np.random.default_rng(7)
    bucket, kinds = rng.integers(0, 5, 1_000), ("i8", "i4", "u8")
    columns = [rng.integers(0, 1 << 30, 1_000).astype(k) for k in kinds]
    rows = [suffixes._dealt(bucket[a : a + 300], [c[a : a + 300] for c in columns]) for a in range(0, 1_000, 300)]
    batches = spark.createDataFrame([r for b in rows for r in zip(*b.to_pydict().values(), strict=True)], suffixes._PACKED).sort("bucket").toArrow().to_batches(max_chunksize=3)
    for k, held in suffixes._rows_by_bucket(iter(batches)):
        got = suffixes._unpacked(held, kinds)
        assert sorted(zip(*map(list, got), strict=True)) == sorted(zip(*(list(c[bucket == k]) for c in columns), strict=True))
    assert not list(suffixes._rows_by_bucket(iter([])))


def test_repeats_leave_no_shuffle_files(spark):
    """Shuffle files go as soon as a step is written, not when the driver collects its garbage."""
    import random
    import time

    random.seed(18)
    text = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = [text(400) for _ in range(40)]
    docs = spark.createDataFrame([(k, text(1_500) + shared[k % 40] + text(300)) for k in range(600)], "doc_id long, text string").withColumn("key", F.xxhash64("text"))
    place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held() -> int:
        files = place.getAllFiles()
        found = [files.apply(k) for k in range(files.size())]
        return sum(f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))

    before = held()
    assert suffixes.repeated_starts(docs).count() == 560
    for _ in range(50):
        if held() - before <= 20_000:
            break
        time.sleep(0.1)
    assert held() - before <= 20_000


def suffixes_rows(bodies):
    """Rows of windows as ``_placed`` gives them, with ranks by brute force."""
    deep = sorted({b[k : k + suffixes.DEPTH] for _, _, b in bodies for k in range(len(b) - suffixes.DEPTH + 1)})
    names = {b: k for k, b in enumerate(deep)}
    eight = lambda b: int.from_bytes(b, "big") - (1 << 63)
    for seg, doc, b in bodies:
        for p in range(len(b) - 49):
            ranks = [names[b[p + d : p + d + suffixes.DEPTH]] for d in suffixes._AWAY[p % suffixes.PERIOD].tolist()]
            yield (seg, doc, p, eight(b[p : p + 8]), eight(b[p + 8 : p + 16]), eight(b[p + 42 : p + 50]), *ranks)


def test_one_state_a_worker():
    """A worker that goes on with another operator lets the encoder's tables and pieces go."""
    import gc
    import pickle
    import weakref

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    codec = bpe.held_codec("digest", r"\w+|\s+|[^\w\s]+", ranks)
    assert codec is bpe.held_codec("digest", r"\w+|\s+|[^\w\s]+", ranks)
    gone = weakref.ref(codec)
    del codec
    model = toxicity.train(["bad words here"] * 6, ["good words here"] * 6)
    held = toxicity.held_model(pickle.dumps(model))
    assert held.score(held.features("words")) >= 0
    gc.collect()
    assert gone() is None


def test_suffix_ranks(spark):
    text = b"mississippi banana mississippi band " * 2
    rows = [(0, k, b + 1) for k, b in enumerate(text)] + [(1, k, b + 1) for k, b in enumerate(b"banana")]
    got = {(r["seg"], r["pos"]): r["rank"] for r in suffixes.suffix_ranks(spark.createDataFrame(rows, "seg long, pos int, sym long")).collect()}
    whole = {0: text, 1: b"banana"}
    order = sorted(got, key=lambda p: whole[p[0]][p[1] :])
    assert [got[p] for p in order] == sorted(got.values())
    for a, b in zip(order, order[1:], strict=False):
        same = whole[a[0]][a[1] :][:50] == whole[b[0]][b[1] :][:50] and len(whole[a[0]]) - a[1] == len(whole[b[0]]) - b[1]
        assert got[a] <= got[b] and (not same or got[a] == got[b])


def test_warc(spark, tmp_path):
    html = ["<p>one</p>" * 50, None, "", "<p>one</p>" * 50, "été\r\n\r\nWARC/1.1\r\n", "", "<i>big</i>" * 40_000]
    rows = [(k, f"http://h/{k} x", h, "clash") for k, h in enumerate(html)] + [(None, None, "lost", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string").repartition(3)
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(pages, folder, archive_bytes=1000)
    got = {r["page_id"]: r for r in warc.read_archives(manifest, folder).collect()}
    assert len(got) == len(rows) and all(r["intact"] for r in got.values())
    for page_id, _, body, _ in rows:
        payload = (body or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (body or "") and r[0] is not None]
        first = min(same, default=None)
        want = ("response", None) if page_id == first else ("revisit", first)
        r = got[page_id]
        assert (r["record_type"], r["refers_to"]) == want and r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    big = warc.write_archives(pages, f"{folder}2", least_bytes=100)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_archives(big, f"{folder}2").collect()}
    assert kinds[3] == "revisit" and kinds[5] == "response"
    assert warc.archive_and_read(spark, pages.limit(0)).count() == 0


def test_archive_can_be_read_by_record():
    zstandard = pytest.importorskip("zstandard")
    records = [warc.encode_record(k, "u", b"payload %d" % k * 40, None, False) for k in range(300)]
    data = warc.encode_archive(records)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little") and list(warc.decode_archive(data)) == records
    assert zstandard.frame_content_size(data[8 + int.from_bytes(data[4:8], "little") :]) == len(records[0])


def test_chat(spark):
    turns = [
        (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yes <|im_end|>"), (3, 0, "user", "hi"), (3, 1, "bot", "yes <|im_end|>"),
        (4, 0, "user", "hi"), (4, 1, "bot", "no"), (5, 0, None, None), (6, 1, "b", "x"), (6, 1, "a", "y"), (None, 0, "user", "alone"), (7, 0, "user", ""),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumn("size", F.lit("clash")).repartition(3)
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"]) for r in chat.format_chats(frame).collect()}
    assert got == {2: (2, 2), 4: (2, 1), 5: (1, 1), 6: (2, 1), None: (1, 1), 7: (1, 1)}
    text = {r["conv_id"]: r["chat"] for r in chat.format_chats(frame).collect()}
    assert text[2] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nyes < |im_end|><|im_end|>\n"
    assert text[6].startswith("<|im_start|>a\ny")
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_toxicity(spark, docs, none):
    import random

    random.seed(6)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randrange(2, 8))) for _ in range(400)]
    plain = lambda: [random.choice(words) for _ in range(120)]

    def bad():
        text = plain()
        for _ in range(6):
            text[random.randrange(len(text))] = random.choice(["wretchling", "scoundrelly", "nastyish"])
        return text

    good_texts, bad_texts = [" ".join(plain()) for _ in range(150)], [" ".join(bad()) for _ in range(90)]
    model = toxicity.train(bad_texts, good_texts)
    assert b"wretchling" in model.toxic and b"wretchling" not in model.ordinary and len(model.toxic) == len(model.ordinary)
    model.open()
    fresh = [(model.score(model.features(" ".join(bad()))), model.score(model.features(" ".join(plain())))) for _ in range(60)]
    assert sum(a >= 0.3 for a, _ in fresh) >= 57 and sum(b < 0.3 for _, b in fresh) >= 57
    rows = toxicity.score_texts(docs, model).select("row.*", F.col("score").alias("found"))
    assert rows.count() == len(ROWS) and rows.columns[:-1] == docs.columns
    assert all(0 <= r["found"] <= 1 for r in rows.collect())
    assert toxicity.score_texts(none, model).count() == 0
    assert toxicity.train([], good_texts) is None and toxicity.train(bad_texts, []) is None
    assert {r["score"] for r in toxicity.score_texts(docs, None).collect()} == {0.0}


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mixing(spark, docs, none):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["taken"])
    assert sorted(rows, key=key) == sorted(again, key=key) and len(rows) == len(ROWS)
    sizes = collections.Counter()
    for r in ROWS:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = brute_targets(sizes)
    source = {r[0]: r[3] for r in ROWS}
    for r in rows:
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]], abs=1e-6)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_mixing_hits_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_mixing(spark, sf).collect()
    source = {r["doc_id"]: r["source"] for r in queries.table(spark, sf, "documents").collect()}
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, sf, name):
    verdict, _, rows, shown = compare(spark, connect(sf), sf, name, queries.QUERIES[name], queries.ORACLE[name])
    assert verdict == "ok" and rows > 0, shown


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "bpe"]


def test_pipeline(spark, docs, tokenizer):
    """Each stage keeps the columns, and the last one's rows are those of the mix."""
    sf, held = "/root/testdata/sf0.001", queries.table(spark, "/root/testdata/sf0.001", "documents")
    columns = held.columns
    before = held.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        held = function(spark, held, sf)
        assert held.columns == columns, name
        assert held.count() <= 3 * before
    ids = collections.Counter(r["doc_id"] for r in held.collect())
    rows = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == ids
    texts = {r["doc_id"]: r["text"] for r in held.collect()}
    _, _, encoding = tokenizer
    for r in rows[:50]:
        assert r["n_tokens"] == len(encoding.encode_ordinary(texts[r["doc_id"]] or ""))
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, sf).columns == docs.columns
        assert function(spark, docs.limit(0), sf).count() == 0
