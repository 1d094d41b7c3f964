"""Hard negatives, tokenizer alignment and least-squares packing against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearframe.llm import align_tokens, hard_negatives, nnls_packing, packing

LONG = " ".join(f"w{i % 977}x{i % 31}, é." for i in range(60_000))
TEXTS = [
    (1, "Alpha beta, gamma. Naïve café don't <|endoftext|> 12345"), (2, None), (3, ""), (4, LONG), (5, "日本語 テキスト  two spaces\n\nlines\t tab "),
    (6, "same text twice"), (6, "same text twice"), (None, "no id at all"), (7, "   "), (8, "a▁b is not spelled by the pieces"), (None, None),
    (9, "H̱ İ K ﬁ Σς 😀 \x1c x"), (10, "x" * 70_000), (11, "to to to " * 900),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, i, "x", b"y", 1) for i, r in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, slice int, bin string, ids binary, codes int")


def key(rows):
    return sorted(rows, key=repr)


# ---------------------------------------------------------------- negatives
VECTORS = [(i, [((i * 37 + j * 11) % 23 - 11) / 16.0 + (i % 5) / 64 for j in range(6)], i % 3) for i in range(240)]
ODD = [
    (300, None, 1), (301, [1.0] * 6, None), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (303, [float("nan")] * 6, 1), (304, [float("inf")] * 6, 2),
    (305, [0.0] * 6, 1), (400, [0.0] * 6, 2), (20, VECTORS[20][1], 2), (306, [0.5, 0.5], 0), (307, [], 1), (500, [0.25] * 6, 77), (600, [0.25] * 6, 77), (None, [1.0] * 6, 0),
]


def brute_negatives(rows, every):
    ok = [(n, i, np.floor(256 * np.array([*v, *[0.0] * (6 - len(v))])).astype(int), c) for n, (i, v, c) in enumerate(rows) if i is not None and v is not None and c is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, v, c in ok:
        if i % every:
            continue
        scored = sorted((-int(v @ w), j, m, d) for m, j, w, d in ok if m != n)
        for p, j, _, _ in [x for x in scored if x[3] == c][:5]:
            far = [(q, k) for q, k, _, d in scored if d != c and 80 * -p <= 100 * -q <= 100 * -p][:5]
            out += [(i, j, r + 1, k, -p, -q) for r, (q, k) in enumerate(far)]
    return key(out)


@pytest.mark.parametrize(("block", "pack"), [(4096, 2048), (16, 3), (50, 1)])
def test_hard_negatives(spark, block, pack):
    rows = VECTORS + ODD
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, block string, score double").repartition(3)
    got = hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 20 == 0, block=block, pack=pack).collect()
    assert key(tuple(r) for r in got) == brute_negatives(rows, 20)


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, (4000, 3))
    x[:5] = 400
    lists, ids = hard_negatives.Lists(x), np.arange(4000)
    a = np.array([[3, 2, 1]])
    (hits,), read = hard_negatives.threshold_search(lists, ids, ids, None, a[0], lists.thresholds(a)[0], [(-(1 << 63), 1 << 62)], 5)
    assert hits.tolist() == [0, 1, 2, 3, 4] and read < 100
    # equal scores at the threshold: the smaller id wins, wherever it lies on the lists
    same = np.ones((900, 4), np.int64)
    lists, back = hard_negatives.Lists(same), np.arange(900)[::-1].copy()
    (hits,), _ = hard_negatives.threshold_search(lists, back, back, None, same[0], lists.thresholds(same[:1])[0], [(0, 4)], 3)
    assert back[hits].tolist() == [0, 1, 2]


def test_hard_negatives_large_components_and_empty(spark):
    rows = [(0, [1e6, 1.0], 1), (20, [1e30, 2.0], 1), (1, [-1e30, 1.0], 2), (2, [9e5, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 20 == 0).collect()
    held = lambda v: [max(-(1 << 27), min(1 << 27, int(np.floor(256 * x)))) for x in v]
    score = lambda a, b: sum(x * y for x, y in zip(held(a), held(b)))
    # exact whole numbers beyond 53 bits
    assert {(r["anchor_id"], r["positive_score"]) for r in got} <= {(0, score(rows[0][1], rows[1][1])), (20, score(rows[0][1], rows[1][1]))}
    assert hard_negatives.mine_hard_negatives(df.limit(0), F.lit(True)).count() == 0
    assert hard_negatives.mine_hard_negatives(df, F.col("vec_id") < 0).count() == 0


# ---------------------------------------------------------------- alignment
def brute_alignment(texts):
    a, b = Tokenizer.from_file(align_tokens.VOCABULARY_A), sentencepiece.SentencePieceProcessor(model_file=align_tokens.VOCABULARY_B)
    a.encode_special_tokens = True
    bytes_a, bytes_b = align_tokens.a_bytes(align_tokens.VOCABULARY_A), align_tokens.b_bytes(b)
    links, held = [], Counter()
    for t in texts:
        found = None
        if t:
            x, y, want = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t), (" " + t).encode()
            if b"".join(bytes_a[i] for i in x) == want == b"".join(bytes_b[i] for i in y):
                ends = [np.cumsum([len(n[i]) for i in ids]).tolist() for n, ids in ((bytes_a, x), (bytes_b, y))]
                groups, i, j = [], 0, 0
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    m, n = i, j
                    while m < len(x) and ends[0][m] <= cut:
                        m += 1
                    while n < len(y) and ends[1][n] <= cut:
                        n += 1
                    groups.append((x[i:m], y[j:n]))
                    i, j = m, n
                pairs = Counter((p, q) for g, h in groups for p in g for q in h)
                held.update(pairs.keys())
                text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
                found = (len(x), len(y), len(groups), pairs, hashlib.sha256(text.encode()).hexdigest())
        links.append(found)
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None
        else (*f[:3], sum(f[3].values()), sum(n for pq, n in f[3].items() if held[pq] == top[pq[0]]), sum(n * held[pq] for pq, n in f[3].items()), f[4])
        for f in links
    ]


def test_alignment(docs):
    got = align_tokens.align_tokenizers(docs.repartition(3)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = [(i, *r) for (i, _), r in zip(TEXTS, brute_alignment([t for _, t in TEXTS]), strict=True)]
    assert key(tuple(r) for r in got) == key(want)


def test_alignment_slices_and_wide_groups(docs, monkeypatch):
    # every document its own slice; long groups counted by distinct ids
    rows = [(i, "日本語" * 40 + " " + t) for i, t in enumerate(["x", "un deux trois", "x y"])]
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(align_tokens, "SLICE", 1)
    got = align_tokens.align_tokenizers(df).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute_alignment([t for _, t in rows])


def test_alignment_groups_and_empty(docs):
    df = docs.where("doc_id in (1, 6)")
    for r in align_tokens.align_tokenizers(df, with_groups=True).collect():
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] and r["groups"].count(";") == r["n_groups"] - 1
    assert align_tokens.align_tokenizers(docs.limit(0)).count() == 0


def test_alignment_in_parts_is_that_of_the_text():
    al = align_tokens.Aligner(align_tokens.VOCABULARY_A, align_tokens.VOCABULARY_B)
    text = LONG + "  two  spaces\n\nand lines " * 9000
    parts = list(al.parts(text))
    assert al.local and len(parts) > 1 and " ".join(parts) == text
    tokens = [al.tokens(p) for p in parts]
    assert np.concatenate([b for _, b in tokens]).tolist() == al.b.encode(text)
    assert np.concatenate([a for a, _ in tokens]).tolist() == packing.encode(al.a, " " + text)


# ---------------------------------------------------------------- packing
def ids_of(encoder, text):
    return np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_word_ids_equal_the_tokenizer():
    words = nnls_packing.WordIds(nnls_packing.VOCABULARY)
    rng = np.random.default_rng(3)
    bits = ["a", "B", "H", "é", "Σ", "ς", "0", "7", ".", ",", "!", "'", "'s", " ", "  ", "\n", "\x1c", "\xa0", "̱", "̇", "I", "İ", "K", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "日本", "😀", "x" * 70]
    for n in rng.integers(0, 12, 3000):
        text = "".join(rng.choice(bits, n))
        assert words.ids(text) == ids_of(words.encoder, text)[:-1].tobytes(), text
    for text in (LONG, " " * 2_000_000, "\n" * 2_000_000):
        assert words.ids(text) == ids_of(words.encoder, text)[:-1].tobytes()


def check_pieces(pieces, texts, size):
    encoder = Tokenizer.from_file(nnls_packing.VOCABULARY)
    want = Counter()
    for i, t in texts:
        want[(i, ids_of(encoder, t).tobytes())] += 1
    # lay out the sequences and the documents
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r["length"] == len(r["ids"]) // 4 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    for (i, n), parts in by_doc.items():
        copies = sum(c for (k, b), c in want.items() if k == i and len(b) == 4 * n)
        assert sum(len(b) for _, b in parts) == 4 * n * copies
    return padding, sum(n for p in by_sequence.values() for _, n in p)


@pytest.mark.parametrize("size", [64, 2048])
def test_pack_by_lengths(docs, size):
    pieces = nnls_packing.pack_by_lengths(docs.repartition(3), size=size, keep_ids=True).collect()
    check_pieces(pieces, TEXTS, size)
    # documents with ids of their own are whole, byte for byte
    encoder, texts = Tokenizer.from_file(nnls_packing.VOCABULARY), dict(TEXTS)
    for i in (1, 2, 3, 4, 5, 7, 9, 10, 11):
        mine = sorted((r["start"], bytes(r["ids"])) for r in pieces if r["doc_id"] == i)
        assert b"".join(b for _, b in mine) == ids_of(encoder, texts[i]).tobytes()


def test_pack_by_lengths_many(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(1, 700, 900))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = nnls_packing.pack_by_lengths(df, size=512, keep_ids=True).collect()
    padding, total = check_pieces(pieces, rows, 512)
    assert padding < 0.03 * total
    kinds = Counter(r["sequence_id"] % 4 for r in pieces)
    assert kinds[1] > kinds[2]  # most rests are placed by combinations
    got = nnls_packing.sequence_rows(nnls_packing.pack_by_lengths(df, size=512, keep_ids=True), 512).collect()
    assert sum(r["n_tokens"] for r in got) == total
    for r in got:
        assert len(r["ids"]) == 4 * (r["n_tokens"] if r["n_tokens"] & (r["n_tokens"] - 1) == 0 else 512) and r["cu_seqlens"][-1] == r["n_tokens"]


def test_pack_by_lengths_empty(docs):
    assert nnls_packing.pack_by_lengths(docs.limit(0)).count() == 0
    assert [r["length"] for r in nnls_packing.pack_by_lengths(docs.where("doc_id = 3")).collect()] == [1]


def test_nnls_against_every_small_answer():
    ways = nnls_packing.combinations(12)
    assert len(ways) == 1 + 6 + 12 and (ways.sum(1) == 12).all()
    made = np.zeros(len(ways))
    made[[1, 4, 9]] = 30, 7, 11
    target = np.zeros(12)
    for way, n in zip(ways, made):
        for b in way[way > 0]:
            target[b - 1] += n
    x = nnls_packing.nnls(ways, target)
    dense = np.zeros((13, len(ways)))
    np.add.at(dense, (ways.ravel(), np.repeat(np.arange(len(ways)), 3)), 1.0)
    assert (x >= 0).all() and np.abs(dense[1:] @ x - target).max() < 1e-4
    kept, times = nnls_packing.repeats(target.astype(int), 12)
    used = np.zeros(13, int)
    for way, n in zip(kept, times):
        np.add.at(used, way, n)
    assert (used[1:] <= target).all()


# ---------------------------------------------------------------- packing ids of long white space
def test_encode_long_white_space():
    enc, whole = packing.encoder(packing.load_ranks()), Tokenizer.from_file(align_tokens.VOCABULARY_A)
    whole.encode_special_tokens = True
    for c in (" ", "\t", "\n", "　"):
        for text in (c * 2_000_000, "a" + c * 5000 + "b c", "a" + c * 5000 + "'s", "\x1c" + c * 5000 + "\x1c" + c * 9000):
            assert packing.encode(enc, text) == whole.encode(text, add_special_tokens=False).ids
