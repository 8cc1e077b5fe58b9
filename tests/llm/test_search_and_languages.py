"""Hard negatives, token alignment and language identification against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffflow.llm import alignment, hard_negatives, language_id
from staffflow.llm.chunks import vocabulary
from staffflow.llm.queries import QUERIES
from tests.conftest import SMALL

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# 11 hard negatives


def brute_negatives(rows, is_anchor, n_pos=5, n_neg=3, least=50, most=95):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by all pairs."""
    whole = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None]
    whole = [r for r in whole if all(x is not None and math.isfinite(x) for x in r[2])]
    out = []
    for i, (vec_id, label, v) in enumerate(whole):
        if not is_anchor(vec_id):
            continue
        scored = [(-sum(int(a) * int(b) for a, b in zip(v, w[2])), w[0], w[1]) for j, w in enumerate(whole) if j != i]
        positives = sorted(s[:2] for s in scored if s[2] == label)[:n_pos]
        for minus, positive in positives:
            fits = sorted(s[:2] for s in scored if s[2] != label and least * -minus <= -100 * s[0] <= most * -minus)
            out += [(vec_id, positive, k + 1, s[1], -minus, -s[0]) for k, s in enumerate(fits[:n_neg])]
    return sorted(out)


def shown(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.select(*names).collect())


VECTORS = "vec_id long, label int, vector array<double>, rank string, anchor int, row_id string"


def clustered(seed=3, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 60, (4, 6))
    rows = [(i, int(rng.integers(0, 3)), np.floor(centres[i % 4] + rng.normal(0, 4, 6)).tolist()) for i in range(n)]
    rows += [(1000 + i, i % 3, [50.0] * 6) for i in range(60)]  # copies: ties everywhere
    return rows


@pytest.mark.parametrize("group, block", [(2048, 4096), (7, 16)])
def test_negatives_equal_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = clustered()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS).repartition(5)
    got = shown(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, group=group))
    assert got == brute_negatives(rows, lambda i: i % 10 == 0) and len(got) > 200


def test_bounds_leave_rows_unscored():
    """Where anchors lie close together, most rows are settled by their bounds."""
    rng = np.random.default_rng(4)
    vectors = np.floor(np.concatenate([rng.normal(200, 2, (40, 8)), rng.normal(0, 40, (2_000, 8))]))
    ids, label = np.arange(len(vectors)), np.arange(len(vectors)) % 5
    anchors = hard_negatives.Anchors(ids[:40], ids[:40], label[:40], vectors[:40], hard_negatives.spanning_tree(vectors[:40]))
    assert sorted(s[0] for s in anchors.steps) == list(range(40))
    positives = hard_negatives.TopPositives(anchors, 5)
    positives.add(ids, ids, label, vectors)
    scores = positives.score.tolist()
    windows = hard_negatives.Windows(
        positives.vec.tolist(), scores, [[s // 2 for s in x] for x in scores], [[95 * s // 100 for s in x] for x in scores]
    )
    top = hard_negatives.TopNegatives(anchors, windows, 3)
    top.add(ids, ids, label, vectors)
    assert top.scored < 0.3 * top.seen


def test_negatives_of_awkward_vectors(spark):
    big = float(2**60)
    rows = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (2, 1, [3.0]), (3, 2, [1.0, 1.0]), (4, 2, []), (5, 2, [0.0, 1.0]),
        (None, 1, [1.0, 1.0]), (6, None, [1.0, 1.0]), (7, 2, None), (8, 2, [None, 1.0]), (9, 2, [float("nan")]),
        (11, 2, [float("inf"), 1.0]), (12, 3, [-5.0, -5.0]), (13, 3, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)
    even = F.col("vec_id") % 2 == 0
    assert shown(hard_negatives.hard_negatives(df, even)) == [
        x for x in brute_negatives(rows, lambda i: i % 2 == 0)
    ]  # a shorter vector ends in zeros, which zip() leaves out alike
    wide = [(0, 1, [big, 3.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.75, 0.0]), (4, 2, [0.6, 7.0])]
    wide = [(i, c, [float(math.floor(x)) if x > 1 else float(round(x * 4)) for x in v]) for i, c, v in wide]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in wide], VECTORS)
    assert shown(hard_negatives.hard_negatives(df, F.col("vec_id") == 0)) == brute_negatives(wide, lambda i: i == 0)
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none, even).count() == 0


def test_mining_scales_and_moves_labels(spark):
    rows = [(i, i % 10, [0.37 * ((i * k) % 5) - 0.5 for k in range(1, 5)]) for i in range(120)]
    rows += [(200, 1, [1e300, -1e308]), (201, 2, [float("nan")] * 4), (203, 5, None)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = shown(hard_negatives.mined(df))
    single = [(i, c, None if v is None else [float(np.float32(x)) for x in v]) for i, c, v in rows if i not in (200, 201)]
    moved = [(i, (c + 1) % 10 if i % 7 == 0 else c, None if v is None else [float(math.floor(256 * x)) for x in v]) for i, c, v in single]
    assert got == brute_negatives(moved, lambda i: i % 50 == 0)  # 1e300 is infinite as a float


# 12 alignment


def plain_alignment(texts):
    """Rows of op12 by the two libraries on whole texts, without units, merges or slices."""
    import sentencepiece
    from tokenizers import Tokenizer

    from staffflow.llm.chunks import BYTE_CHARACTERS

    a = Tokenizer.from_file(vocabulary(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    byte_of = {c: v for v, c in BYTE_CHARACTERS.items()}
    rows, linked = [], []
    for text in texts:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes(byte_of[c] for c in a.id_to_token(x)) for x in ids_a]
        parts_b = [
            bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b
        ]
        whole = (" " + text).encode()
        links = Counter()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            rows.append([0, 0, 0, 0, ""])
            linked.append(links)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in parts_a]).tolist(), np.cumsum([len(x) for x in parts_b]).tolist()
        shared, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in shared:
            to_i, to_j = ends_a.index(end) + 1, ends_b.index(end) + 1
            mine, theirs = ids_a[i:to_i], ids_b[j:to_j]
            groups.append(",".join(map(str, mine)) + "|" + ",".join(map(str, theirs)))
            links.update(itertools.product(mine, theirs))
            i, j = to_i, to_j
        rows.append([len(ids_a), len(ids_b), len(groups), links.total(), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        linked.append(links)
    count = Counter(p for links in linked for p in links)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for row, links in zip(rows, linked):
        best = sum(n for p, n in links.items() if count[p] == most[p[0]])
        out.append((*row[:4], best, sum(n * count[p] for p, n in links.items()), row[4]))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
AWKWARD = [
    None, "", " ", "\n", "a", "a", "The  two  blanks", " leading", "trailing ", "line \n break", "<|endoftext|> <s> </s> <unk>",
    "日本語のテキスト 😀👩‍👩‍👧 café", "x▁y", "▁", "ﬁ ½ é", "it's we'll I'D 12345,678.90", "\x00\x01 \x1c b", "a\tb\r\nc",
    "supercalifragilisticexpialidocious " * 50, "ab" * 3_000, "  　x", "naïveté " + "é" * 700,
]


@pytest.mark.parametrize("slice_pairs, piece", [(2_000_000, 16_384), (40, 7)])
def test_alignment_equals_brute_force(spark, monkeypatch, slice_pairs, piece):
    monkeypatch.setattr(alignment, "PIECE", piece)
    monkeypatch.setattr(alignment, "LISTED", 4 if piece == 7 else 4_096)
    rows = [(k, t, "x", 1) for k, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int")
    out = alignment.alignment(df, vocabulary(A), vocabulary(B), slice_pairs)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    for k, want in enumerate(plain_alignment(AWKWARD)):
        assert got[k] == want, AWKWARD[k]


def test_alignment_of_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], plain_alignment([r.text for r in docs])))
    for r in QUERIES["op12_tokenizer_alignment"](spark, SMALL).collect():
        assert tuple(r[c] for c in COLUMNS) == want[r["doc_id"]], r["doc_id"]


@pytest.mark.parametrize("piece", [1, 2, 5, 64])
def test_pieces_find_every_common_end(piece):
    rng = np.random.default_rng(piece)
    for _ in range(200):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        i, j = alignment.diagonals(a, b, piece)
        assert (np.diff(i + j) <= piece).all() and i[-1] == len(a) and j[-1] == len(b)
        assert alignment.common_ends(a, b, piece).tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_units_outlive_a_full_generation():
    units = alignment.Units(alignment.TwoTokenizers(vocabulary(A), vocabulary(B)), kept=4)
    texts = ["one two three", "two four five", "six one two", "seven eight nine ten eleven"] * 2
    got = [[*x[:4], x[4].tolist(), x[5].tolist()] for t in texts for x in alignment.texts_aligned([t], units)]
    fresh = alignment.Units(units.tokenizers)
    assert got == [[*x[:4], x[4].tolist(), x[5].tolist()] for x in alignment.texts_aligned(texts, fresh)]


def test_alignment_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment(none, vocabulary(A), vocabulary(B)).count() == 0


# 13 languages

PIECES = ["▁", "▁a", "▁ab", "a", "ab", "b", "ba", "bab", "c"]


def all_cuts(word, place):
    """Every segmentation of a marked word into pieces and single letters."""
    if not word:
        return [[]]
    out = []
    for k in range(1, len(word) + 1):
        number = place.get(word[:k], len(PIECES) + 1 if k == 1 else None)
        if number is not None:
            out += [[number, *rest] for rest in all_cuts(word[k:], place)]
    return out


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(9)
    table = np.concatenate([rng.dirichlet(np.ones(len(PIECES)), 3).T, np.zeros((1, 3)), np.full((1, 3), 1e-7)])
    lattice = language_id.Lattice(PIECES)
    words = ["a", "ab", "abab", "babba", "cab", "xbaby", "aaaaaaaa", "ab"]
    got = lattice.log_likelihoods(words, table)
    counts = np.arange(1.0, len(words) + 1)
    expected = np.zeros(len(table))
    for k, word in enumerate(words):
        cuts = all_cuts("▁" + word, lattice.place)
        weights = np.array([np.prod(table[c], axis=0) for c in cuts])
        assert np.allclose(got[k], np.log(weights.sum(axis=0)))
        for c, w in zip(cuts, weights[:, 1] / weights[:, 1].sum()):
            np.add.at(expected, c, w * counts[k])
    assert np.allclose(lattice.expected(words, counts, table[:, 1]), expected)


def test_long_words_keep_their_scale():
    lattice = language_id.Lattice(PIECES)
    table = np.concatenate([np.full((len(PIECES), 2), 1 / len(PIECES)), np.zeros((1, 2)), np.full((1, 2), 1e-7)])
    got = lattice.log_likelihoods(["x" * 5_000], table)
    assert np.allclose(got, 5_000 * math.log(1e-7) + math.log(1 / len(PIECES)))


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op13_language_id"](spark, SMALL).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert set(got) == {r.doc_id for r in rows}
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got[r.doc_id]["held_out"] == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    told = [r for r in held if r.lang is not None and got[r.doc_id]["lang_pred"] != "und"]
    right = sum(got[r.doc_id]["lang_pred"] == r.lang for r in told)
    assert right >= 0.95 * len(told) > 20
    assert all(0 <= r["score"] <= 1 for r in got.values())


DOCS = "doc_id long, text string, lang string, score double, lang_pred string"


def test_undecided_repeated_and_awkward_texts(spark):
    rows = [(k, "the cat and the dog", "en", 0.0, "x") for k in range(40)] + [(100 + k, "der hund und die katze", "de", 0.0, "x") for k in range(20)]
    extra = [
        (500, None, "en"), (501, "", None), (502, "123 ... \n", "de"), (503, "日本語", None), (504, "DER HUND", None),
        (None, "the dog", "en"), (506, "the dog", "en"), (506, "the dog", "en"), (507, "x" * 20_000, None), (508, "²½", "de"),
    ]
    df = spark.createDataFrame(rows + [(*r, 0.0, "x") for r in extra], DOCS)
    out = language_id.languages(df, vocabulary(B))
    assert out.count() == len(rows) + len(extra)
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
    for k in (500, 501, 502, 508):
        assert got[k] == [("und", 0.0)]
    assert got[503][0][0] in ("en", "de")
    assert got[504][0][0] == "de" and got[None][0][0] == "en" and len(got[506]) == 2 and got[506][0] == got[506][1]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "the cat", None, 0.0, "x")], DOCS)
    assert [tuple(r)[2:] for r in language_id.languages(df, vocabulary(B)).collect()] == [("und", 0.0)]
    assert language_id.languages(df.limit(0), vocabulary(B)).count() == 0


def test_training_texts_are_bounded_and_distinct(spark):
    rows = [(k, f"text {k}", "en", 0.0, "x") for k in range(200)] + [(7, "copy", "en", 0.0, "x")] * 300 + [(1, "un", "fr", 0.0, "x")]
    got = language_id.training_texts(spark.createDataFrame(rows, DOCS), 50).collect()
    languages = Counter(r.lang for r in got)
    assert 30 <= languages["en"] <= 70 and languages["fr"] == 1 and len({r.text for r in got}) == len(got)
