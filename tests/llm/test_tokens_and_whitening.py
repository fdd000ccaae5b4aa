"""Alignment, BPE by merges and whitening against the libraries and brute force, with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from orogen.llm import alignment, merges, whitening

SCHEMA = "doc_id long, text string, id string, ids string, row string, n string, pair string"
ODD = list("abcAB İıßẞσςé각ᄀ가. , 's\t\n\r\f\v\x00\x1c\x85\xa0🙂👨‍👩‍👧𐐀 　 -0123½²́̈") + ["<|endoftext|>", "<|startoftext|>", "<|endof", "</s>", "<0x41>", "the", "  ", "hello"]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(n)]


def rows_of(texts):
    """Columns after the text clash with names that operators use inside."""
    rows = [(i, t, "x", "x", "x", "x", "x") for i, t in enumerate(texts)]
    special = [(9000, None), (9001, ""), (9002, "  "), (9003, " "), (9004, "a▁b"), (9005, "x "), (9006, "the cat " * 3000), (9007, "ab" * 20000), (None, "no id"), (None, None)]
    return [*rows, *[(i, t, None, None, None, None, None) for i, t in special], rows[5], rows[5]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_of(odd_texts(300, 3)), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def as_count(rows):
    return collections.Counter(map(tuple, rows))


# --- cross-tokenizer alignment --------------------------------------------------------------------------------------


class Libraries:
    """Both tokenizers over whole texts, without any memory of runs."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(alignment.BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
        alphabet = alignment.byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def of(self, text):
        if not text:
            return None
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        spelt = [[self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]]
        if any(b"".join(s) != f" {text}".encode() for s in spelt):
            return None
        return a, np.cumsum([len(s) for s in spelt[0]]).tolist(), b, np.cumsum([len(s) for s in spelt[1]]).tolist()


def aligned_by_hand(rows):
    libraries, counts, found = Libraries(), collections.Counter(), []
    for doc, text in rows:
        got = libraries.of(text)
        if got is None:
            found.append((doc, 0, 0, 0, [], ""))
            continue
        a, a_ends, b, b_ends = got
        spans = [[(s, e, i) for s, e, i in zip([0, *ends], ends, ids, strict=False)] for ids, ends in ((a, a_ends), (b, b_ends))]
        links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e] if len(a) < 500 else None
        if links is None:  # the same for long texts, by walking along both
            links, x, y = [], 0, 0
            while x < len(a):
                links.append((a[x], b[y]))
                p, q = a_ends[x], b_ends[y]
                x, y = x + (p <= q), y + (q <= p)
        counts.update(links)
        cuts, groups = sorted(set(a_ends) & set(b_ends)), []
        for low, high in zip([0, *cuts], cuts, strict=False):
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= high) for side in spans) if len(a) < 500 else None)
        if None in groups:
            groups = []
            for low, high in zip([0, *cuts], cuts, strict=False):
                inside = lambda ids, ends: ",".join(map(str, ids[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high, "right")]))  # noqa: E731, B023
                groups.append(f"{inside(a, a_ends)}|{inside(b, b_ends)}")
        found.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return as_count((d, na, nb, g, len(ls), sum(counts[p] == most[p[1]] for p in ls), sum(counts[p] for p in ls), s) for d, na, nb, g, ls, s in found)


@pytest.mark.parametrize("share", [alignment.SHARE, 40])
def test_alignment(odd, share, monkeypatch):
    """With a small share, pairs are both broadcast and shuffled."""
    monkeypatch.setattr(alignment, "SHARE", share)
    got = alignment.alignment_scores(odd)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert as_count(got.collect()) == aligned_by_hand([tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_alignment_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = alignment.op11_cross_tokenizer_alignment(spark, data)
    assert as_count(got.collect()) == aligned_by_hand([tuple(r) for r in docs.collect()])


def test_alignment_of_nothing(nothing):
    assert alignment.alignment_scores(nothing).collect() == []


def test_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 4000)
    libraries = Libraries()
    segments = alignment.Segments((alignment.ByteTokens(alignment._read(alignment.BYTES)), alignment.PieceTokens(alignment._read(alignment.PIECES))))
    for text in odd_texts(200, 8):
        got, want = segments.of(text), libraries.of(text)
        if text and want:
            known, numbers = got
            ids = [np.concatenate([np.frombuffer(known[k][side], np.int32) for k in numbers]).tolist() for side in (0, 2)]
            assert ids == [want[0], want[2]]
        assert len(segments.young) < 200


@pytest.mark.parametrize("text", [" a b", " a  b ", "  ", " a\nb  c\n d", " \n\n x", "   x   ", " a\u3000 b", " \t"])
def test_segments_are_the_text(text):
    assert "".join(alignment._SEGMENTS.findall(text)) == text


def test_new_segments_of_a_text_are_encoded_as_one(monkeypatch):
    """The libraries get one string for all of them, and each on its own only where blanks end it or bytes are lost; the tokens are the same."""
    sides = [alignment.ByteTokens(alignment._read(alignment.BYTES)), alignment.PieceTokens(alignment._read(alignment.PIECES))]
    given = []
    for side in sides:
        monkeypatch.setattr(side, "encode", lambda runs, own=side.encode: given.extend(runs) or own(runs))
    joined, alone = alignment.Segments(sides), alignment.Segments(sides)
    text = " ".join(f"wörd{k} and-{k * k}\n\tline" for k in range(50))
    joined.of(text)
    assert len(given) == 2
    for text in [text, "a b  ", " \n", "x▁y z", "\u3000q <s> </s>", *odd_texts(60, 4)]:
        joined.of(text)
        alone._learn_each(list(dict.fromkeys(alignment._SEGMENTS.findall(" " + text))))
    assert all(joined.young[s] == alone.young[s] for s in alone.young)


def test_a_segment_is_aligned_once_for_all_texts_of_a_block(spark):
    """Two texts share a block and its segments; their rows hold numbers alone."""
    docs = spark.createDataFrame([(1, "the cat the dog"), (2, "a dog the cat"), (3, None)], "doc_id long, text string").coalesce(1)
    (block,) = alignment.align(alignment.tokens(docs)).collect()
    assert sorted(s["times"] for s in block["segments"]) == [1, 2, 2, 3]
    assert len(block["groups"]) == len(block["links"]) == 4 and [len(d["numbers"]) for d in block["docs"]] == [4, 4, 0]


def test_small_blocks_give_the_same(spark, odd, monkeypatch):
    docs = odd.where("length(text) < 1000 OR text IS NULL")
    want = as_count(alignment.alignment_scores(docs).collect())
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 500)
    monkeypatch.setattr(alignment, "SLICE", 100)
    assert as_count(alignment.alignment_scores(docs).collect()) == want


def test_texts_are_cut_as_the_pattern_cuts_them():
    texts = [*odd_texts(300, 5), None, "", " ", "a b", "a  b", "x ", "\x1c a", "a\x1c b", "a\xa0 b", "a\n\nb c"]
    order, distinct, numbers, counts = alignment.cut_texts(pa.array(texts))
    stops = np.cumsum(counts)
    got = [[distinct[k] for k in numbers[e - n : e]] for e, n in zip(stops, counts, strict=True)]
    assert got == [alignment._SEGMENTS.findall(f" {texts[i]}") if texts[i] else [] for i in order]


def test_no_python_after_the_tokens(spark, data):
    aligned = alignment.align(alignment.tokens(spark.read.parquet(f"{data}/documents.parquet")))
    plan = aligned.select("links", F.transform("groups", alignment.spelt))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "PythonUDF" not in plan and "ArrowEvalPython" not in plan


# --- BPE by a segment tree --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return merges.Merges(merges.read_merges())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(merges.VOCABULARY)


def bpe_by_library(library, rows):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    return as_count(out)


def test_bpe(odd, library):
    got = merges.digests(odd)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert as_count(got.collect()) == bpe_by_library(library, [tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_bpe_query(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    assert as_count(merges.op12_bpe_round_trip(spark, data).collect()) == bpe_by_library(library, [tuple(r) for r in docs.collect()])


def test_bpe_of_nothing(nothing):
    assert merges.digests(nothing).collect() == [] and merges.encode(nothing).collect() == []


def test_bpe_columns_and_round_trip(odd, library):
    coded = merges.encode(odd)
    assert coded.columns == [c for c in odd.columns if c != "ids"] + ["ids"]
    for r in merges.decode(coded, text_col="n").select("text", "ids", "n").collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["n"] == library.decode(want, skip_special_tokens=False)
    assert merges.decode(odd.select(F.lit(None).cast("array<long>").alias("ids")).limit(1)).first()["decoded"] is None


def test_bpe_memory_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(merges, "REMEMBERED", 3000)
    encoder = merges.Encoder(model)
    for text in odd_texts(300, 9):
        ids, decoded = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert decoded == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert len(encoder.runs) + len(encoder.words) < 60


def test_pairs_hold_the_leftmost_least():
    r, none = random.Random(4), 10**9
    for n in (1, 2, 3, 8, 13):
        ranks = [r.randrange(5) * n + i for i in range(n)]
        tree = merges.Pairs(list(ranks), none)
        for _ in range(40):
            assert tree.least[1] == min(ranks)
            low, middle, high = sorted(r.choices(range(n), k=3))
            for at in (low, middle, high):
                ranks[at] = r.choice([none, r.randrange(5) * n + at])
            tree.set(low, (ranks[low], ranks[middle], ranks[high]), middle, high)


# --- embedding whitening ------------------------------------------------------------------------------------------------


def whitened_by_hand(rows, k=8):
    """Rows (id, vector) with numpy: deviation by id and (whitened with free signs, eigenvalues' shares)."""
    fine = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    size = collections.Counter(len(v) for _, v in fine)
    d = max(size, key=lambda s: (size[s], s))
    fine = [(i, v) for i, v in fine if len(v) == d]
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in fine])
    n, s = len(x), x.sum(0)
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s, strict=True)) for row in x]
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(k, int((e > 1e-12 * e[0]).sum()))
    return [i for i, _ in fine], n, deviation, y @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check_whitening(got, rows):
    ids, n, deviation, want, explained = whitened_by_hand(rows)
    k = want.shape[1]
    got = got.toPandas()
    assert len(got) == len(ids) * k and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"][0] <= 1e-4
    # an id may be null or repeated: rows are told apart by what they hold
    mine = collections.defaultdict(list)
    for c, part in got.groupby("component"):
        assert abs(part["explained"] - explained[c - 1]).max() <= 1e-4 * explained[c - 1]
        mine[c] = sorted(zip(part["vec_id"].fillna(-1), part["deviation"], part["whitened"], strict=True))
    for c in range(1, k + 1):
        def off(sign):
            theirs = sorted(zip([-1 if i is None else i for i in ids], deviation, sign * want[:, c - 1], strict=True))
            assert [t[:2] for t in theirs] == [(i, d) for i, d, _ in mine[c]]
            return max(abs(a[2] - b[2]) for a, b in zip(theirs, mine[c], strict=True))

        assert min(off(1), off(-1)) < 1e-6


def test_whitening(spark):
    r = np.random.default_rng(6)
    rows = [(i, (r.normal(size=9) * np.arange(1, 10) / 8 + 40).tolist()) for i in range(60)]
    rows += [(70, None), (71, []), (72, [None] * 9), (73, [float("nan")] * 9), (74, [float("inf")] * 9), (75, [1.0] * 8), (76, [0.0] * 9), (77, [1e300] * 9), (None, rows[3][1]), rows[4]]
    table = spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, v string, component string").repartition(5)
    check_whitening(whitening.whiten(table), [r for r in rows if r[0] != 77])


def test_whitening_keeps_digits_far_from_zero(spark):
    """Small spread about a large mean: squares of x itself would lose it."""
    r = np.random.default_rng(7)
    rows = [(i, (r.normal(size=4) * 0.1 + [3e8, -3e8, 1e8, 0]).tolist()) for i in range(50)]
    check_whitening(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_whitening_of_float_vectors_and_fewer_components(spark):
    r = np.random.default_rng(8)
    rows = [(i, np.float32(r.normal(size=3)).tolist()) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_whitening(whitening.whiten(table), rows)
    assert whitening.whiten(table, components=2).select("component").distinct().count() == 2


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_whitening_without_variance(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_beyond_a_long(spark):
    rows = [(i, [float(i) * 2**40, 1.0]) for i in range(8)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {None} and abs(got[0]["identity_error"]) < 1e-4


def test_whitening_of_long_vectors(spark):
    r = np.random.default_rng(9)
    rows = [(i, (r.normal(size=130) * np.arange(1, 131)).tolist()) for i in range(150)]
    check_whitening(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_whitening_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(whitening.op13_embedding_whitening(spark, data), rows)
