"""The pipeline against slow versions of its stages, and each stage on awkward rows."""

import pytest
from pyspark.sql import functions as F
from test_llm_operators import slow_components, slow_fingerprint, slow_spans, slow_viterbi

import corpus_pipeline
from orogen.llm import pieces, private, toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_run_by_brute_force(spark, data):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{data}/documents.parquet")
    model = toxicity.fit(frame, spark.read.parquet(f"{data}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.score(frame, model).where("toxic").collect()}
    left = {d: t for d, t in docs.items() if d not in toxic}
    ids = sorted(left)
    roots = slow_components([slow_fingerprint(left[d]) for d in ids], lambda a, b: (a ^ b).bit_count() <= 3)
    left = {d: left[d] for k, d in enumerate(ids) if roots[k] == k}
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    left = {d: t for d, t in left.items() if not any(q and 5 * len(q & shingles(t)) >= 4 * len(q) for q in items)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(got) == set(left) and toxic and len(left) < len(ids)
    vocabulary = pieces.read_vocabulary()
    finder = private.fit(frame.where(F.col("doc_id").isin(sorted(left))))
    for n, d in enumerate(sorted(left)):
        text, out, done = left[d], [], 0
        spans = finder.spans(text)
        assert [(s, e, k) for s, e, k, base in spans if base] == slow_spans(text)
        for s, e, kind, _ in spans:
            if s >= done:
                out += [text[done:s], f"[{kind.upper()}]"]
            done = max(done, e)
        text = "".join([*out, text[done:]])
        assert got[d]["round_trip"] and got[d]["n_pieces"] == len(got[d]["ids"]) and vocabulary.decode(got[d]["ids"]) == text
        if n < 40:
            words = vocabulary.words.findall("▁" + text.replace(" ", "▁"))[:50]
            want = [i for w in words for i in slow_viterbi(vocabulary, w)]
            assert got[d]["ids"][: len(want)] == want


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_rows(spark, data, number):
    name, stage = corpus_pipeline.STAGES[number]
    long_text = "wörter und mehr " * 3000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f", "en", "s", 11), (3, long_text, "de", "s", 1), (4, long_text, "de", "s", 1), (5, "x y z", None, None, 5), (5, "x y z", None, None, 5)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({"id": F.lit(1), "label": F.lit("x")} | {c: F.lit(-5) for c in ("__row", "__leak", "__copy", "___row")})
    got = stage(spark, docs, data)
    if number < 4:
        assert got.columns == docs.columns and {r["__row"] for r in got.collect()} == {-5}
        assert {1, 3, 5} <= {r["doc_id"] for r in got.collect()}
    else:
        assert got.count() == len(rows)
    assert stage(spark, docs.where("false"), data).count() == 0
    assert name


def test_clean_rows_stay(spark, data):
    clean = spark.createDataFrame([(i, f"plain words number {i} about topic {i * 7919} without anything odd {i * 104729}", "en", "s", 10) for i in range(30)], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, clean, data).count() == 30


def test_pieces_are_decoded(spark, data):
    docs = spark.createDataFrame([(1, "plain  words, wörter\n▁ und 漢字", "en", "s", 10), (2, None, "en", "s", 0), (3, "", "en", "s", 0)], COLUMNS)
    assert [r["round_trip"] for r in corpus_pipeline.as_pieces(spark, docs, data).collect()] == [True] * 3


def test_rows_are_judged_by_themselves(spark, data):
    """Rows without an id, and rows that share one, are dropped or stay for their own text."""
    item = max((r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()), key=len)
    plain = [f"plain words number {i} about topic {i * 7919} without anything odd {i * 104729}" for i in range(4)]
    rows = [(None, f"see {item}"), (1, f"see {item}"), (1, plain[0]), (None, plain[1]), (2, plain[2])]
    docs = spark.createDataFrame([(d, t, "en", "s", 10) for d, t in rows], COLUMNS)
    got = corpus_pipeline.without_test_items(spark, docs, data)
    assert sorted(r["text"] for r in got.collect()) == sorted(plain[:3])
    rows = [(None, plain[0]), (None, plain[0]), (3, plain[1]), (3, plain[1]), (2, plain[1]), (3, plain[2]), (None, plain[2]), (None, plain[3])]
    docs = spark.createDataFrame([(d, t, "en", "s", 10) for d, t in rows], COLUMNS)
    got = corpus_pipeline.without_near_copies(spark, docs, data)
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {(None, plain[0]), (2, plain[1]), (3, plain[2]), (None, plain[3])} and got.count() == 4
