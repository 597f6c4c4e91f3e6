"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from silverbrook.llm import mixing, storage
from silverbrook.llm.queries import queries
from test_operators_llm import _classes, _deduped


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.cut(stage(spark, docs, data), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    start, near, dedup, mixed, packed = (seen[n] for n in names)
    assert start.count() == 200

    rows = [(r.doc_id, r.text or "") for r in start.collect()]
    classes = _classes(rows, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, c) in classes.items() if c == i}
    rows = [(r.doc_id, r.text or "") for r in near.collect()]
    expected = _deduped(rows, 20)
    kept = {r.doc_id: r for r in dedup.collect()}
    assert set(kept) == {i for i, (n, gone, _) in expected.items() if gone == 0 or gone < n}
    before = dict(rows)
    assert all((kept[i].text == before[i]) == (expected[i][1] == 0) and kept[i].n_chars == len(kept[i].text) for i in kept)
    sizes = dedup.groupBy().agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n")).first().n
    words = mixed.groupBy().agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n")).first().n
    assert abs(sizes - words) <= 20
    per = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).count()
    assert per == mixed.select("doc_id").distinct().count()


def test_run_and_registration(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 14)]
    empty = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = storage.cut(stage(spark, empty, data), "empty")
        assert empty.count() == 0


def test_null_and_repeated_ids(spark):
    """Rows without an id and rows that share one keep their own text, source and count in each stage."""
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abdeghilmnorstu") for _ in range(5)) for _ in range(n))
    rows = [(i, text(40), "a") for i in range(6)] + [(None, text(n), s) for n, s in ((30, "a"), (50, "a"), (60, "b"), (70, "b"))]
    rows += [(100, text(35), "a"), (100, text(200), "b"), (100, text(36), None)]
    docs = spark.createDataFrame([(i, x, "en", s, len(x)) for i, x, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = storage.cut(docs, "test")
    key = lambda r: (r.doc_id is None, r.doc_id, r.source, r.text)
    whole = Counter(map(key, docs.collect()))
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert Counter(map(key, stage(spark, docs, "").collect())) == whole
    out = corpus_pipeline.mixed(spark, docs, "").collect()
    words, size, want = Counter(), Counter(), {}
    for r in out:
        words[r.source] += len(r.text.split())
        assert any(i == r.doc_id and s == r.source and x.startswith(r.text) for i, x, s in rows) and r.n_chars == len(r.text)
    for r in mixing.mix(docs).collect():
        size[r.source_size] = r.target
    for s in ("a", "b", None):
        mine = sum(len(x.split()) for _, x, t in rows if t == s)
        want[s] = size[mine]
        assert abs(words[s] - want[s]) <= 1
    assert {r.text for r in out} >= {x for i, x, s in rows if i is None and s == "b"}
    packed = corpus_pipeline.packed(spark, docs, "").groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert len(packed) == 8 and all(r.n > 0 for r in packed)


def test_null_ids_are_dealt_like_others(spark):
    docs = spark.createDataFrame([(None, f"word{i} " * (i + 1), "a") for i in range(20)] + [(1, "x " * 4000, "b")], "doc_id long, text string, source string")
    taken = lambda df: sorted((r.carried.text, r.taken) for r in mixing.mix(df, carry=("text",)).collect())
    assert taken(docs.repartition(3)) == taken(docs) and len(taken(docs)) == 21


def test_odd_rows_in_each_stage(spark):
    """Nulls in any column, empty and repeated texts, and further columns whose names clash with the stages' own."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abdeghilmnorstu") for _ in range(5)) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    kept = [(1, text(40), None, None), (2, text(50), "en", None), (3, text(60), None, "a"), (None, text(45), "en", "a")]
    odd = [(10, None, "en", "a"), (11, "", "en", "a"), (12, " \n", None, None), (13, "12 34", "en", "b"), (None, None, None, None)]
    again = [kept[1], kept[1]]
    docs = spark.createDataFrame([(i, x, lang, s, None if x is None else len(x)) for i, x, lang, s in kept + odd + again], "doc_id long, text string, lang string, source string, n_chars long")
    docs = storage.cut(docs.withColumns({c: F.lit(c) for c in ("language", "host", "declared", "c", "rep", "node", "label", "size", "taken", "carried", "tag", "spans", "kept", "bucket", "round", "_size", "_taken", "_round", "_text", "_key", "_hot", "_salt")}), "odd")
    ids = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    whole = Counter((i, x) for i, x, *_ in kept + again)
    first = corpus_pipeline.known_language(spark, docs, "")
    assert first.columns == docs.columns and ids(first) == whole
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.without_repeats):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and Counter((r.doc_id, r.text or "") for r in out.collect()) == whole + Counter((i, x or "") for i, x, *_ in odd)
        assert {r.language for r in out.collect()} == {"language"}
    out = corpus_pipeline.mixed(spark, docs, "")
    assert out.columns == docs.columns and not {10, 11, 12} & {r.doc_id for r in out.collect()}
    assert {(r._size, r._taken, r._round, r._text, r.round) for r in out.collect()} == {("_size", "_taken", "_round", "_text", "round")}
    packed = corpus_pipeline.packed(spark, docs, "").where("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in packed} == {1: 1, 2: 3, 3: 1, None: 2, 10: 1, 11: 1, 12: 1, 13: 1}


def test_stages_leave_clean_documents_and_catch_planted_ones(spark):
    rng = random.Random(21)
    text = lambda n: " ".join("".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randrange(3, 8))) for _ in range(n))
    clean = [(i, text(120)) for i in range(30)]
    passage = text(60)
    copies = [(100 + i, clean[i][1]) for i in range(5)] + [(110 + i, clean[i][1] + " end") for i in range(5)]
    planted = [(200 + i, f"{text(50)} {passage} {text(50)}") for i in range(4)]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in clean + copies + planted], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.known_language(spark, docs, "").count() == docs.count()
    near = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert {r.doc_id for r in near.collect()} == {i for i, _ in clean + planted}
    out = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, storage.cut(near, "near"), "").collect()}
    assert all(out[i] == x for i, x in clean) and passage in out[200] and all(len(out[i].split()) == 100 for i in (201, 202, 203))


def test_run_leaves_one_table(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path))
    assert corpus_pipeline.run(spark, data).count() > 0
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["stage3"]
