"""Queries of this package against their SQL, and the pipeline's stages."""

import random
from collections import Counter
from pathlib import Path

import __spark_entry__ as registry
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from compare import differences

from parcelflow.llm import language, queries
from parcelflow.sources import shared_dir

TABLES = ("documents", "benchmark")


@pytest.fixture(scope="module")
def corpus(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, corpus, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), corpus.sql(queries.SQL[name])) == ([], [])


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in registry.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in registry.queries()


def test_stages_keep_the_columns_and_their_decisions(spark, sf_dir, make_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert name == "sharding" or docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] and counts[5] == counts[4]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), sf_dir).count() == 0


def test_language_stage_rejects_what_is_like_no_learned_language(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(8)
    strange = [
        "Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше в лес. " * 3,
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 3,
        " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=7)) for _ in range(60)),
        "def compute(xs):\n    for x in xs:\n        if x % 2:\n            yield lambda y: y ** x\nimport numpy\n" * 5,
        "12345 67890 !!",
    ]
    rows = make_docs([(10**6 + i, text) for i, text in enumerate(strange)])
    both = docs.unionByName(rows.select(*docs.columns[:4]), allowMissingColumns=True)
    kept = corpus_pipeline.known_language(spark, both, "")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & set(range(10**6, 10**6 + len(strange)))
    assert len(ids) >= 0.99 * docs.count()


def test_known_runs_are_counted_over_all_documents(spark, make_docs):
    rng = random.Random(3)
    common = ["alpha", "bravo", "delta", "gamma", "kappa"]
    marks = {place: "".join(rng.choices("jqxz", k=3)) for place in range(0, 990, 11)}
    texts = []
    for place in range(1000):
        # Three documents in a row share a mark, and one in five hundred a rarer one.
        mark = next((m for start, m in marks.items() if start <= place < start + 3), "")
        texts.append(" ".join([*rng.choices(common, k=6), mark, "wvw" if place in (5, 505) else ""]))
    rows = [(place, text, "en", "a") for place, text in enumerate(texts)]
    got = language.learn_familiar(make_docs(rows))
    in_documents = Counter(run for text in texts for run in set(language._runs(text).tolist()))
    known = np.flatnonzero(np.unpackbits(got.bits)).tolist()
    assert known == sorted(run for run, n in in_documents.items() if n * 400 >= 1000)
    assert language._runs("wvw")[0] not in known and language._runs(marks[0])[0] in known
    assert language.learn_familiar(make_docs([])) is None


def made_texts(rng, letters, count, words=60):
    """Texts from a vocabulary of their own."""
    known = ["".join(rng.choices(letters, k=5)) for _ in range(40)]
    return [" ".join(rng.choices(known, k=words)) for _ in range(count)]


def test_language_stage_rejects_texts_unlike_the_language_they_are_taken_for(spark, make_docs):
    rng = random.Random(5)
    first, second = made_texts(rng, "abcdefghijkl", 130), made_texts(rng, "mnopqrstuvwx", 130)
    rows = [(i, text, lang, "a") for lang, texts in (("aa", first), ("bb", second)) for i, text in enumerate(texts[:120])]
    rows = [(place, *row[1:]) for place, row in enumerate(rows)]
    clean = {10**6 + i: text for i, text in enumerate(first[120:] + second[120:])}
    # Every run of these is known, but half of them of the other language; a label does not help.
    mixed = {2 * 10**6 + i: f"{a} {b}" for i, (a, b) in enumerate(zip(first[120:], second[120:], strict=True))}
    rows += [(key, text, None, "a") for key, text in (clean | mixed).items()]
    rows.append((3 * 10**6, f"{second[125]} {first[125]}", "aa", "a"))
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, make_docs(rows), "").collect()}
    assert not kept & {*mixed, 3 * 10**6}
    assert kept >= set(clean) and len(kept & set(range(240))) >= 236


def test_runs_are_held_against_the_language_told(spark, make_docs):
    rng = random.Random(6)
    texts = {"aa": made_texts(rng, "abcdefgh", 30), "bb": made_texts(rng, "stuvwxyz", 50)}
    rows = [(i, text, lang, "a") for lang in texts for i, text in enumerate(texts[lang])]
    familiar = language.learn_familiar(make_docs(rows))
    for lang, own in texts.items():
        assert sorted(familiar.own_runs[lang]) == sorted({r for t in own for r in language._runs(t).tolist()})
    docs = make_docs([(1, texts["aa"][0]), (2, texts["bb"][0]), (3, "jkqv " * 30), (4, None), (5, "...")])
    zeros = language.Direction(np.zeros((6, 256), np.float32), np.zeros((6, 2), np.float32))
    for lang, strange in (("aa", {2, 3}), ("bb", {1, 3}), ("zz", {3})):
        # A network that takes every text for one language.
        network = language.Network([lang], zeros, zeros, np.zeros((1, 4), np.float32), np.zeros((1, 1), np.float32))
        told = language.identify(docs, network, familiar, also=["source"])
        assert told.columns == ["doc_id", "lang_pred", "score", "share", "own_share", "source"]
        assert {r.doc_id for r in told.where(language.unfamiliar(told, familiar)).collect()} == strange
        assert told.where(language.unfamiliar(told, None)).count() == 0


def test_scores_are_held_against_those_of_the_language_told(spark):
    rows = [(i, "aa", "aa", 0.9) for i in range(1000)] + [(i, "bb", "bb", 0.6) for i in range(1000)]
    # Neither wrong labels nor missing ones move a bound.
    rows += [(-1, "aa", "aa", 0.8), (-2, "aa", None, 0.86), (-3, "bb", None, 0.56), (-4, "bb", "aa", 0.5), (-5, "und", "und", 0.0)]
    rows += [(-6, "cc", None, 0.1), (-7, "und", None, 0.0)] + [(-4, "bb", "aa", 0.5)] * 50
    told = spark.createDataFrame(rows, "doc_id long, lang_pred string, lang string, score double")
    assert {r.doc_id for r in told.where(language.doubtful(told)).collect()} == {-1, -4}
    assert told.where("doc_id < -5").where(language.doubtful(told.limit(0))).count() == 0


def test_pipeline_leaves_one_table(spark, sf_dir):
    before = set(Path(shared_dir(spark)).iterdir())
    result = corpus_pipeline.run(spark, sf_dir)
    assert len(set(Path(shared_dir(spark)).iterdir()) - before) == 1
    assert result.count() > 0


def test_benchmark_stage_rejects_repeated_rows(spark, sf_dir, make_docs):
    passage = next(
        r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r.text.split()) > 12
    )
    docs = make_docs([(1, passage), (1, passage), (None, passage), (None, passage), (2, "clean"), (2, "clean")])
    kept = corpus_pipeline.without_benchmark(spark, docs, sf_dir)
    assert [(r.doc_id, r.text) for r in kept.collect()] == [(2, "clean")] * 2
