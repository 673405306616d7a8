"""Spelling variants, quality and conversation repair against plain computations."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import pytest

from parcelflow.llm import quality, queries, repair, spelling
from tests_llm_rows import ODD_ROWS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TURNS = "conv_id long, turn long, role string, text string, fate string, place string, first string"


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# Spelling variants.


def plain_counts(docs, one_in=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_length}


def is_one_edit(one, other):
    if len(one) == len(other):
        return sum(a != b for a, b in zip(one, other)) == 1
    short, long = sorted((one, other), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    near = defaultdict(list)
    words = sorted(counts)
    by_length = defaultdict(list)
    for word in words:
        by_length[len(word)].append(word)
    for word in words:
        for other in by_length[len(word)] + by_length[len(word) + 1]:
            if (len(other) > len(word) or other > word) and is_one_edit(word, other):
                near[word].append(other)
                near[other].append(word)
    form = {}
    for word in words:
        if near[word]:
            best = min(near[word], key=lambda w: (-counts[w], w))
            if counts[best] >= 2 * counts[word]:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted(
        (w, form.get(w), root(w), counts[w], len(near[w]), counts.get(form.get(w))) for w in words
    )


def found_variants(words, **options):
    return sorted(rows_of(spelling.variants(words, **options), "word", "form", "root", "n", "n_near", "form_n"))


@pytest.mark.parametrize("block", [1, 4, 1024])
def test_variants_equal_all_pairs(spark, block):
    rng = random.Random(block)
    counts = {}
    for _ in range(400):
        counts["".join(rng.choice("abé") for _ in range(rng.randint(5, 8)))] = rng.randint(3, 200)
    counts |= {"a" * n: 3 * n for n in range(5, 12)} | {"x" * 3000 + tail: 9 for tail in ("", "y", "yz")}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found_variants(words, block=block) == plain_variants(counts)


def test_variants_of_documents_equal_a_plain_computation(spark, make_docs):
    rng = random.Random(3)
    syllables = ["Wort", "wort", "Été", "ing", "schen", "té", "中", "œ", "-", "7", "×"]
    docs = [
        (i, " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(120))) for i in range(40)
    ]
    docs += [(None, docs[0][1]), (7, docs[7][1]), (8, None), (9, "")]
    counted = spelling.counted_words(make_docs(docs), one_in=7)
    counts = plain_counts(docs, one_in=7)
    assert dict(rows_of(counted, "word", "n")) == counts
    assert found_variants(counted) == plain_variants(counts)


def test_spelling_query_equals_a_plain_computation(spark, sf_dir):
    docs = rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    found = queries.QUERIES["op11_spelling"](spark, sf_dir)
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(rows_of(found, *columns)) == plain_variants(plain_counts(docs))


def test_spelling_takes_odd_rows_and_empty_tables(spark, make_docs):
    found = dict(rows_of(spelling.counted_words(make_docs(ODD_ROWS)), "word", "n"))
    assert found == plain_counts([row[:2] for row in ODD_ROWS])
    assert spelling.variants(spelling.counted_words(make_docs([]))).count() == 0


# Quality.


def plain_terms(text):
    """Terms of a text as strings; repeats are marked apart."""
    words = [b" " + w + b" " for w in re.split(rb"[\x20\x09-\x0d]+", text) if w]
    terms = Counter(words)
    terms.update((b"again", a == b) for a, b in zip(words, words[1:]))
    for word in words:
        for size in quality.PARTS:
            terms.update(word[i : i + size] for i in range(len(word) - size + 1) if word[i : i + size] != word)
    return terms


def test_terms_equal_plain_ones():
    texts = [b"", b"one two two\ttwo", "déjà vu 中文".encode(), b"  x  ", b"a" * 50 + b" b"]
    found = [Counter() for _ in texts]
    for owner, bucket in quality.features(texts):
        for o, b in zip(owner.tolist(), bucket.tolist()):
            found[o][b] += 1
    for text, got in zip(texts, found):
        plain = plain_terms(text)
        assert sum(got.values()) == sum(plain.values())
        # Buckets depend on the term alone, whatever stands around it.
        alone = Counter()
        for _, bucket in quality.features([text]):
            alone.update(bucket.tolist())
        assert got == alone and len(got) == len(plain)


def test_long_texts_are_taken_in_pieces(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(500))
    whole = sum(len(b) for _, b in quality.features([text, text]))
    monkeypatch.setattr(quality, "PIECE_BYTES", 100)
    cut = list(quality.features([text, text]))
    pieces = sum(1 for _ in quality._pieces(text))
    assert pieces > 10 and sum(len(b) for _, b in cut) == whole - 2 * (pieces - 1)


def test_scores_are_a_softmax_of_means():
    rng = np.random.default_rng(2)
    model = quality.Classifier(
        rng.normal(size=(1 << quality.BUCKET_BITS, 3)).astype(np.float32), rng.normal(size=(3, 2)), rng.normal(size=2), 0.8
    )
    texts = [b"some words here", b"", b"other other words"]
    scores = model.scores(texts)
    for text, score in zip(texts, scores):
        buckets = [b for _, part in quality.features([text]) for b in part.tolist()]
        if not buckets:
            assert score == 0.8
            continue
        z = np.mean([model.vectors[b].astype(float) for b in buckets], axis=0) @ model.output + model.bias
        assert score == pytest.approx(1 / (1 + np.exp(z[0] - z[1])))


def test_quality_is_learned(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = queries.QUERIES["op12_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out")
    rows = rows_of(scored, "score", "quality", "predicted")
    better, worse = ([s for s, q, _ in rows if q == c] for c in (1, 0))
    assert sum(a > b for a in better for b in worse) >= 0.97 * len(better) * len(worse)
    assert sum(p == q for _, q, p in rows) >= 0.95 * len(rows)


def test_quality_takes_odd_rows_and_few_labels(spark, make_docs):
    labels = spark.createDataFrame(
        [(3, 1), (4, 0), (None, 1), (5, None), (99, 0)], "doc_id long, quality int"
    )
    docs = make_docs(ODD_ROWS)
    scores = rows_of(quality.score(docs, quality.learn(docs, labels)), "doc_id", "score")
    assert len(scores) == len(ODD_ROWS) and all(0 <= s <= 1 for _, s in scores)
    assert len({s for i, s in scores if i == 4}) == 1
    assert [s for i, s in scores if i in (1, 2, 5)] == pytest.approx([1 / 3] * 3)
    one_class = quality.learn(docs, labels.where("quality = 1"))
    ones = [s for _, s in rows_of(quality.score(docs, one_class), "doc_id", "score")]
    assert ones == pytest.approx([1] * len(ODD_ROWS), abs=0.002)
    nothing = quality.learn(docs, labels.where("quality > 1"))
    assert {s for _, s in rows_of(quality.score(docs, nothing), "doc_id", "score")} == {0.0}
    assert quality.score(make_docs([]), one_class).count() == 0


# Conversation repair.


def plain_damage(rows):
    damaged = []
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fate = crc32(name.encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        damaged += [(conv_id, turn, role, text)] * (2 if fate == 3 else 1)
    return damaged


def plain_repair(rows):
    """Figures of one conversation, with the least pair of cost and audit by plain recursion."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)[-1:]
        if not last:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if last in ".!?" else "truncated")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(place, state, inserts):
        options = []
        if place == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 3:
            for role in follows[state]:
                if role != "s":
                    cost, audit, turns = best(place, role, inserts + 1)
                    options.append((cost + 3, "I" + audit, (names[role] + ":", *turns)))
        if place < len(rows):
            _, _, own, text = rows[place]
            cost, audit, turns = best(place + 1, state, 0)
            options.append((cost + 4, "D" + audit, turns))
            if faults[place] not in ("blank", "duplicate"):
                more = 3 if faults[place] == "truncated" else 0
                for role in follows[state]:
                    if own[:1] == role:
                        cost, audit, turns = best(place + 1, role, 0)
                        options.append((cost + more, "K" + audit, (f"{own}:{text}", *turns)))
                    if role != "s":
                        cost, audit, turns = best(place + 1, role, 0)
                        options.append((cost + more + 3, "R" + audit, (f"{names[role]}:{text}", *turns)))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    for place in range(len(rows), 0, -1):  # from the end, so that recursion stays flat
        for state in follows:
            best(place, state, 0)
    cost, audit, turns = best(0, "", 0)
    numbers = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(turns).encode()).hexdigest(),
    )


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_table(rows, damaged):
    by_id = {row[0]: [] for row in rows}
    for row in damaged:
        by_id[row[0]].append(row)
    return {conv_id: plain_repair(own) for conv_id, own in by_id.items()}


def random_turns(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "u", None, ""]
    texts = ["Yes.", "No!", "why", "", " \t", None, "Sure? ", "a\nb.", "café"]
    rows = []
    for conv_id in [*range(60), None]:
        for turn in range(rng.randint(1, 14)):
            number = rng.choice([turn, turn, turn, turn + 5, None]) if conv_id != 3 else None
            weights = (8, 8, 2, 1, 1, 1, 1)
            rows.append((conv_id, number, rng.choices(roles, weights)[0], rng.choices(texts, (9, 5, 3, 1, 1, 1, 2, 2, 1))[0]))
    return rows + rows[:20]


@pytest.mark.parametrize("piece_bits", [0, 1, 2, 12])
def test_repair_equals_plain_recursion(spark, piece_bits):
    rows = random_turns(piece_bits)
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    found = repair.repair(repair.damaged(table), table, piece_bits)
    plain = plain_table(rows, plain_damage(rows))
    assert {r[0]: r[1:] for r in rows_of(found, "conv_id", *FIGURES)} == plain
    assert found.count() == len(plain)


def test_repair_query_equals_plain_recursion(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = rows_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "turn", "role", "text")
    found = rows_of(queries.QUERIES["op13_repair"](spark, sf_dir), "conv_id", *FIGURES)
    assert {r[0]: r[1:] for r in found} == plain_table(rows, plain_damage(rows))


def test_repair_of_one_long_conversation_in_pieces(spark):
    """Thousands of turns of one conversation, and thousands of equal ones."""
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"turn {i}{rng.choice(['.', ''])}") for i in range(700)]
    rows += [(2, 4, "user", "Again.")] * 300 + [(2, 5, "assistant", "Yes.")]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    found = {r[0]: r[1:] for r in rows_of(repair.repair(table, piece_bits=4), "conv_id", *FIGURES)}
    assert found == plain_table(rows, rows)


def test_repair_takes_empty_tables_and_lost_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.repair(empty).count() == 0
    one = spark.createDataFrame([(7, 1, "user", "Hello.", "x", "y", "z")], TURNS)
    (row,) = rows_of(repair.repair(one.where("turn > 1"), one), "conv_id", *FIGURES)
    assert row == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
