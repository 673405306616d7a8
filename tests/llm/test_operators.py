"""Every operator on odd rows, on empty tables and against a plain computation."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow import sources
from parcelflow.llm import (
    components,
    factorization,
    jaccard_join,
    language,
    licenses,
    line_dedup,
    mixing,
    multi_index,
    phrase_index,
    pseudonyms,
    queries,
    shards,
)
from tests_llm_rows import ODD_ROWS

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id long, embedding array<float>, rank int, score string"


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# Nearest neighbours.


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], VECTORS)


def test_nearest_is_exact_when_all_cells_are_scanned(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 7)).astype(np.float32)
    data[50:60] = data[0]
    table = vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)])
    found = multi_index.nearest(table, table.where("vec_id % 20 = 0"), k=15, centroids=8, share=1.0)
    got = defaultdict(list)
    for query, _, other in sorted(rows_of(found, "query_id", "rank", "vec_id")):
        got[query].append(other)
    exact = data.astype(np.float64)
    for query in range(0, 200, 20):
        scores = (exact * exact[query]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(200), -scores)) if i != query]
        assert got[query] == order[:15]


def test_an_id_with_two_query_vectors_has_the_nearest_of_both(spark):
    table = vectors(spark, [(1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [0.5, 0.5]), (4, [-1.0, -1.0])])
    asking = vectors(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0])])
    found = multi_index.nearest(table.union(asking), asking, k=4, centroids=2, share=1.0)
    got = sorted(rows_of(found, "query_id", "rank", "vec_id"))
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4)]


def test_share_is_small_where_vectors_are_clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 5
    clustered = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.1).astype(float)
    scattered = rng.normal(size=(4000, 16))
    shares = [
        multi_index.needed_share(multi_index.fit(v, 16), v, 20, 0.95) for v in (clustered, scattered)
    ]
    assert shares[0] < 0.15 < shares[1] <= 1.0


def test_nearest_leaves_out_unusable_vectors_and_reports_few(spark):
    nan, inf = float("nan"), float("inf")
    table = vectors(
        spark,
        [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
         (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0])],
    )
    found = multi_index.nearest(table, table, k=3)
    assert sorted(rows_of(found, "query_id", "vec_id", "rank")) == [(0, 6, 1), (6, 0, 1)]
    assert multi_index.nearest(table.limit(0), table).count() == 0


def test_nearest_reaches_its_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, np.float64) for r in table.collect()}
    found = rows_of(queries.op1_multi_index(spark, sf_dir), "query_id", "vec_id")
    ids = np.array(list(data))
    matrix = np.stack(list(data.values()))
    hits = 0
    asked = [i for i in data if i % 20 == 0]
    for query in asked:
        scores = matrix @ data[query]
        scores[ids == query] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits += len(best & {v for q, v in found if q == query})
    assert hits / (20 * len(asked)) >= 0.9


def test_cells_leave_the_heap_in_the_order_of_their_sums():
    rng = np.random.default_rng(2)
    book = multi_index.Codebook(rng.normal(size=(6, 3)), rng.normal(size=(5, 3)))
    query = rng.normal(size=6)
    sizes = {(i, j): 1 for i in range(6) for j in range(5)}
    sums = {c: query[:3] @ book.first[c[0]] + query[3:] @ book.second[c[1]] for c in sizes}
    for enough in (1, 7, 30):
        visited = multi_index.cells_in_order(book, sizes, enough, query)
        pairs = {(i, j) for i, bits in visited.items() for j in range(5) if bits >> j & 1}
        assert pairs == set(sorted(sizes, key=lambda c: -sums[c])[:enough])


# Jaccard join.


def plain_components(docs, words, percent):
    sets = {}
    for doc_id, text in docs:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        width = min(words, len(tokens))
        sets[doc_id] = {tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)} if tokens else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and percent * len(sets[a] | sets[b]) <= 100 * len(sets[a] & sets[b]):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {(i, len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_all_pairs(make_docs, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, base = [], [rng.choice(vocabulary) for _ in range(90)]
    for i in range(150):
        if i % 3:
            words = list(base if i % 2 else base[:12])
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 5, 30, 200]))]
            words += base[:40] if i % 9 == 0 else []
        docs.append((i, " ".join(words)))
    found = jaccard_join.linked_documents(make_docs(docs))
    assert set(rows_of(found, "doc_id", "n_shingles", "component_id")) == plain_components(docs, 4, 85)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    similarity = jaccard_join.Similarity()
    for _ in range(2000):
        size = int(rng.integers(1, 150))
        one = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        gone = int(rng.integers(0, max(1, size // 6) + 1))
        extra = rng.integers(0, 2**64, int(rng.integers(0, size // 6 + 1)), dtype=np.uint64)
        other = np.unique(np.concatenate([one[gone:], extra]))
        if similarity.linked(one, other):
            shared = np.intersect1d(
                jaccard_join.signatures(one, similarity), jaccard_join.signatures(other, similarity)
            )
            assert len(shared)


def test_differences_to_leaders_are_written_in_batches(spark, make_docs, monkeypatch):
    rng, similarity = random.Random(5), jaccard_join.Similarity()
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    docs = [(i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(200))) for i in range(1, 7)]
    docs += [(i, " ".join([*base[: 10 * i], f"x{i}", *base[10 * i + 1 :]])) for i in range(11, 19)]
    # Each of six leaders shares a signature with all of eight near copies, none of which is known to be one.
    rows = [(s, i, 197, 9, 100 if i < 11 else 1, i) for s in range(1, 7) for i, _ in docs if i in (s, *range(11, 19))]
    labelled = spark.createDataFrame(rows, "signature long, doc_id long, size int, members long, weight long, label long")
    real, written = jaccard_join.keep, []

    def keep(df, name, **options):
        kept = real(df, name, **options)
        if name == "places":
            written.append(kept.count())
        return kept

    monkeypatch.setattr(jaccard_join, "keep", keep)
    texts = make_docs(docs).select("doc_id", "text")
    with sources.scope(spark, "batches"):
        base_dir = sources.fresh_dir(spark, "batches")
        pairs = jaccard_join._remaining_pairs(labelled, similarity, texts, base_dir)
        found = set(rows_of(pairs, "one", "other"))
    assert found == {(a, b) for a in range(11, 19) for b in range(a + 1, 19)}
    # Eight sets are looked at by six leaders each; no batch holds most of these looks.
    assert len(written) > 1 and 2 * max(written) <= sum(written)


def test_jaccard_join_on_odd_rows(make_docs):
    found = jaccard_join.linked_documents(make_docs(ODD_ROWS))
    got = Counter(rows_of(found, "doc_id", "n_shingles", "component_id"))
    assert got[(4, 1, 4)] == 2
    assert got[(1, 0, 1)] == got[(2, 0, 2)] == got[(5, 0, 5)] == got[(None, 2, None)] == 1
    assert jaccard_join.linked_documents(make_docs([])).count() == 0


def test_an_id_with_two_texts_has_the_links_of_both(make_docs):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = make_docs([(1, one), (5, one), (5, two), (9, two + " more"), (7, "else")])
    got = set(rows_of(jaccard_join.linked_documents(docs), "doc_id", "component_id"))
    assert got == {(1, 1), (5, 1), (9, 1), (7, 7)}


def test_first_of_each_keeps_one_and_all_columns(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(9, text), (3, text + " more"), (7, "else"), (None, text), (8, ""), (8, ""), (None, None)]
    docs = make_docs([*rows, (3, text + " more"), (7, "else")]).withColumns({"__row": F.lit(1), "__gone": F.lit(2)})
    kept = jaccard_join.first_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(rows_of(kept, "doc_id", "text")) == Counter(
        [(3, text + " more"), (7, "else"), (8, ""), (8, ""), (None, None)]
    )
    without_ids = jaccard_join.first_of_each(make_docs([(None, text), (None, text), (None, text + " more")]))
    assert without_ids.count() == 1
    named = spark.createDataFrame([("b", text), ("a", text), ("c", "d")], "doc_id string, text string")
    assert {r.doc_id for r in jaccard_join.first_of_each(named).collect()} == {"a", "c"}


def test_tallies_bound_the_difference_from_below():
    rng = np.random.default_rng(6)
    for size in (1, 30, 500, 3000):
        one = np.unique(rng.integers(0, 1 << 64, size, np.uint64, endpoint=False))
        other = np.union1d(one[: size - size // 5], rng.integers(0, 1 << 64, size // 3, np.uint64))
        differ = len(np.setxor1d(one, other))
        tallies = [jaccard_join._tallies(s) for s in (one, other)]
        assert jaccard_join.least_difference(*tallies) <= differ
        assert jaccard_join.least_difference(tallies[0], tallies[0]) == 0
    crowded = np.arange(600, dtype=np.uint64)  # more than 255 in one range
    assert jaccard_join.least_difference(*[jaccard_join._tallies(s) for s in (crowded, crowded[:500])]) <= 100
    unrelated = [jaccard_join._tallies(rng.integers(0, 1 << 64, n, np.uint64)) for n in (500, 520)]
    assert jaccard_join.least_difference(*unrelated) > jaccard_join.Similarity().most_difference(500, 520)


def test_components_of_a_path_and_an_empty_graph(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (5, 5)], "one long, other long")
    labels = dict(rows_of(components.components(edges), "doc_id", "label"))
    assert labels == {**{i: 0 for i in range(1, 21)}, 31: 30}
    assert components.components(edges.limit(0)).count() == 0


# Licences.


def test_automaton_knows_exactly_the_runs_of_its_sequences():
    rng = random.Random(4)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(3)]
        automaton = licenses.Automaton(sequences)
        text = [rng.randrange(4) for _ in range(25)]
        got = automaton.runs(text, 1)
        inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        longest = [
            max((n for n in range(end + 2) if n == 0 or tuple(text[end + 1 - n : end + 1]) in inside))
            for end in range(len(text))
        ]
        want = [
            (end, n) for end, n in enumerate(longest) if n and (end + 1 == len(text) or longest[end + 1] <= n)
        ]
        assert [(end, n) for end, n, _ in got] == want
        for end, n, state in got:
            run = text[end + 1 - n : end + 1]
            places = {
                (number, i + n - 1)
                for number, s in enumerate(sequences)
                for i in range(len(s) - n + 1)
                if s[i : i + n] == run
            }
            assert set(automaton.states[state].ends) == places


def test_licences_of_whole_texts(make_docs):
    docs = make_docs(
        [
            (1, "CC BY, cc-by and All Rights  Reserved"),
            (2, "x " * 30000 + "Licensed under the Apache License, Version 2.0."),
            (3, "Permission is hereby granted, free of charge, dear reader, to any person obtaining a copy"
                " of this software and associated documentation files"),
            *ODD_ROWS[:2],
        ]
    )
    got = {r.doc_id: r for r in licenses.scan(docs.where("doc_id <> 1 OR lang IS NULL")).collect() if r.n_words}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (8, 3, 0, 5)
    assert got[1].base_labels == "cc-by,reserved" and got[1].score == 1.0
    assert got[2].labels == "apache-2.0" and got[2].n_base == 0 and got[2].first_word is None
    assert got[3].labels == "mit" and 0.6 <= got[3].score < 1
    odd = licenses.scan(make_docs(ODD_ROWS))
    assert odd.count() == len(ODD_ROWS) and odd.where("labels <> ''").count() == 0
    assert licenses.scan(make_docs([])).count() == 0
    spans = rows_of(licenses.spans(docs), "doc_id", "label", "start", "end")
    assert (2, "apache-2.0", 30000, 30007) in spans


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))
    places = [
        (start, label)
        for phrase, label in licenses.PHRASES.items()
        for start in range(len(words))
        if words[start : start + len(phrase.split())] == phrase.split()
    ]
    starts = [start for start, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_columns_equal_plain_ones(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = [
        (-1, "all rights reserved all rights reserved"), (-2, "cc, BY general public license"), (-3, None),
        (-4, "all rights-reserved \u212a cc by"), (-5, ""), (-6, "x cc by"), (-6, "x cc by"),
    ]
    both = docs.unionByName(make_docs(odd).select("doc_id", "text"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    want = sorted(((r.doc_id, *plain_base(r.text)) for r in both.collect()), key=str)
    assert sorted(rows_of(licenses.scan(both), "doc_id", *names), key=str) == want


def test_each_licence_of_the_catalogue_gets_its_own_label():
    scanner, known = licenses.Scanner(), licenses.catalogue()
    assert len(known) >= 30
    for label, texts in known.items():
        for text in texts:
            # In capitals, behind and before other words, some of which licences have.
            words = scanner.numbered(f"See the {text.upper()}\n of zebras".encode())
            assert {span.label for span in scanner.spans(words)} == {label}, (label, text)
        both = scanner.spans(scanner.numbered(f"{texts[0]} zebra {texts[-1]}".encode()))
        assert [s.label for s in both] == [label] * 2 and both[0].end < both[1].start


@pytest.mark.parametrize(
    "text, labels",
    [
        ("MIT License", {"mit"}),
        ("The BSD 3-Clause License", {"bsd-3-clause"}),
        ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}),
        ("under the GNU Lesser General Public License, version 2.1", {"lgpl-2.1"}),
        ("// SPDX-License-Identifier: MIT-0", {"mit-0"}),
        ("Creative Commons Attribution-ShareAlike 4.0 International License", {"cc-by-sa-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Licensed under CC BY 4.0 and the ISC License", {"cc-by-4.0", "isc"}),
        ("released under the old oak, licensed under the stars", set()),
        ("the software and the license of the author", set()),
        ("", set()),
    ],
)
def test_names_tags_and_clean_texts(text, labels):
    scanner = licenses.Scanner()
    assert {s.label for s in scanner.spans(scanner.numbered(text.encode()))} == labels


def test_changed_licences_and_long_texts():
    scanner, rng = licenses.Scanner(), random.Random(9)
    for label, texts in licenses.catalogue().items():
        words = texts[0].split()
        if len(words) > 60:
            changed = [w if rng.random() > 0.04 else "zebra" for w in words]
            found = scanner.spans(scanner.numbered(" ".join(changed).encode()))
            assert label in {s.label for s in found}, label
    long = "permission is hereby granted mit license of the software " * 20000
    assert {s.label for s in scanner.spans(scanner.numbered(long.encode()))} == {"mit"}
    assert licenses.Scanner({"own": ("one two three",)}).spans(np.array([], np.int32)) == []


# Pseudonyms.


def plain_feistel(high, low, highs, lows, key, kind):
    for turn in range(pseudonyms.ROUNDS):
        told = low if turn % 2 == 0 else high
        number = int(hashlib.sha256(f"{key}|{kind}|{turn}|{told}".encode()).hexdigest()[:13], 16)
        if turn % 2 == 0:
            high = (high + number) % highs
        else:
            low = (low + number) % lows
    return high, low


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_feistel_equals_the_plain_one_and_is_a_permutation(spark):
    df = spark.range(7 * 11).select((F.col("id") % 7).alias("a"), F.floor(F.col("id") / 7).alias("b"))
    new = pseudonyms.permute(F.col("a"), F.col("b"), F.lit(7), F.lit(11), "k", "test").alias("n")
    rows = rows_of(df.select("a", "b", new).select("a", "b", "n.high", "n.low"), "a", "b", "high", "low")
    assert all((h, w) == plain_feistel(a, b, 7, 11, "k", "test") for a, b, h, w in rows)
    assert len({(h, w) for *_, h, w in rows}) == 77


def test_pseudonyms_keep_formats_and_link_equal_values(make_docs):
    card, bad = "4111111111111111", "4111111111111112"
    docs = make_docs(
        [
            (1, f"card {card}, phone +1 (386) 555-3733; born 1980-02-29 or 29.02.1980."),
            (2, f"again {card}! {bad} 2021-02-30 300.1.1.1 stays"),
            (3, "mail Jo.Do@mail.example.com, ip 10.20.30.40, ssn 123-45-6789, not 666-45-6789"),
            *ODD_ROWS,
        ]
    )
    got = {r.text_before: r for r in pseudonyms.pseudonymise(docs.withColumn("text_before", F.col("text")), "k").collect()}
    one, two, three = (got[t].text for t in list(got)[:0] or [docs.collect()[i].text for i in range(3)])
    new_card = re.search(r"card (\d{16}), phone \+1 \(\d{3}\) \d{3}-\d{4}; born", one)[1]
    assert plain_luhn(new_card) and new_card != card and new_card[0] == "4" and new_card in two
    iso, (d, m, y) = re.search(r"born (\S+) or", one)[1], re.search(r"or (\d+)\.(\d+)\.(\d+)\.$", one).groups()
    assert iso == f"{y}-{m}-{d}" and iso != "1980-02-29"
    assert two.endswith(f"! {bad} 2021-02-30 300.1.1.1 stays")
    assert "Jo.Do@" not in three and "@mail.example.com" in three and "10.20.30.40" not in three
    assert "123-45-6789" not in three and three.endswith("not 666-45-6789")
    for row in ODD_ROWS:
        assert got[row[1]].text == row[1] and got[row[1]].n_private == 0
    assert pseudonyms.pseudonymise(make_docs([]), "k").count() == 0


def test_pseudonyms_take_other_spellings(make_docs):
    phones = ["(386) 555-3733", "386-555-3733", "+1 386 555 3733", "+13865553733", "386.555.3733", "1-386-555-3733"]
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "3782 822463 10005"]
    others = ["+49 30 12345678", "+44 (20) 7946-0958", "0049 30 1234567", "020 7946 0958", "01 23 45 67 89"]
    stay = ["4111 1111 1111 1112", "13/13/1980", "1980-02-30T10:00", "0012345678", "12-34-56", "v1.2.3", "1 000 000"]
    values = [*phones, *cards, *others, "12/25/1980", "12-25"]
    texts = [*values, *stay, "1980-02-29T10:00", "1980-02-29", "4111 1111 1111 1111 123", "4111 1111 1111 1111 12/27"]
    docs = make_docs([(i, f"see {t}, ok") for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in pseudonyms.pseudonymise(docs, "k").collect()}
    got = {t: found[i].text[4:-4] for i, t in enumerate(texts)}
    for value in [*values[:-1], "1980-02-29T10:00"]:
        assert got[value] != value and found[texts.index(value)].n_private == 1, value
        assert re.sub(r"\d", "0", got[value]) == re.sub(r"\d", "0", value)
    assert all(got[t] == t and found[texts.index(t)].n_private == 0 for t in stay)
    digits = {p: re.sub(r"\D", "", got[p])[-10:] for p in phones}
    assert len(set(digits.values())) == 1 and all(got[p].startswith("+1") for p in phones if p[0] == "+")
    assert got["+49 30 12345678"].startswith("+49 ") and got["0049 30 1234567"].startswith("0049 ")
    assert got["+44 (20) 7946-0958"].startswith("+44 (") and got["020 7946 0958"].startswith("0")
    plain = {c: re.sub(r"\D", "", got[c]) for c in cards}
    assert all(map(plain_luhn, plain.values())) and len({plain[c] for c in cards[:3]}) == 1
    assert got[texts[-2]] == f"{got[cards[0]]} 123" and got[texts[-1]] == f"{got[cards[0]]} 12/27"
    assert got["1980-02-29T10:00"] == got["1980-02-29"] + "T10:00"
    month, day, _ = map(int, got["12/25/1980"].split("/"))
    assert month <= 12 < day


def plain_account(value, key):
    """Account number with its digits permuted and its check digits made anew, or None."""

    def remainder(characters):
        return int("".join(str(int(c, 36)) for c in characters)) % 97

    country, body = value[:2], value[4:].replace(" ", "")
    if remainder(body + value[:4]) != 1:
        return None
    digits = re.sub(r"\D", "", body)
    left = len(digits) // 2
    right = len(digits) - left
    new = plain_feistel(int(digits[:left]), int(digits[left:]), 10**left, 10**right, key, "account")
    number = iter(f"{new[0]:0{left}d}{new[1]:0{right}d}")
    new_body = "".join(next(number) if c.isdigit() else c for c in body)
    whole = iter(f"{country}{98 - remainder(new_body + country + '00'):02d}{new_body}")
    spelled = "".join(" " if c == " " else next(whole) for c in value)
    assert remainder(spelled.replace(" ", "")[4:] + spelled[:4]) == 1
    return spelled


def test_account_numbers_equal_plain_ones(make_docs):
    # Published examples of national formats.
    known = [
        "GB82WEST12345698765432", "DE89370400440532013000", "FR1420041010050500013M02606", "BE68539007547034",
        "NO9386011117947", "CH9300762011623852957", "NL91ABNA0417164300", "MT84MALT011000012345MTLCAST001S",
    ]
    grouped = [" ".join(v[i : i + 4] for i in range(0, len(v), 4)) for v in known]
    stay = ["GB82WEST12345698765433", "DE8937040044053201300", "ZZ89370400440532013000", "DE89370400440532013000X"]
    texts = [*known, *grouped, *stay]
    docs = make_docs([(i, f"IBAN: {t} EUR 50, paid") for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in pseudonyms.pseudonymise(docs, "k").collect()}
    for i, value in enumerate(texts):
        new = found[i].text.removeprefix("IBAN: ").removesuffix(" EUR 50, paid")
        assert (new, found[i].n_private) == ((value, 0) if value in stay else (plain_account(value, "k"), 1))
    for one, other in zip(range(8), range(8, 16), strict=True):
        assert found[one].text == found[other].text.replace(" ", "").replace("IBAN:", "IBAN: ").replace("EUR50,paid", " EUR 50, paid")


def test_spaced_numbers_and_short_dates(make_docs):
    texts = [
        "123-45-6789", "123 45 6789", "1 123 45 6789", "123 45 6789 0", "666 45 6789",
        "2/3/1980", "02/03/1980", "2.03.1980", "1980-03-02", "1/31/1980", "13/13/1980", "31/2/1980",
    ]
    docs = make_docs([(i, f"see {t}; ok") for i, t in enumerate(texts)]).withColumn("__finds", F.lit("mine"))
    rows = pseudonyms.pseudonymise(docs, "k")
    assert rows.columns == [*docs.columns, "n_private"] and {r["__finds"] for r in rows.collect()} == {"mine"}
    got = {texts[r.doc_id]: r.text[4:-4] for r in rows.collect()}
    assert got["123 45 6789"] == got["123-45-6789"].replace("-", " ") != "123 45 6789"
    assert all(got[t] == t for t in ("1 123 45 6789", "123 45 6789 0", "666 45 6789", "13/13/1980", "31/2/1980"))
    year, month, day = got["1980-03-02"].split("-")
    assert got["02/03/1980"] == f"{day}/{month}/{year}" != "02/03/1980"
    assert got["2/3/1980"] == f"{int(day)}/{int(month)}/{year}" and got["2.03.1980"] == got["2/3/1980"].replace("/", ".")
    assert int(got["1/31/1980"].split("/")[1]) > 12


# Shards.


def test_shards_are_near_equal_and_keep_groups(make_docs):
    rng = random.Random(6)
    rows = [(i, "x" * rng.choice([1, 5, 50, 400]) + str(i % 90)) for i in range(400)] + [(i, t) for i, t, *_ in ODD_ROWS]
    got = shards.assign_shards(make_docs(rows), 4).collect()
    assert len(got) == len(rows)
    text_of = defaultdict(set)
    for r in got:
        text_of[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(s) == 1 for s in text_of.values())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 1 for _, t in rows)
    assert shards.assign_shards(make_docs([]), 4).count() == 0


def test_pack_gives_the_largest_to_the_least_loaded():
    assert shards.pack([5, 9, 1, 4, 5], 2) == [1, 0, 1, 0, 1]
    assert shards.pack([3, 3, 3], 2) == [0, 1, 0]


def loads_of(places, shard_count):
    return [sum(size * given[s] for size, given in places.items()) for s in range(shard_count)]


@pytest.mark.parametrize("one_by_one", [0, 3, 64])
def test_schedule_of_sizes_equals_the_heap_over_all_groups(monkeypatch, one_by_one):
    monkeypatch.setattr(shards, "ONE_BY_ONE", one_by_one)
    for seed in range(40):
        rng = random.Random(seed)
        shard_count = rng.choice([1, 2, 7, 16])
        sizes = [rng.choice([1, 2, 3, 5, 8, 40, 41, 1000]) for _ in range(rng.randrange(400))]
        loads = [0] * shard_count
        for size, shard in zip(sizes, shards.pack(sizes, shard_count), strict=True):
            loads[shard] += size
        places = shards.schedule(list(Counter(sizes).items()), shard_count)
        assert loads_of(places, shard_count) == loads
        assert {size: sum(given) for size, given in places.items()} == Counter(sizes)


def test_shards_of_rows_have_the_loads_of_the_heap(make_docs):
    rng = random.Random(9)
    rows = [(i, "y" * rng.randrange(1, 60)) for i in range(900)] + [(i, "hot" * 5) for i in range(1000, 1400)]
    got = shards.assign_shards(make_docs(rows), 5).collect()
    groups, loads = Counter(), Counter()
    for _, text in rows:
        groups[text] += len(text) + 1
    sizes = list(groups.values())
    for size, shard in zip(sizes, shards.pack(sizes, 5), strict=True):
        loads[shard] += size
    assert loads == Counter({s: sum(r["size"] for r in got if r.shard == s) for s in {r.shard for r in got}})


# Mixing.


def test_mixing_on_odd_rows_and_many_documents(make_docs):
    rows = [(i, "w " * (i % 37), "en", f"s{i % 3}" if i % 7 else None) for i in range(600)]
    got = mixing.taken_words(make_docs(rows)).collect()
    taken, target, most = Counter(), {}, {}
    for (_, _, _, source), r in zip(sorted(rows), sorted(got, key=lambda r: r.doc_id), strict=True):
        taken[source] += r.taken
        target[source], most[source] = r.target, 2 * r.source_size
        assert r.taken <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 40 and target[s] <= most[s] + 1e-6 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    mixed = mixing.mix(make_docs(rows))
    assert mixed.columns == make_docs([]).columns
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert words == sum(taken.values())
    assert mixing.taken_words(make_docs(ODD_ROWS)).count() == len(ODD_ROWS)
    assert mixing.mix(make_docs([])).count() == 0 and mixing.taken_words(make_docs([])).count() == 0


# Lines.


def test_lines_of_first_policy_and_odd_rows(make_docs):
    rows = [(i, f"Head\n own {i}\n\thead \nlast{i % 2}") for i in range(6)] + list(ODD_ROWS)
    none = {r.doc_id: r for r in line_dedup.without_shared_lines(make_docs(rows[:6]), min_docs=4).collect()}
    assert none[3].text == " own 3\nlast1" and none[3].n_dropped == 2 and none[3].n_lines == 4
    first = {
        r.doc_id: r.text
        for r in line_dedup.without_shared_lines(make_docs(rows[:6]), min_docs=4, policy="first").collect()
    }
    assert first[0] == "Head\n own 0\nlast0" and first[1] == " own 1\nlast1"
    odd = line_dedup.without_shared_lines(make_docs(ODD_ROWS), min_docs=1).collect()
    assert len(odd) == len(ODD_ROWS)
    assert {(r.n_lines, r.n_dropped, r.text) for r in odd if r.doc_id in (1, 2)} == {(1, 0, "")}
    assert all(r.text == "" for r in odd if r.doc_id == 4)
    assert line_dedup.without_shared_lines(make_docs([])).count() == 0


def test_bitmaps_of_more_than_64_lines(make_docs):
    lines = [f"line {i}" for i in range(150)]
    docs = make_docs([(i, "\n".join(lines[:149] + [f"own {i}"])) for i in range(3)])
    kept = line_dedup.without_shared_lines(docs, min_docs=3).collect()
    assert {r.text for r in kept} == {"own 0", "own 1", "own 2"} and {r.n_dropped for r in kept} == {149}


# Benchmark passages.


def test_passages_on_odd_rows_and_short_items(make_docs, spark):
    items = spark.createDataFrame(
        [(1, "alpha beta"), (2, None), (3, "..."), (None, "one two three"), (4, " ".join(f"q{i}" for i in range(14)))],
        "item_id long, text string",
    )
    rows = [*ODD_ROWS, (20, "x Alpha-BETA alpha beta!"), (21, " ".join(f"q{i}" for i in range(2, 13)))]
    got = {r.doc_id: r for r in phrase_index.contamination(make_docs(rows), items, 10).collect()}
    assert (got[20].n_words, got[20].n_hit, got[20].n_items) == (5, 4, 1)
    assert got[20].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert (got[21].n_hit, got[21].contaminated) == (11, True)
    assert not any(got[i].contaminated for i in (1, 2, 3, 4, 5, 6)) and got[1].n_words == 0
    near = phrase_index.proximity_matches(
        make_docs([(1, "q0 q1 q2 um q3 q4 q5 q6 q7 q8 q9 q10 q11 q12 q13")]), items, anchors=3, slop=2
    )
    assert {r.item_id for r in near.collect()} == {"4"}
    assert phrase_index.contamination(make_docs(rows), items.limit(0)).where("contaminated").count() == 0
    assert phrase_index.contamination(make_docs([]), items).count() == 0


@pytest.mark.parametrize("anchors", [1, 2, 3])
def test_repeated_rows_have_equal_passages(make_docs, spark, anchors):
    items = spark.createDataFrame([(7, " ".join(f"q{i}" for i in range(12)))], "item_id long, text string")
    whole, half = " ".join(f"q{i}" for i in range(1, 12)), "q0 q1 q2 q3"
    rows = [(1, whole), (1, whole), (1, half), (None, whole), (None, whole), (2, half), (2, half), (3, whole)]
    found = phrase_index.phrase_matches(make_docs(rows), items, 10, anchors)
    assert sorted(rows_of(found, "doc_id", "start", "end"), key=str) == [(1, 0, 11), (3, 0, 11), (None, 0, 11)]
    got = Counter(rows_of(phrase_index.contamination(make_docs(rows), items, 10), "doc_id", "n_hit", "n_items"))
    assert got == {(1, 11, 1): 2, (1, 0, 0): 1, (None, 11, 1): 2, (2, 0, 0): 2, (3, 11, 1): 1}


# Classifiers.


def held_out(rows, parts, rest):
    return [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % parts == rest]


def test_language_of_held_out_documents(spark, sf_dir, make_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in queries.op10_language(spark, sf_dir).collect()}
    rest = held_out(docs.select("doc_id", "lang").collect(), 5, 0)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in rest]) >= 0.9
    assert all(got[r.doc_id].held_out for r in rest) and all(0 <= r.score <= 1 for r in got.values())
    network = language.learn(make_docs(ODD_ROWS), steps=3)
    odd = language.identify(make_docs(ODD_ROWS), network).collect()
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {1, 2, 5, 6} and len(odd) == len(ODD_ROWS)
    assert language.learn(make_docs([])) is None
    assert {r.lang_pred for r in language.identify(make_docs(ODD_ROWS), None).collect()} == {"und"}


def test_network_gradients_equal_differences():
    rng = np.random.default_rng(8)
    weights = [rng.normal(0, 0.3, s) for s in ((6, 256), (6, 2), (6, 256), (6, 2), (3, 4), (3, 1))]
    windows, lengths = rng.integers(0, 256, (7, 4)), np.array([7, 3, 7, 5])
    labels = np.array([0, 2, 1, 2])

    def loss():
        network = language.Network(
            ["a", "b", "c"], language.Direction(*weights[:2]), language.Direction(*weights[2:4]), *weights[4:]
        )
        inside = (np.arange(7)[:, None] < lengths).astype(np.float64)
        labeller = language.Labeller(network)
        ahead = labeller._states(0, windows, inside, range(7))
        back = labeller._states(1, windows, inside, range(7)[::-1])
        scores = np.matmul(weights[4], np.concatenate([ahead, back], axis=1)) + weights[5]
        scores = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return -(scores[:, labels, np.arange(4)] * inside).sum() / inside.sum()

    gradients = language._gradients(weights, windows, lengths, labels)
    for weight, gradient in zip(weights, gradients, strict=True):
        spot = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = weight[spot]
        weight[spot] = before + 1e-2
        up = loss()
        weight[spot] = before - 1e-2
        down = loss()
        weight[spot] = before
        assert gradient[spot] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4)


def test_toxicity_learns_pairs_and_takes_odd_rows(make_docs, spark):
    rng = random.Random(9)
    fill = [f"f{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(900):
        words, kind = rng.sample(fill, 8), i % 4
        words += [["calm"], ["insult"], ["group"], ["insult", "group"]][kind]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == 3), "en"))
    table = spark.createDataFrame([*labels, (None, 1, "x"), (7, None, "x")], "doc_id long, toxic int, lang string")
    machine = factorization.learn(make_docs(rows), table, rounds=40)
    got = {r.doc_id: r.score for r in factorization.score(make_docs(rows + list(ODD_ROWS)), machine).collect()}
    wrong = sum((got[i] >= 0.5) != bool(toxic) for i, toxic, _ in labels if i > 10)
    assert wrong <= 20 and all(0 <= s <= 1 for s in got.values())
    assert factorization.learn(make_docs(rows), table.limit(0)) is None
    assert factorization.score(make_docs([]), machine).count() == 0


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op9_toxicity(spark, folder).collect()}
    rest = held_out(spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL").collect(), 4, 2)
    toxic = [got[r.doc_id].score for r in rest if r.toxic == 1]
    clean = [got[r.doc_id].score for r in rest if r.toxic == 0]
    assert np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean]) > 0.7
    assert not any(s >= 0.3 for s in clean)


def test_proximity_matches_equal_plain_ones(make_docs, spark):
    rng = random.Random(12)
    items = spark.createDataFrame(
        [(i, " ".join(rng.choices("abcdef", k=rng.randrange(1, 12)))) for i in range(12)] + [(99, None)],
        "item_id long, text string",
    )
    rows = [(i, " ".join(rng.choices("abcdefg", k=rng.randrange(0, 60)))) for i in range(60)]
    rows += [(70, "a b c"), (70, "a b c"), (None, "a b c d e f a b"), (71, None)]
    slop, length = 2, 5
    plain = defaultdict(set)
    for item in items.collect():
        words = (item.text or "").split()
        for at in range(max(1, len(words) - length + 1) if words else 0):
            window = words[at : at + length]
            for number, (_, text) in enumerate(rows):
                own = (text or "").split()
                for start in range(len(own)):
                    rest = iter(own[start : start + len(window) + slop])
                    if own[start] == window[0] and all(w in rest for w in window):
                        plain[number].add(item.item_id)
    got = phrase_index.contamination(make_docs(rows), items, length, slop=slop)
    want = sorted(((key, len(plain[number])) for number, (key, _) in enumerate(rows)), key=str)
    assert sorted(rows_of(got, "doc_id", "n_near"), key=str) == want
    exact = phrase_index.contamination(make_docs(rows), items, length)
    names = ("doc_id", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(rows_of(exact, *names), key=str) == sorted(rows_of(got, *names), key=str)
    assert exact.where("n_near <> n_items").count() == 0 and got.where("n_near > n_items").count() > 5
