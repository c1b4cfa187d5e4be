"""Source divergence, vector codes and toxicity against plain loops, and on odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import codes, divergence, toxicity
from meterline.llm.transducer import Arcs, Transducer, build

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {code: code + 32 for code in range(65, 91)}


# ---- transducer


def test_transducer_gives_ordinals_and_is_minimal():
    random = np.random.default_rng(1)
    terms = sorted({bytes(random.choice(list(b"abc\xc3\xa9"), size)) for size in random.integers(1, 9, 2000)})
    arcs = Arcs.load(build(terms).dump())
    asked = terms + [bytes(random.choice(list(b"abcd\xc3\xa9"), size)) for size in random.integers(1, 12, 5000)]
    ends = np.cumsum([len(term) for term in asked])
    starts = ends - [len(term) for term in asked]
    place = {term: at for at, term in enumerate(terms)}
    found = Transducer(arcs).ordinals(np.frombuffer(b"".join(asked), np.uint8), starts, ends)
    assert found.tolist() == [place.get(term, -1) for term in asked]
    # As many states as there are different sets of endings.
    endings = {}
    for term in terms:
        for cut in range(len(term) + 1):
            endings.setdefault(term[:cut], set()).add(term[cut:])
    assert len(arcs.final) == len({frozenset(rest) for rest in endings.values()})


def test_transducer_of_one_and_of_very_long_terms():
    terms = [b"a" * 50_000, b"a" * 50_000 + b"b"]
    transducer = Transducer(build(terms))
    data = np.frombuffer(terms[1] + b"c", np.uint8)
    starts, ends = np.array([0, 0, 0, 1]), np.array([50_000, 50_001, 50_002, 50_000])
    assert transducer.ordinals(data, starts, ends).tolist() == [0, 1, -1, -1]


# ---- source divergence


def brute_audit(rows, min_docs, ranks):
    """By the contract's own words; rows of doc_id, text, lang and source."""
    rows = [(doc_id, *[value or "" for value in rest]) for doc_id, *rest in rows]
    holders, counts, groups = {}, Counter(), {(lang, source) for _, _, lang, source in rows}
    for doc_id, text, lang, source in rows:
        for term in TERM.findall(text.translate(UPPER)):
            holders.setdefault((lang, term), set()).add(doc_id)
            counts[lang, source, term] += 1
    kept = {}
    for (lang, term), ids in holders.items():
        if len(ids) >= min_docs:
            kept.setdefault(lang, []).append(term)

    def shares(lang, count):
        terms = kept.get(lang, [])
        total = sum(count(term) for term in terms)
        return {term: 1 + 1_000_000_000 * (count(term) + 2) // (total + 2 * len(terms)) for term in terms}

    p = {(lang, source): shares(lang, lambda term: counts[lang, source, term]) for lang, source in groups}
    langs = {lang for lang, _ in groups}
    q = {lang: shares(lang, lambda term: sum(counts[lang, s, term] for own, s in groups if own == lang)) for lang in langs}
    far = lambda x, y: (x - y) ** 2 // (x + y)
    result = []
    for lang, source in groups:
        pair = [
            (-sum(far(p[lang, source][t], p[lang, other][t]) for t in kept.get(lang, [])), other)
            for own, other in groups
            if own == lang and other != source
        ]
        term = [
            (-far(p[lang, source][t], q[lang][t]), t)
            for t in kept.get(lang, [])
            if counts[lang, source, t] and p[lang, source][t] > q[lang][t]
        ]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda row: (row[0], row[1].encode()))
            shown = found if part == "pair" else found[:ranks]
            result += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(shown, 1)]
    return sorted(result)


@pytest.mark.parametrize("limits", [{}, {"shard_terms": 3, "held_bytes": 1}])
def test_divergence_equals_brute_force(spark, limits):
    random = np.random.default_rng(5)
    words = ["The", "the", "naïve", "ÉTÉ", "été", "Zz", "a", "ab", "abc", "abcdefgh", "abcdefghi", "abcdefghj", "日本語", "x"]
    rows = [
        (i, " ,".join(random.choice(words, random.integers(0, 40))), "en", f"s{i % 3}") for i in range(40)
    ]
    rows += [(100 + i, "mot_mot 1mot2 rare" + str(i), "fr", ["s0", None, ""][i % 3]) for i in range(9)]
    # Repeated rows and null ids are one document each, so these terms stay below the least count.
    rows += [(200, "often often", None, "s0")] * 12 + [(None, "nowhere", None, "s1")] * 12
    rows += [(300, None, "de", "s0"), (301, "", "de", "s1"), (302, "einzig", "es", "only")]
    rows += [(400 + i, "w" * 70_000 + " short", "xx", f"s{i % 2}") for i in range(4)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    clashing = given.withColumns({name: F.lit(1) for name in ("term", "ordinal", "n", "p", "rank", "again", "shard")})
    found = divergence.audit(clashing, min_docs=4, ranks=5, **limits)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, 4, 5)


def test_divergence_of_many_sources_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 4)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 3)
    random = np.random.default_rng(6)
    words = [f"w{chr(97 + i)}" for i in range(10)]
    rows = [(i, " ".join(random.choice(words, 8)), "en", f"s{i % 11}") for i in range(60)]
    schema = "doc_id long, text string, lang string, source string"
    found = divergence.audit(spark.createDataFrame(rows, schema), min_docs=2)
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, 2, 10)
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []


# ---- vector codes


def test_products_of_limbs_are_exact():
    random = np.random.default_rng(2)
    for size, width, bits in ((1 << 10, 16, None), (1 << 28, 16, None), (1 << 28, 7, 5), (1, 3, None)):
        left, right = random.integers(-size, size + 1, (20, width)), random.integers(-size, size + 1, (30, width))
        left[0], right[0] = -size, size
        expected = [[sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for b in right] for a in left]
        assert codes.products(left, right, bits).tolist() == expected
    assert 16 * (1 << codes.limb_bits(16)) ** 2 <= 1 << 53
    assert len(codes.limbs(np.array([[1 << 30]]), codes.limb_bits(16))) == 2


def brute_codes(rows, entries, rounds, parts=4):
    """(vec_id, code, error) and the codebooks in plain integers; rows in the order of ids and vectors."""
    vectors = [[int(np.floor(np.float64(x) * 1024)) for x in vector] for _, vector, _ in rows]
    width = -(-len(vectors[0]) // parts)
    vectors = [vector + [0] * (parts * width - len(vector)) for vector in vectors]
    cut = [[vector[at * width : (at + 1) * width] for vector in vectors] for at in range(parts)]
    books = [[list(point) for point in points[:entries]] for points in cut]

    def assigned(at):
        result = []
        for point in cut[at]:
            apart = [sum((x - y) ** 2 for x, y in zip(point, entry, strict=True)) for entry in books[at]]
            result.append((apart.index(min(apart)), min(apart)))
        return result

    for _ in range(rounds):
        for at in range(parts):
            near = assigned(at)
            for entry in range(len(books[at])):
                own = [point for point, (place, _) in zip(cut[at], near, strict=True) if place == entry]
                if own:
                    books[at][entry] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    near = [assigned(at) for at in range(parts)]
    coded = [
        (row[0], "".join(f"{near[at][i][0]:02x}" for at in range(parts)), sum(near[at][i][1] for at in range(parts)))
        for i, row in enumerate(rows)
    ]
    return coded, books


@pytest.mark.parametrize("size", [12, 10])
def test_vector_codes_equal_brute_force(spark, size):
    random = np.random.default_rng(3)
    good = [(i, random.normal(0, 1, size).astype(np.float32).tolist(), i % 3 or None) for i in range(60)]
    # Equal vectors, a large one that takes several limbs, a repeated id and one without an id.
    good += [(60, good[0][1], 7), (61, [50_000.5] * size, 7), (62, [0.0] * size, 7), (62, [1.0] * size, 7), (None, [-0.25] * size, 1)]
    nan, inf = float("nan"), float("inf")
    bad = [(70, None, 1), (71, [], 1), (72, [None] * size, 1), (73, [nan] * size, 1), (74, [0.0] * (size - 1) + [-inf], 1)]
    bad += [(75, [1.0] * (size + 4), 1), (76, [3e38] * size, 1)]
    given = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").repartition(4)
    clashing = given.withColumns({"code": F.lit("x"), "error": F.lit(1), "slot": F.lit(1), "_label": F.lit(2)})
    coded, books = codes.compress(clashing, entries=20, rounds=3)
    expected, expected_books = brute_codes(good, 20, 3)
    key = lambda row: (row[0] is None, row[0] or 0, *row[1:])
    held = [tuple(row) for row in coded.select("vec_id", "code", "error").collect()]
    assert sorted(held, key=key) == sorted(expected, key=key)
    assert books.entries.tolist() == expected_books
    decoded = {row["vec_id"]: row for row in codes.decode(coded, books).filter("vec_id < 60").collect()}
    for vec_id, code, error in expected[:60]:
        flat = [x for at in range(4) for x in expected_books[at][int(code[2 * at : 2 * at + 2], 16)]][:size]
        assert decoded[vec_id]["decoded"] == [x / 1024 for x in flat]
    sums = Counter()
    for (_, _, error), (_, _, label) in zip(expected, good, strict=True):
        sums[label] += error
    told = codes.digests(coded, books).select("vec_id", "error", "label_error").collect()
    label_of = {(row[0], error): row[2] for row, (_, _, error) in zip(good, expected, strict=True)}
    assert all(row["label_error"] == sums[label_of[row["vec_id"], row["error"]]] for row in told)


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1), (2, [], 1)]):
        assert codes.digests(*codes.compress(spark.createDataFrame(rows, schema))).collect() == []


# ---- toxicity


def drawn_network(random):
    width = toxicity.DIMENSIONS
    return toxicity.Network(
        random.normal(0, 1, (toxicity.BUCKETS + 1, width)).astype(np.float32),
        [random.normal(0, 1, (size, width, 3)).astype(np.float32) for size in toxicity.WIDTHS],
        [random.normal(0, 1, 3).astype(np.float32) for _ in toxicity.WIDTHS],
        random.normal(0, 1, 3 * len(toxicity.WIDTHS)).astype(np.float32),
    )


def plain_features(net, ids):
    rows = [sum(net.embeddings[piece].astype(np.float64) for piece in word) for word in ids]
    rows += [sum(net.embeddings[toxicity._PAD].astype(np.float64) for _ in range(4))] * 2
    result = []
    for filters, bias in zip(net.filters, net.biases, strict=True):
        values = [
            sum(rows[at + place] @ one if at + place < len(rows) else 0 for place, one in enumerate(filters))
            for at in range(max(1, len(ids)))
        ]
        result += np.maximum(np.max(values, 0) + bias, 0).tolist()
    return result


@pytest.mark.parametrize("places", [1 << 17, 4])
def test_filters_equal_plain_loops(monkeypatch, places):
    monkeypatch.setattr(toxicity, "_PLACES", places)
    random = np.random.default_rng(4)
    net = drawn_network(random)
    net.embeddings[toxicity._PAD] = 0
    counts = np.array([0, 5, 1, 0, 17, 2, 0])
    ids = random.integers(0, toxicity.BUCKETS, (int(counts.sum()), 4)).astype(np.int32)
    expected = [plain_features(net, part) for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert np.allclose(net.features(ids, counts), expected, atol=1e-4)
    assert net.features(ids[:0], np.zeros(0, np.int64)).shape == (0, 9)


def test_slopes_equal_differences():
    random = np.random.default_rng(8)
    net = drawn_network(random)
    net.embeddings = (net.embeddings * 0.3).astype(np.float64)
    net.filters = [one.astype(np.float64) for one in net.filters]
    counts, labels = np.array([4, 0, 6]), np.array([1, 0, 0])
    ids = random.integers(0, 50, (10, 4)).astype(np.int32)

    def loss():
        layer = net.features(ids, counts)
        return toxicity._loss((layer.astype(np.float64) * net.out).sum(1) + net.bias, labels) * 3

    rows, by_row, by_filter, by_bias, by_out, by_end = toxicity._batch_slopes(net, ids, counts, labels, 1.0)
    net.bias += 1e-3
    up = loss()
    net.bias -= 2e-3
    assert abs((up - loss()) / 2e-3 - by_end) < 1e-2
    net.bias += 1e-3
    for weights, slope in ((net.filters[1][1], by_filter[1][1]), (net.embeddings, None)):
        for _ in range(10):
            at = (int(random.choice(rows)) if slope is None else random.integers(len(weights)), random.integers(weights.shape[1]))
            told = by_row[np.searchsorted(rows, at[0]), at[1]] if slope is None else slope[at]
            weights[at] += 1e-3
            up = loss()
            weights[at] -= 2e-3
            assert abs((up - loss()) / 2e-3 - told) < 2e-2
            weights[at] += 1e-3


def test_thresholds_are_the_best_ones():
    scores, truth = np.array([0.1, 0.2, 0.6, 0.65, 0.9]), np.array([0, 0, 0, 1, 1])
    assert toxicity.best_threshold(scores, truth, 0.7) == pytest.approx(0.625)
    assert toxicity.best_threshold(np.array([0.1, 0.9]), np.array([0, 1]), 0.7) == 0.7


def test_toxicity_of_odd_rows(spark, docs):
    random = np.random.default_rng(9)
    plain = lambda size: " ".join(f"w{x}" for x in random.integers(0, 400, size))
    rows = [(i, f"{plain(40)} {'vilestuff' + str(i % 7) if i % 4 == 0 else ''} {plain(40)}") for i in range(300)]
    odd = [(None, "vilestuff3"), (900, None), (901, ""), (901, ""), (902, " \n"), (903, plain(60_000)), (903, plain(60_000) + " vilestuff9")]
    marks = [(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (0, 1), (5, None), (8, 3), (900, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    given = docs(*rows, *odd).withColumns({"label": F.lit(1), "score": F.lit("x"), "threshold": F.lit(0)})
    found = toxicity.score(given, labels).collect()
    assert len(found) == len(rows) + len(odd)
    by_text = {}
    for row in found:
        by_text.setdefault(row["doc_id"], []).append(row)
    right = [by_text[i][0]["predicted"] == int(i % 4 == 0) for i in range(300) if by_text[i][0]["held_out"]]
    assert len(right) > 60 and np.mean(right) >= 0.9
    assert len({row["score"] for i in (900, 901, 902) for row in by_text[i]}) == 1
    assert sorted(row["predicted"] for row in by_text[903]) == [0, 1]
    # Neither language nor source nor id is an input of a score.
    other = given.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id")})
    again = {(row["doc_id"], row["score"]) for row in toxicity.score(other, labels).collect()}
    assert again == {(row["doc_id"], row["score"]) for row in found}


def test_toxicity_without_rows_or_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs(), none).collect() == []
    assert [row["score"] for row in toxicity.score(docs((1, "a"), (2, None)), none).collect()] == [0.5, 0.5]
