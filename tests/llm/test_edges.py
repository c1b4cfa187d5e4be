"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from meterline.llm import bpe, classifier, credentials, embeddings, jaccard, lines, mixing, quality, repeats, token_files
from meterline.llm.components import components
from meterline.llm.queries import BYTE_BPE, WORD_BPE
from meterline.session import scratch_path
from tests.llm.conftest import by_id

LONG = " ".join(f"w{i}" for i in range(60_000))


def numbered(count, start=0):
    return " ".join(f"n{i}" for i in range(start, start + count))


def only(df, *names):
    return [tuple(row[name] for name in names) for row in by_id(df)]


# ---- byte-pair encoding


def test_bpe_of_odd_rows(docs):
    given = docs((1, None), (2, ""), (2, ""), (None, "a b"), (3, LONG), (4, "<|endoftext|> it's A  ½"))
    found = by_id(bpe.encode_decode(given.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(1)), WORD_BPE))
    assert [row["doc_id"] for row in found] == [None, 1, 2, 2, 3, 4]
    assert [len(row["ids"]) for row in found[1:4]] == [0, 0, 0]
    assert found[1]["decoded"] == ""
    coder = bpe.load(WORD_BPE)
    assert found[4]["ids"] == coder.encode(LONG).tolist() and len(found[4]["ids"]) > 60_000
    assert found[5]["decoded"].startswith("<|endoftext|> it</w> 's</w> a</w>")


def test_bpe_backtracking_equals_the_merges():
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(WORD_BPE), bpe.Bpe(WORD_BPE)
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("aeinrstéñ'1"), size)) for size in random.integers(1, 60, 2000)]
    for word, known in zip(words, library.encode_batch(words, add_special_tokens=False), strict=True):
        assert coder.encode(word).tolist() == known.ids


def test_bpe_of_an_empty_table(docs):
    assert bpe.digests(bpe.encode_decode(docs(), WORD_BPE)).collect() == []


# ---- line dedup


def test_line_dedup_of_odd_rows(docs):
    shared = [(i, f"own {i}\n  Shared LINE\t\n\n") for i in range(9)]
    given = docs(*shared, (20, "shared line\nSHARED LINE"), (None, "x\nshared line"), (30, None), (31, ""), (31, ""))
    found = by_id(lines.drop_repeated_lines(given.withColumn("n_lines", F.lit("old")), min_docs=10))
    assert found[0]["kept_text"] == "x" and found[0]["n_dropped"] == 1
    assert [row["kept_text"] for row in found[1:10]] == [f"own {i}\n\n" for i in range(9)]
    assert [(row["n_lines"], row["n_dropped"]) for row in found[1:10]] == [(4, 1)] * 9
    assert (found[10]["kept_text"], found[10]["n_lines"], found[10]["n_dropped"]) == ("", 2, 2)
    assert [(row["kept_text"], row["n_lines"], row["n_dropped"]) for row in found[11:]] == [("", 1, 0)] * 3
    assert set(found[0]) == {"doc_id", "text", "lang", "source", "n_chars", "kept_text", "n_lines", "n_dropped"}


def test_line_dedup_counts_documents_not_rows(docs):
    given = docs(*[(1, "same\nsame")] * 20)
    assert only(lines.drop_repeated_lines(given), "n_lines", "n_dropped") == [(2, 0)] * 20
    assert lines.drop_repeated_lines(docs()).collect() == []


def test_line_keys_change_only_ascii(spark):
    rows = spark.createDataFrame([("\t ÀB \x0b",), ("ab",), ("\xa0A",)], "line string")
    assert [row[0] for row in rows.select(lines.line_key(F.col("line"))).collect()] == ["Àb", "ab", "\xa0a"]


# ---- substring dedup


def brute_repeats(rows, window):
    """doc_id, words and removed words by the contract's own words."""
    named = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    first = {}
    for doc_id, words in named:
        for at in range(len(words) - window + 1):
            if doc_id is not None:
                name = tuple(words[at : at + window])
                first[name] = min(first.get(name, doc_id), doc_id)
    result = []
    for doc_id, words in named:
        gone = set()
        for at in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[at : at + window])] < doc_id:
                gone.update(range(at, at + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        result.append((doc_id, len(words), len(gone), kept))
    return sorted(result, key=lambda row: (row[0] is not None, row[0] or 0, row[3]))


@pytest.mark.parametrize("task_suffixes", [4096, 2])
def test_substring_dedup_equals_brute_force(docs, task_suffixes):
    passage, other = numbered(70), numbered(90, 1000)
    random = np.random.default_rng(2)
    noise = [" ".join(f"z{x}" for x in random.integers(0, 12, 150)) for _ in range(12)]
    rows = [
        (5, f"a b {passage} c"), (3, f"x  {passage}\n\ny"), (9, passage), (9, passage), (9, f"{passage} q {other}"),
        (7, f"{other} {other}"), (8, f"{passage[:-4]} {other}"), (None, passage), (1, None), (2, ""), (4, numbered(49)),
        (6, numbered(50)), (30, LONG), (31, "new " + LONG), *[(40 + i, text) for i, text in enumerate(noise)],
        *[(60 + i, f"{text} {passage} {i}") for i, text in enumerate(noise)],
    ]
    given = docs(*rows).withColumn("text_hash", F.lit(1)).withColumn("prefix", F.lit(1))
    found = only(repeats.drop_repeats(given, task_suffixes=task_suffixes), "doc_id", "n_words", "n_removed", "kept_text")
    key = lambda row: (row[0] is not None, row[0] or 0, row[3])
    assert sorted(found, key=key) == brute_repeats(rows, 50)


def test_substring_dedup_without_repeats(docs):
    assert repeats.drop_repeats(docs()).collect() == []
    assert only(repeats.drop_repeats(docs((1, None), (2, "a"))), "n_words", "n_removed", "kept_text") == [(0, 0, ""), (1, 0, "a")]


# ---- quality rules


def test_quality_of_odd_rows(docs):
    given = docs((1, None, "a"), (2, "", None), (3, numbered(60), ""), (None, numbered(60), "a"), (4, "x " * 60, "a"))
    given = given.unionByName(docs((5, LONG, "a"), (5, LONG, "a")))
    found = by_id(quality.judge(given.withColumn("host", F.lit("z")).withColumn("line", F.lit(1))))
    assert [(row["doc_id"], row["n_words"], row["base_failed"], row["kept"]) for row in found] == [
        (None, 60, False, True), (1, 0, True, False), (2, 0, True, False), (3, 60, False, True), (4, 60, True, False),
        (5, 60_000, False, True), (5, 60_000, False, True),
    ]
    assert found[4]["n_repeat_words"] == 60
    assert quality.judge(docs()).collect() == []


def test_quality_rejects_what_is_mostly_boilerplate_of_its_host(docs):
    line = numbered(60)
    rows = [(i, f"{line}\n{numbered(10, 1000 * i + 100)}", "hot") for i in range(12)]
    rows += [(50 + i, f"{line}\n{numbered(10, 1000 * i + 100)}", f"host {i}") for i in range(5)]
    rows += [(70, f"{line}\n{numbered(100, 500)}", "hot")]
    kept = {row["doc_id"]: row["kept"] for row in by_id(quality.judge(docs(*rows)))}
    assert [kept[i] for i in range(12)] == [False] * 12
    assert all(kept[50 + i] for i in range(5)) and kept[70]


def test_boilerplate_lines_leave_the_text(spark, docs):
    own = {i: f"{numbered(60, 1000 * i)}\n\n{numbered(5, 1000 * i + 500)}" for i in range(12)}
    given = docs(*[(i, f"Menu of it\n{text}\n menu OF it ", "hot") for i, text in own.items()], (70, "Menu of it\n" + numbered(60), "b"))
    left = {row["doc_id"]: row for row in by_id(corpus_pipeline.quality_rules(spark, given, ""))}
    assert {i: left[i]["text"] for i in own} == own
    assert all(left[i]["n_chars"] == len(own[i]) for i in own)
    assert left[70]["text"] == "Menu of it\n" + numbered(60)


def test_rows_of_one_document_do_not_make_its_lines_boilerplate(docs):
    text = f"{numbered(60)}\n{numbered(10, 100)}"
    found = by_id(quality.judge(docs(*[(1, text, "hot")] * 12, (2, numbered(60, 900), "hot"))))
    assert len(found) == 13 and all(row["kept"] and row["n_boilerplate"] == 0 for row in found)


# ---- Jaccard join


def brute_groups(rows):
    """The component of every doc_id, each pair of its sets held against each other."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").lower().split()
        if doc_id is not None:
            sets.setdefault(doc_id, []).append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = {doc_id: doc_id for doc_id in sets}

    def root(key):
        while group[key] != key:
            key = group[key]
        return key

    for a in sets:
        for b in sets:
            if a < b and any(x and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {doc_id: root(doc_id) for doc_id in sets}


def edited(random, base, most):
    words = list(base)
    for at in random.integers(0, len(base), random.integers(0, most)):
        words[at] = f"x{random.integers(0, 100_000)}"
    return " ".join(words)


def test_jaccard_of_repeated_ids_in_large_groups(docs):
    """Ninety near copies at the default settings, ids with several texts, and one id in two groups."""
    random = np.random.default_rng(11)
    base, other = [f"w{i}" for i in range(200)], [f"v{i}" for i in range(200)]
    rows = [(i, edited(random, base, 8)) for i in range(90)] + [(500 + i, edited(random, other, 8)) for i in range(90)]
    rows += [(7, edited(random, base, 8)), (7, numbered(80)), (700, numbered(80)), (90, edited(random, base, 8)), (90, None)]
    rows += [(3, rows[4][1]), (2, rows[2][1]), (2, rows[2][1])]
    found = jaccard.join(docs(*rows)).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == brute_groups(rows)
    tied = [*rows, (600, edited(random, base, 8)), (600, edited(random, other, 8))]
    found = jaccard.join(docs(*tied)).collect()
    assert len(found) == len(tied)
    assert {(row["doc_id"], row["component_id"]) for row in found} == set(brute_groups(tied).items())


@pytest.mark.parametrize(("seed", "long_list"), [(1, 2), (2, 2), (3, 8)])
def test_jaccard_of_texts_that_share_most_of_a_passage(docs, seed, long_list):
    """Passages that make up more or less than the share needed, so that links lie near the threshold."""
    random = np.random.default_rng(seed)
    rows = []
    for passage in range(4):
        base = [f"p{passage}_{i}" for i in range(random.integers(40, 120))]
        for _ in range(45):
            cut = base[random.integers(0, 8) : len(base) - random.integers(0, 8)]
            own = [f"o{random.integers(0, 60)}" for _ in range(random.integers(0, 25))]
            rows.append((len(rows), " ".join([*cut, *own] if random.random() < 0.5 else [*own, *cut])))
    order = random.permutation(len(rows))
    rows = [(int(order[i]), text) for i, text in rows]
    found = jaccard.join(docs(*rows), long_list=long_list).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == brute_groups(rows)


@pytest.mark.parametrize("long_list", [32, 1])
def test_jaccard_equals_brute_force(docs, long_list):
    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, None) for i in (1, 2)] + [(3, ""), (4, "A b"), (5, "a  B"), (6, "a b c"), (8, LONG), (7, LONG + " end")]
    for i in range(40):
        words = list(base)
        for at in random.integers(0, 200, random.integers(0, 7)):
            words[at] = f"x{random.integers(0, 1000)}"
        rows.append((100 + i, " ".join(words)))
    for i in range(20):
        rows.append((200 + i, " ".join([*base[:45], *[f"y{i}_{j}" for j in range(random.integers(5, 60))]])))
    rows += [(100, rows[10][1]), (300, rows[10][1].upper()), (None, rows[10][1])]
    given = docs(*rows).withColumn("n", F.lit(0)).withColumn("component", F.lit(0))
    found = by_id(jaccard.join(given, long_list=long_list))
    assert len(found) == len(rows)
    assert {row["doc_id"]: row["component_id"] for row in found} == {None: None, **brute_groups(rows)}
    assert {row["n_shingles"] for row in found if row["doc_id"] in (1, 2, 3)} == {0}
    assert [row["n_shingles"] for row in found if row["doc_id"] == 8] == [59_996]


def test_jaccard_of_an_empty_table(docs):
    assert jaccard.join(docs()).collect() == []


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 1), (9, 8), (8, 9), (7, 7), *[(100, i) for i in range(101, 140)], (139, 200)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {row["node"]: row["component"] for row in found} == {
        1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 200: 100, **dict.fromkeys(range(100, 140), 100),
    }
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {row["component"] for row in components(chain).collect()} == {0}


# ---- token files


def test_token_files_of_odd_rows(spark, docs):
    given = docs((7, "b b b"), (None, "n"), (3, None), (3, ""), (9, LONG), (-2, "<|endoftext|>x"))
    path = scratch_path(spark, "test")
    token_files.write(given.withColumn("ids", F.lit(1)), BYTE_BPE, path, block_ids=1000)
    found = by_id(token_files.read(spark, path))
    library = token_files.Encoder(BYTE_BPE).library
    start = 0
    for row, (doc_id, text) in zip(found, [(None, "n"), (-2, "<|endoftext|>x"), (3, ""), (3, ""), (7, "b b b"), (9, LONG)], strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_token_files_of_an_empty_table(spark, docs):
    path = scratch_path(spark, "test")
    token_files.write(docs(), BYTE_BPE, path)
    assert token_files.read(spark, path).collect() == []


def test_pieces_are_merged_as_the_library_does(tmp_path):
    encoder = token_files.Encoder(BYTE_BPE)
    random = np.random.default_rng(9)
    letters = ["a", "e", "t", "n", " ", "  ", "'", "'s", "\n", "\t", "é", "ß", "中", "🙂", "1", "23", "_", "...", "the", "ing", "\u00a0", "\x00"]
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(400)] + ["a" * 50_000, " " * 3000, "ab" * 9000]
    assert encoder.merger is not None
    assert encoder.encode(texts) == encoder._ids(texts)

    # A vocabulary whose ids do not follow its merges is left to the library.
    with open(BYTE_BPE, encoding="utf-8") as file:
        held = json.load(file)
    held["model"]["merges"][300], held["model"]["merges"][900] = held["model"]["merges"][900], held["model"]["merges"][300]
    path = tmp_path / "swapped.json"
    path.write_text(json.dumps(held), encoding="utf-8")
    swapped = token_files.Encoder(str(path))
    assert swapped.merger is None
    assert swapped.encode(texts) == swapped._ids(texts)


def _counted_anew(ids, least):
    """Pairs replaced round by round, each round counting all pairs of the sequence left."""
    symbols, rules = list(ids), []
    while True:
        counts = Counter(zip(symbols[:-1], symbols[1:], strict=True))
        chosen = {pair: token_files.BASE + len(rules) + i for i, pair in enumerate(sorted(p for p in counts if counts[p] >= least))}
        if not chosen:
            return symbols, rules
        left, at = [], 0
        while at < len(symbols):
            pair = tuple(symbols[at : at + 2])
            left.append(chosen.get(pair, symbols[at]))
            at += 2 if pair in chosen else 1
        symbols, rules = left, rules + list(chosen)


def test_grammar_counts_as_if_all_pairs_were_counted_in_each_round(monkeypatch):
    random = np.random.default_rng(5)
    for spread in (2, 6, 40):
        ids = np.concatenate([random.integers(0, spread, 2000), np.tile(random.integers(0, 300, 25), 40)])
        grammar = token_files.Grammar.of(ids, least=5)
        symbols, rules = _counted_anew(ids.tolist(), 5)
        assert grammar.symbols.tolist() == symbols
        assert [tuple(rule) for rule in grammar.rules.tolist()] == rules
        # With little room in a round, frequent pairs are left over and counted again.
        monkeypatch.setattr(token_files, "PER_ROUND", 3)
        few = token_files.Grammar.of(ids, least=5)
        monkeypatch.undo()
        pairs = few.symbols[:-1].astype(np.int64) << 16 | few.symbols[1:]
        assert few.rounds.max() <= 3 and np.unique(pairs, return_counts=True)[1].max(initial=0) < 5
        assert (few.expand(few.symbols) == ids).all()


def test_grammar_reads_any_range():
    random = np.random.default_rng(4)
    ids = np.concatenate([random.integers(0, 40, 3000), np.tile(random.integers(0, 50_257, 30), 200), np.zeros(501, int)])
    grammar = token_files.Grammar.of(ids.astype(np.uint16), rounds=6)
    assert len(grammar.symbols) < len(ids) / 2
    assert (grammar.expand(grammar.symbols) == ids).all()
    for start, stop in [(0, 0), (0, 1), (17, 4000), (3001, 9000), (len(ids) - 1, len(ids)), (0, len(ids))]:
        assert grammar.read(start, stop).tolist() == ids[start:stop].tolist()
    for few in ([], [5], [5, 5, 5]):
        small = token_files.Grammar.of(np.array(few, np.uint16))
        assert small.expand(small.symbols).tolist() == few


def test_a_long_passage_is_replaced_until_no_pair_is_frequent():
    ids = np.tile(np.arange(1000), 400)
    grammar = token_files.Grammar.of(ids)
    assert grammar.lengths.max() >= 512 and len(grammar.symbols) < len(ids) // 500
    assert (grammar.expand(grammar.symbols) == ids).all()
    pairs = grammar.symbols[:-1].astype(np.int64) << 16 | grammar.symbols[1:]
    assert np.unique(pairs, return_counts=True)[1].max(initial=0) < token_files.LEAST


# ---- mixing


def test_mixing_of_odd_rows(docs):
    given = docs((1, None, "a"), (1, None, "a"), (2, "", None), (None, "x", "b"), (3, LONG, "b"))
    found = by_id(mixing.mix(given.withColumn("mix_slot", F.lit("old")), block_chars=100))
    assert len(found) == 5 and all(row["mix_release"] <= row["mix_slot"] < row["mix_deadline"] for row in found)
    assert set(found[0]) == {*given.columns, "mix_slot", "mix_block", "mix_at", "mix_release", "mix_deadline"}
    assert mixing.mix(docs()).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(given, weights={"a": 0.0})


def test_a_period_keeps_every_source_within_one_block():
    for shares in ([1], [1, 1, 1], [7, 2, 1], [500, 300, 150, 49, 1], [3, 0, 2]):
        slots = mixing.period(shares)
        total, served = sum(shares), np.zeros(len(shares))
        for slot, source in enumerate(slots, 1):
            served[source] += 1
            assert (np.abs(served - slot * np.array(shares) / total) < 1).all()
        assert served.tolist() == shares


def test_mix_follows_the_weights_and_drops_nothing(spark, docs):
    given = docs(*[(i, "x" * 99, "big" if i % 4 else "small") for i in range(400)])
    found = mixing.mix(given, {"big": 3.0, "small": 1.0}, block_chars=1000, parts=4)
    slots = found.groupBy("source").agg(F.countDistinct("mix_slot").alias("n"), F.count("*").alias("rows")).collect()
    assert {row["source"]: (row["n"], row["rows"]) for row in slots} == {"big": (30, 300), "small": (10, 100)}
    ordered = [row["source"] for row in found.orderBy("mix_slot").select("source", "mix_slot").distinct().orderBy("mix_slot").collect()]
    assert all(ordered[at : at + 4].count("small") == 1 for at in range(0, 40, 4))
    path = scratch_path(spark, "test")
    mixing.in_mixed_order(given, {"big": 3.0, "small": 1.0}).write.parquet(path)
    assert spark.read.parquet(path).columns == given.columns and spark.read.parquet(path).count() == 400


def plain_period(shares):
    """Earliest deadline first, slot by slot over all sources."""
    total, served, slots = sum(shares), [0] * len(shares), []
    for slot in range(total):
        ready = [i for i, p in enumerate(shares) if served[i] < p and served[i] * total // p <= slot]
        slots.append(min(ready, key=lambda i: (-(-(served[i] + 1) * total // shares[i]), i)))
        served[slots[-1]] += 1
    return slots


def test_a_period_with_many_small_sources_is_the_plain_one():
    random = np.random.default_rng(3)
    for _ in range(200):
        shares = random.choice([0, 1, 1, 1, 2, 3, 17], random.integers(1, 40)).tolist()
        assert mixing.period(shares) == plain_period(shares)


def test_empty_slots_and_first_slots_of_a_schedule():
    """A period longer than all shares leaves slots empty; a part of it is its beginning."""
    random = np.random.default_rng(5)
    for _ in range(100):
        shares = random.choice([1, 1, 2, 3, 9], random.integers(1, 12)).tolist()
        parts = sum(shares) + int(random.integers(0, 20))
        large = {i: p for i, p in enumerate(shares) if p > 1}
        slots, runs = mixing.schedule(large, len(shares) - len(large), parts)
        placed = {(source, block): slot for source, block, slot in slots}
        placed |= {(source, 0): source + shift for first, end, shift in runs for source in range(first, end) if source not in large}
        assert len(set(placed.values())) == len(placed) == sum(shares)
        for (source, block), slot in placed.items():
            assert block * parts // shares[source] <= slot < -(-(block + 1) * parts // shares[source])
        some, _ = mixing.schedule(large, len(shares) - len(large), parts, parts // 2)
        assert [row for row in slots if row[2] < parts // 2] == [row for row in some if row[2] < parts // 2]


def test_five_thousand_sources_keep_to_their_exact_weights(spark):
    """One source has a third of the weight, 5,000 share the rest, one of them with 0.19 % of all."""
    weights = {"big": 1 / 3, "odd": 0.0019, **{f"h{i}": (2 / 3 - 0.0019) / 4999 for i in range(4999)}}
    big = spark.range(2600).selectExpr("id AS doc_id", "'big' AS source", "repeat('x', 99) AS text")
    odd = spark.range(5000, 5015).selectExpr("id AS doc_id", "'odd' AS source", "repeat('x', 99) AS text")
    rest = spark.range(10_000, 14_999).selectExpr("id AS doc_id", "concat('h', id - 10000) AS source", "repeat('x', 99) AS text")
    found = mixing.mix(big.unionByName(odd).unionByName(rest), weights, block_chars=100)
    rows = sorted((row["mix_slot"], row["source"]) for row in found.select("mix_slot", "source").collect())
    # As long as all sources last, over which a source is at most that far from its weight.
    served = dict.fromkeys(weights, 0)
    for slot, source in rows:
        if slot >= 7400:
            break
        before = served[source] - slot * weights[source]
        served[source] += 1
        after = served[source] - (slot + 1) * weights[source]
        assert before > -1.01 and after < 1.01
    assert all(abs(served[source] - 7400 * weight) < 1.01 for source, weight in weights.items())


def test_mixing_keeps_columns_of_any_name(spark, docs):
    given = docs(*[(i, "x" * i, "ab"[i % 2]) for i in range(50)])
    names = ["_block", "_order", "_group", "_size", "_index", "_share", "_place", "_at", "in_text", "_name", "a.b"]
    clashing = given.withColumns({name: F.col("doc_id") * 2 for name in names})
    found = mixing.mix(clashing, block_chars=100)
    assert found.columns[: len(clashing.columns)] == clashing.columns
    assert all(row[name] == 2 * row["doc_id"] for row in found.collect() for name in names)
    plain = {row["doc_id"]: row["mix_slot"] for row in mixing.mix(given, block_chars=100).collect()}
    assert {row["doc_id"]: row["mix_slot"] for row in found.collect()} == plain


def test_rows_without_an_id_fall_into_many_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 100)
    given = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'s' AS source", "concat('t', id) AS text")
    shares = mixing.shares_of(given, None, 1000)
    sizes = mixing._numbered(given, 1000, shares).select("_at").distinct().count()
    assert sizes == 4000
    named = F.concat(F.lit("-"), F.md5("text"))
    groups = given.select(F.shiftright(F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long"), 54).alias("g")).groupBy("g").count()
    assert groups.agg(F.max("count")).first()[0] < 200


def test_more_than_ten_thousand_sources_are_mixed(spark):
    given = spark.range(30_000).selectExpr("id AS doc_id", "concat('h', id % 12000) AS source", "repeat('x', 99) AS text")
    given = given.unionByName(spark.range(30_000, 31_000).selectExpr("id AS doc_id", "'h5x' AS source", "repeat('x', 99999) AS text"))
    found = mixing.mix(given, {"h5x": 3.0, "h7": 1e-4}).select("doc_id", "source", "mix_slot", "mix_release", "mix_deadline")
    rows = found.collect()
    assert len(rows) == 31_000 and all(row["mix_release"] <= row["mix_slot"] < row["mix_deadline"] for row in rows)
    assert len({(row["source"], row["mix_slot"]) for row in rows}) == len({row["mix_slot"] for row in rows}) == 13_000


# ---- embeddings


def test_embeddings_of_odd_rows(spark):
    random = np.random.default_rng(5)
    base = random.standard_normal(16)
    near = [(base + 0.02 * random.standard_normal(16)).tolist() for _ in range(5)]
    far = (np.eye(16)[0] * 3 - base * base[0] / (base @ base)).tolist()
    nan, inf = float("nan"), float("inf")
    rows = [(10 + i, v) for i, v in enumerate(near)] + [(30, near[0]), (30, near[0]), (31, [2e200 * x for x in near[0]]), (20, far)]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [nan] * 16), (5, [inf] + [0.0] * 15), (6, [None] + [1.0] * 15)]
    rows += [(7, near[0][:8]), (8, near[0][:8]), (None, near[0])]
    given = spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]))
    given = given.withColumn("component", F.lit(0)).withColumn("vec", F.lit(0)).withColumn("links", F.lit(0))
    found = sorted(map(tuple, embeddings.near_duplicates(given).collect()), key=lambda row: (row[0] is not None, row[0] or 0))
    group = [(i, 6, 10, i == 10) for i in range(10, 15)]
    assert found == [
        (None, 0, None, False), *[(i, 0, i, True) for i in range(1, 7)], (7, 1, 7, True), (8, 1, 7, False), *group,
        (20, 0, 20, True), (30, 6, 10, False), (30, 6, 10, False), (31, 6, 10, False),
    ]
    assert embeddings.near_duplicates(given.limit(0)).collect() == []


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    random = np.random.default_rng(6)
    base = random.standard_normal(24)
    points = np.array([base + 0.15 * random.standard_normal(24) for _ in range(60)])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.975
    np.fill_diagonal(links, False)
    given = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = {row["vec_id"]: row["n_links"] for row in embeddings.near_duplicates(given, 0.975).collect()}
    assert sum(found.values()) >= 0.9 * links.sum() and all(found[i] <= links[i].sum() for i in range(60))


# ---- classifier


def test_classifier_of_odd_rows(spark, docs):
    rows = [(i, numbered(80, i) if i % 2 else "junk!! " * 80) for i in range(300)]
    given = docs(*rows, (1000, None), (1001, ""), (None, "a b"), (5, LONG)).withColumn("label", F.lit("old"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(7, 0), (8, None), (None, 1), (9, 5)], "doc_id long, quality int")
    found = by_id(classifier.score(given.withColumn("score", F.lit(9)), labels.withColumn("text", F.lit("x"))))
    assert len(found) == 304 and all(0 <= row["score"] <= 1 for row in found)
    good = [row["predicted"] == row["doc_id"] % 2 for row in found if row["doc_id"] is not None and row["doc_id"] < 300 and row["held_out"]]
    assert np.mean(good) > 0.9
    same = [row["score"] for row in found if row["doc_id"] in (1000, 1001)]
    assert same[0] == same[1]


def test_classifier_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert only(classifier.score(docs((1, "a"), (2, None)), labels), "score", "predicted") == [(0.5, 1), (0.5, 1)]
    assert classifier.score(docs(), labels).collect() == []


# ---- secrets


def test_secrets_of_odd_rows(docs):
    given = docs((1, None), (2, ""), (None, "pwd: x7Kp9!vQ2z"), (3, "é password=abcdef password=abc AKIA" + "A" * 16), (4, LONG), (4, LONG))
    found = by_id(credentials.digests(credentials.scan(given.withColumn("found", F.lit(1)), WORD_BPE)))
    assert [row["spans"] for row in found] == ["guess:5:15", "", "", "assign:2:17,access:31:51", "", ""]
    assert found[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert credentials.scan(docs(), WORD_BPE).collect() == []


def test_guess_costs():
    words = credentials.dictionary(WORD_BPE)
    cost = {value: credentials.guess_cost(value, words) for value in (
        "password", "Password1", "qwerty123", "aaaaaaaaaaaa", "2019-03-04", "abcabcabcabc", "x7Kp9!vQ2z", "8f3a9c1e77")}
    assert all(cost[v] < 8 for v in ("password", "Password1", "qwerty123", "aaaaaaaaaaaa", "2019-03-04", "abcabcabcabc"))
    assert all(cost[v] > 8 for v in ("x7Kp9!vQ2z", "8f3a9c1e77"))
    assert credentials.guess_cost("k9" * 100_000 + "Zq", words, 8.0) >= 8


def test_letters_alone_and_prefixed_names_reach_the_guess_cost():
    words = credentials.dictionary(WORD_BPE)
    for text in (
        "pwd: kXqZvTbNmWpLrHsY", "bearer QxJvKtRbnWzMpLdFgHsT", "passphrase = qzvkxwjtbnmrhplc", "DB_PASS=Xk9!vv$2Qz",
        "MYSQL_PWD=x7Kp9!vQ2z", "AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCY", "dbPassword is x7Kp9!vQ2z",
        "smtp2pass: x7Kp9!vQ2z", "my-auth-token=x7Kp9!vQ2z",
    ):
        value = text.split(" ")[-1].split("=")[-1]
        assert ("guess", text.index(value), len(text)) in credentials.find(text, words), text
    for text in ("The password is required", "secret: information", "the compass is pointing", "pwd: qwertyuiop", "pass: abcdef"):
        assert credentials.find(text, words) == [] or "secret" in text, text
        assert all(kind != "guess" for kind, _, _ in credentials.find(text, words)), text


# ---- pipeline


def test_pipeline_stages_of_odd_rows(spark, docs):
    given = docs((1, None), (2, "", None), (3, numbered(60)), (3, numbered(60)), (4, "tail " + numbered(60)), (None, numbered(70, 500)))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(), "").collect() == []
        given = stage(spark, given.withColumn("_id", F.lit(1)).withColumn("kept_text", F.lit("z")), "")
        assert {row["doc_id"] for row in given.collect()} == ({None, 3, 4} if name in ("quality_rules", "line_dedup") else {None, 3})
