"""The queries of the corpus operators over whole tables, against SQL or brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from meterline.llm import mixing
from meterline.llm.queries import BYTE_BPE, QUERIES, SQL, WORD_BPE
from tools.compare import oracle, same

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {code: code + 32 for code in range(65, 91)}


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(spark, name):
    return {row[0]: row for row in QUERIES[name](spark, SF_DIR).collect()}


def test_one_query_for_each_operator():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(QUERIES) - set(SQL) == {
        "op1_bpe", "op6_token_files", "op8_embedding_dedup", "op9_quality_classifier", "op10_secret_scan",
        "op13_toxicity", "pipeline",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert same(QUERIES[name](spark, SF_DIR).toPandas(), duck.execute(SQL[name]).df()) == ""


def encoded(texts):
    library = Tokenizer.from_file(WORD_BPE)
    found = {}
    for doc_id, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        found[doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    return found


def test_bpe(spark, texts):
    assert {key: tuple(row)[1:] for key, row in rows(spark, "op1_bpe").items()} == encoded(texts)


def test_token_files(spark, texts):
    library = Tokenizer.from_file(BYTE_BPE)
    start, expected = 0, {}
    for doc_id, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {key: tuple(row)[1:] for key, row in rows(spark, "op6_token_files").items()} == expected


def test_embedding_dedup(spark, duck):
    ids, vectors = zip(*duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall(), strict=True)
    points = np.array(vectors, np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    links = points @ points.T >= 0.95
    np.fill_diagonal(links, False)
    found = rows(spark, "op8_embedding_dedup")
    total = sum(row["n_links"] for row in found.values())
    assert 0.9 * links.sum() <= total <= links.sum()
    assert set(found) == set(ids)
    assert all(row["kept"] == (row["component_id"] == key) for key, row in found.items())


def test_quality_classifier(spark, duck, texts):
    found = rows(spark, "op9_quality_classifier")
    assert set(found) == set(texts)
    assert all(row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0) for key, row in found.items())
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in found.values())
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [key for key in labels if found[key]["held_out"]]
    assert np.mean([found[key]["predicted"] == labels[key] for key in held]) >= 0.9


def test_toxicity(spark, duck, texts):
    found = rows(spark, "op13_toxicity")
    assert set(found) == set(texts)
    assert all(row["held_out"] == (zlib.crc32(str(key).encode()) % 3 == 1) for key, row in found.items())
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.7) for row in found.values())
    # Held-out accuracy needs more labels than the smallest tables have.
    big = "/root/testdata/sf0.1"
    labels = dict(oracle(big).execute("SELECT doc_id, toxic FROM labels").fetchall())
    held = [row for row in QUERIES["op13_toxicity"](spark, big).collect() if row["held_out"] and row["doc_id"] in labels]
    assert np.mean([row["predicted"] == labels[row["doc_id"]] for row in held]) >= 0.97
    toxic = [row for row in held if labels[row["doc_id"]]]
    assert np.mean([row["predicted"] for row in toxic]) >= 0.85


def base_spans(text):
    kinds = [
        (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
         r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    ]
    found = []
    for kind, (pattern, group, least) in enumerate(kinds):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return sorted(found)


def test_secret_scan(spark, texts):
    names = ["assign", "access", "hex"]
    for key, row in rows(spark, "op10_secret_scan").items():
        base = base_spans(texts[key])
        told = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in base)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(
            sum(k == kind for _, k, _ in base) for kind in range(3)
        )
        assert row["base_sha256"] == sha(told)
        assert set(told.split(",")) - {""} <= set(row["spans"].split(","))


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def test_pipeline(spark, duck, texts):
    """Each stage by itself in plain Python; the mix changes the places only."""
    kept = {row[0] for row in duck.execute(f"SELECT doc_id FROM ({SQL['op4_quality_rules']}) WHERE kept").fetchall()}
    left = {key: text for key, text in texts.items() if key in kept}
    holders = {}
    for key, text in left.items():
        for name in {key_of(line) for line in text.split("\n")} - {""}:
            holders.setdefault(name, set()).add(key)
    common = {name for name, keys in holders.items() if len(keys) >= 10}
    left = {key: "\n".join(x for x in text.split("\n") if key_of(x) not in common) for key, text in left.items()}

    sets = {}
    for key, text in left.items():
        words = WORD.findall(text.translate(UPPER))
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {key: key for key in left}

    def root(key):
        return key if group[key] == key else root(group[key])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    left = {key: text for key, text in left.items() if root(key) == key}
    found = rows(spark, "pipeline")
    assert {key: tuple(row)[1:-1] for key, row in found.items()} == encoded(left)
    assert sorted(row["place"] for row in found.values()) == list(range(len(left)))


def test_the_pipeline_drops_boilerplate_that_line_dedup_would_keep(spark, tmp_path):
    """Of twelve documents with a line of their host's, five are rejected, so seven hold it after the rules."""
    line = "Subscribe to our weekly letter today"
    own = {key: " ".join(f"w{key}_{i}" for i in range(80 if key < 7 or key >= 12 else 20)) for key in range(40)}
    texts = {key: f"{text}\n{line}" if key < 12 else text for key, text in own.items()}
    rows = [(key, text, "en", "host", len(text)) for key, text in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    expected = encoded({key: text for key, text in own.items() if key < 7 or key >= 12})
    found = {row["doc_id"]: row for row in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {key: tuple(row)[1:-1] for key, row in found.items()} == expected
    deduped = corpus_pipeline.line_dedup(spark, docs.filter("doc_id < 7"), str(tmp_path)).collect()
    assert all(row["text"].endswith(line) for row in deduped)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.selectExpr("*", "doc_id AS _id", "text AS kept"), SF_DIR).columns == docs.columns


def test_the_mix_gives_the_pipeline_its_order(spark, monkeypatch, tmp_path):
    """The mix's later files are larger, and Spark reads large files first; without the stage the order is another."""
    ids = sorted(range(60), key=lambda key: hashlib.md5(str(key).encode()).hexdigest())
    rows = [(key, " ".join(sha(f"{key} {i}") for i in range(10 * place + 1)), "en", "s", 0) for place, key in enumerate(ids)]
    docs = spark.createDataFrame(sorted(rows), "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    slots = mixing.mix(docs).select("doc_id", "mix_slot", "mix_block", "mix_at").collect()
    expected = [row[0] for row in sorted(slots, key=lambda row: (*row[1:], row[0]))]
    stages = dict(corpus_pipeline.STAGES)
    changed = {"shuffle.partitions": "7", "adaptive.enabled": "false", "files.maxPartitionBytes": "64k"}
    before = {name: spark.conf.get(f"spark.sql.{name}") for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(f"spark.sql.{name}", value)
        monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, stages[name]) for name in ("mix_sources", "encode")])
        found = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert [row["doc_id"] for row in found] == expected
        assert [row["place"] for row in found] == list(range(60))
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("encode", stages["encode"])])
        assert [row["doc_id"] for row in corpus_pipeline.run(spark, str(tmp_path)).collect()] != expected
    finally:
        for name, value in before.items():
            spark.conf.set(f"spark.sql.{name}", value)
