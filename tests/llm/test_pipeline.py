"""The pipeline over small tables with planted cases, and its stages' contract."""

import random

import pytest
import sentencepiece

import corpus_pipeline
from clickguard.llm import queries, simhash
from clickguard.llm.common import stored

N = 240


def words(r, n):
    return " ".join("".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents 0..N-1: every fourth one junk; then the planted ones."""
    r = random.Random(1)
    text = {i: words(r, r.randrange(60, 400)).capitalize() + "." for i in range(N)}
    for i in range(0, N, 4):
        text[i] = "### ".join(text[i].upper().split())
    item, passage = words(r, 30), words(r, 80)
    long = max((i for i in text if i % 4), key=lambda i: len(text[i]))
    near = (text[long].replace(w, "changed", 1) for w in text[long].split())
    near = next(t for t in near if (simhash.fingerprint(t) ^ simhash.fingerprint(text[long])).bit_count() <= 4)
    good = [i for i in range(N) if i % 4]
    planted = {
        1000: text[good[0]],  # exact copy
        1001: near,  # near copy
        1002: f"{words(r, 90)} {item} {words(r, 90)}.",  # benchmark leak
        1003: f"{words(r, 120)} {passage} {words(r, 110)}.",
        1004: f"{words(r, 100)} {passage} {words(r, 130)}.",
        1005: "$$$ ".join(words(r, 120).upper().split()),  # junk without a label
        1006: f"{words(r, 150)}\nof several\tlines.",
    }
    rows = [(i, t, "en", "s", len(t)) for i, t in {**text, **planted}.items()]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s", 0), (None, words(r, 140) + ".", "en", "s", 1),
             (5, text[5], "en", "s", len(text[5]))]
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(N)], "doc_id long, quality int, toxic int") \
        .coalesce(1).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, text, planted, passage


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "simhash", "substring", "decontaminate", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_planted_cases(spark, tables):
    d, text, planted, passage = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    schema, seen = docs.schema, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, d), f"test-{name}")
        seen[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.schema == schema, name
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    clean = {i for i in range(N) if i % 4}
    # junk goes, labelled or not; the clean stay
    assert not ids["quality"] & {*range(0, N, 4), 1005} and ids["quality"] >= clean | set(range(1000, 1005)) | {1006}
    # of copies the smallest id stays, once
    assert not ids["simhash"] & {1000, 1001}
    assert ids["simhash"] >= clean | {1002, 1003, 1004, 1006}
    assert sum(r.doc_id == 5 for r in seen["simhash"]) == 1
    # the passage stays in the first document and goes from the second
    cut = {r.doc_id: r for r in seen["substring"]}
    assert cut[1003].text == planted[1003]
    assert len(cut[1004].text.split()) < len(planted[1004].split()) - 55
    assert cut[1004].n_chars == len(cut[1004].text)
    assert all(cut[i].text == text[i] for i in clean)
    # the leak goes
    assert 1002 not in ids["decontaminate"] and ids["decontaminate"] >= clean | {1003, 1004, 1006}
    # tokens are the library's, and decode to what was left
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    left = {r.doc_id: r.text for r in seen["decontaminate"]}
    assert len(seen["sentencepiece"]) == len(seen["decontaminate"])
    for r in seen["sentencepiece"]:
        assert r.token_ids == sp.encode(left[r.doc_id]) and r.round_trip


def test_decisions_are_by_row(spark, tables, tmp_path):
    """Rows that share an id, or have none, each have their own decision."""
    from pyspark.sql import functions as F

    d, text, planted, passage = tables
    r = random.Random(2)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    texts = lambda df: sorted((x.doc_id is None, x.doc_id or 0, x.text) for x in df.collect())
    rows = lambda got: sorted((i is None, i or 0, t) for i, t in got)
    stages = dict(corpus_pipeline.STAGES)
    item = spark.read.parquet(f"{d}/benchmark.parquet").first().text
    clean = [words(r, 150).capitalize() + "." for _ in range(4)]
    leak = [f"{words(r, 60)} {item} {words(r, 60)}." for _ in range(2)]
    junk = "$$$ ".join(words(r, 120).upper().split())
    # a leak without an id, or with another's, takes no clean row along
    got = stages["decontaminate"](spark, frame([(None, leak[0]), (None, clean[0]), (7, leak[1]), (7, clean[1])]), d)
    assert texts(got) == rows([(None, clean[0]), (7, clean[1])])
    # a good row keeps no junk
    known = spark.read.parquet(f"{d}/documents.parquet").where("doc_id < 900")
    got = stages["quality"](spark, known.unionByName(frame(
        [(None, junk), (None, clean[0]), (1, junk)])), d)
    left = {(x.doc_id, x.text) for x in got.collect()}
    assert (None, clean[0]) in left and (None, junk) not in left and (1, junk) not in left
    # one row of a component, whatever its ids
    near = next(t for t in (clean[1].replace(w, "changed", 1) for w in clean[1].split())
                if (simhash.fingerprint(t) ^ simhash.fingerprint(clean[1])).bit_count() <= 4)
    got = stages["simhash"](spark, frame([
        (None, clean[0]), (9, clean[0]),  # named by 9
        (8, clean[1]), (8, near),  # one id, two near texts
        (None, clean[2]), (None, clean[2]),  # no id at all
        (8, clean[3]), (8, clean[3])]), d).collect()
    left = sorted((x.doc_id is None, x.doc_id or 0, x.text) for x in got)
    assert len(left) == 4 and (False, 9, clean[0]) in left and (True, 0, clean[2]) in left
    assert (False, 8, clean[3]) in left
    # a passage is cut from rows without an id, and once within an id
    held = [f"{words(r, 100)} {passage} {words(r, 100 + k)}." for k in range(5)]
    got = stages["substring"](spark, frame([(4, held[0]), (None, held[1])]), d)
    left = {x.doc_id: x.text for x in got.collect()}
    assert left[4] == held[0] and len(left[None].split()) < len(held[1].split()) - 55
    got = stages["substring"](spark, frame([(4, held[2]), (4, held[3]), (None, clean[2])]), d)
    left = [x.text for x in got.where(F.col("doc_id") == 4).collect()]
    assert sum(t in held for t in left) == 1 and min(len(t.split()) for t in left) < 280 - 55
    got = stages["substring"](spark, frame([(None, held[1]), (None, held[4])]), d).collect()
    assert sum(x.text in held for x in got) == 1


def test_stages_keep_clashing_columns_and_long_texts(spark, tables):
    """Columns that stages use themselves, a very long text, nulls and repeats."""
    d, text, planted, passage = tables
    r = random.Random(3)
    long = words(r, 40_000).capitalize() + "."
    rows = [(1, long, 3, "a", 2, 7), (2, None, None, None, None, None), (3, "", 1, "b", 0, 1),
            (4, f"{words(r, 80)} {planted[1003]}", 1, "c", 1, 1), (4, f"{words(r, 80)} {planted[1003]}", 2, "c", 1, 2)]
    schema = "doc_id long, text string, pipeline_row int, place string, n_chars long, row int"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, d)
        if name == "sentencepiece":
            assert got.columns[:2] == ["doc_id", "token_ids"]
            assert {x.doc_id: len(x.token_ids or []) for x in got.collect()}[1] > 40_000
            continue
        assert got.schema == docs.schema, name
        left = {(x.doc_id, x.pipeline_row, x.place, x.row) for x in got.collect()}
        assert left <= {(a, p, q, w) for a, _, p, q, _, w in rows}
        if name in ("substring", "decontaminate"):
            assert len(left) == 5 and {x.doc_id: x.text for x in got.collect()}[1] == long


def test_run_over_empty_tables(spark, tables, tmp_path):
    d = tables[0]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
