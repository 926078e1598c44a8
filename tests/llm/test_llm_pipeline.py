"""Each stage of the pipeline on what the one before kept, against the operators' brute-force rules."""

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cadence.llm import packing, simhash, toxicity
from cadence.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
    names = set(E.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}


def test_columns_stay(kept):
    for before, after in kept[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go(kept, spark):
    before, after = kept[0]
    bad = {r.doc_id for r in toxicity.toxicity(before, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert bad and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad


def test_repeated_lines_go(kept):
    before, after = ({r.doc_id: r for r in x.collect()} for x in kept[1])
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    held = {}
    for r in before.values():
        for k in {key(x) for x in (r.text or "").split("\n")} - {""}:
            held[k] = held.get(k, 0) + 1
    assert set(after) == set(before)
    for k, r in after.items():
        assert r.text == "\n".join(x for x in before[k].text.split("\n") if held.get(key(x), 0) < 10) and r.n_chars == len(r.text)


def test_one_of_each_component_stays(kept):
    rows = sorted(((r.doc_id, simhash.fingerprint(r.text)) for r in kept[2][0].collect()))
    fp = np.array([f for _, f in rows], np.uint64)
    label = np.arange(len(fp))
    while True:
        new = np.array([label[np.bitwise_count(f ^ fp) <= 3].min() for f in fp])
        if (new == label).all():
            break
        label = new
    assert sorted(r.doc_id for r in kept[2][1].collect()) == [rows[k][0] for k in sorted(set(label))]


def test_leaks_go(kept, spark):
    before, after = kept[3]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    words = {k: toxicity.words(t) for k, t in items}
    sets = {k: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for k, w in words.items()}
    want = set()
    for r in before.collect():
        w = toxicity.words(r.text)
        own = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        if not any(s and len(s & own) >= 0.8 * len(s) for s in sets.values()):
            want.add(r.doc_id)
    assert {r.doc_id for r in after.collect()} == want and len(want) < before.count()


def test_all_kept_text_is_packed(kept):
    tok = packing.tokenizer("byte_bpe_50k.json")
    want = {r.doc_id: len(tok.tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept[4][0].collect()}
    got = {}
    for r in kept[4][1].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_run_is_the_stages(kept, spark):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == \
        sorted(map(tuple, kept[-1][1].select("doc_id", "start", "length", "ids_crc32").collect()))


# ---------------------------------------------------------------- edges of every stage

CLASH = ["n_lines", "n_dropped", "tox_score", "tox_passages", "leak_items", "leak_shares", "_fp", "_least", "_root", "_k", "_in0", "fp", "start", "score", "_lines"]
LONG = "alpha beta gamma delta " * 9000
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one two three four"), (5, "one two three four"), (None, "nobody wrote this line"), (7, "the line\nanother text here")]
SHARED = [(20 + k, f"A shared line\nown words {k} of document {k * k} and {k * 7}") for k in range(12)]


def edge_docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "length(text) AS n_chars")
    return df.selectExpr("*", *[f"concat('{c}-', coalesce(doc_id, 0)) AS `{c}`" for c in CLASH]).repartition(3)


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_columns_rows_and_clashing_names(spark, number):
    docs = edge_docs(spark, ROWS + SHARED)
    out = corpus_pipeline.STAGES[number][1](spark, docs, SF)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows, before = out.collect(), docs.collect()
    assert all(r[c] == f"{c}-{r.doc_id or 0}" for r in rows for c in CLASH)
    ids = sorted(r.doc_id or 0 for r in rows)
    if number in (0, 3):  # nothing toxic, no item: all rows stay as they are
        assert sorted(map(str, rows)) == sorted(map(str, before))
    elif number == 1:
        assert ids == sorted(r.doc_id or 0 for r in before)
        for r in rows:
            was = next(b for b in before if b.doc_id == r.doc_id)
            shared = (r.doc_id or 0) >= 20
            assert r.text == (was.text.split("\n")[1] if shared else was.text) and r.n_chars == (len(r.text) if shared else was.n_chars)
    else:  # one row of each component; the texts without a word are one
        comp = {r.doc_id: r.component_id for r in simhash.near_dedup(docs.select("doc_id", "text")).collect()}
        assert len(rows) == len(set(comp.values())) and len([i for i in ids if i == 5]) == 1 and {1, 2, 3} & set(ids) == {1}


@pytest.mark.parametrize("number", range(5))
def test_stages_of_an_empty_table(spark, number):
    docs = edge_docs(spark, ROWS).where("doc_id = 10000")
    out = corpus_pipeline.STAGES[number][1](spark, docs, SF)
    assert out.collect() == [] and (number == 4 or out.columns == docs.columns)


def test_lines_go_without_a_count_of_characters(spark):
    docs = edge_docs(spark, SHARED).select("text", "doc_id")
    out = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert out.columns == ["text", "doc_id"] and not [r for r in out.collect() if "shared" in r.text]


def test_packing_covers_every_row(spark):
    docs = edge_docs(spark, ROWS)
    got = packing_rows = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS} and len([r for r in packing_rows if r.doc_id == 5]) >= 2

