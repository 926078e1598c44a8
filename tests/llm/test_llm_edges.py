"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cadence.llm import decontaminate, extraction, fingerprints, language, line_dedup, packing, repeats, simhash, token_counts, toxicity

EXTRA = ("score", "n_tokens", "fp", "spans", "start", "sequence_id", "leak_items", "component_id", "held_out", "_text", "_b", "a", "data", "next_text", "tox_score")
LONG = "alpha beta gamma delta " * 12_000
TEXTS = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, LONG, "en"), (5, "x", "de"), (5, "x", "de"), (None, "the cat sat on the mat", None),
         (7, "the cat sat on the mat", "en"), (8, "Ünïcode ▁ ‹|endoftext|› <|endoftext|> </s>  two  spaces\r\nline\n\n", "fr"), (9, "\x00\x1f weird ​́ 中文字 🙂🙂", None),
         (10, "The Cat sat\non the mat", "en"), (-3, "one two three four five six", "de")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(7).alias(c) for c in EXTRA]).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (4, 0), (5, None), (7, 1), (None, 1), (7, 1)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat"), (2, None), (3, ""), (4, "x"), (4, "x"), (5, "not in any document at all")], "item_id int, text string")


OPS = {
    "token_counts": (lambda d, lab, it: token_counts.token_counts(d), ["doc_id", "n_bytes", "n_tokens", "over_limit"]),
    "fingerprints": (lambda d, lab, it: fingerprints.edited_fingerprints(d), ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles"]),
    "repeats": (lambda d, lab, it: repeats.remove_repeats(d), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "toxicity": (lambda d, lab, it: toxicity.toxicity(d, lab), ["doc_id", "held_out", "score", "predicted", "n_passages"]),
    "language": (lambda d, lab, it: language.identify(d), ["doc_id", "held_out", "lang_pred", "score"]),
    "simhash": (lambda d, lab, it: simhash.near_dedup(d), ["doc_id", "fingerprint", "component_id"]),
    "line_dedup": (lambda d, lab, it: line_dedup.line_dedup(d, min_docs=2), ["doc_id", "text", "n_lines", "n_dropped"]),
}


@pytest.mark.parametrize("name", OPS)
def test_one_row_for_each_row(name, docs, labels, items):
    run, columns = OPS[name]
    got = run(docs, labels, items)
    assert got.columns == columns
    rows = got.collect()
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in rows), key=key) == sorted((t[0] for t in TEXTS), key=key)


@pytest.mark.parametrize("name", OPS)
def test_empty_table(name, nothing, spark):
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    assert OPS[name][0](nothing, lab, None).count() == 0


def test_empty_tables_of_the_others(nothing, spark):
    assert packing.pack(nothing).count() == 0
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.leaks(nothing, none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert extraction.main_text(pages).count() == 0


def test_no_labels_means_no_toxic_text(docs, spark):
    rows = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(rows) == len(TEXTS) and all(r.score < 0.5 and r.predicted == 0 for r in rows)


def test_no_benchmark_means_no_leak(docs, spark):
    assert decontaminate.leaks(docs, spark.createDataFrame([], "item_id int, text string")).count() == 0


def test_leaks_of_short_and_null_items(docs, items):
    got = sorted((r.doc_id or -1, r.item_id, r.containment) for r in decontaminate.leaks(docs, items).collect())
    assert got == sorted([(-1, 1, 1.0), (7, 1, 1.0), (10, 1, 1.0), *[(5, 4, 1.0)] * 4])


def test_language_without_letters_is_und(docs):
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1, 2, 3))
    assert all(0 <= r.score <= 1 for r in got.values())


def test_packing_covers_every_row(docs):
    from collections import Counter

    rows = packing.pack(docs).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(t[0] for t in TEXTS)
    assert all(r.length > 0 for r in rows)
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}


def test_pages_with_nulls_repeats_and_broken_markup(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title &amp; more</h1><p>First  line,\n of text.<p>Second &lt;b&gt; line.</article><footer>&copy; me</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<<<>>> </p></div>"), (None, "u", page), (6, "u", "plain"), (7, "u", "<article><p>" + "long text. " * 30_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("text"), F.lit(2).alias("n_chars"))
    got = extraction.main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == "" for r in got if r.page_id in (2, 3))
    assert [r.text for r in got if r.page_id == 1] == ["Title & more\n\nFirst line, of text.\n\nSecond <b> line."] * 2


def marked(k):
    return f"<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav><article><h1>Title {k}</h1><p>Line {k} of text, and more of it.</p></article><footer>me</footer></body></html>"


@pytest.mark.parametrize("form", ["<body>", "<BODY class='x'>", "", "<noscript><img src='p'></noscript><body>", "<template><p>no</p></template><script>no()</script><body>"])
def test_a_head_without_end_tag_holds_no_text(form):
    closed, opened = (extraction.blocks(marked(3).replace("</head><body>", x)) for x in ("</head><body>", form))
    assert [b[1:] for b in opened] == [b[1:] for b in closed] and len(closed) == 4
    assert all("t:head" not in b[0] and "t:title" not in b[0] for b in opened)


def test_text_of_formulas_objects_and_noscript_is_judged(spark):
    inner = ("<p>The area is <math><mi>a</mi><mo>=</mo><mn>2</mn></math> here, <svg><title>no</title><text>drawn</text></svg>.</p>"
             "<object data='x'><p>An object with a sentence of its own.</p></object><noscript><p>A paragraph for those without scripts.</p></noscript>"
             "<script>no()</script><style>no{}</style><template><p>no</p></template><textarea>no</textarea><select><option>no</select></article>")
    rows = [(k, "u", marked(k)) for k in range(30)] + [(100, "u", marked(100).replace("</article>", inner)), (101, "u", marked(101).replace("</head><body>", "<body>"))]
    got = {r.page_id: r.text for r in extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[100].split("\n\n") == ["Title 100", "Line 100 of text, and more of it.", "The area is a=2 here, drawn.", "An object with a sentence of its own.",
                                      "A paragraph for those without scripts."]
    assert got[101] == "Title 101\n\nLine 101 of text, and more of it."


def test_training_pages_are_found_among_unmarked_ones(spark, monkeypatch):
    """Few marked pages, one of them in a third of the rows: the sample is full, bounded and holds copies once."""
    given = []
    monkeypatch.setattr(extraction, "train", lambda labelled, train=extraction.train: given.append(len(labelled)) or train(labelled))
    rows = [(k, "u", "<html><body><div><p>plain</p></div></body></html>") for k in range(3000)]
    rows += [(5000 + k, "u", marked(k)) for k in range(12)] + [(5000, "u", marked(0))] * 1500
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in extraction.main_text(df, fit_pages=8).where("page_id >= 5000").collect()}
    assert given == [6 * 8] and got == {5000 + k: f"Title {k}\n\nLine {k} of text, and more of it." for k in range(12)}
    extraction.fit(df, fit_pages=200)
    assert given[1:] == [6 * 12]


def test_repeated_rows_are_copies(docs):
    got = {(r.doc_id, r.n_bytes): r for r in repeats.remove_repeats(docs).collect()}
    long = got[(4, len(LONG))]
    assert (long.n_removed, long.n_spans, long.kept_sha256) == (len(LONG), 1, hashlib.sha256(b"").hexdigest())


def test_representatives_keep_one_of_each_component(docs):
    got = simhash.representatives(docs)
    assert got.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    assert len(rows) == len({simhash.fingerprint(t) for _, t, _ in TEXTS})
    assert (1, None) in rows and (7, "the cat sat on the mat") in rows and (5, "x") in rows
