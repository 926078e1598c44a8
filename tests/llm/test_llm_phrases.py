"""Phrase collocations against a brute-force count, with buffers and steps small enough to break texts anywhere."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cadence.llm import phrases

SCHEMA = "doc_id long, text string, lang string, a int, rank int, phrase string, c long, shard int, data int, n int"


def made(spark, docs, parts=3):
    return spark.createDataFrame([(i, t, lang, 1, 2, "x", 3, 4, 5, 6) for i, (t, lang) in enumerate(docs)], SCHEMA).repartition(parts)


def brute(docs, longest=3, min_count=10, cover=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = [p for p, a in count.items() if len(p) > 1 and a >= min_count]
        rows = []
        for p in cand:
            a = count[p]
            around = [q for q in cand if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * count[q] >= cover * a for q in around):
                continue
            score, _, le, r = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), le, r))
        out += [(lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def prose(pick, n):
    words = ["the", "The", "cat", "SAT", "on", "mat", "é", "ÉÉ", "中文", "a.b", "x\x85y", "dog", "🙂"]
    return "".join(pick.choice(words) + pick.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "; ", "\x0b", "! ?", "\r\n", "\x00 "]) for _ in range(n))


@pytest.mark.parametrize(("longest", "shards", "held", "step"), [(2, 1, 50, 7), (3, 4, 1 << 21, 1 << 20), (3, 3, 40, 11), (4, 6, 30, 5)])
def test_phrases_match_brute_force(spark, longest, shards, held, step):
    pick = random.Random(longest * 10 + shards)
    docs = [(prose(pick, pick.randrange(60)), pick.choice(["en", "en", None, "", "zh"])) for _ in range(60)]
    docs += [(None, "en"), ("", None), (" \t\n", "en"), ("the cat sat on the mat", "en"), *[("a lonely copied line", "en")] * 12, ("word " * 300, "en")]
    assert got(phrases.collocations(made(spark, docs), longest=longest, min_count=10, shards=shards, held=held, step=step)) == brute(docs, longest)


def test_a_full_bitmap_and_low_support_change_nothing(spark, monkeypatch):
    pick = random.Random(5)
    docs = [(prose(pick, 40), "en") for _ in range(30)]
    want = brute(docs, 3, 3, 70, 25)
    real = phrases.bitmap
    monkeypatch.setattr(phrases, "bitmap", lambda keys, shards, size: real(keys, shards, size, most=64))
    assert got(phrases.collocations(made(spark, docs), min_count=3, cover=70, top=25, shards=2)) == want


def test_products_beyond_64_bits_are_exact(spark):
    big = 3_000_000_019
    known = spark.createDataFrame([("en", "", 0, 9 * big), ("en", "x", 1, big + 1), ("en", "y", 1, big + 2), ("en", "x y", 2, big)], "lang string, phrase string, size int, f long")
    original, phrases.frequent_phrases = phrases.frequent_phrases, lambda *a, **k: known
    try:
        assert got(phrases.collocations(spark.range(0))) == [("en", 1, "x y", big, big + 1, big + 2, 9 * big, 1_000_000 * big * big // ((big + 1) * (big + 2)))]
    finally:
        phrases.frequent_phrases = original


def test_empty_table_and_long_text(spark):
    assert phrases.collocations(made(spark, [("x", "en")]).where("doc_id < 0")).collect() == []
    text = "alpha beta, gamma delta epsilon " * 40_000  # over one step
    assert got(phrases.collocations(made(spark, [(text, "en")]))) == brute([(text, "en")])
    assert [r[:3] for r in got(phrases.collocations(made(spark, [("w" * 3_000_000 + " b " + "w" * 3_000_000, "en"), *[("b c", "en")] * 10])))] == [("en", 1, "b c")]
