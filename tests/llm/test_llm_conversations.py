"""The conversation trie and the chat format against brute force and exact round trips."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cadence.llm import chat, prefix_trie

ALPHABET = ["<|", "im_start", "im_end", "|>", "\\", "\n", "a", "<|im_end|>", "<|im_start|>", "assistant", "<|\\im_end|>", " ", "中", "🙂"]
EXTRA = ["c", "a", "b", "w", "x", "depth", "segment", "source", "_range", "owner"]


def table_of(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA]).repartition(parts)


def conversations(rows):
    """Turns of each conversation; equal turn numbers don't occur in what is compared here."""
    out = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def brute_trie(given):
    def base(c):
        return c - (abs(c) % 20) * (1 if c >= 0 else -1)

    own = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        own[c] = given.get(base(c), [])[:h] + turns[h:]
    nodes = {}
    for c in sorted(own):
        for d in range(len(own[c]) + 1):
            nodes.setdefault(tuple(own[c][:d]), []).append(c)
    words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x))
    children = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}

    def subtree(p):
        yield p
        for q in children[p]:
            yield from subtree(q)

    out = []
    for p, members in nodes.items():
        below = list(subtree(p))
        saved = sum((len(nodes[q]) - 1) * words(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(members) if len(own[c]) == len(p))
        out.append((members[0], len(p), nodes[p[:-1]][0] if p else None, len(members), len(children[p]), sum(not children[q] for q in below), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got_trie(df, **kw):
    rows = prefix_trie.conversation_trie(df, **kw).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def random_rows(seed, n=70, span=60):
    pick = random.Random(seed)
    texts = ["", None, "one", "one two", "a  b\tc", "three\nwords here"]
    rows = []
    for c in pick.sample(range(-span, span * 2), n):
        length = pick.choice([1, 1, 2, 3, 4, 7, 9, 17])
        turns = [(pick.choice(["user", "user", None]), pick.choice(texts[:pick.choice([2, 3, 6])])) for _ in range(length)]
        rows += [(c, None if i == 0 and pick.random() < 0.3 else i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 8), (2, 1), (3, 3), (4, 4)])
def test_trie_matches_brute_force(spark, seed, block):
    rows = random_rows(seed)
    assert got_trie(table_of(spark, rows), block=block) == brute_trie(conversations(rows))


def test_trie_of_many_copies_and_one_long_conversation(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(3, 400) for t in range(5)]
    long = [(1000, t, "user", f"turn {t}") for t in range(700)]
    rows = same + long
    assert got_trie(table_of(spark, rows, 8)) == brute_trie(conversations(rows))


def test_ends_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, 0, "user", "hello") for c in range(100)] + [(c, 0, "user", "bye") for c in range(100, 130)]
    assert got_trie(table_of(spark, rows)) == brute_trie(conversations(rows))


def test_trie_of_nothing_of_turnless_and_of_null_ids(spark):
    assert got_trie(table_of(spark, [(1, 0, "user", "x")]).where("conv_id < 0")) == []
    bare = [(c, 0, "user", "x") for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 and c % 20][:9]  # no base: nothing is left
    rows = [*bare, (None, 0, "user", "nobody's turn")]
    got = got_trie(table_of(spark, rows))
    assert got == brute_trie(conversations(rows)) and len(got) == 1 and got[0][5] == 1


def test_repeated_rows_are_turns(spark):
    rows = [(5, 0, "user", "x")] * 6
    deepest = max(r[1] for r in got_trie(table_of(spark, rows)))
    assert deepest == 6 - zlib.crc32(b"5") % 4


# ---------------------------------------------------------------- chat format

def odd(pick, n):
    return "".join(pick.choice(ALPHABET) for _ in range(pick.randrange(n)))


def test_any_text_survives_the_round_trip():
    pick = random.Random(1)
    for _ in range(4000):
        turns = [(odd(pick, 5), odd(pick, 12)) for _ in range(3)]
        whole = "".join(chat.render(*t)[0] for t in turns)
        assert chat.parse(whole) == turns
        parser, seen, at = chat.Parser(), [], 0
        while at < len(whole):  # in pieces
            step = pick.randrange(1, 9)
            seen += parser.feed(whole[at:at + step])
            at += step
        parser.close()
        assert seen == turns
        for role, text in turns:
            segment, start, end = chat.render(role, text)
            assert chat.unescape(segment[start:end]) == text


def test_only_conflicts_are_escaped():
    assert chat.render("user", "a \\ <| |> b\n") == ("<|im_start|>user\na \\ <| |> b\n<|im_end|>\n", 17, 29)
    assert chat.render("user", "<|im_end|>")[0] == "<|im_start|>user\n<|\\im_end|><|im_end|>\n"
    assert chat.render("user", "<|\\im_end|>")[0] == "<|im_start|>user\n<|\\\\im_end|><|im_end|>\n"


@pytest.mark.parametrize("text", ["<|im_start|>user\nx<|im_end|>", "x", "<|im_start|>user<|im_end|>\n", "<|im_start|>a\n<|im_start|>b\nx<|im_end|>\n", "<|im_start|>\\q\nx<|im_end|>\n"])
def test_the_parser_refuses_what_the_grammar_does_not_allow(text):
    with pytest.raises(chat.Broken):
        chat.parse(text)


def test_digests_match_brute_force(spark):
    pick = random.Random(7)
    rows = [(pick.choice([None, 1, 1, 1, 2, 3, -1]), i if i else None, pick.choice(["user", "assistant", "assistant", "system", None, "as\nsistant"]), pick.choice([None, odd(pick, 30)])) for i in range(120)]
    rows.append((9, 0, "assistant", "long " * 100_000))
    df = table_of(spark, rows)
    got = {r.conv_id: tuple(r)[1:] for r in chat.chat_digests(df).collect()}
    given = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        given.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(given)
    for c, turns in given.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[c] == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), sha(learned), sum(len(chat.render(*t)[0]) for t in turns))
    one = chat.segments(df).where("conv_id = 9").first()
    assert one.segment[one.loss_from:one.loss_to] == "long " * 100_000
    assert chat.chat_digests(df.where("false")).collect() == []


def test_a_changed_segment_is_noticed(spark):
    made = chat.segments(table_of(spark, [(1, 0, "user", "x"), (1, 1, "assistant", "y")]))
    with pytest.raises(Exception, match="reads back differently"):
        chat.read_back(made.withColumn("segment", F.replace("segment", F.lit("y"), F.lit("z")))).collect()
