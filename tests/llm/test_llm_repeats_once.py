"""op3: bytes of stretches are exchanged once, sorted anchor after anchor, and sent once a task."""

import random

import pyarrow as pa
import pytest

from cadence.llm import repeats

WORDS = "storm river cloud meadow stone winter harvest lantern bridge copper".split()


def prose(pick, n):
    return " ".join(pick.choice(WORDS) + str(pick.randrange(90)) for _ in range(n))


def test_only_frequent_anchors_are_split(spark, monkeypatch):
    """Stretches of anchors within HOT never meet the steps that checkpoint and exchange them again."""
    pick = random.Random(5)
    passage = prose(pick, 40)
    texts = [f"{prose(pick, 30)} {passage} {prose(pick, 30)}" for _ in range(12)] + [prose(pick, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    given, settle = [], repeats.settle
    monkeypatch.setattr(repeats, "settle", lambda stretches, width: given.append(stretches.count()) or settle(stretches, width))
    want = None
    for hot in (2048, 4):
        monkeypatch.setattr(repeats, "HOT", hot)
        got = sorted(map(tuple, repeats.remove_repeats(df).collect()))
        assert want in (None, got)
        want = got
    assert given[0] == 0 and given[1] > 0
    assert all(len(passage) <= r[2] <= len(passage) + 30 for r in want[:12]) and want[12][2] == 0


@pytest.mark.parametrize("batch,shard", [(1, 1), (3, 400), (1000, 1 << 20)])
def test_sorting_anchor_after_anchor(monkeypatch, batch, shard):
    """Every window that starts twice is found, wherever batches end and however many anchors are sorted together."""
    monkeypatch.setattr(repeats, "SHARD", shard)
    pick, width, rows, want = random.Random(batch), 64, [], {}
    for a in range(40):
        shared = prose(pick, 30).encode()
        several = sorted({(i, shared[(k := pick.randrange(40)):k + pick.choice([64, 80, 110])]) for i in range(pick.choice([1, 2, 5]))})
        twins = [pick.random() < 0.2 for _ in several]
        for (i, data), twin in zip(several, twins):
            rows += [(a, a * 10 + i, 7, twin, data)] + [(a, a * 10 + i, 7, True, None)] * (k := pick.choice([0, 0, 2]))
            others = [o for j, o in several if j != i]
            windows = [twin or k > 0 or any(data[p:p + width] in o for o in others) for p in range(len(data) - width + 1)]
            want[a * 10 + i] = [p for p, hit in enumerate(windows) if hit]
    names = ["a", "c1", "c2", "twin", "data"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) if n != "data" else pa.array(c, pa.binary()) for n, c in zip(names, zip(*rows[p:p + batch]))], names=names) for p in range(0, len(rows), batch)]
    got = {r["c1"]: [p for h in r["hits"] for p in range(h["s"], h["s"] + h["n"])] for out in repeats.search_rows(iter(batches), width) for r in out.to_pylist()}
    assert got == {c: hits for c, hits in want.items() if hits}


def test_bytes_of_a_stretch_leave_a_task_once():
    pick = random.Random(9)
    passage = prose(pick, 60).encode()
    anchors = [int(x) for x in repeats.runs(passage, 200)[3].view("int64")]
    pack = repeats.zstandard.ZstdCompressor(level=1).compress
    texts = [prose(pick, 5).encode() + passage + prose(pick, 5).encode() for _ in range(6)]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "t1": i, "t2": i, "text": pack(t), "copies": 1, "anchors": anchors, "busy": [], "first": True} for i, t in enumerate(texts)])
    rows = [r for out in repeats.first_rows(iter([batch]), 200, False) for r in out.to_pylist()]
    stretches = [r for r in rows if r["kind"] == "stretch"]
    for c in {(r["c1"], r["c2"]) for r in stretches}:
        mine = [r for r in stretches if (r["c1"], r["c2"]) == c]
        assert [(r["data"] is not None, r["twin"]) for r in mine] == [(True, False), (False, True), *[(False, None)] * 4][:len(mine)]
    assert max(sum((r["c1"], r["c2"]) == (s["c1"], s["c2"]) for r in stretches) for s in stretches) == 6
    assert [r["data"] for r in rows if r["kind"] == "text"] == [pack(t) for t in texts]
