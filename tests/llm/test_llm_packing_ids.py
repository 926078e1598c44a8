"""Ids of packed texts: pre-tokens are learnt together, each once, and the ids are the tokenizer's own."""

import numpy as np

from cadence.llm import packing


def test_ids_are_the_tokenizers_and_known_ones_are_not_learnt_again(monkeypatch):
    ids = packing.Ids("byte_bpe_50k.json")
    learnt = []
    learn = ids.learn
    monkeypatch.setattr(ids, "learn", lambda units: (learnt.append(units), learn(units))[1])
    texts = ["", "It's an odd  one, isn't it?\n\n 12 Œuvres\t", " \n", "ends <|endoftext|> inside", "a 日本 text ", "a b a b 'll 's", "x" * 300, *(f"w{i} v{i}" for i in range(700))]
    want = [np.array(ids.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(ids.encode(texts)) == want and len(learnt) == 1 and len(learnt[0]) == len(set(learnt[0]))
    assert list(ids.encode(texts)) == want and len(learnt) == 1
    assert list(ids.encode([texts[1], "w1 new"])) == [want[1], np.array(ids.tok.encode("w1 new", add_special_tokens=False).ids, "<u4").tobytes()]
    assert learnt[1:] == [[" new"]]
    monkeypatch.setattr(packing, "CACHE", 3)  # the cache is emptied while ids of known pre-tokens are held
    assert list(ids.encode([texts[1], "w1 newer"]))[0] == want[1]
