import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weavemine.llm import automaton as A

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n", "Hello, WORLD's they're 12 x²", "aaaaaaaaaaaaab ab" * 50, "ΣΑΣ final Σ", "éÅ あ漢字🙂", "a\x1cb\x85c\xa0d", "x<|endoftext|>Y <|startoftext|><|", "don't", "word " * 300_000, "q" * 5000]


def fuzz(n):
    rnd = random.Random(11)
    vocab = [s.replace("</w>", "") for s in json.load(open(PATH))["model"]["vocab"]]
    return ["".join(rnd.choice(vocab) if rnd.random() < 0.6 else rnd.choice(" aeioust'!1É\n") for _ in range(rnd.randrange(1, 30))) for _ in range(n)]


def test_query_matches_the_library(spark, tmp_path):
    texts = TEXTS + fuzz(400) + ["Hello"] * 3
    rows = [(i if i % 50 else None, t, "ids") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, k string").write.parquet(f"{tmp_path}/documents.parquet")
    lib = Tokenizer.from_file(PATH)
    want = []
    for d, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in A.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_operator_keeps_columns_and_round_trips(spark):
    df = spark.createDataFrame([(1, "some text", "x", 4.0)], "doc_id long, text string, ids string, z double")
    r = A.encode(df, PATH, decoded="decoded").first()
    lib = Tokenizer.from_file(PATH)
    assert r.ids == lib.encode("some text", add_special_tokens=False).ids and r.decoded == lib.decode(r.ids) and r.z == 4.0


def plain_bpe(symbols, ranks):
    s = list(symbols)
    while True:
        best = min(((ranks[a, b], i) for i, (a, b) in enumerate(zip(s, s[1:])) if (a, b) in ranks), default=None)
        if best is None:
            return s
        i = best[1]
        s[i : i + 2] = [s[i] + s[i + 1]]


def test_automaton_on_random_rules():
    for seed in range(60):
        rnd = random.Random(seed)
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 25:
            a, b = rnd.choice(tokens), rnd.choice(tokens)
            if a + b not in tokens and len(a + b) < 9:
                merges.append((a, b))
                tokens.append(a + b)
        m = A.MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges, "")
        ranks = {p: k for k, p in enumerate(merges)}
        for _ in range(80):
            w = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 16)))
            assert [tokens[i] for i in m.encode_word(w)] == plain_bpe(w, ranks)


def test_rules_out_of_order_are_refused():
    with pytest.raises(ValueError):
        A.MergeAutomaton({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")], "")


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert A.query(spark, str(tmp_path)).count() == 0


def test_every_kind_of_code_point_splits_as_in_the_library():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 11 == 0 or c in A.LOWER_NEW or A.NEWER_AT.match(chr(c)))]
    texts = [f"ab{chr(c)}1{chr(c)}c" for c in points]
    own = A.loaded(A.read_spec(PATH))
    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert [hex(c) for c, t, f in zip(points, texts, found) if np.frombuffer(own.encode_bytes(t), np.uint32).tolist() != f.ids] == []


class Counted(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


def test_words_that_begin_alike_share_their_states():
    m = A.Tokenizer(json.loads(A.read_spec(PATH))).automaton
    m.inner = Counted(m.inner)
    words = [f"thionderestalbleof{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    lib = Tokenizer.from_file(PATH).encode_batch(words, add_special_tokens=False)
    assert [m.encode_word(w) for w in words] == [x.ids for x in lib]
    assert m.inner.asked < 3 * len(words)


def test_long_words_and_a_small_table_of_beginnings(monkeypatch):
    monkeypatch.setattr(A, "PATHS", 5)
    own, lib, rnd = A.Tokenizer(json.loads(A.read_spec(PATH))), Tokenizer.from_file(PATH), random.Random(5)
    words = ["".join(rnd.choice(["th", "e", "ion", "q", "an", "s"]) for _ in range(k))[: A.NEAR - 8 + k % 17] for k in range(20, 200)] + ["a" * k for k in range(1, 80)]
    texts = words + [f"({w}.,' {w}'s! {w}\x1c{w}" for w in words[:20]] + ["Ᲊb.", "\x1dᲉ b", "éꟋ1", "it's", "a''", "a'sb.", "1''", "\x7fa.", "\x00a"]
    assert [np.frombuffer(own.encode_bytes(t), np.uint32).tolist() for t in texts] == [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
