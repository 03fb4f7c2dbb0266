import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from weavemine.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def lib():
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, B.read_ranks(PATH).splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(5)
    vocab = [base64.b64decode(x.split()[0]).decode("utf-8", "ignore") for x in B.read_ranks(PATH).splitlines()]
    out = [None, "", " ", "\n", "  x", "x \n y", "it's  they'll\t\tgo ", "a\x1cb\x85c\xa0 d 　 e", "<|endoftext|> é漢字🙂 ́", "word " * 300_000, "q" * 30_000, "ab" * 20_000, " " * 5000 + "x", "=" * 999]
    out += ["".join(rnd.choice(vocab) if rnd.random() < 0.6 else rnd.choice(" aeioust'!1É\n  ") for _ in range(rnd.randrange(1, 60))) for _ in range(400)]
    out += ["".join(rnd.choice("abcehinorst"[: rnd.randrange(2, 11)]) for _ in range(rnd.randrange(1, 300))) for _ in range(300)]
    return out


def test_query_matches_the_library(spark, tmp_path, lib):
    rows = [(i if i % 50 else None, t, "x") for i, t in enumerate(texts() + ["Hello there"] * 3)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t, _ in rows:
        ids = lib.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode_bytes(ids)).hexdigest()))
    got = [tuple(r) for r in B.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_memo_generations_and_pieces_change_nothing(lib, monkeypatch):
    monkeypatch.setattr(B, "MEMO", 50)
    monkeypatch.setattr(B, "PIECE", 300)
    monkeypatch.setattr(B, "CELLS", 64)
    bpe = B.ByteBPE({lib.decode_single_token_bytes(r): r for r in range(lib.n_vocab)}, P.PATTERN)
    for t in texts()[:9] + texts()[14:214]:
        assert np.frombuffer(bpe.encode_texts([t, t])[1], np.uint32).tolist() == lib.encode_ordinary(t or "")


def test_every_kind_of_code_point(lib):
    bpe = B.loaded(B.read_ranks(PATH), P.PATTERN)
    t = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} " for c in range(k, min(k + 40, 0x110000)) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 40 * 13)]
    for a, ids in zip(t, bpe.encode_texts(t)):
        assert np.frombuffer(ids, np.uint32).tolist() == lib.encode_ordinary(a)


def plain(word, ranks):
    parts = [bytes([b]) for b in word]
    while True:
        joined = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joined:
            return [ranks[x] for x in parts]
        k = min(joined)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_merges_that_make_pairs_of_lower_rank_keep_their_order():
    rnd = random.Random(3)
    for _ in range(40):  # vocabularies in any order: later tokens may be parts of earlier ones
        made = sorted({bytes(rnd.choices(b"abc", k=rnd.randrange(2, 6))) for _ in range(25)})
        rnd.shuffle(made)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(made)}
        bpe = B.ByteBPE(ranks, r"\S+|\s+")
        words = [w for w in (bytes(rnd.choices(b"abc", k=rnd.randrange(1, 120))) for _ in range(40)) if w not in ranks]
        assert [np.frombuffer(x, np.uint32).tolist() for x in bpe.encode_words(words)] == [plain(w, ranks) for w in words]


def test_operator_keeps_columns_and_round_trips(spark, lib):
    df = spark.createDataFrame([(1, "some text", "x", 4.0), (2, None, "y", None)], "doc_id long, text string, ids string, z double")
    got = B.decode(B.encode(df, PATH, P.PATTERN), PATH).orderBy("doc_id").collect()
    assert got[0].ids == lib.encode_ordinary("some text") and bytes(got[0].decoded) == b"some text" and got[0].z == 4.0
    assert got[1].ids == [] and bytes(got[1].decoded) == b""
    assert B.encode(df.limit(0), PATH, P.PATTERN).count() == 0
