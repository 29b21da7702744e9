import base64
import os
import random

import numpy as np
import pytest

from trailmart.llm import tokens
from trailmart.llm.lexicon import Lexicon, build

FILE = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabularies")

TEXTS = [
    None, "", " ", "\n\n  \n", "Hello  world's   end", "don't we'll I'VE", "a" * 5000, "ab" * 700 + "c", "=" * 3000, " \t 　x  y\x85z\x1c\x1d", "<|endoftext|> plain",
    "日本語のテキスト。タイ語ไทยไม่มีช่องว่าง हिन्दी العربية", "👩‍👧 🙂✈️👍🏽", "123456 7,890.12 ½ ²", "�﻿​", "x\r\ny\r\n\r\n z", "\U0001e900\U0001e922 \U0002ebf0 new", "naïve café é é",
    "qV7+9v3bSEWLkIPazw3ycfKATy8MVMU7HcGew11gz3N4Ey/dSkEU7", "_" * 300 + "\n" + "-" * 77,
]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_lexicon_round_trip(tmp_path):
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abcd\xff ") for _ in range(rng.randrange(1, 9))) for _ in range(3000)} | {b"walking", b"talking", b"king"})
    ids = {w: [rng.randrange(50_000) for _ in range(rng.randrange(0, 4))] for w in words}
    path = tmp_path / "l.bin"
    path.write_bytes(build(words, ids))
    lexicon = Lexicon(str(path))
    asked = words + [b"", b"walkin", b"walkings", b"zzz", b"\x00"]
    data, starts, lengths = tokens._flat(asked)
    numbers = lexicon.find(data, starts, lengths)
    assert len(lexicon) == len(words) and (numbers[len(words) :] == -1).all()
    for word, n in zip(words, numbers, strict=False):
        assert lexicon.ids[lexicon.offsets[n] : lexicon.offsets[n + 1]].tolist() == ids[word]
    path.write_bytes(build([], {}))
    assert Lexicon(str(path)).find(data, starts, lengths).max() == -1


def test_suffixes_share_states(tmp_path):
    path = tmp_path / "l.bin"
    words = sorted(a + b for a in (b"walk", b"talk", b"jump") for b in (b"ing", b"ed", b"s"))
    path.write_bytes(build(words, {w: [1] for w in words}))
    assert len(Lexicon(str(path)).keys) < 20


def test_merges_are_exact(reference):
    rng = random.Random(3)
    merge = tokens.merger(tokens.vocabulary())
    words = ["".join(rng.choice("aehinorst lé日ไ9=A") for _ in range(rng.randrange(1, 60))).encode() for _ in range(1500)] + [b"a" * 255, b"ab" * 200, b"the" * 400, "日本".encode() * 300]
    ids, counts = merge.merge_all(*tokens._flat(words))
    ends = np.cumsum(counts)
    import tiktoken

    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    for word, end, count in zip(words, ends, counts, strict=True):
        try:
            text = word.decode()
        except UnicodeDecodeError:
            continue
        assert ids[end - count : end].tolist() == whole(text), text
        assert merge.merge_long(word) == whole(text), text


@pytest.mark.parametrize("limit", [0, 4, 1 << 15])
def test_ids_equal_the_public_tokenizer(spark, reference, limit):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS + TEXTS)], "doc_id long, text string, ids string")
    found = {r["doc_id"]: r["ids"] for r in tokens.encode(df, limit=limit).collect()}
    assert len(found) == 2 * len(TEXTS)
    for i, text in enumerate(TEXTS + TEXTS):
        assert found[i] == (reference(text) if text else []), text
    counts = {r["doc_id"]: r["tokens"] for r in tokens.encode(df, limit=limit, only_counts=True).collect()}
    assert counts == {i: len(x) for i, x in found.items()}


def test_empty_table(spark):
    assert tokens.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_corpus(spark, data, reference):
    df = spark.read.parquet(f"{data}/documents.parquet")
    found = {r["doc_id"]: r["ids"] for r in tokens.encode(df).collect()}
    assert found == {r["doc_id"]: reference(r["text"]) if r["text"] else [] for r in df.collect()}
